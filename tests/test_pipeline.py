"""Whole builds from delivered files."""

import datetime as dt
import random
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratamart.operators.storage import shared_folder
from stratamart.plans import gold, marts, pipeline, silver
from stratamart.plans.checks import ChecksFailed
from stratamart.schemas import LISTING_COLUMNS, REFERENCE_FILES
from stratamart.sources.bronze import listings_schema, load_listings_label, load_listings_period, load_reference
from stratamart.sources.tables import Warehouse
from stratamart.streaming.arrivals import load_arrivals

LABELS = ("11_2020", "12_2020", "01_2021", "02_2021")
PERIODS = [dt.date(2020, 11, 1), dt.date(2020, 12, 1), dt.date(2021, 1, 1), dt.date(2021, 2, 1)]
AREAS = ["Mosman", "Ryde", "North Sydney", "Fairfield", "Camden", "Penrith", "Burwood"]


def listing_line(draw, listing, day):
    host = listing % 9 + 1 if listing <= 45 else 100 + listing
    return ",".join(
        [
            str(listing), f"{day:%Y%m%d}", f"{day:%Y-%m-%d}", str(host) if listing % 17 else "",
            f'"Host, {host}"', "14/2/2012", draw.choice("tf"),
            draw.choice([*AREAS, "Paris", "", "Suburbia"]), AREAS[listing % 7],
            draw.choice(["House", "Flat"]), draw.choice(["Private room", "Entire home"]),
            str(draw.randrange(1, 5)), f'"${draw.randrange(50, 3000):,}.00"', draw.choice(["t", "t", "f", ""]),
            str(draw.randrange(31)), str(draw.randrange(90)), draw.choice(["90", "80", ""]),
            "10", "9", "10", "9", "10",
        ]
    )


def write_deliveries(folder, seed=1):
    draw = random.Random(seed)
    for name, layout in REFERENCE_FILES.items():
        path = folder / layout.path
        path.parent.mkdir(parents=True, exist_ok=True)
        codes = [str(10000 + 10 * i) for i in range(len(AREAS))]
        if name == "lga_code_raw":
            lines = [f"{c},{a}" for c, a in zip(codes, AREAS)]
        elif name == "lga_suburb_raw":
            lines = [f"{AREAS[0]},Suburbia,,", f"{AREAS[1]},Suburbia,,", f"{AREAS[2]},Fairfield,,"]
        elif name == "census_g02_raw":
            lines = [f"LGA{c},{30 + i},{100 + i},1,2,3,0.8,4,2.5" for i, c in enumerate(codes)]
        else:
            lines = [f"LGA{c}," + ",".join(["5"] * 108) for c in codes]
        path.write_text("\n".join([",".join(layout.columns), *lines]) + "\n")
    for label, period in zip(LABELS, PERIODS):
        lines = []
        for listing in range(1, 61):
            if draw.random() < 0.25:
                continue
            lines.append(listing_line(draw, listing, period + dt.timedelta(days=draw.randrange(27))))
        if label == "12_2020":  # rows of February arrive early, some come again in their own file
            lines += [listing_line(draw, i, dt.date(2021, 2, 3)) for i in range(1, 20)]
        path = folder / "listings" / f"{label}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([",".join(LISTING_COLUMNS), *lines]) + "\n")
    return str(folder)


def content(frame):
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=str)


def state(warehouse):
    """Stored tables, dimensions and marts."""
    found = pipeline.tables(warehouse)
    return {name: content(frame) for name, frame in found.items() if not name.startswith("bronze.")}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("built")
    deliveries = write_deliveries(folder / "in")
    warehouse = Warehouse(spark, str(folder / "warehouse"))
    loaded = pipeline.backfill(warehouse, deliveries, checked=False)
    pipeline.check(warehouse)
    return warehouse, deliveries, loaded, state(warehouse)


def test_backfill_loads_every_file_in_date_order(built):
    _, _, loaded, _ = built
    assert list(loaded) == [*REFERENCE_FILES, *LABELS]
    assert loaded["lga_suburb_raw"] == 3 and loaded["12_2020"] > 19


def test_monthly_history_equals_the_one_pass_history(spark, built):
    warehouse, _, _, after = built
    listings = warehouse.read("silver.silver_listings")
    once = gold.dim_listing(gold.listing_versions(listings))
    assert content(once) == after["gold.dim_listing"]
    hosts = gold.dim_host(gold.host_versions(listings))
    assert content(hosts) == after["gold.dim_host"]


def test_building_month_by_month_equals_building_at_once(spark, built, tmp_path):
    _, deliveries, _, after = built
    warehouse = Warehouse(spark, str(tmp_path / "again"))
    for name, layout in REFERENCE_FILES.items():
        load_reference(warehouse, f"{deliveries}/{layout.path}", name)
    for label in reversed(LABELS):
        load_listings_label(warehouse, f"{deliveries}/listings", label)
    pipeline.build(warehouse, history="all")
    assert state(warehouse) == after
    pipeline.check(warehouse)


def test_repeating_a_build_changes_nothing(built):
    warehouse, deliveries, _, after = built
    load_listings_label(warehouse, f"{deliveries}/listings", LABELS[-1])
    pipeline.build(warehouse, changed=[PERIODS[-1]])
    pipeline.check(warehouse)
    assert state(warehouse) == after
    pipeline.build(warehouse)
    assert state(warehouse) == after


def slices(warehouse, table):
    """The version that holds each slice."""
    return {name.split("=")[-1]: version for name, version in warehouse._pointer(table).slices.items()}


def test_only_due_slices_of_marts_are_read_and_written(spark, built, tmp_path):
    shutil.copytree(built[0].root, tmp_path / "warehouse")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    before = {table: slices(warehouse, table) for table in pipeline.MARTS}
    load_listings_label(warehouse, f"{built[1]}/listings", LABELS[-1])
    pipeline.build(warehouse, changed=[PERIODS[-1]])
    for table in pipeline.MARTS:
        after = slices(warehouse, table)
        assert [m for m, version in after.items() if version != before[table][m]] == [str(PERIODS[-1])]
    # a month in the middle: the month in which a group is seen next gets new changes, as it compares with it
    stored, keys = warehouse.read(pipeline.MARTS[1]), marts.PROPERTY_KEYS
    rows, wanted = marts.refreshed_slices(warehouse.read("gold.int_listing_month"), stored, keys, {PERIODS[1]})
    assert PERIODS[2] in wanted and PERIODS[0] not in wanted
    assert content(rows) == content(stored.where(F.col("month").isin(list(wanted))))
    rows, wanted = marts.refreshed_slices(warehouse.read("gold.int_listing_month"), stored, keys, {PERIODS[3]})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "listing_id" not in line and "host_id" in line]
    assert wanted == {PERIODS[3]} and scans
    assert all("PartitionFilters: [isnotnull(month" in line and str(PERIODS[3]) in line for line in scans)


def test_early_rows_are_not_published_before_their_month(spark, tmp_path):
    deliveries = write_deliveries(tmp_path / "in")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for name, layout in REFERENCE_FILES.items():
        load_reference(warehouse, f"{deliveries}/{layout.path}", name)
    for position, label in enumerate(LABELS[:2]):
        load_listings_label(warehouse, f"{deliveries}/listings", label)
        pipeline.build(warehouse, changed=[PERIODS[position]] if position else None)
    february = F.lit(PERIODS[3])
    found = pipeline.tables(warehouse)
    assert found["silver.silver_listings"].where(F.col("month_key") == february).count() == 19
    assert found["gold.fact_listing_monthly"].where(F.col("snap_month") == february).count() == 0
    assert found["gold.dim_listing"].where(F.col("valid_from") == february).count() == 0
    pipeline.check(warehouse)
    # January is skipped: its rows never reach the history, and the build says so
    load_listings_label(warehouse, f"{deliveries}/listings", LABELS[2])
    load_listings_label(warehouse, f"{deliveries}/listings", LABELS[3])
    pipeline.build(warehouse, changed=PERIODS[2:])
    with pytest.raises(ChecksFailed, match="snapshots cover all months: 1"):
        pipeline.check(warehouse)


def test_corrected_month_and_vanished_rows(spark, built, tmp_path):
    write_deliveries(tmp_path / "in")
    shutil.copytree(built[0].root, tmp_path / "warehouse")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    # December again, without the early February rows and with fewer listings
    source = tmp_path / "december.csv"
    lines = (tmp_path / "in" / "listings" / "12_2020.csv").read_text().splitlines()
    source.write_text("\n".join(lines[:9]) + "\n")
    load_listings_period(warehouse, str(source), PERIODS[1])
    pipeline.build(warehouse, changed=[PERIODS[1]])
    part = state(warehouse)
    pipeline.build(warehouse)
    whole = state(warehouse)
    assert part == whole
    fact = pipeline.tables(warehouse)["gold.fact_listing_monthly"]
    assert fact.where(F.col("snap_month") == F.lit(PERIODS[1])).count() == 8
    # recorded versions are not corrected by an older month, but by recomputing the history
    december = F.col("valid_from") == F.lit(PERIODS[1])
    assert pipeline.tables(warehouse)["gold.dim_listing"].where(december).count() > 8
    pipeline.build(warehouse, history="all")
    assert pipeline.tables(warehouse)["gold.dim_listing"].where(december).count() == 8
    pipeline.check(warehouse)


def test_a_month_that_loses_all_rows_leaves_the_warehouse(spark, tmp_path):
    deliveries = write_deliveries(tmp_path / "in")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for name, layout in REFERENCE_FILES.items():
        load_reference(warehouse, f"{deliveries}/{layout.path}", name)
    load_listings_label(warehouse, f"{deliveries}/listings", LABELS[1])
    pipeline.build(warehouse)
    assert warehouse.read("silver.silver_listings").select("month_key").distinct().count() == 2
    source = tmp_path / "december.csv"
    lines = (tmp_path / "in" / "listings" / "12_2020.csv").read_text().splitlines()
    source.write_text("\n".join(lines[:9]) + "\n")
    load_listings_period(warehouse, str(source), PERIODS[1])
    pipeline.build(warehouse, changed=[PERIODS[1]])
    assert warehouse.read("silver.silver_listings").select("month_key").distinct().count() == 1


def test_answers_and_sql_names(spark, built, tmp_path):
    warehouse, *_ = built
    reports = {name: frame.collect() for name, frame in pipeline.answers(warehouse).items()}
    assert len(reports) == 6 and all(reports.values())
    pipeline.write_answers(warehouse, str(tmp_path / "results"))
    back = spark.read.option("header", True).csv(str(tmp_path / "results" / "q5_mortgage_coverage"))
    assert back.columns == ["lga_name", "lga_code", "single_hosts", "can_cover", "pct_cover"]
    assert back.count() == len(reports["q5_mortgage_coverage"])
    q1 = pipeline.answers(warehouse)["q1_top_bottom_lgas"]
    plan = q1._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snap_month" in plan
    n = spark.sql("select count(*) n from gold_fact_listing_monthly").first().n
    assert spark.sql("select sum(listings_total) n from gold_dm_property_type").first().n == n


def test_arrivals_load_like_batch_runs(spark, tmp_path):
    folder = tmp_path / "in"
    write_deliveries(folder)
    landing = tmp_path / "landing"
    landing.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))

    def arrive(*labels):
        for label in labels:
            (landing / f"{label}.csv").write_text((folder / "listings" / f"{label}.csv").read_text())
        return load_arrivals(warehouse, str(landing))

    def stored():
        rows = warehouse.read("bronze.listings_raw").groupBy("load_month").count().collect()
        return {r.load_month: r["count"] for r in rows}

    assert sorted(arrive(*LABELS[:2])) == sorted(LABELS[:2]) and set(stored()) == set(PERIODS[:2])
    assert arrive(LABELS[2]) == [LABELS[2]] and set(stored()) == set(PERIODS[:3])
    before = stored()
    assert arrive() == [] and stored() == before
    # a corrected month under the same name
    corrected = landing / f"{LABELS[0]}.csv"
    corrected.write_text("".join(corrected.read_text().splitlines(keepends=True)[:-1]))
    assert arrive() == [LABELS[0]]
    assert stored() == before | {PERIODS[0]: before[PERIODS[0]] - 1}
    # a month delivered as a folder, which then gets another file
    text = (folder / "listings" / f"{LABELS[0]}.csv").read_text()
    late = landing / "09_2031.csv"
    late.mkdir()
    (late / "part-0.csv").write_text(text)
    assert arrive() == ["09_2031"]
    (late / "part-1.csv").write_text(text)
    assert arrive() == ["09_2031"]
    assert stored()[dt.date(2031, 9, 1)] == 2 * before[PERIODS[0]]
    (landing / "notes.csv").write_text(text)
    with pytest.raises(ValueError):
        arrive()


def test_the_typed_projection_is_short_enough_for_the_jvm_to_compile(spark):
    raw = spark.createDataFrame([], listings_schema())
    plan = silver.typed_listings(raw)._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000


def test_a_changed_file_is_not_stored_between_text_and_silver(spark, built, tmp_path):
    shutil.copytree(built[0].root, tmp_path / "warehouse")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    before = set(Path(shared_folder(spark), "stratamart").glob("changed-files-*"))
    load_listings_label(warehouse, f"{built[1]}/listings", LABELS[-1])
    pipeline.build(warehouse, changed=[PERIODS[-1]])
    assert set(Path(shared_folder(spark), "stratamart").glob("changed-files-*")) == before
    assert state(warehouse) == built[3]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
