"""The whole build: load a period, refresh what it touches, answer the questions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratamart.plans import analysis, gold, marts, silver
from stratamart.plans.checks import require_all, rule_counts
from stratamart.plans.snapshots import advance_snapshot, rebuild_snapshot
from stratamart.schemas import LISTINGS_FOLDER, LISTINGS_TABLE, REFERENCE_FILES
from stratamart.session import short_methods
from stratamart.sources.bronze import (
    load_listings_label,
    load_reference,
    raw_listings,
    raw_reference,
)
from stratamart.sources.periods import discover_periods
from stratamart.sources.results import write_result_csv
from stratamart.sources.tables import Warehouse, even_files

_SILVER = "silver.silver_listings"
_FILE_MONTHS = "silver.file_months"
_FACT = "gold.fact_listing_monthly"
_LISTING_MONTH = "gold.int_listing_month"
_LISTING_HISTORY = "silver.snap_dim_listing"
_HOST_HISTORY = "silver.snap_dim_host"
MARTS = ("gold.dm_listing_neighbourhood", "gold.dm_property_type", "gold.dm_host_neighbourhood")


def newest_loaded_period(warehouse: Warehouse) -> dt.date:
    """Newest month by file, not by the dates inside the files."""
    table = f"bronze.{LISTINGS_TABLE}"
    loaded = warehouse.slices(table, "load_month") if warehouse.exists(table) else []
    if not loaded:
        raise ValueError("nothing loaded: load a month of listings first")
    return loaded[-1]


def _noted(typed: DataFrame) -> tuple[DataFrame, Observation]:
    """Typed rows that note, while they are read, which months the rows of each file belong to: a few pairs a file."""
    noted = Observation()
    pairs = F.collect_set(F.struct(F.col("load_month").cast("string"), F.col("month_key").cast("string")))
    return typed.observe(noted, pairs.alias("pairs")), noted


def _pairs(noted: Observation) -> set[tuple[dt.date, dt.date]]:
    return {tuple(map(dt.date.fromisoformat, pair)) for pair in noted.get["pairs"]}


def _pair_rows(warehouse: Warehouse, pairs: set[tuple[dt.date, dt.date]]) -> DataFrame:
    return warehouse.spark.createDataFrame([(month, file) for file, month in sorted(pairs)], "month_key date, load_month date")


def _refresh_silver(
    warehouse: Warehouse, changed: Iterable[dt.date] | None
) -> set[dt.date] | None:
    """Rebuild silver, or only the months that the changed files touch.

    A month's rows can lie in several files. The stored list of file months tells which, so a
    partial refresh reads the changed files and those sharing a month with them, not the whole
    raw table. The months of the changed files are told from two of their columns, so that no wide
    rows are written before they are known. Returns the months rewritten, or None when everything was.
    """
    typed = silver.typed_listings(raw_listings(warehouse))
    if changed is not None and warehouse.exists(_SILVER) and warehouse.exists(_FILE_MONTHS):
        files = set(changed)
        rows = typed.where(F.col("load_month").isin(list(files)))
        pairs = {tuple(pair) for pair in rows.select("load_month", "month_key").distinct().collect()}  # a few a file
        stored = {(r.load_month, r.month_key) for r in warehouse.read(_FILE_MONTHS).collect()}
        months = {month for file, month in stored | pairs if file in files}
        others = {file for file, month in stored if month in months} - files
        if others:
            shared = F.col("load_month").isin(list(others)) & F.col("month_key").isin(list(months))
            rows = rows.unionByName(typed.where(shared))
        latest = even_files(silver.latest_listings(rows), "month_key")
        # a month or file left without rows has no new slice to replace its old one with
        if files == {file for file, _ in pairs} and (
            warehouse.replace(_SILVER, latest, "month_key").slices == months
        ):
            warehouse.replace(_FILE_MONTHS, _pair_rows(warehouse, pairs), "load_month")
            return months
    rows, noted = _noted(typed)
    warehouse.rebuild(_SILVER, silver.latest_listings(rows), "month_key")
    warehouse.rebuild(_FILE_MONTHS, _pair_rows(warehouse, _pairs(noted)), "load_month")
    return None


def _refresh_fact(
    warehouse: Warehouse, months: set[dt.date] | None, until: dt.date
) -> set[dt.date] | None:
    """Rebuild the fact, or its rewritten and newly published months. Returns them likewise."""
    listings = warehouse.read(_SILVER)
    places = warehouse.read("gold.dim_place")
    if months is None or not warehouse.exists(_FACT):
        fact = gold.fact_listing_monthly(listings, places, until)
        warehouse.rebuild(_FACT, fact, "snap_month")
        return None
    stored, known = warehouse.slices(_FACT, "snap_month"), warehouse.slices(_SILVER, "month_key")
    due = {m for m in months | (set(known) - set(stored)) if m <= until}
    if due:
        rows = listings.where(F.col("month_key").isin(list(due)))
        fact = gold.fact_listing_monthly(rows, places, until)
        warehouse.replace(_FACT, even_files(fact, "snap_month"), "snap_month")
    return due


def _refresh_listing_month(
    warehouse: Warehouse, months: set[dt.date] | None, until: dt.date
) -> set[dt.date] | None:
    """Store the fact with its attributes, so the temporal joins run once for all marts.

    Merging the newest month into the history changes what is valid from that month on, so with
    the rewritten months that one is refreshed. Returns the months rewritten, or None for all.
    """
    fact = warehouse.read(_FACT)
    listings = gold.dim_listing(warehouse.read(_LISTING_HISTORY))
    hosts = gold.dim_host(warehouse.read(_HOST_HISTORY))
    if months is not None and warehouse.exists(_LISTING_MONTH):
        due = months | {until}
        rows = gold.int_listing_month(
            fact.where(F.col("snap_month").isin(list(due))), listings, hosts, max(due), min(due)
        )
        replaced = warehouse.replace(_LISTING_MONTH, even_files(rows, "month"), "month")
        if replaced.slices == due:
            return due
    whole = gold.int_listing_month(fact, listings, hosts, until)
    warehouse.rebuild(_LISTING_MONTH, whole, "month")
    return None


def _refresh_listing_mart(
    warehouse: Warehouse, table: str, keys: Sequence[str], due: set[dt.date] | None
) -> None:
    """Store a mart of listings, or its slices that depend on the due months."""
    month = warehouse.read(_LISTING_MONTH)
    if due is not None and warehouse.exists(table):
        rows, wanted = marts.refreshed_slices(month, warehouse.read(table), keys, due)
        if warehouse.replace(table, even_files(rows, "month"), "month").slices == wanted:
            return
    warehouse.rebuild(table, marts.listing_mart(month, keys), "month")


def _refresh_host_mart(warehouse: Warehouse, due: set[dt.date] | None, until: dt.date) -> None:
    """Store the mart of hosts, or its due months: a month of it depends on no other."""
    table, fact = MARTS[2], warehouse.read(_FACT)
    hosts, places = gold.dim_host(warehouse.read(_HOST_HISTORY)), warehouse.read("gold.dim_place")
    if due is not None and warehouse.exists(table):
        rows = fact.where(F.col("snap_month").isin(list(due)))
        mart = marts.dm_host_neighbourhood(rows, hosts, places, max(due), min(due))
        if warehouse.replace(table, even_files(mart, "month"), "month").slices == due:
            return
    warehouse.rebuild(table, marts.dm_host_neighbourhood(fact, hosts, places, until), "month")


def _store_marts(warehouse: Warehouse, due: set[dt.date] | None, until: dt.date) -> None:
    """Store the marts by month, so that other sessions and the checks read them without aggregating anew."""
    _side_by_side(
        [
            lambda: _refresh_listing_mart(warehouse, MARTS[0], marts.NEIGHBOURHOOD_KEYS, due),
            lambda: _refresh_listing_mart(warehouse, MARTS[1], marts.PROPERTY_KEYS, due),
            lambda: _refresh_host_mart(warehouse, due, until),
        ]
    )


def _side_by_side(steps: list[Callable[[], object]]) -> None:
    """Run writes that do not depend on each other at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def build_reference(warehouse: Warehouse) -> None:
    """Silver and gold tables that depend on the reference files only."""
    cleaned = {
        "silver.silver_lga_code": (silver.silver_area_codes, "lga_code_raw"),
        "silver.silver_lga_suburb": (silver.silver_area_suburbs, "lga_suburb_raw"),
        "silver.silver_census_g01": (silver.silver_census_persons, "census_g01_raw"),
        "silver.silver_census_g02": (silver.silver_census_medians, "census_g02_raw"),
    }
    _side_by_side(
        [
            lambda n=name, clean=clean, raw=raw: warehouse.rebuild(n, clean(raw_reference(warehouse, raw)))
            for name, (clean, raw) in cleaned.items()
        ]
    )
    areas, suburbs, persons, medians = map(warehouse.read, cleaned)
    _side_by_side(
        [
            lambda: warehouse.rebuild("gold.dim_lga", gold.dim_area(areas)),
            lambda: warehouse.rebuild("gold.dim_place", gold.dim_place(areas, suburbs)),
            lambda: warehouse.rebuild("gold.dim_census_g01", gold.with_area_name(persons, areas)),
            lambda: warehouse.rebuild("gold.dim_census_g02", gold.with_area_name(medians, areas)),
        ]
    )


def build(
    warehouse: Warehouse,
    changed: Iterable[dt.date] | None = None,
    history: str = "newest",
) -> None:
    """Bring all layers up to date.

    ``changed`` names the files (re)loaded since the last build; only the months they touch
    are recomputed. Without it, or after the reference tables changed, everything is.

    ``history='newest'`` merges the newest loaded month into the stored history, so months have
    to be built one after the other, and a corrected month does not change versions already
    recorded. ``history='all'`` recomputes the history from all published months.
    """
    if history not in ("newest", "all"):
        raise ValueError(f"history must be 'newest' or 'all', got {history!r}")
    until = newest_loaded_period(warehouse)
    if changed is None:
        build_reference(warehouse)
    with short_methods(warehouse.spark):  # all columns of the raw text are typed in one projection
        months = _refresh_silver(warehouse, changed)
    listings = warehouse.read(_SILVER)
    if history == "newest":
        newest = listings.where(F.col("month_key") == F.lit(until))
        advance_snapshot(
            warehouse, _LISTING_HISTORY, gold.listing_months(newest), "listing_id", "month_key", until
        )
        advance_snapshot(
            warehouse, _HOST_HISTORY, gold.host_months(newest), "host_id", "month_key", until
        )
    else:
        published = listings.where(F.col("month_key") <= F.lit(until))
        _side_by_side(
            [
                lambda: rebuild_snapshot(warehouse, _LISTING_HISTORY, gold.listing_versions(published)),
                lambda: rebuild_snapshot(warehouse, _HOST_HISTORY, gold.host_versions(published)),
            ]
        )
    months = _refresh_fact(warehouse, months, until)
    due = _refresh_listing_month(warehouse, months if history == "newest" else None, until)
    _store_marts(warehouse, due, until)


def tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Every table and view of the warehouse; the two versioned dimensions are plans over their history.

    All are published as temporary views ``layer_name`` for SQL.
    """
    found = {"bronze.listings_raw": raw_listings(warehouse)}
    for name in REFERENCE_FILES:
        found[f"bronze.{name}"] = raw_reference(warehouse, name)
    for name in (
        _SILVER,
        "silver.silver_lga_code",
        "silver.silver_lga_suburb",
        "silver.silver_census_g01",
        "silver.silver_census_g02",
        _LISTING_HISTORY,
        _HOST_HISTORY,
        "gold.dim_lga",
        "gold.dim_place",
        "gold.dim_census_g01",
        "gold.dim_census_g02",
        _FACT,
        _LISTING_MONTH,
        *MARTS,
    ):
        found[name] = warehouse.read(name)
    found["gold.dim_listing"] = gold.dim_listing(found[_LISTING_HISTORY])
    found["gold.dim_host"] = gold.dim_host(found[_HOST_HISTORY])
    for name, frame in found.items():
        warehouse.publish(name, frame)
    return found


def check(warehouse: Warehouse) -> None:
    """Run every check; raise when one fails."""
    require_all(rule_counts(tables(warehouse), newest_loaded_period(warehouse)))


def backfill(
    warehouse: Warehouse,
    deliveries: str,
    listings_folder: str = LISTINGS_FOLDER,
    checked: bool = True,
) -> dict[str, int]:
    """Load the reference files, then load and build month after month, oldest first.

    Returns the rows loaded per file.
    """
    base = deliveries.rstrip("/")
    loaded = {
        name: load_reference(warehouse, f"{base}/{layout.path}", name)
        for name, layout in REFERENCE_FILES.items()
    }
    folder = f"{base}/{listings_folder}"
    for position, (label, period) in enumerate(discover_periods(warehouse.spark, folder)):
        loaded[label] = load_listings_label(warehouse, folder, label)
        build(warehouse, changed=[period] if position else None)
        if checked:
            check(warehouse)
    return loaded


def answers(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The reports of the five questions."""
    found = tables(warehouse)
    fact = found[_FACT]
    last = warehouse.slices(_FACT, "snap_month")[-1]  # a literal bound prunes the fact's slices
    medians, persons = found["gold.dim_census_g02"], found["gold.dim_census_g01"]
    return {
        "q1_top_bottom_lgas": analysis.top_and_bottom_areas(fact, medians, persons, last),
        "q2_age_revenue_correlation": analysis.age_revenue_correlation(fact, medians, last),
        "q3_best_listing_configurations": analysis.best_configurations(found[_LISTING_MONTH]),
        "q4_multi_property_hosts": analysis.multi_listing_hosts(fact),
        "q4_multi_property_hosts_2": analysis.primary_areas(fact),
        "q5_mortgage_coverage": analysis.mortgage_coverage(fact, medians, found["gold.dim_lga"]),
    }


def write_answers(warehouse: Warehouse, folder: str) -> None:
    for name, report in answers(warehouse).items():
        write_result_csv(report, f"{folder.rstrip('/')}/{name}")
