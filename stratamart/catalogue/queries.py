"""One query per operator or pipeline, each over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart import functions as fn
from stratamart.catalogue.stand_in import (
    LINE_COLUMNS,
    areas,
    census_medians,
    census_persons,
    listing_rows,
    newest_month,
    places,
    published,
    ship_date,
    silver,
    silver_table,
    suburbs,
    table,
)
from stratamart.operators import metrics, quality, sketches
from stratamart.operators.history import (
    as_dimension,
    changes_from_history,
    merge_changes,
    merge_versions,
    versions_from_history,
)
from stratamart.operators.storage import drop_path, fresh_path, written_once
from stratamart.operators.temporal import as_of_join, newest, published_until, trailing_months
from stratamart.plans import analysis, gold, marts, pipeline
from stratamart.plans.checks import rule_counts
from stratamart.plans.silver import silver_census_medians, silver_census_persons, silver_listings
from stratamart.plans.snapshots import advance_snapshot
from stratamart.schemas import LISTING_COLUMNS, REFERENCE_FILES
from stratamart.session import short_methods
from stratamart.sources.bronze import load_listings_label, load_listings_period, load_reference, raw_listings
from stratamart.sources.delimited import read_positional_csv
from stratamart.sources.periods import in_date_order, parse_period_label
from stratamart.sources.records import read_split_csv
from stratamart.sources.results import write_result_csv
from stratamart.sources.tables import Warehouse, even_files
from stratamart.streaming.stream import stream_arrivals

Query = Callable[[SparkSession, str], DataFrame]


def rows() -> Column:
    return F.count(F.lit(1))


# ---- cleaning ------------------------------------------------------------------------------


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_text"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price_text"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity_text"),
    )
    return text.select(
        fn.typed(F.col("order_text"), "bigint").alias("order_key"),
        fn.typed(F.col("price_text"), "double").alias("price"),
        fn.typed(F.col("quantity_text"), "int").alias("quantity"),
    )


def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 5
    text = (
        F.when(kind == 0, "  ")
        .when(kind == 1, "")
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"),
        fn.blank_to_null(text).alias("trimmed"),
        fn.empty_to_null(text).alias("untrimmed"),
    )


def tristate_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    text = (
        F.when((flag == "A") & (status == "O"), "t")
        .when(flag == "A", "T ")
        .when(flag == "N", " F ")
        .when(status == "O", "yes")
        .otherwise("")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(text.alias("mark"))
        .withColumn("value", fn.tristate(F.col("mark")))
        .groupBy("mark", "value")
        .agg(rows().alias("n"))
    )


def parse_date_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = F.col("l_orderkey") % 4
    day = ship_date()
    text = (
        F.when(layout == 0, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd")))
        .when(layout == 1, F.date_format(day, "d/M/yyyy"))
        .when(layout == 2, F.date_format(day, "d-M-yyyy"))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(layout.alias("layout"), fn.parse_date_multi(text).alias("day"))
        .groupBy("layout", "day")
        .agg(rows().alias("n"))
    )


def clean_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.format_number(F.col("l_extendedprice"), 2)
    text = F.when(F.col("l_linenumber") == 7, " ").otherwise(F.concat(F.lit("$"), price))
    amounts = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), fn.clean_currency(text).alias("amount")
    )
    return published(
        amounts.groupBy("flag").agg(
            F.sum("amount").alias("total"), F.count("amount").alias("known"), rows().alias("n")
        )
    )


def place_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [
        table(spark, sf_dir, source).select(F.lit(source).alias("source"), F.col(name).alias("name"))
        for source, name in (
            ("customer", "c_name"),
            ("nation", "n_name"),
            ("part", "p_name"),
            ("region", "r_name"),
            ("supplier", "s_name"),
        )
    ]
    union = names[0]
    for other in names[1:]:
        union = union.unionByName(other)
    return union.distinct().withColumn("place_key", fn.name_key(F.col("name")))


def unify_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_custkey") % 4
    nation = F.col("c_nationkey").cast("string")
    text = (
        F.when(kind == 0, nation)
        .when(kind == 1, F.concat(F.lit(" lga"), F.lpad(nation, 5, "0")))
        .when(kind == 2, F.concat(F.lpad(nation, 4, "0"), F.lit(" ")))
        .otherwise(F.concat(F.lit("area "), nation))
    )
    return (
        table(spark, sf_dir, "customer")
        .select(text.alias("text"))
        .withColumn("lga_code", fn.unify_code(F.col("text")))
        .where("lga_code IS NOT NULL")
        .groupBy("text", "lga_code")
        .agg(rows().alias("n"))
    )


def month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(fn.month_start(ship_date()).alias("month_key"))
        .agg(rows().alias("n"))
    )


def period_label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(
        F.col("l_linestatus") == "F", F.date_format(ship_date(), "MM_yyyy")
    ).otherwise(F.date_format(ship_date(), "yyyy_MM"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(label.alias("label"))
        .agg(rows().alias("n"))
        .withColumn("period", fn.parse_period_label_column(F.col("label")))
    )


def filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .where(
            (F.col("o_orderstatus") != "F")
            & F.col("o_totalprice").between(50000, 300000)
            & F.col("o_orderdate").isNotNull()
            & (priority.startswith("1-") | priority.rlike("^[2-4]-"))
        )
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(rows().alias("n"))
    )


def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    per_part = lines.groupBy("l_partkey").agg(
        F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("active"),
        F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("open"),
    )
    # sizes up to 10 get an empty base
    base = F.when(F.col("p_size") > 10, F.col("open")).otherwise(0)
    per_size = (
        per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_size")
        .agg(F.sum("active").alias("active"), F.sum(base).alias("base"))
    )
    return published(
        per_size.withColumn("active_rate", fn.percent_of(F.col("active"), F.col("base")))
    )


def _raw_text(
    spark: SparkSession, sf_dir: str, day: Column | None = None, first: dt.date | None = None, by_file: bool = False
) -> DataFrame:
    """Line items as delivered text, with blanks, three date layouts, currency and stray spaces.

    Scraped on ``day``, in files from month ``first`` on. With ``by_file`` they are dealt out and sorted by the month of
    their file, as lines, before the much wider text is made of them.
    """
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    day = ship_date() if day is None else day
    layout = order % 8

    def text(c: Column) -> Column:
        return c.cast("string")

    def padded(c: Column) -> Column:
        return F.concat(F.lit(" "), text(c), F.lit(" "))

    values = {
        "listing_id": F.when(layout == 6, "  ").otherwise(text(F.col("l_partkey"))),
        "scrape_id": padded(order),
        "scraped_date": F.when(layout == 0, F.date_format(day, "d/M/yyyy"))
        .when(layout == 1, F.date_format(day, "d-M-yyyy"))
        .when(layout == 7, F.date_format(day, "d MMM"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")),
        "host_id": F.when(line == 6, " ").otherwise(padded(F.col("l_suppkey"))),
        "host_name": F.concat(F.lit(" Host, "), text(F.col("l_suppkey"))),
        "host_since": F.when(line == 5, "").otherwise(F.date_format(day, "d/M/yyyy")),
        "host_is_superhost": F.when(line == 4, "n/a")
        .when(F.col("l_linestatus") == "O", "T")
        .otherwise(" f"),
        "host_neighbourhood": F.when(line == 3, "  ").otherwise(
            F.concat(F.lit(" Nation "), text(order % 40))
        ),
        "listing_neighbourhood": F.concat(F.lit("nation_"), text(F.col("l_partkey") % 27)),
        "property_type": F.concat(F.lit("type "), text(F.col("l_suppkey") % 6)),
        "room_type": F.concat(F.lit("room "), text(F.col("l_suppkey") % 4)),
        "accommodates": text(F.col("l_quantity").cast("int") % 16 + 1),
        "price": F.when(line == 2, "").otherwise(
            F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
        ),
        "has_availability": F.when(line == 1, "")
        .when(F.col("l_returnflag") == "R", "f")
        .otherwise("t"),
        "availability_30": text(F.col("l_quantity").cast("int") % 31),
        "number_of_reviews": text(line * 3),
        "review_scores_rating": F.when(line == 7, " ").otherwise(text(line * 10)),
        "review_scores_accuracy": text(line),
        "review_scores_cleanliness": text(line + 1),
        "review_scores_checkin": text(line + 2),
        "review_scores_communication": text(line + 3),
        "review_scores_value": padded(line + 4),
    }
    # every seventh line arrives early, in the file of the month before
    file_month = F.add_months(fn.month_start(day), F.when(line == 7, -1).otherwise(0))
    file_month = file_month if first is None else F.greatest(file_month, F.lit(first))
    lines = table(spark, sf_dir, "lineitem").withColumn("load_month", file_month)
    if by_file:
        lines = even_files(lines.select(*LINE_COLUMNS, "load_month"), "load_month").sortWithinPartitions("load_month")
    return lines.select(*[values[c].alias(c) for c in LISTING_COLUMNS], "load_month")


def _stored_bronze(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with the text rows stored by the month of their file."""
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    raw = _raw_text(spark, sf_dir, by_file=True).withColumn("loaded_at", F.current_timestamp())
    warehouse.rebuild("bronze.listings_raw", raw, "load_month", dealt=True)
    return warehouse


def silver_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(silver_listings(raw_listings(_stored_bronze(spark, sf_dir))))


# ---- sources and loads ---------------------------------------------------------------------


def positional_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as a delivery with quoted commas, quotes and line breaks, read back."""
    folder = fresh_path(spark, "delivery")
    note = F.when(F.col("l_returnflag") == "A", F.concat(F.lit('a "b", '), F.col("l_linestatus")))
    note = note.when(F.col("l_returnflag") == "R", F.lit("two\nlines"))
    table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("WRONG NAME"), note.alias("NOTE"), "l_linenumber", F.lit(None).cast("string").alias("x")
    ).write.option("header", True).option("escape", '"').csv(folder)
    delivery = read_positional_csv(spark, folder, ["order_key", "note", "line"], cut_extra=True)
    return delivery.groupBy("note", "line").agg(
        rows().alias("n"), F.sum(F.col("order_key").cast("bigint")).alias("order_keys")
    )


def _delivered(spark: SparkSession, sf_dir: str, files: int) -> str:
    """Line items as CSV files, each with a byte-order mark, with stray quotes, line breaks, blank rows and
    trailing cells."""
    folder = fresh_path(spark, "deliveries")
    line = F.col("l_linenumber")
    note = F.when(line == 1, F.lit('5" pipe')).when(line == 2, F.lit('"two\nlines, ""x"""')).when(line == 3, F.lit('"a,b"'))
    record = F.when(line == 7, F.lit(" ,,,")).otherwise(
        F.concat_ws(",", F.col("l_orderkey"), F.coalesce(note, F.lit("")), line, F.lit('6" z'), F.lit('"w\n"'))
    )
    bucket = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(files)).cast("int")
    dealt = table(spark, sf_dir, "lineitem").select(record.alias("value"), bucket.alias("bucket")).repartitionById(files, "bucket")
    _headed(dealt, "\ufeffORDER,NOTE,LINE").write.text(folder)
    return folder


def _headed(lines: DataFrame, header: str) -> DataFrame:
    """The lines ``value`` with the header before whichever is the first of a task: a task writes one file, as its rows come."""
    at_top = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    headed = F.when(at_top, F.concat(F.lit(f"{header}\n"), F.col("value"))).otherwise(F.col("value"))
    return lines.select(headed.alias("value"))


def csv_any_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries as one file and as 16 files: the rows read do not depend on sizes."""
    forms = [
        read_positional_csv(spark, _delivered(spark, sf_dir, files), ["order_key", "note", "line"], cut_extra=True)
        .groupBy("note", "line")
        .agg(rows().alias("n"), F.sum(F.col("order_key").cast("bigint")).alias("order_keys"))
        .withColumn("files", F.lit(files))
        for files in (1, 16)
    ]
    return forms[0].unionByName(forms[1])


def _delivery(rows_: DataFrame, folder: str) -> str:
    rows_.write.option("header", True).option("escape", '"').csv(folder)
    return folder


def _recut(source: str, folder: str, cells: list[str], line: Callable[[Column], Column], spark: SparkSession) -> str:
    """The delivery at ``source``, of one line a record, as a packed one with the header ``cells`` and each line put through ``line``."""
    lines = spark.read.text(source).where(F.col("value") != ",".join(LISTING_COLUMNS))
    _headed(lines.select(line(F.col("value")).alias("value")), ",".join(cells)).write.option("compression", "gzip").text(folder)
    return folder


def load_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month loaded from line items, then deliveries that must be refused or cut: what happened, and the rows that the
    month holds after each. A delivery is made before the first case that reads it and dropped after the last."""
    warehouse, folder = Warehouse(spark, fresh_path(spark, "warehouse")), fresh_path(spark, "guards")
    period = dt.date(2020, 1, 1)
    raw = _raw_text(spark, sf_dir).drop("load_month")
    good, wide, empty, short = (f"{folder}/{name}.csv" for name in ("good", "wide", "empty", "short"))
    # the good one is read in splits too; wide and short ones are read as whole files, so they may be packed
    deliver = {
        good: lambda: _delivery(raw, good),
        wide: lambda: _recut(good, wide, [*LISTING_COLUMNS, "x"], lambda row: F.concat(row, F.lit(",more")), spark),
        empty: lambda: _delivery(raw.where("false"), empty),
        # the last cell is a number or empty, never quoted
        short: lambda: _recut(good, short, LISTING_COLUMNS[:-1], lambda row: F.left(row, F.length(row) - F.length(F.substring_index(row, ",", -1)) - 1), spark),
    }
    cases = [
        ("whole delivery", good, lambda: load_listings_period(warehouse, good, period)),
        ("rows too short", short, lambda: load_listings_period(warehouse, short, period)),
        ("no rows", empty, lambda: load_listings_period(warehouse, empty, period)),
        ("not the first of a month", good, lambda: load_listings_period(warehouse, good, dt.date(2020, 1, 2))),
        ("no period label", good, lambda: load_listings_label(warehouse, folder, "13_2020")),
        ("unknown reference table", good, lambda: load_reference(warehouse, good, "no_such_table")),
        ("reference rows too long", wide, lambda: load_reference(warehouse, wide, "lga_code_raw")),
        ("trailing cells cut", wide, lambda: load_listings_period(warehouse, wide, period)),
        ("the same again in splits", good, lambda: load_listings_period(warehouse, good, period, split_files=True)),
    ]
    found, made = [], set()
    for at, (name, source, load) in enumerate(cases):
        if source not in made:
            made.add(deliver[source]())
        try:
            load()
            refused = False
        except (ValueError, PySparkException):
            refused = True
        found.append((name, refused, raw_listings(warehouse).count()))
        if all(later != source for _, later, _ in cases[at + 1 :]):
            drop_path(spark, source)
    return spark.createDataFrame(found, "case string, refused boolean, rows_kept bigint")


def load_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months loaded from line items: the rows that each load reports, those stored under its month, and those
    stamped with the time of loading; and the registered reference files."""
    warehouse, folder = Warehouse(spark, fresh_path(spark, "warehouse")), fresh_path(spark, "lineage")
    started = spark.sql("select current_timestamp() as t").first().t
    raw = written_once(_raw_text(spark, sf_dir).drop("load_month"), "raw")
    loaded = []
    for label, part in (("01_2020", F.col("availability_30") == "0"), ("02_2020", F.col("availability_30") != "0")):
        _delivery(raw.where(part), f"{folder}/{label}.csv")
        loaded.append((label, load_listings_label(warehouse, folder, label)))
    reported = spark.createDataFrame(loaded, "label string, rows_loaded bigint")
    stamped = F.count(F.when(F.col("loaded_at") >= F.lit(started), 1))
    stored = raw_listings(warehouse).groupBy(F.date_format("load_month", "MM_yyyy").alias("label")).agg(
        rows().alias("rows_stored"), stamped.alias("rows_stamped")
    )
    files = F.lit(",".join(sorted(REFERENCE_FILES)))
    return reported.join(stored, "label").withColumn("reference_files", files)


def arrivals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered as months (by day of the month), landing in two goes; then all of it streamed once more from an
    empty checkpoint, which must change nothing."""
    warehouse, landing = Warehouse(spark, fresh_path(spark, "warehouse")), fresh_path(spark, "landing")
    month = F.make_date(F.lit(2024), F.day("ts") % 12 + 1, F.lit(1))
    events = written_once(table(spark, sf_dir, "events").select("event_id", "event_type", "value", month.alias("month")), "events")
    months = [r.month for r in events.select("month").distinct().orderBy("month").collect()]

    def load(label: str) -> None:
        delivery = read_positional_csv(spark, f"{landing}/{label}.csv", ["event_id", "event_type", "value"])
        period = parse_period_label(label)
        warehouse.replace("bronze.events", delivery.withColumn("load_month", F.lit(period)), "load_month", only=period)

    checkpoint = fresh_path(spark, "stream")
    for some in (months[::2], months[1::2]):
        for period in some:
            _delivery(events.where(F.col("month") == F.lit(period)).drop("month"), f"{landing}/{period:%m_%Y}.csv")
        stream_arrivals(spark, landing, checkpoint, load)
    stream_arrivals(spark, landing, fresh_path(spark, "stream"), load)
    amount = F.sum(F.col("value").cast("decimal(18,2)"))
    return published(warehouse.read("bronze.events").groupBy("load_month").agg(rows().alias("n"), amount.alias("amount")))


def csv_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delivery as one file, read in about 7 and about 40 splits whose borders fall anywhere."""
    path = _delivered(spark, sf_dir, 1)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]  # listed, not read
    forms = [
        read_split_csv(spark, path, ["order_key", "note", "line"], cut_extra=True, split_bytes=size // splits)
        .groupBy("note", "line")
        .agg(rows().alias("n"), F.sum(F.col("order_key").cast("bigint")).alias("order_keys"))
        .withColumn("splits", F.lit(splits))
        for splits in (7, 40)
    ]
    return forms[0].unionByName(forms[1])


def census_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw census text cleaned: codes trimmed, counts and medians typed, blanks NULL."""
    code = F.col("c_nationkey").cast("string")
    text = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.when(F.col("c_mktsegment") == "BUILDING", 1)).cast("string").alias("tot_p_m"),
        F.lit("").alias("tot_p_f"),
        F.concat(F.lit(" "), rows().cast("string")).alias("tot_p_p"),
        F.max(F.length("c_name")).cast("string").alias("median_age_persons"),
        F.lit("").alias("median_mortgage_repay_monthly"),
    )
    code = F.concat(F.lit("LGA"), F.lpad(code, 5, "0"))
    people = silver_census_persons(_as_text(text.withColumn("lga_code_2016", F.concat(F.lit(" "), code)), "census_g01_raw"))
    medians = silver_census_medians(_as_text(text.withColumn("lga_code_2016", code), "census_g02_raw"))
    return people.select("lga_code", "total_pop_male", "total_pop_female", "total_pop").join(
        medians.select("lga_code", "median_age_persons", "median_mortgage_monthly"), "lga_code"
    )


def _as_text(df: DataFrame, layout: str) -> DataFrame:
    """The columns of a reference file as text, NULL where ``df`` has none."""
    columns = REFERENCE_FILES[layout].columns
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in columns])


def period_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month delivered with finished lines only; then all months from 2000 on again, whole."""
    warehouse = Warehouse(spark, fresh_path(spark, "period-replace"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_extendedprice", fn.month_start(ship_date()).alias("load_month")
    )
    first = lines.where("l_linestatus = 'F'")
    again = lines.where("load_month >= DATE'2000-01-01'")
    for delivery in (first, again, again):
        warehouse.replace("bronze.lines", even_files(delivery, "load_month"), "load_month")
    return published(
        warehouse.read("bronze.lines")
        .groupBy("load_month")
        .agg(
            rows().alias("n"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"),
        )
    )


def reference_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer list delivered twice in full; the second delivery replaces the first."""
    warehouse = Warehouse(spark, fresh_path(spark, "reference-refresh"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    old = customers.withColumn("c_name", F.lower("c_name"))
    for delivery in (old, customers):
        warehouse.replace("bronze.customers", delivery.withColumn("load_slice", F.lit("current")), "load_slice", only="current")
    return warehouse.read("bronze.customers").select("c_custkey", "c_name", "c_nationkey")


def backfill_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "lineitem").select(
        F.date_format(ship_date(), "MM_yyyy").alias("label")
    )
    return in_date_order(labels)


def result_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverage-style report written as a result file and read back by its header."""
    path = fresh_path(spark, "result")
    report = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(rows().alias("n"))
        .orderBy("o_orderpriority", "o_orderstatus")
    )
    write_result_csv(report, path)
    return spark.read.schema("priority string, status string, n bigint").option("header", True).csv(path)


# ---- de-duplication and areas --------------------------------------------------------------


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(
        silver(spark, sf_dir).select("listing_id", "month_key", "scraped_dt", "host_id", "price")
    )


def host_representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.host_months(silver(spark, sf_dir))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()


def resolve_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places from nations, with suburbs from regions, suppliers and customer segments; some
    supplier suburbs carry the name of another nation and lose to it."""
    nation = areas(spark, sf_dir)
    in_nation = [
        table(spark, sf_dir, "customer").select(
            F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("key")
        ),
        table(spark, sf_dir, "supplier").select(
            F.col("s_name").alias("name"), F.col("s_nationkey").alias("key")
        ),
        table(spark, sf_dir, "supplier").select(
            F.concat(F.lit("Nation "), (F.col("s_suppkey") % 30).cast("string")).alias("name"),
            F.col("s_nationkey").alias("key"),
        ),
    ]
    named = in_nation[0].unionByName(in_nation[1]).unionByName(in_nation[2]).distinct()
    more = named.join(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
        F.col("key") == F.col("n_nationkey"),
    ).select(fn.tidy_upper(F.col("name")).alias("suburb_name"), fn.tidy_upper(F.col("n_name")).alias("lga_name"))
    return gold.dim_place(nation, suburbs(spark, sf_dir).unionByName(more))


def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments per neighbourhood class with the area of that name; two classes have none."""
    per_class = (
        listing_rows(spark, sf_dir)
        .groupBy("listing_neighbourhood")
        .agg(rows().alias("n"))
        .withColumn("lga_name", F.upper("listing_neighbourhood"))
    )
    return per_class.join(areas(spark, sf_dir), "lga_name", "left").select(
        "listing_neighbourhood", "n", "lga_code"
    )


# ---- fact ----------------------------------------------------------------------------------


def _fact(spark: SparkSession, sf_dir: str, host: str = "l_suppkey") -> DataFrame:
    return gold.fact_listing_monthly(silver(spark, sf_dir, host), places(spark, sf_dir))


def fact_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = gold.with_measures(listing_rows(spark, sf_dir))
    return published(
        measured.groupBy("month_key").agg(
            F.sum("booked_nights_30").alias("booked_nights"),
            F.sum("est_revenue_30").alias("est_revenue"),
        )
    )


def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(_fact(spark, sf_dir))


def publish_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments up to the month of the newest order; later shipments are held back."""
    orders = table(spark, sf_dir, "orders").select(
        fn.month_start(F.col("o_orderdate").cast("date")).alias("month_key")
    )
    shipped = table(spark, sf_dir, "lineitem").select(fn.month_start(ship_date()).alias("month_key"))
    return (
        published_until(shipped, "month_key", newest(orders, "month_key"))
        .groupBy("month_key")
        .agg(rows().alias("n"))
    )


def trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trailing_months(_fact(spark, sf_dir), "snap_month", until=newest_month(spark, sf_dir))
    return published(
        fact.groupBy("snap_month").agg(
            rows().alias("n"), F.sum("est_revenue_30").alias("est_revenue")
        )
    )


def rev_per_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = trailing_months(_fact(spark, sf_dir), "snap_month", until=newest_month(spark, sf_dir))
    return published(
        analysis.revenue_per_active(fact).withColumn(
            "rev_per_active", F.round("rev_per_active", 2)
        )
    )


# ---- history -------------------------------------------------------------------------------


def _host_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.host_months(silver(spark, sf_dir))


def scd2_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = silver(spark, sf_dir).select(
        "listing_id", "month_key", "listing_neighbourhood", "review_scores_rating"
    )
    return versions_from_history(
        months, "listing_id", "month_key", ["listing_neighbourhood", "review_scores_rating"]
    )


def scd2_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = gold.host_versions(silver(spark, sf_dir))
    return as_dimension(versions, "host_id", gold.HOST_ATTRIBUTES)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of all months before the newest, then the newest month merged into it."""
    last = newest_month(spark, sf_dir)
    months = _host_months(spark, sf_dir)
    current = versions_from_history(
        months.where(F.col("month_key") < last), "host_id", "month_key", gold.HOST_ATTRIBUTES
    )
    return merge_versions(current, months.where(F.col("month_key") == last), "host_id", "month_key")


def _part_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part and year of shipping, with attributes that often stay as they are; stored."""
    lines = table(spark, sf_dir, "lineitem")
    per_year = lines.groupBy(F.col("l_partkey").alias("part_key"), F.trunc(ship_date(), "YEAR").alias("year")).agg(
        (rows() > 4).alias("busy"), F.max(F.when(F.col("l_returnflag") == "R", F.col("l_returnflag"))).alias("returned")
    )
    return written_once(per_year, "part-years")


def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_from_history(_part_years(spark, sf_dir), "part_key", "year", ["busy", "returned"])


def scd2_changes_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log kept up year by year, the last year merged twice."""
    yearly = _part_years(spark, sf_dir)
    years = [r.year for r in yearly.select("year").distinct().orderBy("year").collect()]
    log = changes_from_history(yearly.where(F.col("year") == F.lit(years[0])), "part_key", "year", ["busy", "returned"])
    for year in [*years[1:], years[-1]]:
        log = written_once(merge_changes(log, yearly.where(F.col("year") == F.lit(year)), "part_key", "year"), "change-log")
    return log


def backfill_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order history stored year by year, one merge per year, the last year merged twice.

    Orders skip years, so versions stay open across gaps. The SQL side computes the same history
    from all years at once.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.trunc(ship_date(), "YEAR").alias("year"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    yearly = written_once(
        lines.groupBy("order_key", "year").agg(rows().alias("n"), F.max("price").alias("top_price")),
        "order-years",
    )
    warehouse = Warehouse(spark, fresh_path(spark, "history"))
    years = sorted(r.year for r in yearly.select("year").distinct().collect())
    for year in [*years, years[-1]]:
        slice_ = yearly.where(F.col("year") == F.lit(year))
        advance_snapshot(warehouse, "silver.order_years", slice_, "order_key", "year", year)
    stored = warehouse.read("silver.order_years")
    return published(stored.withColumn("valid_to", F.col("valid_to").cast("date")))


# ---- temporal joins ------------------------------------------------------------------------


def _gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """Fact, listing versions, host versions and the last month, all from one stored silver."""
    stored = silver_table(spark, sf_dir)
    fact = gold.fact_listing_monthly(stored, places(spark, sf_dir))
    return fact, gold.listing_versions(stored), gold.host_versions(stored), newest(stored, "month_key")


def _listing_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temporal joins stored once: marts read their input for the metrics and for medians."""
    fact, listings, hosts, last = _gold(spark, sf_dir)
    return written_once(gold.int_listing_month(fact, listings, hosts, last), "listing-month", "zstd")


def temporal_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = silver_table(spark, sf_dir)
    joined = as_of_join(
        stored.select(F.col("month_key").alias("snap_month"), "listing_id", "price"),
        gold.listing_versions(stored),
        "listing_id",
        "snap_month",
        until=newest(stored, "month_key"),
        grain="month",
        spread=False,
    )
    return published(joined)


def _finished_hosts(stored: DataFrame) -> DataFrame:
    """Host versions recorded from finished shipments only, so early months have none."""
    return gold.host_versions(stored.where("NOT host_is_superhost"))


def temporal_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = silver_table(spark, sf_dir)
    fact = gold.fact_listing_monthly(stored, places(spark, sf_dir))
    return published(
        gold.int_listing_month(
            fact, gold.listing_versions(stored), _finished_hosts(stored), newest(stored, "month_key")
        )
    )


def join_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance of an inner join to hosts that have no version in some early months."""
    stored = silver_table(spark, sf_dir)
    fact = stored.select("listing_id", "month_key", "host_id")
    joined = as_of_join(
        fact,
        _finished_hosts(stored).select("host_id", "host_is_superhost", "valid_from", "valid_to"),
        "host_id",
        "month_key",
        until=newest(stored, "month_key"),
        grain="month",
    )
    return quality.join_balance(fact, joined, ["listing_id", "month_key"])


def unmapped_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _, hosts, last = _gold(spark, sf_dir)
    return (
        marts.host_month_areas(fact, hosts, places(spark, sf_dir), last)
        .groupBy("host_neighbourhood_lga")
        .agg(F.sum("listing_months").alias("listing_months"))
    )


def _reference_text(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four reference tables as delivered text, in the columns that the build reads."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return {
        "lga_code_raw": nation.select(
            F.col("n_nationkey").cast("string").alias("lga_code"), F.lower("n_name").alias("lga_name")
        ),
        "lga_suburb_raw": nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_name").alias("lga_name"), F.col("r_name").alias("suburb_name")
        ),
        "census_g01_raw": census_persons(spark, sf_dir).select(
            F.col("lga_code").alias("lga_code_2016"),
            F.col("total_pop_male").cast("string").alias("tot_p_m"),
            F.col("total_pop_female").cast("string").alias("tot_p_f"),
            F.col("total_pop").cast("string").alias("tot_p_p"),
        ),
        "census_g02_raw": census_medians(spark, sf_dir).select(
            F.col("lga_code").alias("lga_code_2016"),
            F.col("median_age_persons").cast("string").alias("median_age_persons"),
            F.col("median_mortgage_monthly").cast("string").alias("median_mortgage_repay_monthly"),
        ),
    }


def warehouse_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole warehouse from text: bronze, silver, histories, dimensions, fact and a mart."""
    warehouse = _stored_bronze(spark, sf_dir)
    for name, text in _reference_text(spark, sf_dir).items():
        warehouse.rebuild(f"bronze.{name}", text)
    pipeline.build(warehouse, history="all")
    return published(pipeline.tables(warehouse)["gold.dm_listing_neighbourhood"])


def warehouse_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly path: files delivered for four months (a few years of line items each), loaded and built one after
    the other, the last one delivered twice, and checked; what is returned is the mart that months have refreshed."""
    month = F.floor(F.year(ship_date()) % 8 / 2) + 1
    day = F.make_date(F.lit(2020), month.cast("int"), F.dayofyear(ship_date()) % 28 + 1)
    # rows without an id would fail the check on raw rows; silver leaves them out
    # a delivery reads the lines, cuts them to its month and makes text of what is left: the text is written once, as files
    raw = _raw_text(spark, sf_dir, day, dt.date(2020, 1, 1)).where("trim(listing_id) <> ''")
    folder = fresh_path(spark, "monthly")
    months = [r.load_month for r in raw.select("load_month").distinct().orderBy("load_month").collect()]
    for period in months:
        delivery = raw.where(F.col("load_month") == F.lit(period)).drop("load_month")
        with short_methods(spark):
            delivery.write.option("header", True).option("escape", '"').csv(f"{folder}/listings/{period:%m_%Y}.csv")
    for name, text in _reference_text(spark, sf_dir).items():
        whole = _as_text(text, name)
        whole.write.option("header", True).option("escape", '"').csv(f"{folder}/{REFERENCE_FILES[name].path}")
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    pipeline.backfill(warehouse, folder, "listings", checked=False)
    load_listings_label(warehouse, f"{folder}/listings", f"{months[-1]:%m_%Y}")
    pipeline.build(warehouse, changed=[months[-1]])
    pipeline.check(warehouse)
    return published(warehouse.read("gold.dm_property_type"))


# ---- metrics and marts ---------------------------------------------------------------------


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows with measures and part attributes, for the metric operators on their own."""
    return gold.with_measures(silver_table(spark, sf_dir)).withColumnRenamed("month_key", "month")


def mart_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(metrics.group_metrics(_measured(spark, sf_dir), ["property_type", "month"]))


def filtered_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = listing_rows(spark, sf_dir).where("has_availability")
    return metrics.exact_quantile(active, ["host_id"], "price", "median_price_active")


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_members(
        listing_rows(spark, sf_dir), ["listing_neighbourhood"], "host_id", "host_is_superhost"
    )


def mom_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active and inactive shipments per supplier and month, with change."""
    active = F.col("has_availability")
    per_month = (
        listing_rows(spark, sf_dir)
        .groupBy("host_id", F.col("month_key").alias("month"))
        .agg(
            F.sum(active.cast("int")).alias("listings_active"),
            F.sum((~active).cast("int")).alias("listings_inactive"),
        )
    )
    return published(metrics.with_changes(per_month, ["host_id"], "month", marts.CHANGES))


def mom_change_gap_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments per part and month with the change against the calendar month before; parts skip months."""
    per_month = listing_rows(spark, sf_dir).groupBy("listing_id", F.col("month_key").alias("month")).agg(rows().alias("n"))
    return published(metrics.with_changes(per_month, ["listing_id"], "month", {"n": "pct_change"}, gap_aware=True))


def median_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median price over six months from stored monthly sketches: the number of values, and whether the exact rank
    of the estimate lies within the stated error."""
    keys = ["listing_neighbourhood"]
    active = listing_rows(spark, sf_dir).where("has_availability").select(*keys, F.col("month_key").alias("month"), "price")
    sketches_ = written_once(sketches.month_sketches(active, keys, "month", "price"), "sketches")
    found = written_once(sketches.trailing_quantile(sketches_, keys, "month", 6, "estimate"), "estimates")
    # the exact ranks, from the rows again: values below the estimate, and up to it
    counted = active.groupBy(*keys, "month", F.col("price").cast("double").alias("price")).agg(rows().alias("n"))
    ahead = F.sequence("month", F.add_months("month", 5), F.expr("interval 1 month"))
    listed = counted.withColumn("month", F.explode(ahead)).join(F.broadcast(found), [*keys, "month"])
    ranks = listed.groupBy(*keys, "month", "n_values").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("price") < F.col("estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("price") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("upto"),
    )
    error = F.lit(sketches.rank_error()) * F.col("n") + 1
    middle = F.col("n") / 2
    within = (F.col("below") <= middle + error) & (F.col("upto") >= middle - error) & (F.col("n") == F.col("n_values"))
    return ranks.select(*keys, "month", "n", within.alias("within"))


def mart_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(marts.dm_listing_neighbourhood(_listing_month(spark, sf_dir)))


def mart_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(marts.dm_property_type(_listing_month(spark, sf_dir)))


def mart_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _, hosts, last = _gold(spark, sf_dir)
    return published(marts.dm_host_neighbourhood(fact, hosts, places(spark, sf_dir), last))


# ---- analyses ------------------------------------------------------------------------------


def q1_top_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(
        analysis.top_and_bottom_areas(
            _fact(spark, sf_dir),
            census_medians(spark, sf_dir),
            census_persons(spark, sf_dir),
            newest_month(spark, sf_dir),
        )
    )


def q2_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(
        analysis.age_revenue_correlation(
            _fact(spark, sf_dir), census_medians(spark, sf_dir), newest_month(spark, sf_dir)
        )
    )


def q3_best_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = silver_table(spark, sf_dir)
    fact = gold.fact_listing_monthly(stored, places(spark, sf_dir))
    months = as_of_join(
        fact, gold.listing_versions(stored), "listing_id", "snap_month",
        until=newest(stored, "month_key"), grain="month", spread=False,
    )
    return analysis.best_configurations(months.withColumnRenamed("snap_month", "month"))


def q4_multi_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(analysis.multi_listing_hosts(_fact(spark, sf_dir, "l_orderkey")))


def q4_primary_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.primary_areas(_fact(spark, sf_dir, "l_orderkey"), shown=None)


def q5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir, _fact(spark, sf_dir, "l_orderkey"))


def _coverage(spark: SparkSession, sf_dir: str, fact: DataFrame) -> DataFrame:
    return published(
        analysis.mortgage_coverage(
            fact,
            census_medians(spark, sf_dir),
            gold.dim_area(areas(spark, sf_dir)),
        )
    )


def report_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the ordered reports by their position."""
    # two reports read the same fact, of which they need five columns
    fact = _fact(spark, sf_dir, "l_orderkey").select("host_id", "lga_code", "listing_id", "has_availability", "est_revenue_30")
    fact = written_once(fact, "fact", "zstd")
    reports = {
        "configurations": (
            q3_best_config(spark, sf_dir), analysis.CONFIGURATION_ORDER, F.concat_ws("|", *analysis.CONFIGURATION_ORDER)
        ),
        "primary areas": (analysis.primary_areas(fact, shown=None), analysis.primary_order(), F.col("host_id").cast("string")),
        "coverage": (_coverage(spark, sf_dir, fact), analysis.coverage_order(), F.col("lga_code")),
    }
    found = [
        analysis.in_positions(report, *order).select(F.lit(name).alias("report"), "position", row.alias("row"))
        for name, (report, order, row) in reports.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


# ---- checks --------------------------------------------------------------------------------


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("line"),
    )
    return quality.check_not_null(marked, ["l_orderkey", "flag", "line"])


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("order_key")
    )
    return quality.check_unique(keys, "order_key")


def unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique_combination(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def referential_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host places of all listing rows against the nations; places past the 25th are missing."""
    child = listing_rows(spark, sf_dir).select(
        F.nullif(fn.name_key(F.col("host_neighbourhood")), F.lit("NATION39")).alias("place")
    )
    parent = table(spark, sf_dir, "nation").select(fn.name_key(F.col("n_name")).alias("nation"))
    return quality.check_relationship(child, "place", parent, "nation")


def _planted(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables under a rule, with violations of most rules planted in them."""

    def twice(df: DataFrame, where: Column) -> DataFrame:
        copies = F.array_repeat(F.lit(1), F.when(where, 2).otherwise(1))
        return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")

    def wide(df: DataFrame) -> DataFrame:
        return twice(df, F.col("month") >= "1998-01-01")

    stored = silver_table(spark, sf_dir)
    codes, named = areas(spark, sf_dir), places(spark, sf_dir)
    fact = written_once(gold.fact_listing_monthly(stored, named), "fact")
    hosts = written_once(gold.host_versions(stored), "hosts")
    listings = written_once(gold.listing_versions(stored), "listings")
    last = newest(stored, "month_key")
    listing_month = written_once(gold.int_listing_month(fact, listings, hosts, last), "listing-month")
    raw = listing_rows(spark, sf_dir).select(
        F.when(F.col("l_linenumber") != 7, F.col("listing_id")).alias("listing_id"), F.col("month_key").alias("load_month")
    )
    stray = F.when(F.col("listing_id") % 50 == 0, -F.col("host_id")).otherwise(F.col("host_id"))
    return {
        "bronze.listings_raw": raw,
        "silver.silver_listings": twice(stored, F.col("host_id") % 10 == 0),
        "silver.silver_lga_code": twice(
            codes.withColumn("lga_code", F.nullif("lga_code", F.lit("LGA00003"))), F.col("lga_name") < "F"
        ),
        "gold.dim_lga": twice(codes.where("lga_code <> 'LGA00007'"), F.col("lga_code") > "LGA00020"),
        "gold.dim_place": twice(
            named.withColumn("lga_code", F.nullif("lga_code", F.lit("LGA00004"))), F.col("match_type") == "suburb"
        ),
        "gold.fact_listing_monthly": twice(fact.withColumn("host_id", stray), F.col("listing_id") % 30 == 0),
        "gold.int_listing_month": listing_month.where("listing_id % 100 <> 1"),
        "gold.dim_listing": listings.where("valid_from <> '1995-03-01'"),
        "gold.dim_host": twice(hosts.withColumn("valid_to", F.add_months("valid_to", 1)), F.col("host_id") % 7 == 0),
        "gold.dm_listing_neighbourhood": wide(marts.dm_listing_neighbourhood(listing_month)),
        "gold.dm_property_type": wide(marts.dm_property_type(listing_month)),
        "gold.dm_host_neighbourhood": wide(marts.dm_host_neighbourhood(fact, hosts, named, last)),
    }


def build_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of a build as one result, over tables in which most are broken."""
    return rule_counts(_planted(spark, sf_dir), dt.date(1998, 6, 1))


def scd2_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host versions that end one month late and so run into the next version."""
    versions = gold.host_versions(silver(spark, sf_dir)).withColumn(
        "valid_to", F.add_months("valid_to", 1)
    )
    return quality.check_no_overlap(versions, "host_id", "dim_host")


def scd2_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host versions that end two months late: each pair that overlaps."""
    versions = gold.host_versions(silver(spark, sf_dir)).withColumn("valid_to", F.add_months("valid_to", 2))
    return quality.overlapping_pairs(written_once(versions, "late-versions"), "host_id", "dim_host")


def coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipping months in which no order was placed."""
    shipped = table(spark, sf_dir, "lineitem").select(fn.month_start(ship_date()).alias("month_key"))
    ordered = table(spark, sf_dir, "orders").select(
        fn.month_start(F.col("o_orderdate").cast("date")).alias("valid_from")
    )
    return quality.check_periods_covered(shipped, "month_key", ordered, "valid_from")


QUERIES: dict[str, Query] = {
    "typed_cast": typed_cast,
    "blank_to_null": blank_to_null,
    "tristate_bool": tristate_bool,
    "parse_date_multi": parse_date_multi,
    "clean_currency": clean_currency,
    "place_key": place_key,
    "unify_code": unify_code,
    "month_key": month_key,
    "period_label_parse": period_label_parse,
    "filters": filters,
    "safe_ratio": safe_ratio,
    "silver_listings": silver_from_text,
    "positional_csv": positional_csv,
    "csv_any_size": csv_any_size,
    "arrivals_stream": arrivals_stream,
    "load_guards": load_guards,
    "load_lineage": load_lineage,
    "csv_split_records": csv_split_records,
    "census_silver": census_silver,
    "period_replace": period_replace,
    "reference_refresh": reference_refresh,
    "backfill_order": backfill_order,
    "backfill_equivalence": backfill_equivalence,
    "result_csv": result_csv,
    "dedup_latest": dedup_latest,
    "host_representative": host_representative,
    "distinct_rows": distinct_rows,
    "resolve_priority": resolve_priority,
    "enrich_left": enrich_left,
    "fact_measures": fact_measures,
    "fact_build": fact_build,
    "publish_until": publish_until,
    "trailing_window": trailing_window,
    "rev_per_active": rev_per_active,
    "scd2_from_history": scd2_from_history,
    "scd2_dim": scd2_dim,
    "scd2_merge": scd2_merge,
    "scd2_changes": scd2_changes,
    "scd2_changes_merge": scd2_changes_merge,
    "temporal_inner": temporal_inner,
    "temporal_left": temporal_left,
    "join_preserves_rows": join_preserves_rows,
    "unmapped_bucket": unmapped_bucket,
    "warehouse_build": warehouse_build,
    "warehouse_monthly": warehouse_monthly,
    "mart_metrics": mart_metrics,
    "filtered_median": filtered_median,
    "median_sketch": median_sketch,
    "distinct_counts": distinct_counts,
    "mom_change": mom_change,
    "mom_change_gap_aware": mom_change_gap_aware,
    "mart_neighbourhood": mart_neighbourhood,
    "mart_property": mart_property,
    "mart_host": mart_host,
    "q1_top_bottom": q1_top_bottom,
    "q2_corr": q2_corr,
    "q3_best_config": q3_best_config,
    "q4_multi_hosts": q4_multi_hosts,
    "q4_primary_area": q4_primary_area,
    "q5_coverage": q5_coverage,
    "report_positions": report_positions,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "unique_combination": unique_combination,
    "referential_check": referential_check,
    "scd2_overlap": scd2_overlap,
    "scd2_overlap_pairs": scd2_overlap_pairs,
    "coverage_gap": coverage_gap,
    "build_checks": build_checks,
}
