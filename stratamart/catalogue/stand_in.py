"""The test tables read as deliveries: a line item is a listing row, a part a listing, a
supplier (or an order) a host, a nation an area and a region a suburb lying in several areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions import month_start, unify_code
from stratamart.functions.numbers import MONEY
from stratamart.operators.dedup import latest_per_key
from stratamart.operators.storage import bounded_broadcast, written_once
from stratamart.operators.temporal import newest
from stratamart.plans import gold

# 25 nations; neighbourhood classes beyond them belong to no area
CLASSES = 27
HOST_PLACES = 40
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_date() -> Column:
    return F.col("l_shipdate").cast("date")


def listing_rows(spark: SparkSession, sf_dir: str, host: str = "l_suppkey") -> DataFrame:
    """Typed listing rows with repeats: a part can be shipped several times in a month."""
    return _as_listings(table(spark, sf_dir, "lineitem"), host, month_start(ship_date()))


def _as_listings(lines: DataFrame, host: str, month: Column) -> DataFrame:
    return lines.select(
        F.col("l_partkey").alias("listing_id"),
        month.alias("month_key"),
        ship_date().alias("scraped_dt"),
        F.col(host).alias("host_id"),
        F.concat(F.lit("Host "), F.col(host).cast("string")).alias("host_name"),
        (F.col("l_linestatus") == "O").alias("host_is_superhost"),
        F.concat(F.lit("Nation "), (F.col("l_orderkey") % HOST_PLACES).cast("string")).alias(
            "host_neighbourhood"
        ),
        F.concat(F.lit("nation_"), (F.col("l_partkey") % CLASSES).cast("string")).alias(
            "listing_neighbourhood"
        ),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        (F.col("l_returnflag") != "R").alias("has_availability"),
        (F.col("l_quantity").cast("int") % 31).alias("availability_30"),
        (F.col("l_linenumber") * 10).alias("review_scores_rating"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
    )


def silver(spark: SparkSession, sf_dir: str, host: str = "l_suppkey") -> DataFrame:
    """One row per part and ship month: the latest shipment, by a total order.

    Lines are cut down as they are; names and measures are made of what is left, so they do not move.
    """
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    latest = latest_per_key(
        lines.withColumns({"_day": ship_date(), "_month": month_start(ship_date())}),
        ["l_partkey", "_month"],
        ["_day", "l_orderkey", "l_linenumber"],
        [F.col("l_suppkey").asc(), F.col("l_extendedprice").asc()],
    )
    # the month of the key itself, so that bounds on it reach the scan
    return _as_listings(latest, host, F.col("_month")).drop("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def with_part(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes that depend on the part alone, attached after the repeats are gone."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("listing_id"),
        F.col("p_type").alias("property_type"),
        F.col("p_brand").alias("room_type"),
        F.col("p_size").alias("accommodates"),
    )
    return rows.join(bounded_broadcast(part), "listing_id")


def silver_table(spark: SparkSession, sf_dir: str, host: str = "l_suppkey") -> DataFrame:
    """Silver written once, as in a warehouse, for plans that read it for the fact and for
    both histories."""
    return written_once(with_part(silver(spark, sf_dir, host), spark, sf_dir), "silver", "zstd")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        unify_code(F.col("n_nationkey").cast("string")).alias("lga_code"),
        F.upper(F.trim("n_name")).alias("lga_name"),
    )


def suburbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region names as suburbs, each lying in the areas of its nations."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.upper(F.trim("r_name")).alias("suburb_name"), F.upper(F.trim("n_name")).alias("lga_name")
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places written once, as in a warehouse, so that joins know their size."""
    return written_once(gold.dim_place(areas(spark, sf_dir), suburbs(spark, sf_dir)), "places")


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per area from its customers, with the column names of both census dimensions."""
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    mean = F.sum(balance).cast("double") / F.count(balance)
    return (
        table(spark, sf_dir, "customer")
        .groupBy(unify_code(F.col("c_nationkey").cast("string")).alias("lga_code"))
        .agg(
            F.round(mean / 100).cast("int").alias("median_age_persons"),
            F.round(F.max(balance)).cast("int").alias("median_mortgage_monthly"),
            F.count(F.when(F.col("c_mktsegment") == "BUILDING", 1)).alias("total_pop_male"),
            F.count(F.when(F.col("c_mktsegment") != "BUILDING", 1)).alias("total_pop_female"),
            F.count(F.lit(1)).alias("total_pop"),
            F.round(F.min(balance)).cast("int").alias("average_household_size"),
        )
    )


def census_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = census(spark, sf_dir).select(
        "lga_code", "median_age_persons", "median_mortgage_monthly", "average_household_size"
    )
    return gold.with_area_name(medians, areas(spark, sf_dir))


def census_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = census(spark, sf_dir).select(
        "lga_code", "total_pop_male", "total_pop_female", "total_pop"
    )
    return gold.with_area_name(persons, areas(spark, sf_dir))


def newest_month(spark: SparkSession, sf_dir: str) -> Column:
    """Newest ship month, from one column of the raw rows: de-duplication keeps every month."""
    rows = table(spark, sf_dir, "lineitem").select(month_start(ship_date()).alias("month_key"))
    return newest(rows, "month_key")


def published(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for reports and comparisons."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
