"""Five business questions over the gold layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions import percent_of, ratio
from stratamart.operators.ordering import numbered
from stratamart.operators.storage import bounded_broadcast
from stratamart.operators.temporal import trailing_months

TRAILING_MONTHS = 12


def revenue_per_active(fact: DataFrame) -> DataFrame:
    """Revenue per active listing-month by area; NULL for an area without active rows."""
    active = F.col("has_availability")
    return fact.groupBy("lga_code").agg(
        ratio(
            F.sum(F.when(active, F.col("est_revenue_30")).otherwise(0)),
            F.sum(F.when(active, 1).otherwise(0)),
        ).alias("rev_per_active")
    )


CONFIGURATION_ORDER = ("listing_neighbourhood", "rank_in_nhood", "property_type", "room_type", "accommodates")


def primary_order() -> list[Column]:
    return [F.col("host_id").asc_nulls_last()]


def coverage_order() -> list[Column]:
    return [F.col("pct_cover").desc_nulls_first(), F.col("lga_name").asc(), F.col("lga_code").asc()]


def in_positions(report: DataFrame, *order: Column | str) -> DataFrame:
    """A report with each row's position in its order, from 1: rows may then be stored and read in any order."""
    return numbered(report, *[F.col(c) if isinstance(c, str) else c for c in order], start=1)


def _within_rank(df: DataFrame, order: Column, places: int, bucket: str) -> DataFrame:
    """Rows ranked up to ``places``, ties kept. Map tasks cut to that rank before the one
    ordered task, which sees a few rows per task."""
    ranked = df.withColumn("_rank", F.rank().over(Window.orderBy(order)))
    return ranked.where(F.col("_rank") <= places).drop("_rank").withColumn("bucket", F.lit(bucket))


def top_and_bottom_areas(
    fact: DataFrame,
    medians: DataFrame,
    persons: DataFrame,
    until: Column | dt.date | None = None,
    places: int = 3,
) -> DataFrame:
    """Q1: areas that earn most and least per active listing over the trailing year.

    Rows without an area compete as one area; an area without revenue ranks first from above.
    """
    areas = revenue_per_active(
        trailing_months(fact, "snap_month", TRAILING_MONTHS, until)
    )
    picked = _within_rank(
        areas, F.col("rev_per_active").desc_nulls_first(), places, "TOP_3"
    ).unionByName(
        _within_rank(areas, F.col("rev_per_active").asc_nulls_last(), places, "BOTTOM_3")
    )
    return (
        picked.join(medians, "lga_code", "left")
        .join(persons.drop("lga_name"), "lga_code", "left")
        .select(
            "bucket",
            "lga_name",
            F.round("rev_per_active", 2).alias("rev_per_active"),
            "median_age_persons",
            "average_household_size",
            "total_pop_male",
            "total_pop_female",
            "total_pop",
        )
        .orderBy(
            F.col("rev_per_active").desc_nulls_first(),
            F.col("bucket").desc(),
            F.col("lga_name").asc_nulls_last(),
        )
    )


def age_revenue_correlation(
    fact: DataFrame, medians: DataFrame, until: Column | dt.date | None = None
) -> DataFrame:
    """Q2: does an area's median age go with revenue per active listing?

    NULL when there is nothing to go with: fewer than two areas, or all of one age or of one revenue.
    """
    areas = revenue_per_active(trailing_months(fact, "snap_month", TRAILING_MONTHS, until))
    joined = areas.join(medians.select("lga_code", "median_age_persons"), "lga_code").where(
        "rev_per_active IS NOT NULL AND median_age_persons IS NOT NULL"
    )
    revenue, age = F.col("rev_per_active").cast("double"), F.col("median_age_persons").cast("double")
    # F.corr divides by zero, which is an error, where all areas have the same age or revenue
    spread = F.nullif(F.stddev_pop(revenue) * F.stddev_pop(age), F.lit(0.0))
    corr = F.covar_pop(revenue, age) / spread
    return joined.agg(
        F.count(F.lit(1)).alias("n_lgas"),
        F.round(F.avg("rev_per_active"), 2).alias("avg_rev_per_active"),
        F.round(F.avg(F.col("median_age_persons").cast("decimal(12,4)")), 2).alias("avg_median_age"),
        corr.alias("_corr"),
    ).select(
        "n_lgas",
        "avg_rev_per_active",
        "avg_median_age",
        F.round(F.col("_corr").cast("decimal(20,12)"), 4).alias("corr_rev_age"),
    )


def best_configurations(listing_month: DataFrame, neighbourhoods: int = 5, places: int = 3) -> DataFrame:
    """Q3: most stayed-in configurations of the neighbourhoods with the best monthly revenue.

    ``listing_month`` is the fact with the attributes valid each month, as the build stores it. A
    neighbourhood's figure is the plain mean of its monthly means.
    """
    attributes = ["listing_neighbourhood", "property_type", "room_type", "accommodates"]
    revenue = F.when(F.col("has_availability"), F.col("est_revenue_30"))
    months = (
        listing_month.where("listing_neighbourhood IS NOT NULL")
        .groupBy(*attributes, "month")
        .agg(
            F.sum(revenue).alias("revenue"),
            F.count(revenue).alias("revenues"),
            F.sum(F.when(F.col("has_availability"), F.col("booked_nights_30"))).alias("stays"),
        )
    )
    best = (
        months.groupBy("listing_neighbourhood", "month")
        .agg(ratio(F.sum("revenue"), F.sum("revenues")).alias("mean"))
        .groupBy("listing_neighbourhood")
        .agg(F.round(F.avg("mean"), 2).alias("avg_rev_per_active"))
        .orderBy(F.col("avg_rev_per_active").desc_nulls_first(), "listing_neighbourhood")
        .limit(neighbourhoods)
    )
    stays = (
        months.join(F.broadcast(best), "listing_neighbourhood", "left_semi")
        .groupBy(*attributes)
        .agg(F.sum("stays").alias("total_stays"))
    )
    order = Window.partitionBy("listing_neighbourhood").orderBy(
        F.col("total_stays").desc_nulls_last()
    )
    return (
        stays.withColumn("rank_in_nhood", F.rank().over(order))
        .where(F.col("rank_in_nhood") <= places)
        .orderBy(*CONFIGURATION_ORDER)
    )


def multi_listing_hosts(fact: DataFrame) -> DataFrame:
    """Q4a: hosts with more than one listing, and how many of them cover several areas.

    More than one listing means the lowest and highest id differ, so no distinct counts are
    needed: two aggregates combine in the map tasks, however many listings a host has.
    """
    per_host = (
        fact.where("lga_code IS NOT NULL")
        .groupBy("host_id", "lga_code")
        .agg(F.min("listing_id").alias("_low"), F.max("listing_id").alias("_high"))
        .groupBy("host_id")
        .agg(
            (F.min("_low") < F.max("_high")).alias("_multi"),
            F.count(F.lit(1)).alias("_areas"),
        )
    )
    multi = F.col("_multi")
    return per_host.agg(
        F.count(F.when(multi, 1)).alias("multi_hosts"),
        F.count(F.when(multi & (F.col("_areas") == 1), 1)).alias("multi_hosts_one_lga"),
        F.count(F.when(multi & (F.col("_areas") > 1), 1)).alias("multi_hosts_multi_lga"),
    ).withColumn(
        "pct_multi_lga", percent_of(F.col("multi_hosts_multi_lga"), F.col("multi_hosts"))
    )


def primary_areas(fact: DataFrame, shown: int | None = 20) -> DataFrame:
    """Q4b: each host's area with most listings (lowest code on ties), first hosts by id."""
    per_area = (
        fact.where("lga_code IS NOT NULL")
        .select("host_id", "lga_code", "listing_id")
        .distinct()
        .groupBy("host_id", "lga_code")
        .agg(F.count("listing_id").alias("listings_in_lga"))
    )
    order = Window.partitionBy("host_id").orderBy(
        F.col("listings_in_lga").desc(), F.col("lga_code").asc()
    )
    primary = (
        per_area.withColumn("_rank", F.rank().over(order))
        .where("_rank = 1")
        .select("host_id", F.col("lga_code").alias("primary_lga"), "listings_in_lga")
    )
    ordered = primary.orderBy(*primary_order())
    return ordered if shown is None else ordered.limit(shown)


def mortgage_coverage(fact: DataFrame, medians: DataFrame, areas: DataFrame) -> DataFrame:
    """Q5: share of single-listing hosts whose active revenue covers a year of mortgage.

    A host is single when all its rows share one listing and one area, NULL counting as a
    value of its own. Hosts without active revenue do not cover.
    """
    revenue = F.when(F.col("has_availability"), F.coalesce("est_revenue_30", F.lit(0)))
    known = F.count("listing_id")
    rows = F.count(F.lit(1))
    single = (
        fact.where("host_id IS NOT NULL")
        .groupBy("host_id", "lga_code")
        .agg(
            ((known == 0) | ((known == rows) & (F.min("listing_id") == F.max("listing_id")))).alias(
                "_one_listing"
            ),
            F.sum(revenue).alias("_revenue"),
        )
        .groupBy("host_id")
        .agg(
            F.count(F.lit(1)).alias("_areas"),
            F.bool_and("_one_listing").alias("_one_listing"),
            F.max("lga_code").alias("lga_code"),
            F.max("_revenue").alias("rev_12m"),
        )
        .where("_areas = 1 AND _one_listing")
    )
    mortgage = bounded_broadcast(
        medians.select("lga_code", (F.col("median_mortgage_monthly") * 12).alias("annual_mortgage"))
        .join(areas.select("lga_code", "lga_name"), "lga_code")
    )
    covers = F.sum(F.when(F.col("rev_12m") >= F.col("annual_mortgage"), 1).otherwise(0))
    return (
        single.join(mortgage, "lga_code")
        .groupBy("lga_name", "lga_code")
        .agg(F.count(F.lit(1)).alias("single_hosts"), covers.alias("can_cover"))
        .withColumn("pct_cover", percent_of(F.col("can_cover"), F.col("single_hosts")))
        .orderBy(*coverage_order())
    )
