"""Dimensions, the monthly fact, and the fact with attributes as of its month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions import name_key
from stratamart.operators.dedup import first_per_key
from stratamart.operators.history import as_dimension, versions_from_history
from stratamart.operators.storage import bounded_broadcast
from stratamart.operators.temporal import as_of_join, published_until

# Names of published columns, and how a place was matched.
LISTING_ATTRIBUTES = (
    "listing_neighbourhood",
    "property_type",
    "room_type",
    "accommodates",
    "review_scores_rating",
)
HOST_ATTRIBUTES = ("host_name", "host_is_superhost", "host_neighbourhood")
PLACE_MATCHES = ("lga_name", "suburb")
NIGHTS = 30


# ---- history inputs ------------------------------------------------------------------------


def host_months(silver: DataFrame) -> DataFrame:
    """One row per host and month: that of the latest scrape, then of the lowest listing id."""
    return first_per_key(
        silver.where("host_id IS NOT NULL").select(
            "host_id", "month_key", "scraped_dt", "listing_id", *HOST_ATTRIBUTES
        ),
        ["host_id", "month_key"],
        [F.col("scraped_dt").desc_nulls_first(), F.col("listing_id").asc_nulls_last()],
    ).select("host_id", "month_key", *HOST_ATTRIBUTES)


def listing_months(silver: DataFrame) -> DataFrame:
    return silver.select("listing_id", "month_key", *LISTING_ATTRIBUTES)


def listing_versions(silver: DataFrame) -> DataFrame:
    """Listing history over all months at once."""
    return versions_from_history(
        listing_months(silver), "listing_id", "month_key", LISTING_ATTRIBUTES
    )


def host_versions(silver: DataFrame) -> DataFrame:
    """Host history over all months at once."""
    return versions_from_history(host_months(silver), "host_id", "month_key", HOST_ATTRIBUTES)


def dim_listing(versions: DataFrame) -> DataFrame:
    return as_dimension(versions, "listing_id", LISTING_ATTRIBUTES)


def dim_host(versions: DataFrame) -> DataFrame:
    return as_dimension(versions, "host_id", HOST_ATTRIBUTES)


# ---- areas ---------------------------------------------------------------------------------


def dim_area(areas: DataFrame) -> DataFrame:
    return areas.where("lga_code IS NOT NULL").select("lga_code", "lga_name").distinct()


def dim_place(areas: DataFrame, suburbs: DataFrame) -> DataFrame:
    """Place name to area, one row per name key.

    A name that areas bear belongs to the one of them with the lowest code. Any other name of a suburb belongs to the
    area with the lowest code among those that the suburb lies in.
    """
    home = F.struct("lga_code", F.col("lga_name").isNull().alias("unnamed"), "lga_name")

    def lowest(rows: DataFrame, name: str, match_type: str) -> DataFrame:
        per_key = rows.groupBy(name_key(F.col(name)).alias("place_key")).agg(F.min(home).alias("home"))
        return per_key.select("place_key", "home.lga_code", "home.lga_name", F.lit(match_type).alias("match_type"))

    own = lowest(areas, "lga_name", PLACE_MATCHES[0])
    inside = lowest(suburbs.join(areas, "lga_name"), "suburb_name", PLACE_MATCHES[1])
    return own.unionByName(inside.join(own, "place_key", "left_anti"))


def with_area_name(census: DataFrame, areas: DataFrame) -> DataFrame:
    """Census rows with the area's name after its code; areas unknown to the list keep NULL."""
    values = [c for c in census.columns if c != "lga_code"]
    return census.join(areas.select("lga_code", "lga_name"), "lga_code", "left").select(
        "lga_code", "lga_name", *values
    )


# ---- fact ----------------------------------------------------------------------------------


def with_measures(rows: DataFrame) -> DataFrame:
    """Booked nights out of the next 30 and the revenue they stand for; NULLs carry through."""
    booked = F.lit(NIGHTS) - F.col("availability_30")
    return rows.withColumns(
        {"booked_nights_30": booked, "est_revenue_30": F.col("price") * booked}
    )


def fact_listing_monthly(
    silver: DataFrame, places: DataFrame, until: Column | dt.date | None = None
) -> DataFrame:
    """Keys and measures per listing and month, up to the newest loaded month.

    ``until`` is that month. Silver may hold later rows, whose versions do not exist yet.
    """
    rows = silver if until is None else published_until(silver, "month_key", until)
    area = bounded_broadcast(
        places.select("place_key", "lga_code").withColumnRenamed("place_key", "_place")
    )
    return (
        with_measures(rows)
        .join(area, name_key(F.col("listing_neighbourhood")) == F.col("_place"), "left")
        .select(
            F.col("month_key").alias("snap_month"),
            "listing_id",
            "host_id",
            "lga_code",
            "price",
            "availability_30",
            "has_availability",
            "booked_nights_30",
            "est_revenue_30",
        )
    )


def int_listing_month(
    fact: DataFrame,
    listings: DataFrame,
    hosts: DataFrame,
    until: Column | dt.date | None = None,
    since: Column | dt.date | None = None,
) -> DataFrame:
    """Fact rows with listing and host attributes as they were that month.

    With the bounds of the fact's months, only the versions that reach into them are read. A fact without a listing version is dropped, one without a host version is kept.
    """
    measures = fact.select(
        "snap_month",
        "listing_id",
        "host_id",
        "price",
        "has_availability",
        "booked_nights_30",
        "est_revenue_30",
    )
    # hosts first: the rows that move for the second join are still narrow
    with_host = as_of_join(
        measures,
        hosts.select("host_id", "host_is_superhost", "valid_from", "valid_to"),
        "host_id",
        "snap_month",
        how="left",
        until=until,
        since=since,
        grain="month",
    )
    with_listing = as_of_join(
        with_host,
        listings.select("listing_id", *LISTING_ATTRIBUTES, "valid_from", "valid_to"),
        "listing_id",
        "snap_month",
        until=until,
        since=since,
        grain="month",
        spread=False,
    )
    return with_listing.select(
        F.col("snap_month").alias("month"),
        "listing_id",
        "host_id",
        *LISTING_ATTRIBUTES,
        "host_is_superhost",
        "price",
        "has_availability",
        "booked_nights_30",
        "est_revenue_30",
    )
