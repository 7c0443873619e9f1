"""Published marts: as plans over everything, and as the slices that changed months make due. Sort them when presenting."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions import name_key, ratio
from stratamart.operators.metrics import group_metrics, with_changes, with_rates
from stratamart.operators.storage import bounded_broadcast, written_once
from stratamart.operators.temporal import as_of_join

UNMAPPED = "UNMAPPED"
NEIGHBOURHOOD_KEYS = ("listing_neighbourhood",)
PROPERTY_KEYS = ("property_type", "room_type", "accommodates")
CHANGES = {"listings_active": "pct_change_active", "listings_inactive": "pct_change_inactive"}


def listing_mart(listing_month: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Metric set per group and month, with rates and change against the group's last month.

    ``listing_month`` is read twice, for the metrics and for medians: pass a stored table.
    """
    metrics = with_changes(
        with_rates(group_metrics(listing_month, [*keys, "month"])), keys, "month", CHANGES
    )
    return metrics.select(
        *keys,
        "month",
        "listings_total",
        "listings_active",
        "listings_inactive",
        "active_listings_rate",
        "min_price_active",
        "max_price_active",
        "median_price_active",
        "avg_price_active",
        "hosts_total",
        "superhost_rate",
        "avg_rating_active",
        "pct_change_active",
        "pct_change_inactive",
        "total_stays_active",
        "avg_est_revenue_active",
    )


def due_after(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], due: Collection[dt.date]) -> set[dt.date]:
    """Months whose changes depend on a due month: in which some group is seen next after one.

    A group counts that a due month holds now or held before. Only keys and months are read.
    """
    seen = stored.select(*keys, "month").unionByName(fresh.select(*keys, "month")).distinct()
    is_due = F.col("month").isin(list(due))
    before = F.lag(is_due).over(Window.partitionBy(*keys).orderBy("month"))
    # a stored group that has left a due month still marks the month after it
    following = seen.withColumn("_next", before & ~is_due).where("_next")
    return {row.month for row in following.select("month").distinct().collect()}  # some months at most


def refreshed_slices(
    listing_month: DataFrame, stored: DataFrame, keys: Sequence[str], due: Collection[dt.date]
) -> tuple[DataFrame, set[dt.date]]:
    """The slices of a listing mart to be replaced when ``due`` months of its input have changed, and their months.

    Metrics are made for the due months only. Those of other months stand as they are, but the first month of a group
    after a due one compares with it, so its slice gets new changes. Of all other slices only keys and counts are
    read, to find each group's month before.
    """
    last = stored.agg(F.max("month")).first()[0]
    months = F.col("month").isin(list(due))
    fresh = with_rates(group_metrics(listing_month.where(months), [*keys, "month"])).drop("hosts_super")
    if last is not None and last > min(due):
        fresh = written_once(fresh, "due-metrics")
        following = due_after(stored, fresh, keys, due)
    else:
        following = set()
    wanted = set(due) | following
    kept = stored.where(~months & (F.col("month") <= F.lit(max(wanted))))
    again = F.col("month").isin(list(following))
    narrow = kept.where(~again).select(*keys, "month", *CHANGES)
    whole = kept.where(again).drop(*CHANGES.values())
    rows = fresh.unionByName(whole, allowMissingColumns=True).unionByName(narrow, allowMissingColumns=True)
    changed = with_changes(rows, keys, "month", CHANGES).where(F.col("month").isin(list(wanted)))
    return changed.select(*stored.columns), wanted


def dm_listing_neighbourhood(listing_month: DataFrame) -> DataFrame:
    return listing_mart(listing_month, NEIGHBOURHOOD_KEYS)


def dm_property_type(listing_month: DataFrame) -> DataFrame:
    return listing_mart(listing_month, PROPERTY_KEYS)


def with_host_area(hosts: DataFrame, places: DataFrame) -> DataFrame:
    """Host versions with the area of the host's own neighbourhood, or the unmapped bucket."""
    area = bounded_broadcast(
        places.select(F.col("place_key").alias("_place"), F.col("lga_name").alias("_area"))
    )
    return (
        hosts.join(area, name_key(F.col("host_neighbourhood")) == F.col("_place"), "left")
        .withColumn("host_neighbourhood_lga", F.coalesce("_area", F.lit(UNMAPPED)))
        .drop("_place", "_area")
    )


def host_month_areas(
    fact: DataFrame,
    hosts: DataFrame,
    places: DataFrame,
    until: Column | dt.date | None = None,
    since: Column | dt.date | None = None,
) -> DataFrame:
    """Listing-months and active revenue per host and month with the host's area that month.

    The fact shrinks to one row per host and month before the join, so a host with very many
    listings is one row there. Rows without a host version are dropped.
    """
    per_host = fact.groupBy("host_id", F.col("snap_month").alias("month")).agg(
        F.count(F.lit(1)).alias("listing_months"),
        F.sum(F.when(F.col("has_availability"), F.col("est_revenue_30"))).alias("revenue"),
    )
    versions = with_host_area(
        hosts.select("host_id", "host_neighbourhood", "valid_from", "valid_to"), places
    ).drop("host_neighbourhood")
    return as_of_join(per_host, versions, "host_id", "month", until=until, since=since, grain="month")


def dm_host_neighbourhood(
    fact: DataFrame,
    hosts: DataFrame,
    places: DataFrame,
    until: Column | dt.date | None = None,
    since: Column | dt.date | None = None,
) -> DataFrame:
    """Hosts and estimated revenue per area of the host and month."""
    return (
        host_month_areas(fact, hosts, places, until, since)
        .groupBy("host_neighbourhood_lga", "month")
        .agg(
            F.countDistinct("host_id").alias("distinct_hosts"),
            F.sum("revenue").alias("estimated_revenue"),
        )
        .withColumn(
            "estimated_revenue_per_host",
            F.round(ratio(F.col("estimated_revenue"), F.col("distinct_hosts")), 2),
        )
    )
