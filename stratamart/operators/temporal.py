"""Joins and filters over time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.validity import valid_on


def _as_column(value: Column | dt.date) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def newest(df: DataFrame, period: str) -> Column:
    """Largest period as a scalar subquery: resolved once, then an ordinary bound."""
    return df.agg(F.max(period)).scalar()


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    on: str,
    how: str = "inner",
    until: Column | dt.date | None = None,
    grain: str = "day",
    since: Column | dt.date | None = None,
    spread: bool = True,
) -> DataFrame:
    """Attach to each fact the version of ``key`` that was valid on the fact's date.

    An interval condition alone would compare every fact of a key with every version of it,
    and put a busy key's facts into one join group. Versions are instead listed once per month
    they touch, which turns the join into an equi join on (key, month): a fact meets only the
    versions of its own month, the exact interval condition decides, and a busy key is spread
    over its months (adaptive skew handling splits what is still large). A version covers a
    month at most once, so the list stays within keys x months.

    ``spread=False`` is for keys that have about one fact a month, whatever the table's size: no list is made, the
    versions as they are join on the key alone, and what moves is the versions instead of their months. Versions already
    partitioned by key do not move at all. A key's facts are then compared with all its versions.

    Versions are never broadcast on an estimate: files of histories pack very small, and listed by month they are many
    times what the estimate says, all of it in the driver's memory.

    ``until`` is the last date any fact may have and closes open versions for the listing; it
    is looked up in ``facts`` when not given. ``since`` is the first one: versions outside the two
    bounds are not read, and months before it are not listed. A fact beyond a given bound fails the
    join. ``grain='month'`` states that facts are dated by the
    first day of their month; facts already partitioned by key and month then join without moving.
    Version columns other than the key must not clash with fact columns; ``valid_from`` and
    ``valid_to`` are dropped from the result.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    if grain not in ("day", "month"):
        raise ValueError(f"grain must be 'day' or 'month', got {grain!r}")
    last = newest(facts, on) if until is None else _as_column(until)
    attributes = [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    outside = F.lit(False) if until is None else F.col(on) > last
    if since is not None:
        first = _as_column(since)
        outside = outside | (F.col(on) < first)
        versions = versions.where(F.col("valid_to").isNull() | (F.col("valid_to") > first))
        versions = versions.where(F.col("valid_from") <= last)
    if until is not None or since is not None:
        refused = F.raise_error(F.concat(F.lit("a fact lies beyond the bounds: "), F.col(on).cast("string")))
        facts = facts.where(F.when(F.coalesce(outside, F.lit(False)), refused.cast("boolean")).otherwise(True))
    if not spread:
        closed = versions.withColumnRenamed(key, "_key").hint("merge")
        matches = (F.col(key) == F.col("_key")) & valid_on(F.col(on), F.col("valid_from"), F.col("valid_to"))
        return facts.join(closed, matches, how).drop("_key", "valid_from", "valid_to")
    start = F.col("valid_from") if since is None else F.greatest(F.col("valid_from"), _as_column(since))
    listed = (
        versions.withColumn("_last", F.least(F.date_sub("valid_to", 1), last))
        .where(F.col("_last") >= F.col("valid_from"))
        .withColumn(
            "_month",
            F.explode(
                F.sequence(
                    F.trunc(start, "MM"), F.trunc("_last", "MM"), F.expr("interval 1 month")
                )
            ),
        )
        .select(
            F.col(key).alias("_key"), "_month", "valid_from", "valid_to", *attributes
        )
    )
    matches = (
        (F.col(key) == F.col("_key"))
        & ((F.col(on) if grain == "month" else F.trunc(on, "MM")) == F.col("_month"))
        & valid_on(F.col(on), F.col("valid_from"), F.col("valid_to"))
    )
    return facts.join(listed.hint("merge"), matches, how).drop("_key", "_month", "valid_from", "valid_to")


def trailing_months(
    df: DataFrame, period: str, months: int = 12, until: Column | dt.date | None = None
) -> DataFrame:
    """Rows of the last ``months`` months, ending at ``until`` or the newest period present.

    The bound is a scalar, never a joined one-row table, so it reaches the scan as a
    partition filter.
    """
    last = newest(df, period) if until is None else _as_column(until)
    return df.where(F.col(period).between(F.add_months(last, 1 - months), last))


def published_until(df: DataFrame, period: str, until: Column | dt.date) -> DataFrame:
    return df.where(F.col(period) <= _as_column(until))
