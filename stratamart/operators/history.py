"""Slowly changing dimensions, type 2, with half-open ``[valid_from, valid_to)`` versions.

Two ways to the same history:

* ``versions_from_history``: all periods at once, one window.
* ``merge_versions``: one period at a time against the open versions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def versions_from_history(
    df: DataFrame, key: str, period: str, attributes: Sequence[str]
) -> DataFrame:
    """One version per (key, period); it ends where the key is seen next.

    ``df`` holds one row per (key, period), so a window group is as long as the number of
    periods, whatever the number of raw rows.
    """
    later = F.lead(period).over(Window.partitionBy(key).orderBy(period))
    return df.select(key, *attributes, F.col(period).alias("valid_from"), later.alias("valid_to"))


def advance_open_versions(
    open_versions: DataFrame, incoming: DataFrame, key: str, period: str
) -> DataFrame:
    """Open versions after one more period: those closed by it, kept open, and newly opened.

    A key seen for the first time opens a version. A strictly later period closes the open
    version at its date and opens the next. The same or an earlier period changes nothing,
    and an absent key stays open. Keys must be unique and not NULL on both sides, so the one
    join is one to one.
    """
    attributes = [c for c in open_versions.columns if c not in (key, "valid_from", "valid_to")]
    old, new = open_versions.alias("old"), incoming.alias("new")
    is_newer = F.col(f"new.{period}") > F.col("old.valid_from")

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            F.col(f"{side}.{key}").alias(key),
            *[F.col(f"{side}.{a}").alias(a) for a in attributes],
            start.alias("valid_from"),
            end.cast("date").alias("valid_to"),
        )

    kept = F.when(
        F.col(f"old.{key}").isNotNull(),
        version("old", F.col("old.valid_from"), F.when(is_newer, F.col(f"new.{period}"))),
    )
    opened = F.when(
        F.col(f"new.{key}").isNotNull() & (F.col(f"old.{key}").isNull() | is_newer),
        version("new", F.col(f"new.{period}"), F.lit(None)),
    )
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    versions = joined.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v"))
    return versions.select("v.*").select(*open_versions.columns)


def merge_versions(
    current: DataFrame, incoming: DataFrame, key: str, period: str
) -> DataFrame:
    """Whole history after one more period. Closed versions pass through untouched."""
    advanced = advance_open_versions(current.where("valid_to IS NULL"), incoming, key, period)
    return current.where("valid_to IS NOT NULL").unionByName(advanced)


def changes_from_history(
    df: DataFrame, key: str, period: str, attributes: Sequence[str]
) -> DataFrame:
    """Compact history: one version per run of equal attributes, NULL equal to NULL.

    A run goes on over periods in which the key is not seen, and ends where it is seen with another value.
    """
    own = F.struct(*attributes)
    before = F.lag(own).over(Window.partitionBy(key).orderBy(period))  # NULL for the first one only
    changed = df.withColumn("_changed", ~own.eqNullSafe(before)).where("_changed").drop("_changed")
    return versions_from_history(changed, key, period, attributes)


def merge_changes(
    current: DataFrame, incoming: DataFrame, key: str, period: str
) -> DataFrame:
    """Compact history after one more period: a run that goes on is left alone, one that ends is closed.

    Periods have to come in order. Only open runs are looked at.
    """
    attributes = [c for c in current.columns if c not in (key, "valid_from", "valid_to")]
    known = current.where("valid_to IS NULL").select(
        F.col(key).alias("_key"), F.struct(*attributes).alias("_known")
    )
    changed = (
        incoming.join(known, F.col(key) == F.col("_key"), "left")
        .where(~F.struct(*attributes).eqNullSafe(F.col("_known")))
        .select(*incoming.columns)
    )
    return merge_versions(current, changed, key, period)


def as_dimension(versions: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Published form: date bounds and a flag for the open version."""
    return versions.select(
        key,
        *attributes,
        F.col("valid_from").cast("date").alias("valid_from"),
        F.col("valid_to").cast("date").alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )
