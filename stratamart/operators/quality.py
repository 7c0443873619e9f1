"""Data-quality checks. Each returns the failing rows; no rows means the check passes.

Repeated keys are counted with map-side aggregation before they move, so a key that repeats
often is no more work than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_null) for every listed column with NULLs, in one pass over the table."""
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count(F.when(F.col(c).isNull(), F.lit(1))).alias("n_null"),
                )
                for c in columns
            ]
        ).alias("counts")
    )
    return counts.select(F.inline("counts")).where("n_null > 0")


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count; NULL keys form a group."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return check_unique_combination(df.where(F.col(column).isNotNull()), [column])


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child values with no parent, with the number of rows holding each; NULL is allowed."""
    held = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return held.join(known, F.col(column) == F.col("_parent"), "left_anti")


def check_no_overlap(versions: DataFrame, key: str, dimension: str) -> DataFrame:
    """Versions still valid when a later version of the same key starts.

    Comparing each start date with the next one finds exactly the versions that overlap some
    later one; pairs are never formed.
    """
    far = F.lit("9999-12-31").cast("date")
    starts = versions.groupBy(F.col(key).alias("id"), "valid_from").agg(
        F.max(F.coalesce("valid_to", far)).alias("_until")
    )
    following = F.lead("valid_from").over(Window.partitionBy("id").orderBy("valid_from"))
    return (
        starts.withColumn("next_valid_from", following)
        .where("_until > next_valid_from")
        .select(F.lit(dimension).alias("dim"), "id", "valid_from", "next_valid_from")
    )


def overlapping_pairs(versions: DataFrame, key: str, dimension: str) -> DataFrame:
    """Every pair of versions of a key of which one is still valid when the other starts later.

    Versions are listed once per month they touch, and meet the versions that start in that month. A pair so meets
    in one month only, that of the later start, and a key with very many versions is spread over its months.
    """
    last = versions.agg(F.max("valid_from")).scalar()
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    listed = versions.where(F.col("valid_from") <= end).select(
        F.col(key).alias("id"),
        "valid_from",
        "valid_to",
        F.explode(F.sequence(F.trunc("valid_from", "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))).alias("_month"),
    )
    starts = versions.select(
        F.col(key).alias("_id"), F.col("valid_from").alias("next_valid_from"), F.trunc("valid_from", "MM").alias("_start")
    )
    later = (F.col("valid_from") < F.col("next_valid_from")) & (
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_valid_from"))
    )
    met = listed.join(starts, (F.col("id") == F.col("_id")) & (F.col("_month") == F.col("_start")) & later)
    return met.select(F.lit(dimension).alias("dim"), "id", "valid_from", "next_valid_from")


def join_balance(facts: DataFrame, joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before and after a join, and keys that lost or gained rows.

    Totals alone would let one lost row and one repeated row cancel out.
    """
    before = facts.select(*keys, F.lit(1).alias("_before"), F.lit(0).alias("_after"))
    after = joined.select(*keys, F.lit(0).alias("_before"), F.lit(1).alias("_after"))
    per_key = (
        before.unionByName(after)
        .groupBy(*keys)
        .agg(F.sum("_before").alias("_before"), F.sum("_after").alias("_after"))
    )
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("_before"), zero).alias("fact_rows"),
        F.coalesce(F.sum("_after"), zero).alias("joined_rows"),
        F.count(F.when(F.col("_after") < F.col("_before"), F.lit(1))).alias("keys_lost"),
        F.count(F.when(F.col("_after") > F.col("_before"), F.lit(1))).alias("keys_repeated"),
    )


def check_join_preserves(
    facts: DataFrame, joined: DataFrame, keys: Sequence[str]
) -> DataFrame:
    return join_balance(facts, joined, keys).where(
        "fact_rows <> joined_rows OR keys_lost > 0 OR keys_repeated > 0"
    )


def check_periods_covered(
    periods: DataFrame, period: str, versions: DataFrame, version_period: str
) -> DataFrame:
    """Periods present in the data for which no version was recorded."""
    recorded = versions.select(F.col(version_period).alias("_recorded")).distinct()
    return (
        periods.select(period)
        .distinct()
        .join(recorded, F.col(period) == F.col("_recorded"), "left_anti")
    )
