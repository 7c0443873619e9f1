"""Quantiles from stored sketches that merge: one per group and month, for any trailing number of months.

An exact median of a year needs all values of the year again each month. A sketch of a month keeps some hundreds of
values, however many there were; the sketches of twelve months merge into that of the year without the rows. Spark's
own KLL sketches are used. Groups are combined in the map tasks, and no task holds more than sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch. Up to about that many values it is exact.
K = 400


def rank_error(k: int = K) -> float:
    """How far, as a share of all values, an estimate's rank may lie from the wanted one.

    Twice the error that holds in 99 of 100 cases (fixed values of the KLL sketch's own tables), so that a miss is
    not expected in any number of groups.
    """
    return 2 * 2.296 / k**0.9723


def month_sketches(df: DataFrame, keys: Sequence[str], period: str, value: str, k: int = K) -> DataFrame:
    """keys, period, sketch: one sketch of the non-NULL values of each group and month. To be stored."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, period).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def trailing_quantile(
    sketches: DataFrame, keys: Sequence[str], period: str, months: int, name: str, q: float = 0.5
) -> DataFrame:
    """keys, period, ``name``, n_values: the quantile over each month present and the ``months - 1`` before it.

    ``period`` holds first days of months. Each sketch is listed for the months that it counts for.
    """
    ahead = F.sequence(F.col(period), F.add_months(period, months - 1), F.expr("interval 1 month"))
    listed = sketches.select(*keys, F.explode(ahead).alias("_month"), (F.col(period)).alias("_own"), "sketch")
    merged = listed.groupBy(*keys, "_month").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.bool_or(F.col("_own") == F.col("_month")).alias("_present")
    )
    return merged.where("_present").select(
        *keys,
        F.col("_month").alias(period),
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name),
        F.kll_sketch_get_n_double("sketch").alias("n_values"),
    )
