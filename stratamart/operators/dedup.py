"""One row per key.

A ``row_number() = 1`` filter lets Spark keep one row per key inside each map task
(WindowGroupLimit) before anything is shuffled, so a key that holds a large part of all
rows reaches its reducer as at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order, which should be total."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    then: Sequence[Column] | None = None,
) -> DataFrame:
    """Newest row of every key; full ties are settled by ``then``.

    Without ``then`` the remaining columns settle ties, so that a recomputed task always
    picks the same row. Pass ``then`` where a shorter order is already total.
    """
    if then is None:
        named = {*keys, *newest_first}
        then = [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    order = [F.col(c).desc_nulls_first() for c in newest_first]
    return first_per_key(df, keys, [*order, *then])
