"""How often each key of several key sets occurs in a table, in one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counter(column: str) -> str:
    return f"nulls of {column}"


def tallies(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    required: Sequence[str] = (),
    extremes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every key of every key set with its rows, from one scan and one shuffle.

    Result: ``key_set`` (position in ``key_sets``, 0 when there are none), the key columns (NULL where a column is not in
    the set), ``n``, the largest value of each of ``extremes``, and for each required column that no key set holds its
    number of NULLs. Rows combine in the map tasks, so that a key holding a third of all rows moves as one row per task.
    """
    columns = list(dict.fromkeys(c for keys in key_sets for c in keys))
    measures = [F.count(F.lit(1)).alias("n")]
    measures += [F.max(value).alias(name) for name, value in (extremes or {}).items()]
    measures += [F.count_if(F.col(c).isNull()).alias(null_counter(c)) for c in required if c not in columns]
    if len(key_sets) < 2:
        counted = df.groupBy(*columns).agg(*measures) if columns else df.agg(*measures)
        return counted.select(F.lit(0).alias("key_set"), *counted.columns)
    absent = [sum(1 << k for k, c in enumerate(reversed(columns)) if c not in keys) for keys in key_sets]
    counted = df.groupingSets([[F.col(c) for c in keys] for keys in key_sets], *columns).agg(
        F.grouping_id().alias("_absent"), *measures
    )
    position = F.coalesce(*[F.when(F.col("_absent") == bits, F.lit(k)) for k, bits in enumerate(absent)])
    return counted.select(position.alias("key_set"), *[c for c in counted.columns if c != "_absent"])
