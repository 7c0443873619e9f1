"""Numbers that tell repeated rows apart, without a task that holds all rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.storage import small_side, stored

#: A group's rows are numbered in runs of 2 ** RUN_BITS rows of a task at most; only the runs' sizes are put in one order.
RUN_BITS = 16


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def repeated(df: DataFrame, group: list[str]) -> DataFrame:
    """The values of ``group`` that more than one row has, stored."""
    return stored(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*group), "repeated")


def numbered_copies(df: DataFrame, group: list[str], name: str = "copy", groups: DataFrame | None = None) -> DataFrame:
    """Add ``name``: 0 to n - 1 for the n rows alike in ``group`` (null equals null), in any order.

    ``groups``: the result of ``repeated``, if it is known already. Rows of other groups get 0 and are not shuffled
    by their group (but by the join, where repeated groups are too many to broadcast).
    """
    groups = repeated(df, group) if groups is None else groups
    if groups.isEmpty():
        return df.withColumn(name, F.lit(0).cast("long"))
    named = [f"_of_{c}" for c in group]
    known = groups.select(*[F.col(c).alias(n) for c, n in zip(group, named)], F.lit(True).alias("_many"))
    marked = df.join(small_side(known), _same(group, named), "left").drop(*named)
    single = marked.where("_many IS NULL").drop("_many").withColumn(name, F.lit(0).cast("long"))
    many = marked.where("_many").drop("_many").withColumn("_nth", F.monotonically_increasing_id())
    many = stored(many.withColumn("_run", F.shiftright("_nth", RUN_BITS)), "copies")
    inside = F.row_number().over(Window.partitionBy(*group, "_run").orderBy("_nth")) - 1
    sizes = many.groupBy(*group, "_run").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(n) for c, n in zip(group, named)], F.col("_run").alias("_of_run"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"))
    many = many.withColumn("_inside", inside).join(small_side(stored(starts, "runs")), _same([*group, "_run"], [*named, "_of_run"]))
    return single.unionByName(many.withColumn(name, F.col("_start") + F.col("_inside")).select(*df.columns, name))
