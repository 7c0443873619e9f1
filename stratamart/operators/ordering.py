"""Positions in a total order, without a task that sorts all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.operators.storage import written_once

#: monotonically_increasing_id holds the partition above these bits and the row's place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, *order: Column, name: str = "position", start: int = 0) -> DataFrame:
    """Add ``name``: the row's position in ``order``, gapless from ``start``.

    Rows are dealt into ranges of the order and sorted inside them; a row's position is the number of rows in the ranges
    before its own plus its place there. Only the number of rows per range meets in one task. Give an order without
    ties if it has to be the same in every run; equal rows share a range, so append a column that tells them apart
    where they may be many. An empty frame gives an empty one.
    """
    tag, held = "_" + name + "_tag", "_" + name + "_before"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written_once(ranged.withColumn(tag, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(tag, _PLACE_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(held))  # one row per range
    place = F.col(tag) - F.shiftleft(part, _PLACE_BITS)
    joined = rows.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.withColumn(name, F.col(held) + place + start).drop(tag, held, "_part")
