"""Stored history, advanced one period at a time.

The stored versions are partitioned by ``valid_to``: open versions form one slice and the
versions closed by a period another. One more period therefore reads and rewrites the open
slice and the slice of its own date, never the older history, in one job that moves its files
into place when everything has been written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from stratamart.operators.history import merge_versions
from stratamart.sources.tables import Warehouse, even_files


def _stored_schema(incoming: DataFrame, period: str) -> StructType:
    kept = [f for f in incoming.schema.fields if f.name != period]
    return StructType(kept).add("valid_from", DateType()).add("valid_to", DateType())


def read_versions(
    warehouse: Warehouse, table: str, incoming: DataFrame, period: str
) -> DataFrame:
    """Stored versions, or an empty frame of the same shape before the first period."""
    schema = _stored_schema(incoming, period)
    if warehouse.exists(table):
        return warehouse.read(table, schema)
    return warehouse.spark.createDataFrame([], schema)


def advance_snapshot(
    warehouse: Warehouse, table: str, incoming: DataFrame, key: str, period: str, now: dt.date
) -> int:
    """Merge the slice of period ``now`` into the stored history; returns the rows rewritten.

    Repeating a period changes nothing. Versions already closed at ``now`` are merged along,
    since their slice is rewritten.
    """
    touched = read_versions(warehouse, table, incoming, period).where(
        F.col("valid_to").isNull() | (F.col("valid_to") == F.lit(now))
    )
    merged = merge_versions(touched, incoming, key, period)
    return warehouse.replace(table, even_files(merged, "valid_to"), "valid_to").rows


def rebuild_snapshot(warehouse: Warehouse, table: str, versions: DataFrame) -> DataFrame:
    """Store a history computed from all periods at once."""
    return warehouse.rebuild(table, versions, "valid_to")
