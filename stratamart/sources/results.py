"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result_csv(df: DataFrame, path: str) -> None:
    """A finished report as one CSV file with a header, in its presented order.

    For reports only: a handful of rows per area. The frame's own sort is kept.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
