"""Bounded broadcasts and tables written once for several readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only when it is counted to hold at most ``max_rows`` rows.

    The count stops at ``max_rows + 1``. A larger side is marked for a merge join: the join then
    shuffles, with adaptive skew handling, even if its files are so small that Spark would broadcast it.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df.hint("merge")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/stratamart/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder from ``fresh_path`` that nothing reads any more, by the file system Spark itself uses for it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


def written_once(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``codec`` packs the files, zstd closer than the default.

    For an expensive frame with several readers: it is computed once, lost executors cost
    nothing that was finished, and each reader prunes columns from the written files.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
