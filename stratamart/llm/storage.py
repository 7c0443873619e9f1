"""Tables that several steps read, kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratamart-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/stratamart-llm/{label}-{uuid.uuid4().hex}"


@contextmanager
def passing_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A new path for tables that nothing reads any more when the block ends: they are deleted then."""
    path = fresh_path(spark, label)
    try:
        yield path
    finally:
        found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


def stored(df: DataFrame, label: str, codec: str = "snappy", folder: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: lost executors then cost nothing that was finished. In ``folder``, if given."""
    path = f"{folder}/{label}" if folder else fresh_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark narrow rows for broadcast if a count finds at most ``max_rows``; else the join shuffles, with the same result."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def one_row(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Of the rows that share ``keys``, the one with the smallest text hash; map tasks cut to one row per key first."""
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(1), text))
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
