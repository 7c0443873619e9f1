"""Arrivals as a stream: new files in a landing folder start the loads that batch runs use.

The stream tells which deliveries have got a new file; each of them is then loaded whole by the given load, which
replaces its month. A batch that is run again, after a stop between load and checkpoint, so loads the same months with
the same result, and a month that gets another file later is loaded again with all its files. Files are listed, not
read, by the stream. It remembers files by their path: a corrected file under its old name is not seen again, for that
there is ``arrivals.load_arrivals``, which compares times and lengths as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.sources.bronze import load_listings_label
from stratamart.sources.periods import in_date_order, parse_period_label
from stratamart.sources.tables import Warehouse

# The columns of Spark's source of whole files; only the path is asked for.
_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def stream_arrivals(
    spark: SparkSession, landing: str, checkpoint: str, load: Callable[[str], object]
) -> list[list[str]]:
    """Call ``load`` with the label of each delivery that has files the checkpoint does not know, oldest month first.

    A delivery is a file ``MM_YYYY.csv`` or a folder of that name; another CSV name is an error, before anything of its
    batch is loaded. Runs until all files that are there have been handled, and returns the labels of each batch.
    """
    batches: list[list[str]] = []

    def handle(files: DataFrame, number: int) -> None:
        found = in_date_order(files.select(F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1).alias("label")))
        labels = [row.label for row in found.orderBy("position").collect()]  # one row per month
        for label in labels:
            parse_period_label(label)
        for label in labels:
            load(label)
        batches.append(labels)

    # a folder of files is named like a file: the pattern matches both
    files = spark.readStream.format("binaryFile").schema(_LISTED).load(f"{landing.rstrip('/')}/*.csv").select("path")
    query = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return batches


def stream_listings(warehouse: Warehouse, landing: str, checkpoint: str) -> list[list[str]]:
    """Load the listing deliveries that have arrived; returns the labels of each batch."""
    return stream_arrivals(
        warehouse.spark, landing, checkpoint, lambda label: load_listings_label(warehouse, landing, label)
    )
