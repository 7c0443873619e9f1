"""Load monthly deliveries as their files arrive.

An extension of the monthly load for landing folders. What lies there is compared with a stored log
of what has been loaded, by path, time of modification and length; a month that differs, because it is
new, corrected, or has got another file, goes to the same idempotent load that batch runs use. The log
is written after the load, so a run that stops in between loads the month again with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.sources.bronze import load_listings_label
from stratamart.sources.periods import in_date_order, parse_period_label
from stratamart.sources.tables import Warehouse

_LOG = "bronze.arrivals"
_LOG_SCHEMA = "signature string, label string"


def deliveries(warehouse: Warehouse, landing: str) -> DataFrame:
    """label, signature: one row per delivery, a file ``MM_YYYY.csv`` or a folder of that name.

    Files are listed, not read. A CSV name that is no label is an error.
    """
    files = (
        warehouse.spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path", "modificationTime", "length")
        .withColumn("label", F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1))
        .where("label <> ''")
    )
    listed = F.array_sort(F.collect_list(F.struct("path", "modificationTime", "length")))
    return files.groupBy("label").agg(F.sha2(F.to_json(listed), 256).alias("signature"))


def load_arrivals(warehouse: Warehouse, landing: str) -> list[str]:
    """Load every delivery that is new or has changed since the last run, oldest month first.

    Returns the labels loaded.
    """
    folder = landing.rstrip("/")
    found = deliveries(warehouse, folder)
    if warehouse.exists(_LOG):
        loaded = warehouse.read(_LOG, found.select("signature", "label").schema)
        found = found.join(loaded, ["label", "signature"], "left_anti")
    due = {row.label: row.signature for row in found.collect()}  # one row per month
    order = in_date_order(warehouse.spark.createDataFrame([(x,) for x in due], "label string"))
    labels = [row.label for row in order.orderBy("position").collect()]
    for label in labels:
        parse_period_label(label)
    for label in labels:
        load_listings_label(warehouse, folder, label)
        row = warehouse.spark.createDataFrame([(due[label], label)], _LOG_SCHEMA)
        warehouse.replace(_LOG, row, "label")
    return labels
