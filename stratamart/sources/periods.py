"""Labels of monthly deliveries and their order."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.functions.dates import PERIOD_LABEL_FORMAT, PERIOD_LABEL_SHAPE, parse_period_label_column

_LABEL = re.compile(PERIOD_LABEL_SHAPE.replace(r"\z", r"\Z"), re.ASCII)


def parse_period_label(label: str) -> dt.date:
    """``05_2020`` as the first day of that month; anything else is an error."""
    if not _LABEL.match(label):
        raise ValueError(f"a period label looks like MM_YYYY, for example 05_2020; got {label!r}")
    month, year = label.split("_")
    return dt.date(int(year), int(month), 1)


def require_month_start(period: dt.date) -> dt.date:
    if period.day != 1:
        raise ValueError(f"a period is named by the first day of its month, got {period}")
    return period


def in_date_order(labels: DataFrame, label: str = "label") -> DataFrame:
    """Distinct period labels with their date and position in time (not in name order)."""
    dated = labels.select(label).distinct().withColumn(
        "period", parse_period_label_column(F.col(label))
    )
    # one row per period from here on
    return dated.withColumn(
        "position", F.row_number().over(Window.orderBy(F.col("period").asc_nulls_first()))
    )


def discover_periods(spark: SparkSession, folder: str) -> list[tuple[str, dt.date]]:
    """Labels of the monthly deliveries in ``folder``, oldest first.

    A delivery is a file ``MM_YYYY.csv`` or a folder of that name. Any other CSV name is an
    error. Only names are read.
    """
    names = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1).alias("label"))
        .where("label <> ''")
    )
    found = in_date_order(names).orderBy("position").collect()
    return [(row.label, parse_period_label(row.label)) for row in found]


__all__ = [
    "PERIOD_LABEL_FORMAT",
    "discover_periods",
    "in_date_order",
    "parse_period_label",
    "require_month_start",
]
