"""Idempotent loads of the raw layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampType

from stratamart.schemas import (
    LISTING_COLUMNS,
    LISTINGS_TABLE,
    REFERENCE_FILES,
    text_schema,
)
from stratamart.sources.delimited import read_positional_csv
from stratamart.sources.periods import parse_period_label, require_month_start
from stratamart.sources.records import read_split_csv
from stratamart.sources.tables import Warehouse

_SLICE = "load_slice"
_LISTINGS = f"bronze.{LISTINGS_TABLE}"


def listings_schema() -> StructType:
    return (
        text_schema(LISTING_COLUMNS).add("loaded_at", TimestampType()).add("load_month", DateType())
    )


def load_listings_period(
    warehouse: Warehouse,
    source: str,
    period: dt.date,
    multiline: bool = True,
    split_files: bool = False,
) -> int:
    """Replace one month of raw listings with the delivery at ``source``; returns its row count.

    A delivery with no rows, or with a row that is too short, is an error and leaves the table
    as it was: nothing moves before the write has succeeded, and a write without rows replaces
    no slice. ``split_files`` reads large files by many tasks, whatever their cells hold.
    """
    require_month_start(period)
    if split_files:
        delivery = read_split_csv(warehouse.spark, source, LISTING_COLUMNS, cut_extra=True)
    else:
        delivery = read_positional_csv(
            warehouse.spark, source, LISTING_COLUMNS, cut_extra=True, multiline=multiline
        )
    rows = warehouse.replace(
        _LISTINGS,
        delivery.withColumn("loaded_at", F.current_timestamp()).withColumn(
            "load_month", F.lit(period)
        ),
        "load_month",
        only=period,
    ).rows
    if rows == 0:
        raise ValueError(f"no data rows for {period:%Y-%m}; the stored month is kept")
    return rows


def load_listings_label(warehouse: Warehouse, folder: str, label: str) -> int:
    """Load the delivery named by its label, ``<folder>/MM_YYYY.csv``."""
    period = parse_period_label(label)
    return load_listings_period(warehouse, f"{folder.rstrip('/')}/{label}.csv", period)


def load_reference(warehouse: Warehouse, source: str, table: str) -> int:
    """Replace a whole reference table; returns its row count. Same safety as a monthly load."""
    if table not in REFERENCE_FILES:
        raise ValueError(f"unknown reference table {table!r}; known: {sorted(REFERENCE_FILES)}")
    layout = REFERENCE_FILES[table]
    delivery = read_positional_csv(
        warehouse.spark, source, layout.columns, cut_extra=layout.cut_extra
    )
    rows = warehouse.replace(
        f"bronze.{table}", delivery.withColumn(_SLICE, F.lit("current")), _SLICE, only="current"
    ).rows
    if rows == 0:
        raise ValueError(f"no data rows for {table}; the stored table is kept")
    return rows


def raw_listings(warehouse: Warehouse) -> DataFrame:
    return warehouse.read(_LISTINGS, listings_schema())


def raw_reference(warehouse: Warehouse, table: str) -> DataFrame:
    columns = REFERENCE_FILES[table].columns
    return warehouse.read(f"bronze.{table}", text_schema(columns)).select(*columns)
