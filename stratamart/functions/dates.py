"""Dates that arrive as text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts (shape, order of its parts as year-month-day), and the label
# of a monthly delivery.
DATE_LAYOUTS: tuple[tuple[str, str], ...] = (
    (r"^(\d{4})-(\d{2})-(\d{2})\z", "$1-$2-$3"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})\z", "$3-$2-$1"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})\z", "$3-$2-$1"),
)
PERIOD_LABEL_SHAPE = r"^(0[1-9]|1[0-2])_\d{4}\z"
PERIOD_LABEL_FORMAT = "MM_yyyy"


def parse_date_multi(
    c: Column, layouts: Sequence[tuple[str, str]] = DATE_LAYOUTS
) -> Column:
    """Date from any of the layouts, which exclude each other; NULL when none fits or the day does not exist.

    The parts are put in year-month-day order and cast: several times cheaper per value than
    a date formatter. All layouts are one pattern, whose last choice empties any other text: a
    pattern and a cast per layout make generated methods too long to be compiled by the JVM.
    """
    shapes, orders, groups = [], [], 0
    for shape, order in layouts:
        orders.append([re.sub(r"\d+", lambda g, n=groups: str(int(g[0]) + n), part) for part in order.split("-")])
        shapes.append(shape)
        groups += re.compile(shape.replace(r"\z", r"\Z")).groups
    pattern = "|".join([*shapes, r"(?s:^.*\z)"])
    # groups of layouts that do not fit are empty
    ordered = "-".join("".join(parts) for parts in zip(*orders, strict=True))
    return F.regexp_replace(F.trim(c), pattern, ordered).try_cast("date")


def month_start(c: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(c, "MM")


def parse_period_label_column(c: Column) -> Column:
    """``05_2020`` as 2020-05-01; NULL for any other shape."""
    return F.when(c.rlike(PERIOD_LABEL_SHAPE), F.try_to_date(c, PERIOD_LABEL_FORMAT))
