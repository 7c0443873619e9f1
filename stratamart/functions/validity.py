"""Half-open validity intervals."""

from __future__ import annotations

from pyspark.sql import Column


def valid_on(day: Column, valid_from: Column, valid_to: Column) -> Column:
    """True when ``day`` lies in ``[valid_from, valid_to)``; a NULL end is open."""
    return (day >= valid_from) & (valid_to.isNull() | (day < valid_to))
