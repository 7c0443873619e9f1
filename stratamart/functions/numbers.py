"""Numbers: strict typing, currency text, exact ratios.

Money and ratios stay decimal until they are published. A decimal quotient keeps at least
16 digits after the point here, so rounding it is rounding half away from zero on the
true value; rounding a double would not be (1.005 is below its tie in binary).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
# 22 digits before the point; wide enough for sums, narrow enough to leave a quotient its scale
_NUMERATOR = "decimal(26,4)"


def typed(c: Column, to: str, on_bad: str = "fail") -> Column:
    """Cast that fails on malformed text, or gives NULL with ``on_bad='null'``."""
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', got {on_bad!r}")
    return c.try_cast(to) if on_bad == "null" else c.cast(to)


def clean_currency(c: Column, to: str = MONEY, on_bad: str = "fail") -> Column:
    """Amount from text such as ``$1,234.50``: only digits and dots count.

    A minus sign is dropped with the other characters, so ``-5`` is 5.
    """
    digits = F.nullif(F.regexp_replace(c, "[^0-9.]", ""), F.lit(""))
    return typed(digits, to, on_bad)


def ratio(part: Column, whole: Column) -> Column:
    """Decimal quotient, NULL for a zero base."""
    return part.cast(_NUMERATOR) / F.nullif(whole, F.lit(0))


def percent_of(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, rounded; NULL for a zero base."""
    return F.round(ratio(part * F.lit(100), whole), places)


def percent_change(now: Column, before: Column, places: int = 2) -> Column:
    """Relative change in percent; NULL without an earlier value or with a zero one."""
    return percent_of(now - before, before, places)
