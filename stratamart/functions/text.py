"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How flags and area codes are written in the delivered files.
TRUE_MARK = "t"
FALSE_MARK = "f"
CODE_PREFIX = "LGA"
CODE_DIGITS = 5


def empty_to_null(c: Column) -> Column:
    """NULL for the empty string only; spaces are kept as delivered."""
    return F.nullif(c, F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Value without surrounding spaces, or NULL when nothing is left."""
    return empty_to_null(F.trim(c))


def tidy_upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def tristate(c: Column) -> Column:
    """TRUE for ``t``, FALSE for ``f`` in any case, NULL for everything else."""
    mark = F.lower(F.trim(c))
    return F.when(mark.isin(TRUE_MARK, FALSE_MARK), mark == F.lit(TRUE_MARK))


def name_key(c: Column) -> Column:
    """Matching key for names: ``Canterbury-Bankstown`` becomes ``CANTERBURYBANKSTOWN``.

    A name with no letter or digit becomes the empty string, NULL stays NULL.
    """
    return F.regexp_replace(tidy_upper(c), "[^A-Z0-9]", "")


def unify_code(c: Column, prefix: str = CODE_PREFIX, digits: int = CODE_DIGITS) -> Column:
    """One spelling for area codes: ``10300``, ``300`` and ``lga10300`` all carry the prefix.

    Bare digits are padded to ``digits`` places (longer codes are cut to it). Values of any
    other shape become NULL.
    """
    code = tidy_upper(c)
    padded = F.concat(F.lit(prefix), F.lpad(code, digits, "0"))
    return F.when(code.rlike(r"^[0-9]+\z"), padded).when(code.startswith(prefix), code)
