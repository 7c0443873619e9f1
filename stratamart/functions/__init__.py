"""Column functions. Each takes and returns Columns, so it stays inside generated code."""

from stratamart.functions.dates import month_start, parse_date_multi, parse_period_label_column
from stratamart.functions.numbers import (
    clean_currency,
    percent_change,
    percent_of,
    ratio,
    typed,
)
from stratamart.functions.text import (
    blank_to_null,
    empty_to_null,
    name_key,
    tidy_upper,
    tristate,
    unify_code,
)
from stratamart.functions.validity import valid_on

__all__ = [
    "blank_to_null",
    "clean_currency",
    "empty_to_null",
    "month_start",
    "name_key",
    "parse_date_multi",
    "parse_period_label_column",
    "percent_change",
    "percent_of",
    "ratio",
    "tidy_upper",
    "tristate",
    "typed",
    "unify_code",
    "valid_on",
]
