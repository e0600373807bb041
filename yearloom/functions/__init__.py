"""Name rules (driver side) and column expressions (executor side)."""

from yearloom.functions.names import compact_name, database_name, storable_name
from yearloom.functions.text import short_name, title_name, without_sentinel
from yearloom.functions.values import (
    as_measure,
    cleaned_year,
    exact_avg,
    exact_sum,
    is_leap_year,
    measure_in_text,
)

__all__ = [
    "as_measure",
    "cleaned_year",
    "compact_name",
    "database_name",
    "exact_avg",
    "exact_sum",
    "is_leap_year",
    "measure_in_text",
    "short_name",
    "storable_name",
    "title_name",
    "without_sentinel",
]
