"""Number and date readings that turn junk into NULL, also under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearloom.fixed import DATE_PATTERN


def as_measure(value: Column) -> Column:
    """A 32-bit float, or NULL where the value is no number."""
    return value.try_cast("float")


def measure_in_text(text: Column) -> Column:
    """``as_measure`` for text columns with much junk: same results, less work.

    A failed cast raises and catches an exception for that row. Whatever can be
    read as a number has a digit or, as ``nan`` and ``inf`` have, an n in it;
    text without either is NULL without being cast.
    """
    return F.when(text.rlike("[0-9nN]"), as_measure(text))


def cleaned_year(text: Column, pattern: str = DATE_PATTERN) -> Column:
    """The year of a date text, or NULL where it does not fit ``pattern``."""
    return F.year(F.try_to_timestamp(text, F.lit(pattern)))


def is_leap_year(year: Column) -> Column:
    """Gregorian leap-year test; NULL for a NULL year."""
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


_EXACT = "decimal(38,18)"


def exact_sum(value: Column) -> Column:
    """The sum of numbers as a double, the same for every order and partitioning.

    Each number is taken in its decimal notation with 18 places, and these are
    added exactly; the total alone is rounded. Where a number has no such form,
    as NaN and infinity and those of 20 digits before the point have none, or the
    total outgrows it, the result is the ordinary sum. NULL if there is none.
    """
    value = value.cast("double")
    number = value.try_cast(_EXACT)
    exact = F.when(F.count(value) == F.count(number), F.try_sum(number).cast("double"))
    return F.coalesce(exact, F.sum(value))


def exact_avg(value: Column) -> Column:
    """``exact_sum`` over the number of values."""
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))
