"""Helpers for tables of texts that may hold nulls, repeated rows and any columns."""

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name that is not among ``columns``, whatever their case."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as it stands in SQL, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def same(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """Null-safe equality of ``left``'s columns with those of ``right`` they map to."""
    condition = F.lit(True)
    for mine, theirs in names.items():
        condition &= left[quoted(mine)].eqNullSafe(right[quoted(theirs)])
    return condition


def text_key(text: str = "text") -> Column:
    """Tells rows of one id but different texts apart; equal rows stay equal."""
    return F.xxhash64(F.col(quoted(text)))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns that are computed once for each row.

    An expression put in place of its name by the optimizer, as a pushed filter
    or a merged projection does, would be evaluated once for every use, and
    within a higher-order function once for every element.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def released(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, giving back what Arrow holds once its rows are through.

    Python workers are used again by later tasks, and Arrow keeps what its
    largest batches took for them.
    """

    def through(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return through
