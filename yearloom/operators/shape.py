"""Column names, projections and row filters."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.fixed import EMISSION_MEASURES, ENTITY, NOT_A_COUNTRY
from yearloom.functions import as_measure, compact_name, storable_name


def _renamed(df: DataFrame, rule) -> DataFrame:
    new_names = [rule(c) for c in df.columns]
    by_name = {}
    for old, new in zip(df.columns, new_names):
        by_name.setdefault(new.lower(), []).append(old)
    clashes = [olds for olds in by_name.values() if len(olds) > 1]
    if clashes:
        raise ValueError(f"columns would get the same name: {clashes}")
    return df.toDF(*new_names)


def with_storable_names(df: DataFrame) -> DataFrame:
    """Give every column a name Parquet accepts; order and data are untouched."""
    return _renamed(df, storable_name)


def with_compact_names(df: DataFrame) -> DataFrame:
    """Take the spaces out of every column name."""
    return _renamed(df, compact_name)


def drop_entities(df: DataFrame, names: Iterable[str], column: str = "Country") -> DataFrame:
    """Rows whose entity is none of ``names`` (exact match). NULL entities go too."""
    return df.filter(~F.col(column).isin(list(names)))


def keep_entities(df: DataFrame, names: Iterable[str], column: str = "Country") -> DataFrame:
    """Rows whose entity is one of ``names`` (exact match)."""
    return df.filter(F.col(column).isin(list(names)))


def from_year(df: DataFrame, year: int) -> DataFrame:
    """Rows of ``year`` and later."""
    return df.filter(F.col("Year") >= year)


def after_year(df: DataFrame, year: int) -> DataFrame:
    """Rows later than ``year``, which is itself left out."""
    return df.filter(F.col("Year") > year)


def country_emissions(
    raw: DataFrame,
    discard: Iterable[str] = NOT_A_COUNTRY,
    measures: Mapping[str, str] = EMISSION_MEASURES,
) -> DataFrame:
    """The emissions of each country and year, as floats under short names.

    Continents and other groups stay in unless ``discard`` names them.
    """
    return drop_entities(raw, discard, ENTITY).select(
        "Year",
        F.col(ENTITY).alias("Country"),
        *[as_measure(F.col(old)).alias(new) for old, new in measures.items()],
    )
