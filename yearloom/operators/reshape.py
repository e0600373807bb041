"""Long to wide and back."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.fixed import EUROPE_THREE, FIRST_MODERN_YEAR
from yearloom.functions import compact_name
from yearloom.operators.shape import from_year

WIDE_MEASURES = ("TotalEmissions", "PerCapitaEmissions")


def _cell(entity: str, measure: str) -> str:
    return f"{compact_name(entity)}_{measure}"


def widen(
    emissions: DataFrame,
    entities: Sequence[str] = EUROPE_THREE,
    measures: Sequence[str] = WIDE_MEASURES,
    since: int = FIRST_MODERN_YEAR,
) -> DataFrame:
    """One row per year with a column for each entity and measure.

    Years in which none of the entities occurs stay, with NULL in every column.
    Conditional maxima need one shuffle of already reduced rows, where a pivot
    needs two; where an entity has several rows in a year the largest value is
    taken.
    """
    cells = [
        F.max(F.when(F.col("Country") == entity, F.col(measure))).alias(_cell(entity, measure))
        for entity in entities
        for measure in measures
    ]
    return from_year(emissions, since).groupBy("Year").agg(*cells)


def lengthen(
    wide: DataFrame,
    entities: Sequence[str] = EUROPE_THREE,
    measure: str = "TotalEmissions",
) -> DataFrame:
    """The series of one measure out of a widened table: year, entity, value."""
    named = wide.select(
        "Year", *[F.col(_cell(e, measure)).alias(e) for e in entities]
    )
    return named.unpivot("Year", list(entities), "Country", measure)
