"""Sorted series and top-k reports.

Every order ends in the key columns, so that equal values come out in the same
order each time.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.fixed import (
    CONTINENT_NAMES,
    OCEANIA_TWO,
    TOP_EMITTERS,
    TOP_OBSERVATIONS,
    TOP_TEMPERATURES,
)
from yearloom.operators.order import in_order
from yearloom.operators.shape import after_year, drop_entities, keep_entities


def top_rows(df: DataFrame, measure: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``measure``.

    Each task keeps only its own best ``k`` rows, which are then merged; the
    whole table is never sorted or fetched.
    """
    return df.orderBy(F.desc(measure), *ties).limit(k)


def top_emitters(averages: DataFrame, k: int = TOP_EMITTERS) -> DataFrame:
    """The countries with the highest mean emissions."""
    return top_rows(averages, "TotalEmissionsByCountry", k, ["Country"])


def hottest_countries(averages: DataFrame, k: int = TOP_TEMPERATURES) -> DataFrame:
    """The countries with the highest mean temperature."""
    return top_rows(averages, "AverageTemperatureByCountry", k, ["Country"])


def top_observations(panel: DataFrame, k: int = TOP_OBSERVATIONS) -> DataFrame:
    """The single country-years with the highest emissions."""
    return top_rows(panel, "TotalEmissions", k, ["Country", "Year"])


def countries_only(after: int | None = None) -> Column:
    """The condition of :func:`without_continents`, for the inputs of a panel."""
    kept = ~F.col("Country").isin(*CONTINENT_NAMES)
    return kept if after is None else kept & (F.col("Year") > after)


def without_continents(panel: DataFrame, after: int | None = None) -> DataFrame:
    """The panel without the rows of whole continents, if wanted only after a year."""
    kept = drop_entities(panel, CONTINENT_NAMES)
    return kept if after is None else after_year(kept, after)


def emissions_temperature_curve(panel: DataFrame) -> DataFrame:
    """Highest land temperature against emissions, in order of emissions."""
    curve = panel.select("Year", "TotalEmissions", "LandMaxTemperature")
    return in_order(curve, ["TotalEmissions", "Year"])


def country_series(panel: DataFrame, by: str = "Year") -> DataFrame:
    """Emissions of each country and year, in order of year or of emissions."""
    columns = ["Year", "Country", "TotalEmissions"]
    if by not in columns:
        raise ValueError(f"a series is ordered by one of {columns}, not {by!r}")
    rest = [c for c in columns if c != by]
    return in_order(panel.select(*columns), [by, *rest])


def country_temperature_series(
    panel: DataFrame, entities: Sequence[str] = OCEANIA_TWO
) -> DataFrame:
    """Temperatures of the named countries in order of year."""
    columns = ["Year", "Country", "AverageTemperature"]
    return in_order(keep_entities(panel, entities).select(*columns), columns)
