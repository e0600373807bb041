"""Aggregations per year and per country.

Every one is a plain ``groupBy().agg()`` of sums, averages, minima or maxima,
so each task first reduces its own rows to one per group: a year or country
that holds most of the rows costs no more to shuffle than any other.

Doubles are added in the order in which tasks come to them, so the last digits
of a sum may differ between runs. With ``exact=True`` they do not: sums and means
are then made of decimals, which takes about twice the time.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.functions import (
    cleaned_year,
    exact_avg,
    exact_sum,
    measure_in_text,
    title_name,
    without_sentinel,
)


def _sum(column: str, exact: bool) -> Column:
    return exact_sum(F.col(column)) if exact else F.sum(column)


def _avg(column: str, exact: bool) -> Column:
    return exact_avg(F.col(column)) if exact else F.avg(column)


def yearly_total(
    emissions: DataFrame, measure: str = "TotalEmissions", exact: bool = False
) -> DataFrame:
    """``measure`` summed over all entities of a year."""
    return emissions.groupBy("Year").agg(_sum(measure, exact).cast("float").alias(measure))


def yearly_temperatures(
    readings: DataFrame, date: str = "Date", exact: bool = False
) -> DataFrame:
    """Mean, highest and lowest temperatures of each calendar year."""
    summary = {
        "LandAverageTemperature": _avg("LandAverageTemperature", exact),
        "LandMaxTemperature": F.max("LandMaxTemperature"),
        "LandMinTemperature": F.min("LandMinTemperature"),
        "LandAndOceanAverageTemperature": _avg("LandAndOceanAverageTemperature", exact),
    }
    return readings.groupBy(F.year(date).alias("Year")).agg(
        *[value.cast("float").alias(c) for c, value in summary.items()]
    )


def clean_readings(dirty: DataFrame) -> DataFrame:
    """Year, tidy country name and float temperature of each untidy reading."""
    return dirty.select(
        cleaned_year(F.col("Date")).alias("Year"),
        title_name(F.col("Country")).alias("Country"),
        measure_in_text(without_sentinel(F.col("AverageTemperature"))).alias("AverageTemperature"),
    )


def country_temperatures(dirty: DataFrame, exact: bool = False) -> DataFrame:
    """Mean temperature per year and country; NULL where every reading is junk."""
    return (
        clean_readings(dirty)
        .groupBy("Year", "Country")
        .agg(_avg("AverageTemperature", exact).cast("float").alias("AverageTemperature"))
    )


def country_averages(panel: DataFrame, exact: bool = False) -> DataFrame:
    """Mean temperature and mean emissions of each country over all its years."""
    return panel.groupBy("Country").agg(
        _avg("AverageTemperature", exact).alias("AverageTemperatureByCountry"),
        _avg("TotalEmissions", exact).alias("TotalEmissionsByCountry"),
    )


def null_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: how many values of ``column`` are missing and how many are not."""
    return df.agg(
        F.count_if(F.col(column).isNull()).alias("missing"),
        F.count(column).alias("present"),
    )
