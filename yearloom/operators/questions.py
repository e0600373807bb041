"""Answers to the questions the data was collected for."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.fixed import EUROPE_THREE, TOP_QUESTION
from yearloom.operators.joins import skew_safe_join
from yearloom.operators.rank import top_rows
from yearloom.operators.reshape import lengthen

BROADCAST_MAX_RANKS = 10_000


def temperature_anomalies(
    temperatures: DataFrame, first: int, last: int, salts: int = 1
) -> DataFrame:
    """How far each year and country lies from the country's own baseline.

    The baseline is the mean over the years ``first`` to ``last``, both
    included; a country without a reading in that period has NULL anomalies.
    """
    # Not a filter: with the same rows on both sides of the join Spark computes
    # the yearly temperatures once and reuses their shuffle.
    in_period = F.col("Year").between(first, last)
    baselines = temperatures.groupBy("Country").agg(
        F.avg(F.when(in_period, F.col("AverageTemperature"))).alias("Baseline")
    )
    anomaly = F.col("AverageTemperature") - F.col("Baseline")
    return skew_safe_join(temperatures, baselines, ["Country"], "left", salts).select(
        "Year",
        "Country",
        "AverageTemperature",
        F.col("Baseline").cast("float").alias("Baseline"),
        anomaly.cast("float").alias("Anomaly"),
    )


def worst_anomalies(anomalies: DataFrame, k: int) -> DataFrame:
    """The countries with the highest single-year anomaly."""
    worst = anomalies.groupBy("Country").agg(F.max("Anomaly").alias("WorstAnomaly"))
    return top_rows(worst.filter("WorstAnomaly IS NOT NULL"), "WorstAnomaly", k, ["Country"])


def largest_emitters(panel: DataFrame, group: str = "Country", k: int = TOP_QUESTION) -> DataFrame:
    """The ``k`` countries or continents with the largest emissions over all years."""
    known = panel.filter(F.col(group).isNotNull())
    totals = known.groupBy(group).agg(F.sum("TotalEmissions").alias("TotalEmissions"))
    return top_rows(totals, "TotalEmissions", k, [group])


def rank_polluters(
    emissions: DataFrame,
    yardsticks: Sequence[str] = ("TotalEmissions", "PerCapitaEmissions", "ShareOfGlobalEmissions"),
    k: int = 10,
) -> DataFrame:
    """Countries up to rank ``k`` by the mean of each yardstick over the years.

    Countries with equal means share a rank, and all of them are kept.
    """
    means = emissions.groupBy("Country").agg(
        *[F.avg(y).cast("float").alias(y) for y in yardsticks]
    )
    long = means.unpivot("Country", list(yardsticks), "Yardstick", "Mean").filter("Mean IS NOT NULL")
    # Ranks are found on the different means, each with the number of countries
    # that have it, so that a mean shared by very many is one row. No rank up
    # to k lies below the k-th of them, so the window sees k rows a yardstick.
    different = long.groupBy("Yardstick", "Mean").agg(F.count("*").alias("countries"))
    best = [
        different.filter(F.col("Yardstick") == y).orderBy(F.desc("Mean")).limit(k) for y in yardsticks
    ]
    steps = reduce(DataFrame.unionAll, best)
    best_first = Window.partitionBy("Yardstick").orderBy(F.desc("Mean"))
    better = F.sum("countries").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    ranks = (
        steps.withColumn("Rank", F.coalesce(better, F.lit(0)) + 1)
        .filter(F.col("Rank") <= k)
        .select("Yardstick", "Mean", F.col("Rank").cast("int").alias("Rank"))
    )
    # At most k rows for each yardstick, so for a usual k the broadcast is small.
    if k <= BROADCAST_MAX_RANKS:
        ranks = F.broadcast(ranks)
    ranked = long.join(ranks, ["Yardstick", "Mean"])
    return ranked.select("Country", "Yardstick", "Mean", "Rank")


def worst_of_widened(
    wide: DataFrame,
    entities: Sequence[str] = EUROPE_THREE,
    measure: str = "TotalEmissions",
) -> DataFrame:
    """The entities of a widened table by their sum over the years, worst first."""
    totals = lengthen(wide, entities, measure).groupBy("Country").agg(F.sum(measure).alias(measure))
    return totals.orderBy(F.desc(measure), "Country")
