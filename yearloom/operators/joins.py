"""Joins of panels with each other and with a lookup."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.functions import short_name

BROADCAST_MAX_BYTES = 8 * 1024 * 1024
_SALT = "__salt"


def skew_safe_join(
    many: DataFrame,
    few: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int = 1,
) -> DataFrame:
    """Equi-join whose left side may hold most of its rows under one key.

    Both sides are shuffled for the join itself, also a right side that an
    aggregation has already hashed on the keys. Only then can adaptive
    execution split a left partition that turns out too large, over as many
    tasks as its size asks for, or send a right side that turns out small to
    all tasks. Nothing is repeated for the keys that are not hot.

    ``salts`` above 1 is for sessions without adaptive execution: the rows of
    each key go to up to ``salts`` tasks and each right row is repeated as many
    times. The salt is the number of the input partition, so it splits
    identical rows too, and a task that runs again after a lost executor gives
    its rows the same salt again. Filter the inputs of a salted join rather
    than its result, as no filter moves down past the salt.

    NULL keys match nothing; a left join keeps their rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"the join is inner or left, not {how!r}")
    on = list(keys)
    if salts > 1:
        many = many.withColumn(_SALT, F.spark_partition_id() % salts)
        few = few.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append(_SALT)
    right_names = {k: f"__few_{k}" for k in on}
    # Null-safe equality is what brings about the shuffle of both sides. Plain
    # equality would also filter the right side on non-NULL keys, below its
    # aggregation: keys made by cleaning text would be computed twice for each
    # raw row, and a shuffle shared with the left side would be lost.
    condition = [F.col(k).eqNullSafe(F.col(right_names[k])) for k in on]
    known = [F.col(k).isNotNull() for k in keys]
    if how == "inner":
        many = many.filter(reduce(and_, known))
    else:
        condition += known
    joined = many.join(few.withColumnsRenamed(right_names), condition, how)
    return joined.drop(_SALT, *right_names.values())


def global_panel(total_emissions: DataFrame, temperatures: DataFrame) -> DataFrame:
    """Yearly emissions beside yearly temperatures; years found in both.

    Both sides hold one row per year, already hashed on the year by their
    aggregation, so the join adds no shuffle.
    """
    return total_emissions.join(temperatures, on="Year", how="inner")


def country_panel(
    emissions: DataFrame,
    temperatures: DataFrame,
    salts: int = 1,
    where: Column | None = None,
    colocated: bool = False,
) -> DataFrame:
    """Emissions beside the mean temperature of the same year and country.

    ``where`` is a condition on ``Year`` and ``Country``. It is put to both
    inputs, so that readings the join would drop are not aggregated first; a
    filter of the result reaches the emissions only.

    ``colocated`` says that both are tables with buckets by year and country,
    or that one is: those rows stay where they are, and a country with most of
    the rows of its bucket is not split.

    Names must agree exactly: title-cased temperature names such as
    ``Bosnia And Herzegovina`` find no emissions row and are dropped;
    ``reconciled_panel`` finds them.
    """
    if where is not None:
        emissions, temperatures = emissions.filter(where), temperatures.filter(where)
    if colocated:
        return emissions.join(temperatures, on=["Year", "Country"], how="inner")
    return skew_safe_join(emissions, temperatures, ["Year", "Country"], "inner", salts)


def continent_lookup(raw: DataFrame, unique: bool = False) -> DataFrame:
    """Country and continent, with formal country names cut to short ones.

    Cutting makes some names equal and some countries lie on two continents;
    all rows are kept. ``unique=True`` keeps the alphabetically first continent
    of each name, so that a join with the lookup does not repeat rows.
    """
    lookup = raw.select(
        short_name(F.col("Country_Name")).alias("Country"),
        F.col("Continent_Name").alias("Continent"),
    )
    if unique:
        lookup = lookup.groupBy("Country").agg(F.min("Continent").alias("Continent"))
    return lookup


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the rows of ``df``, as text, take at most ``max_bytes``.

    Runs one aggregation over ``df`` on the executors and fetches one number.
    """
    row_bytes = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns),
        F.lit(16),
    )
    total = df.agg(F.sum(row_bytes.cast("long")).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes


def with_continent(
    panel: DataFrame,
    lookup: DataFrame,
    broadcast: bool = False,
    max_bytes: int = BROADCAST_MAX_BYTES,
    salts: int = 1,
    stored: int | None = None,
) -> DataFrame:
    """The panel with the continent of each country, NULL where unknown.

    As it stands Spark broadcasts the lookup where its known size is under the
    session's threshold and shuffles otherwise. ``broadcast=True`` sends it to
    every executor, whatever the threshold, if it fits into ``max_bytes``: by
    the size ``stored`` of its files where the caller knows it, else measured by
    a job of its own.
    """
    if broadcast and (stored <= max_bytes if stored is not None else fits_broadcast(lookup, max_bytes)):
        return panel.join(F.broadcast(lookup), on="Country", how="left")
    return skew_safe_join(panel, lookup, ["Country"], "left", salts)
