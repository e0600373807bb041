"""Replacing flagged values by the nearest trusted neighbour."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.fixed import FILL_AHEAD_YEARS, FILL_BACK_YEARS, OCEANIA_TWO
from yearloom.functions import is_leap_year
from yearloom.operators.joins import skew_safe_join
from yearloom.operators.shape import keep_entities


_BUCKET, _HOME = "__bucket", "__home"


def _neighbour(by: Sequence[str], order: str, value: str, back: float, ahead: float) -> Column:
    """Nearest earlier value within ``back``, else nearest later within ``ahead``."""
    # The frames are ranges of the order value, not row offsets: a gap in the
    # years must not bring a farther year nearer.
    by_order = Window.partitionBy(*by).orderBy(order)
    earlier = F.last(value, ignorenulls=True).over(by_order.rangeBetween(-back, -1))
    later = F.first(value, ignorenulls=True).over(by_order.rangeBetween(1, ahead))
    placed = F.col(by[0]).isNotNull() & F.col(order).isNotNull()
    return F.when(placed, F.coalesce(earlier, later))


def _with_nearest(
    df: DataFrame,
    name: str,
    key: str,
    order: str,
    value: str,
    back: float,
    ahead: float,
    bucket: float | None,
) -> DataFrame:
    """``df`` with the nearest value of every row as ``name``."""
    if bucket is None:
        return df.withColumn(name, _neighbour([key], order, value, back, ahead))
    if bucket <= 0:
        raise ValueError(f"a bucket holds a positive range of order values, not {bucket!r}")
    whole = df.schema[order].dataType.typeName() in ("byte", "short", "integer", "long")
    at = F.col(order).cast("long" if whole else "double")

    def of(x: Column) -> Column:
        return F.floor(x / F.lit(bucket))

    # A row goes to its own bucket and to each that holds rows which may look at
    # it. Rows without a place in the order look at none: they stay spread.
    placed = F.col(key).isNotNull() & F.col(order).isNotNull()
    home = F.when(placed, of(at)).otherwise(F.spark_partition_id().cast("long"))
    first, last = (F.when(placed, of(x)).otherwise(home) for x in (at - ahead, at + back))
    copies = df.withColumn(_HOME, home).withColumn(
        _BUCKET, F.explode(F.sequence(first, last))
    )
    nearest = _neighbour([key, _BUCKET], order, value, back, ahead)
    found = copies.withColumn(name, nearest).filter(F.col(_BUCKET) == F.col(_HOME))
    return found.drop(_BUCKET, _HOME)


def fill_flagged(
    df: DataFrame,
    flag: Column,
    key: str = "Country",
    order: str = "Year",
    value: str = "TotalEmissions",
    back: int = FILL_BACK_YEARS,
    ahead: int = FILL_AHEAD_YEARS,
    unique: bool = False,
    salts: int = 1,
    bucket: float | None = None,
) -> DataFrame:
    """Replace ``value`` where ``flag`` holds; other rows and columns stay.

    The replacement is the nearest non-NULL value of the same key up to
    ``back`` steps earlier, else up to ``ahead`` steps later, else NULL; the
    flagged value itself is never kept. Neighbours are read as they were before
    any replacement. A row without a key or order value has no neighbours.

    With ``unique=True`` the caller vouches for one row per key and order value
    and the work is a single window with a single shuffle. Otherwise a key may
    repeat without limit: its rows are first reduced to one per order value,
    the largest, so that the window sees only as many rows as there are order
    values. The replacements are then joined by ``skew_safe_join`` to the
    flagged rows; the others are not shuffled at all. For that ``flag`` is
    evaluated more than once and must give the same answer each time.

    A window takes the order values of a key in one task. That suits years; for
    keys with very many order values, such as seconds, ``bucket`` cuts the order
    into ranges of that length, each of which may go to another task. A row that
    lies within ``back`` or ``ahead`` of a range is copied there to be looked at
    and is returned once. Let a bucket be many times ``back + ahead`` long, as
    the share of copied rows is about ``(back + ahead) / bucket``.
    """
    if unique:
        made = _with_nearest(df, "__nearest", key, order, value, back, ahead, bucket)
        return made.withColumn(
            value, F.when(flag, F.col("__nearest")).otherwise(F.col(value))
        ).drop("__nearest")

    steps = df.groupBy(key, order).agg(F.max(value).alias(value))
    found = _with_nearest(steps, "__nearest", key, order, value, back, ahead, bucket)
    fills = found.select(key, order, "__nearest").filter("__nearest IS NOT NULL")
    flagged = F.coalesce(flag, F.lit(False))
    replaced = (
        skew_safe_join(df.filter(flagged), fills, [key, order], "left", salts)
        .withColumn(value, F.col("__nearest"))
        .select(*df.columns)
    )
    return df.filter(~flagged).unionByName(replaced)


def leap_year_fill(
    emissions: DataFrame,
    entities: Sequence[str] | None = OCEANIA_TWO,
    measure: str = "TotalEmissions",
    unique: bool = False,
    bucket: float | None = None,
) -> DataFrame:
    """Year, country and emissions, with the leap-year figures replaced.

    Keeps only ``entities``; ``None`` keeps every named country. ``unique`` and
    ``bucket`` are those of ``fill_flagged``.
    """
    if entities is None:
        kept = emissions.filter(F.col("Country").isNotNull())
    else:
        kept = keep_entities(emissions, entities)
    rows = kept.select("Year", "Country", F.col(measure).cast("float").alias(measure))
    return fill_flagged(rows, is_leap_year(F.col("Year")), value=measure, unique=unique, bucket=bucket)
