"""Small frames, plans and comparisons for tests."""

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame

EMISSION_COLUMNS = (
    "Year int, Country string, TotalEmissions float, PerCapitaEmissions float,"
    " ShareOfGlobalEmissions float"
)


def frame(spark, schema: str, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def emission_rows(spark, *rows) -> DataFrame:
    """Rows of (year, country, total); the other measures follow from the total."""
    return frame(spark, EMISSION_COLUMNS, *[(y, c, t, t / 10, 0.5) for y, c, t in rows])


def assert_rows(df: DataFrame, schema: str, *rows) -> None:
    """Same column names, types and rows; row order does not count."""
    expected = df.sparkSession.createDataFrame(list(rows), schema)
    assert df.dtypes == expected.dtypes
    key = lambda row: [(v is not None, v) for v in row]
    assert sorted(df.collect(), key=key) == sorted(expected.collect(), key=key)


def plan_of(df: DataFrame) -> str:
    """The physical plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df: DataFrame) -> str:
    """The physical plan as it was changed while running."""
    df._jdf.queryExecution().executedPlan().executeCollect()
    text = plan_of(df)
    return text.split("== Initial Plan ==")[0]


def count_nodes(plan: str, name: str) -> int:
    return len(re.findall(rf"^[\s:+\-|*()\d]*{name}\b", plan, flags=re.MULTILINE))


def stored(df: DataFrame, path) -> DataFrame:
    """``df`` after a trip through Parquet, so that plans start at a file scan."""
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@contextmanager
def settings(spark, **values):
    """Session settings for a while; underscores in their names stand for dots."""
    names = {k.replace("_", "."): v for k, v in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)
