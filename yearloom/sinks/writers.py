"""Writing Parquet datasets. Every write replaces what was there."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from yearloom.operators import in_order


def arranged(df: DataFrame, sort_by: Sequence[str], single_file: bool) -> DataFrame:
    if not single_file:
        return in_order(df, sort_by) if sort_by else df
    # Only the last step, and no more of the plan, is left to the single task.
    one = df.repartition(1)
    return one.sortWithinPartitions(*sort_by) if sort_by else one


def writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").option("compression", "snappy")


def write_parquet(
    df: DataFrame, path: str, sort_by: Sequence[str] = (), single_file: bool = False
) -> None:
    """Write ``df`` as Parquet, ordered by ``sort_by`` across its files if given.

    Unsorted output is written by the tasks that computed it. ``single_file``
    sends all rows through one task, which takes the time and the local disk
    that sorting and writing all of them needs; leave it off for large output.
    """
    writer(arranged(df, sort_by, single_file)).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], one_file_each: bool = False
) -> None:
    """Write ``df`` as Parquet in one directory per value of ``columns``.

    The rows of a value are brought together, so small directories get one file
    and Spark splits a value with too many rows for one task.
    ``one_file_each`` forbids the split.
    """
    if one_file_each:
        together = df.repartition(*columns)
    else:
        together = df.hint("rebalance", *columns)
    by_value = writer(together).option("partitionOverwriteMode", "static")
    by_value.partitionBy(*columns).parquet(path)
