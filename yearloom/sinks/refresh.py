"""Bringing a partitioned dataset up to date without writing all of it again."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.scratch import remove, scratch_dir, settled
from yearloom.sinks.writers import write_partitioned, writer
from yearloom.sources import file_names


class RefreshRefused(ValueError):
    """A partition would lose more of its rows than may be."""


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _digests(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    """Rows of each partition and a sum over them that depends on every value, not on order."""
    values = [_quoted(c) for c in sorted(df.columns) if c not in columns]
    row = F.xxhash64(*values, *[v.isNull() for v in values]).cast("decimal(38,0)")
    own = [_quoted(c).alias(f"{side}_{i}") for i, c in enumerate(columns)]
    return df.groupBy(*own).agg(
        F.count("*").alias(f"{side}_rows"), F.sum(row).alias(f"{side}_sum")
    )


def _compared(new: DataFrame, old: DataFrame, columns: Sequence[str]) -> DataFrame:
    a, b = _digests(new, columns, "new"), _digests(old, columns, "old")
    same_place = reduce(
        and_, [F.col(f"new_{i}").eqNullSafe(F.col(f"old_{i}")) for i in range(len(columns))]
    )
    state = (
        F.when(F.col("old_rows").isNull(), "added")
        .when(F.col("new_rows").isNull(), "absent")
        .when((F.col("old_rows") == F.col("new_rows")) & (F.col("old_sum") == F.col("new_sum")), "same")
        .otherwise("changed")
    )
    names = [F.coalesce(f"new_{i}", f"old_{i}").alias(c) for i, c in enumerate(columns)]
    return a.join(b, same_place, "full").select(
        *names,
        F.coalesce("old_rows", F.lit(0)).alias("old_rows"),
        F.coalesce("new_rows", F.lit(0)).alias("new_rows"),
        state.alias("state"),
    )


def _shape(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema if f.name not in columns}


def refresh_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], most_lost: float | None = None
) -> DataFrame:
    """Replace those partitions of a dataset whose rows in ``df`` differ; returns what was done.

    The dataset is one of ``write_partitioned`` by the same ``columns``. ``df``
    holds all rows of the partitions it has rows of: a partition with other rows
    than before is replaced, a new one is added, one with the same rows keeps its
    files, and one that ``df`` has no rows of stays. Rows are compared by their
    number and a digest over all their values that does not depend on order.
    Each partition is replaced as the write commits; the whole is not one step.

    The result has one row for each partition: ``columns``, ``old_rows``,
    ``new_rows`` and ``state``, which is ``added``, ``changed``, ``same`` or
    ``absent``. Where a changed partition would lose more than the share
    ``most_lost`` of its rows, nothing is written and it is an error.

    ``df`` is computed once, into a scratch folder. A dataset that does not
    exist is written whole. One with other columns or types is an error.
    """
    spark = df.sparkSession
    rows_path = scratch_dir(spark, "refresh")
    try:
        new = settled(df, "refresh", rows_path)
        if file_names(spark, path) is None:
            write_partitioned(new, path, columns)
            added = new.groupBy(*[_quoted(c) for c in columns]).agg(F.count("*").alias("new_rows"))
            old_rows = F.lit(0).cast("long").alias("old_rows")
            return settled(added.select(*columns, old_rows, "new_rows", F.lit("added").alias("state")), "report")
        old = spark.read.parquet(path)
        if _shape(old, columns) != _shape(new, columns):
            raise ValueError(f"{path} has columns {_shape(old, columns)}, not {_shape(new, columns)}")
        # Values of partition columns are read back from the names of folders.
        old = old.withColumns({c: _quoted(c).cast(new.schema[c].dataType) for c in columns})
        report = settled(_compared(new, old, columns), "report")
        if most_lost is not None:
            lost = (F.col("state") == "changed") & (F.col("new_rows") < F.col("old_rows") * (1 - most_lost))
            n, example = report.filter(lost).agg(F.count("*"), F.min(F.concat_ws("/", *columns))).first()
            if n:
                raise RefreshRefused(f"{path}: {n} partitions would lose too many rows, such as {example}")
        due = report.filter(F.col("state").isin("added", "changed"))
        if due.isEmpty():
            return report
        keys = due.select(*[_quoted(c).alias(f"__due_{i}") for i, c in enumerate(columns)])
        among = reduce(and_, [_quoted(c).eqNullSafe(F.col(f"__due_{i}")) for i, c in enumerate(columns)])
        rows = new.join(keys, among, "left_semi").hint("rebalance", *columns)
        by_value = writer(rows).option("partitionOverwriteMode", "dynamic")
        by_value.partitionBy(*columns).parquet(path)
        return report
    finally:
        remove(spark, rows_path)
