"""Checking a written dataset against what it was promised to be."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from yearloom.sinks.writers import arranged, writer
from yearloom.sources import file_names, files_below

#: Relative standard deviation of the estimated number of different keys.
_RSD = 0.01


class ContractBroken(AssertionError):
    """A written dataset is not what its consumers were promised."""


def _file_faults(spark: SparkSession, path: str, single_file: bool) -> tuple[list[str], int]:
    """What is wrong with the files of a dataset, and how many hold data."""
    names = file_names(spark, path)
    if names is None:
        raise ContractBroken(f"{path}: no such dataset")
    # Those of a dataset partitioned by column lie in folders of their own.
    parts = [
        f
        for f in files_below(spark, path)
        if f.endswith(".snappy.parquet") and all(n[0] not in "._" for n in f.split("/"))
    ]
    wrong = []
    if names.count("_SUCCESS") != 1:
        wrong.append("no _SUCCESS mark")
    if not parts or (single_file and len(parts) != 1):
        wrong.append(f"{len(parts)} data files")
    return wrong, len(parts)


def _row_faults(rows: int, count: int | None) -> list[str]:
    return [f"{rows} rows, not {count}"] if count is not None and rows != count else []


def _schema_faults(found: StructType, schema: StructType) -> list[str]:
    if found == schema:
        return []
    return [f"schema {found.simpleString()}, not {schema.simpleString()}"]


def _as_stored(schema: StructType) -> StructType:
    """Columns of Parquet may always hold NULLs."""
    return StructType([StructField(f.name, f.dataType) for f in schema])


def check_output(
    spark: SparkSession,
    path: str,
    schema: StructType,
    count: int | None = None,
    single_file: bool = False,
) -> int:
    """Check files, schema and row count of a Parquet dataset; returns the count.

    The rows are counted from the file footers and none is fetched. All that is
    wrong is reported at once. A dataset that is just being written is checked
    by ``write_checked`` without being read.
    """
    wrong, parts = _file_faults(spark, path, single_file)
    rows = None
    if parts:
        df = spark.read.parquet(path)
        wrong += _schema_faults(df.schema, schema)
        rows = df.count()
        wrong += _row_faults(rows, count)
    if wrong:
        raise ContractBroken(f"{path}: " + "; ".join(wrong))
    return rows


@dataclass(frozen=True)
class Written:
    """What the job that wrote a dataset saw of its rows."""

    rows: int
    nulls: dict[str, int]


def write_checked(
    df: DataFrame,
    path: str,
    schema: StructType,
    sort_by: Sequence[str] = (),
    single_file: bool = False,
    count: int | None = None,
    required: Sequence[str] = (),
    unique: Sequence[str] = (),
) -> Written:
    """Write ``df`` as ``write_parquet`` does and check it as ``check_output`` does.

    Rows and NULLs are counted by the job that writes them, in its last step, so
    the dataset is not read again; a task that ran twice counts once. Columns in
    ``required`` must have no NULL. ``unique`` names a key that no two rows may
    share. The different keys are estimated, so a few repeated ones may pass,
    but not more than some percent of all rows; an exact test needs a shuffle.
    What is wrong is reported once the dataset is written, all at once.
    """
    seen = Observation()
    names = {c: f"nulls_{i}" for i, c in enumerate(df.columns)}
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    metrics = [F.count_if(quoted[c].isNull()).alias(name) for c, name in names.items()]
    if unique:
        key = F.struct(*[quoted[c] for c in unique])
        metrics.append(F.approx_count_distinct(F.xxhash64(key), _RSD).alias("keys"))
    observed = arranged(df, sort_by, single_file).observe(seen, F.count("*").alias("rows"), *metrics)
    writer(observed).parquet(path)

    found = seen.get
    rows = found.get("rows") or 0
    nulls = {c: found.get(name) or 0 for c, name in names.items()}
    wrong, _ = _file_faults(df.sparkSession, path, single_file)
    wrong += _schema_faults(_as_stored(df.schema), _as_stored(schema))
    wrong += _row_faults(rows, count)
    wrong += [f"{nulls[c]} NULLs in {c}" for c in required if nulls[c]]
    if unique and (found.get("keys") or 0) < rows * (1 - 4 * _RSD):
        wrong.append(f"about {found['keys']} different ({', '.join(unique)}) in {rows} rows")
    if wrong:
        raise ContractBroken(f"{path}: " + "; ".join(wrong))
    return Written(rows, nulls)
