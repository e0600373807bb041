"""Reading CSV and Parquet."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from yearloom.fixed import CONTINENT_CSV_SCHEMA
from yearloom.sources.files import is_complete


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header row.

    Without a schema the types are inferred, which reads the input a second
    time. With one, its names are checked against the header.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


#: Holds the text of a CSV record that does not fit its schema.
BAD_RECORD = "_bad_record"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row, and ``BAD_RECORD`` beside the columns of ``schema``.

    A record with too few or too many fields, or with a field that is no value
    of its type, has its whole text there, and NULLs for what cannot be read;
    other records have NULL. An empty field is a missing value and no fault.
    Take rows from it by ``good_rows`` and ``bad_records``, which read every
    record whole: which records have faults would otherwise depend on the
    columns in use.
    """
    with_text = StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.schema(with_text).csv(path)


def _fields_read(checked: DataFrame) -> Column:
    names = ["`" + c.replace("`", "``") + "`" for c in checked.columns if c != BAD_RECORD]
    return sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))


def _where(checked: DataFrame, condition: Column) -> DataFrame:
    # Spark reads no fields that a query does not name, and finds no faults in
    # them. This names them all and is true of all rows.
    return checked.filter(condition & (_fields_read(checked) >= 0))


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows of ``read_csv_checked`` that fit the schema."""
    return _where(checked, F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def bad_records(checked: DataFrame) -> DataFrame:
    """The others: their ``file``, their text as ``record`` and how many fields could be read."""
    return _where(checked, F.col(BAD_RECORD).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"),
        F.col(BAD_RECORD).alias("record"),
        _fields_read(checked).alias("fields_read"),
    )


def bad_records_by_file(bad: DataFrame) -> DataFrame:
    """How many bad records each file has; files without any are left out."""
    return bad.groupBy("file").agg(F.count("*").alias("bad_records"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset."""
    return spark.read.parquet(path)


def read_continents(spark: SparkSession, path: str) -> DataFrame:
    """The raw country and continent CSV, as text columns and one number."""
    return read_csv(spark, path, CONTINENT_CSV_SCHEMA)


def resolve_source(
    spark: SparkSession, primary: str, fallback: str, datasets: Iterable[str]
) -> str:
    """``primary`` if it holds every dataset, completely written; else ``fallback``."""
    ready = all(is_complete(spark, f"{primary}/{name}") for name in datasets)
    return primary if ready else fallback
