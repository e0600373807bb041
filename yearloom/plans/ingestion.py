"""From raw CSV files to Parquet datasets with storable column names."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from yearloom.operators import with_storable_names
from yearloom.sinks import write_checked, write_parquet
from yearloom.sources import bad_records, good_rows, read_csv, read_csv_checked


class IngestionRefused(ValueError):
    """An input has more bad records than may be."""


def _without_bad_records(
    spark: SparkSession, path: str, schema: StructType, quarantine: str, most_bad: int | None
) -> DataFrame:
    checked = read_csv_checked(spark, path, schema)
    bad = bad_records(checked)
    found = write_checked(bad, quarantine, bad.schema).rows
    if most_bad is not None and found > most_bad:
        raise IngestionRefused(f"{path}: {found} bad records, at most {most_bad} may be; see {quarantine}")
    return good_rows(checked)


def run_ingestion(
    spark: SparkSession,
    csv_paths: Mapping[str, str],
    target: str,
    schemas: Mapping[str, StructType] | None = None,
    single_file: bool = False,
    quarantine: str | None = None,
    most_bad: int | None = None,
) -> list[str]:
    """Write each CSV, given by dataset name, as ``target/<dataset name>``.

    Give ``schemas`` for large inputs: without one a file is read once more.

    As it stands, what does not fit its column's type becomes NULL. With a
    ``quarantine`` folder, records that do not fit are kept out of the dataset
    and written as ``quarantine/<dataset name>``, with their file, their text
    and the number of fields that could be read; of more than ``most_bad`` such
    records the ingestion fails before it writes the dataset. That reads the
    input twice.
    """
    schemas = schemas or {}
    written = []
    for dataset, path in csv_paths.items():
        if quarantine is None:
            rows = read_csv(spark, path, schemas.get(dataset))
        else:
            schema = schemas.get(dataset) or read_csv(spark, path).schema
            kept = f"{quarantine}/{dataset}"
            rows = _without_bad_records(spark, path, schema, kept, most_bad)
        written.append(f"{target}/{dataset}")
        write_parquet(with_storable_names(rows), written[-1], single_file=single_file)
    return written
