"""Inputs: CSV, Parquet and the readiness check for a producer's output."""

from yearloom.sources.files import (
    file_names,
    files_below,
    is_complete,
    same_place,
    stored_bytes,
)
from yearloom.sources.readers import (
    BAD_RECORD,
    bad_records,
    bad_records_by_file,
    good_rows,
    read_continents,
    read_csv,
    read_csv_checked,
    read_parquet,
    resolve_source,
)

__all__ = [
    "BAD_RECORD",
    "bad_records",
    "bad_records_by_file",
    "file_names",
    "files_below",
    "good_rows",
    "is_complete",
    "read_continents",
    "read_csv",
    "read_csv_checked",
    "read_parquet",
    "resolve_source",
    "same_place",
    "stored_bytes",
]
