"""Outputs: Parquet datasets, managed tables and checks on them."""

from yearloom.sinks.contract import ContractBroken, Written, check_output, write_checked
from yearloom.sinks.refresh import RefreshRefused, refresh_partitioned
from yearloom.sinks.tables import create_database, drop_database, write_table, write_tables
from yearloom.sinks.writers import write_parquet, write_partitioned

__all__ = [
    "ContractBroken",
    "RefreshRefused",
    "Written",
    "check_output",
    "create_database",
    "drop_database",
    "refresh_partitioned",
    "write_checked",
    "write_parquet",
    "write_partitioned",
    "write_table",
    "write_tables",
]
