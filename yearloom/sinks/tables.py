"""Managed tables that can be published again and again.

A table is replaced by writing its new rows to a folder beside the old ones and
then pointing the catalog at that folder, which is one change of the catalog: a
reader sees all old rows or all new ones. What a run that was stopped has left
behind is in nobody's way and goes with the next publication of the table.

One job at a time may publish a table; any number may read it.
"""

import re
from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from yearloom.scratch import remove
from yearloom.sinks.writers import arranged, writer
from yearloom.sources import file_names, same_place

#: Stands between a table's name and the number of a folder or table of its rows.
_MARK = "__published_"
#: What a writer of Parquet leaves in a folder, whether or not it came to its end.
_WRITTEN = re.compile(r"_SUCCESS|_temporary|part-.*|_spark_metadata")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it is missing; the session's current one stays.

    A database stays where it is. Without ``location`` it is taken wherever it
    lies; a ``location`` is a claim about its place, and one that exists
    elsewhere is an error.
    """
    if location is None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")
        return
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION {_text(location)}")
    place = spark.catalog.getDatabase(_quoted(name)).locationUri
    if not same_place(spark, place, location):
        raise ValueError(f"database {name} is at {place}, not at {location}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database with all its tables and their rows, if it exists."""
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)} CASCADE")


def _described(spark: SparkSession, full: str) -> dict[str, str]:
    """What the catalog says of a table, by the names it gives."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()
    start = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[start:]}


def _same(spark: SparkSession, one: str, other: str) -> bool:
    return same_place(spark, spark._jvm.org.apache.hadoop.fs.Path(one).toUri().toString(), other)


def _home(spark: SparkSession, db: str) -> str:
    """The folder of a database as a path; the catalog gives it as an escaped URI."""
    uri = spark._jvm.java.net.URI(spark.catalog.getDatabase(db).locationUri)
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString()


def _remove_leftovers(spark: SparkSession, db: str, table: str, keep: str | None) -> None:
    """Remove what earlier publications of a table have left, but for the folder ``keep``."""
    ours = re.compile(re.escape(table) + _MARK + "[0-9a-f]{32}(_retired)?", re.IGNORECASE)
    for found in spark.sql(f"SHOW TABLES IN {db}").collect():
        if ours.fullmatch(found["tableName"]):
            spark.sql(f"DROP TABLE {db}.{_quoted(found['tableName'])}")
    home = _home(spark, db)
    for name in file_names(spark, home) or []:
        path = f"{home}/{name}"
        if not ours.fullmatch(name) and name.lower() != table.lower():
            continue
        if keep is not None and _same(spark, keep, path):
            continue
        # In the table's own place there may be something else than its rows.
        if all(_WRITTEN.fullmatch(n) for n in file_names(spark, path) or []):
            remove(spark, path)


def _put_back(spark: SparkSession, db: str, table: str) -> bool:
    """Give a table its name again if a run was stopped between two renamings."""
    ours = re.compile(re.escape(table) + _MARK + "[0-9a-f]{32}_retired", re.IGNORECASE)
    for found in spark.sql(f"SHOW TABLES IN {db}").collect():
        if ours.fullmatch(found["tableName"]):
            spark.sql(f"ALTER TABLE {db}.{_quoted(found['tableName'])} RENAME TO {db}.{_quoted(table)}")
            return True
    return False


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def write_table(
    df: DataFrame,
    table: str,
    sort_by: Sequence[str] = (),
    single_file: bool = False,
    database: str | None = None,
    keep_replaced: bool = False,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Publish ``df`` as the managed Parquet table ``table`` of ``database``.

    ``database`` is the current one if not given. A table that exists is
    replaced in one step, with all its rows or, if this fails, with none. ``df``
    may read the table it replaces. ``keep_replaced`` leaves the files of the
    rows before in place until the next publication, for readers that began
    before this one; otherwise they go at once.

    With ``bucket_by`` the rows lie in ``buckets`` files by a hash of these
    columns, sorted by them. Two such tables with as many buckets are joined on
    the columns without a shuffle, see ``country_panel(colocated=True)``.

    New columns or types, and buckets, cannot be put in place in that step: the
    old table is renamed then and the new one takes its name, and between the two a reader
    finds no table of that name. A run that is stopped just there leaves the
    old rows under the longer name; the next publication puts them back first.
    """
    spark = df.sparkSession
    db = _quoted(database or spark.catalog.currentDatabase())
    version = f"{table}{_MARK}{uuid4().hex}"
    full = f"{db}.{_quoted(table)}"
    if bucket_by:
        # The hash is that of the buckets, so each is the work of one task.
        rows = writer(df.repartition(buckets, *bucket_by)).format("parquet")
        rows = rows.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    else:
        rows = writer(arranged(df, sort_by, single_file)).format("parquet")
    if not spark.catalog.tableExists(full) and not _put_back(spark, db, table):
        # The catalog learns of a new table when all its rows are there.
        _remove_leftovers(spark, db, table, None)
        rows.saveAsTable(full)
        return

    known = _described(spark, full)
    if known["Type"] != "MANAGED":
        raise ValueError(f"{full} is not a managed table but {known['Type']}")
    old = known["Location"]
    _remove_leftovers(spark, db, table, old)
    same = known["Provider"].lower() == "parquet" and _shape(spark.table(full)) == _shape(df)
    if same and not bucket_by and "Num Buckets" not in known:
        new = f"{_home(spark, db)}/{version}"
        rows.save(new)
        spark.sql(f"ALTER TABLE {full} SET LOCATION {_text(new)}")
        spark.catalog.refreshTable(full)
        if not keep_replaced:
            remove(spark, old)
    else:
        beside, retired = (f"{db}.{_quoted(version + end)}" for end in ("", "_retired"))
        rows.saveAsTable(beside)
        spark.sql(f"ALTER TABLE {full} RENAME TO {retired}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {full}")
        spark.sql(f"DROP TABLE {retired}")


def write_tables(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    sort_by: Sequence[str] = (),
    single_file: bool = False,
    location: str | None = None,
    keep_replaced: bool = False,
) -> list[str]:
    """Create ``database`` and publish every table in it; returns their full names.

    Each table is replaced by itself, after the one before it.
    """
    create_database(spark, database, location)
    written = []
    for name, df in tables.items():
        write_table(df, name, sort_by, single_file, database, keep_replaced)
        written.append(f"{database}.{name}")
    return written
