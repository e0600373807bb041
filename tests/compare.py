"""Running a query here and its SQL in DuckDB, and comparing the results."""

import math
from pathlib import Path

import duckdb


def oracle_connection(sf_dir) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda r: [(c is None, str(type(c)), c) for c in r])


_SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql) -> list[str]:
    """What differs between the rows of ``df`` and of ``sql``; empty if nothing."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    types = dict((r[0], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall())
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)}, expected {sorted(names)}"]
    for name, spark_type in df.dtypes:
        if _SAME_TYPE.get(spark_type) != types[name]:
            found.append(f"{name} is {spark_type}, expected {types[name]}")
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted_rows(names, expected)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows, expected {len(theirs)}")
    unlike = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if unlike:
        found.append(f"{len(unlike)} rows differ, first {unlike[0]}")
    return found
