"""The queries on tables where one key holds a third of the rows.

Broadcasts are off and the limits for splitting a partition are low, so that
joins run as sort-merge joins whose hot partitions are split.
"""

from pathlib import Path

import duckdb
import pytest
from compare import differences, oracle_connection
from conftest import TESTDATA
from helpers import settings

from testbed.registry import REGISTRY

SOURCE = TESTDATA / "sf0.001"
HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey)",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN l_partkey % 3 = 0 THEN 12 ELSE l_orderkey END AS l_orderkey)""",
}
QUERIES = [
    "global_panel",
    "country_panel",
    "customer_panel",
    "pivot_entities",
    "leap_year_fill_all",
    "leap_year_fill_repeated",
    "country_series_by_emissions",
    "top_observations",
    "top_emitters",
    "continent_enrich",
    "continent_enrich_broadcast",
    "continent_enrich_large",
    "temperature_anomaly",
    "worst_anomalies",
    "largest_emitting_continents",
    "rank_polluters",
    "sorted_roundtrip",
    "partitioned_roundtrip",
    "leap_year_fill_bucketed",
    "avg_by_country_exact",
    "reconciled_panel",
    "bucketed_panel",
    "refreshed_years",
    "csv_bad_records",
    "managed_table_again",
    "whole_run",
]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    target = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for path in sorted(Path(SOURCE).glob("*.parquet")):
        select = HOT.get(path.stem, "SELECT *")
        con.execute(f"COPY ({select} FROM '{path}') TO '{target / path.name}' (FORMAT parquet)")
    con.close()
    return str(target)


@pytest.fixture(scope="module")
def oracle(hot_dir):
    con = oracle_connection(hot_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", QUERIES)
def test_hot_tables(spark, hot_dir, oracle, name):
    low = {
        "spark_sql_autoBroadcastJoinThreshold": "-1",
        "spark_sql_adaptive_autoBroadcastJoinThreshold": "-1",
        "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "1KB",
        "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "1.5",
        "spark_sql_adaptive_advisoryPartitionSizeInBytes": "4KB",
    }
    query = REGISTRY[name]
    with settings(spark, **low):
        assert differences(query.run(spark, hot_dir), oracle, query.sql) == []
