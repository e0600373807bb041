"""What Spark makes of the operators: shuffles, pushdown, joins, skew."""

import pytest
from conftest import TESTDATA
from helpers import (
    EMISSION_COLUMNS,
    assert_rows,
    count_nodes,
    final_plan_of,
    frame,
    plan_of,
    settings,
    stored,
)
from pyspark.sql import functions as F

from testbed import registry, views
from yearloom import operators as op
from yearloom import sinks
from yearloom.functions import is_leap_year
from yearloom.scratch import settled

SMALL = str(TESTDATA / "sf0.001")


def no_broadcast(spark):
    return settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_autoBroadcastJoinThreshold="-1",
    )


@pytest.fixture(scope="module")
def emissions(spark, tmp_path_factory):
    raw = views.emissions_panel(spark, SMALL)
    return op.country_emissions(stored(raw, tmp_path_factory.mktemp("plans") / "emissions"))


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    return stored(views.dirty_readings(spark, SMALL), tmp_path_factory.mktemp("plans") / "readings")


@pytest.mark.parametrize("name", registry.queries())
def test_no_python_stage_and_no_cross_join(spark, name):
    plan = plan_of(registry.queries()[name](spark, SMALL))
    for unwanted in ("EvalPython", "MapInPandas", "InPandas", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
    assert "Window [" not in plan or "SinglePartition" not in plan


def test_widen_needs_one_shuffle(emissions):
    plan = plan_of(op.widen(emissions))
    assert count_nodes(plan, "Exchange") == 1
    assert "GreaterThanOrEqual(Year,1900)" in plan.split("PushedFilters")[1]
    assert "Share_of_global" not in plan.split("ReadSchema")[1]


def test_unique_fill_needs_one_shuffle_and_one_window(emissions):
    plan = plan_of(op.leap_year_fill(emissions, unique=True))
    assert count_nodes(plan, "Exchange") == 1
    assert count_nodes(plan, "Window") == 1
    assert "In(Entity, [Australia,New Zealand])" in plan
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert schema == "struct<Year:int,Entity:string,Annual_CO2_emissions:double>"


def test_bucketed_fill_spreads_a_key_with_many_order_values(spark):
    seconds = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").alias("Second"), F.lit("one place").alias("Place"), F.col("id").cast("double").alias("V")
    )
    flag = F.col("Second") % 10 == 0

    def tasks(bucket):
        filled = op.fill_flagged(seconds, flag, "Place", "Second", "V", unique=True, bucket=bucket)
        plan = plan_of(filled)
        assert count_nodes(plan, "Exchange") == 1 and count_nodes(plan, "Window") == 1
        with settings(spark, spark_sql_adaptive_enabled="false"):
            by_task = filled.groupBy(F.spark_partition_id())
            counts = by_task.agg(F.count("*").alias("n"), F.sum("V")).collect()
        return sorted(r["n"] for r in counts)

    assert len(tasks(None)) == 1
    spread = tasks(1000)
    assert len(spread) == 8 and sum(spread) == 60_000 and spread[-1] < 20_000


def test_fill_reduces_rows_before_its_window(spark):
    rows = spark.range(0, 100_000, numPartitions=8).select(
        (1990 + F.col("id") % 20).cast("int").alias("Year"),
        F.lit("one country").alias("Country"),
        F.col("id").cast("float").alias("TotalEmissions"),
    )
    filled = op.fill_flagged(rows, is_leap_year(F.col("Year")))
    plan = plan_of(filled)
    below_window = plan[plan.index("Window"):]
    assert below_window.index("HashAggregate") < below_window.index("+- Range")
    assert filled.count() == 100_000
    wanted = filled.groupBy("Year").agg(F.max("TotalEmissions").alias("m")).filter("Year = 1992")
    assert wanted.first()["m"] == 99_981.0


def test_fill_splits_a_hot_year_and_leaves_other_rows_alone(spark, tmp_path):
    rows = spark.range(0, 200_000, numPartitions=16).select(
        F.when(F.col("id") % 3 > 0, 2000).otherwise(1900 + F.col("id") % 99).cast("int").alias("Year"),
        F.lit("one country").alias("Country"),
        F.col("id").cast("float").alias("TotalEmissions"),
    )
    rows = stored(rows, tmp_path / "rows")
    filled = op.fill_flagged(rows, is_leap_year(F.col("Year")))
    with no_broadcast(spark):
        others = plan_of(filled).split("Union")[1].split("SortMergeJoin")[0]
        assert "FileScan" in others and "Exchange" not in others
        with settings(spark, **LOW_SKEW_LIMITS):
            assert "skew=true" in final_plan_of(filled)
        assert filled.filter("Year = 2000").select("TotalEmissions").distinct().count() == 1


def test_yearly_and_country_aggregates_combine_before_the_shuffle(emissions, readings):
    for df in (op.yearly_total(emissions), op.country_temperatures(readings)):
        plan = plan_of(df)
        assert count_nodes(plan, "Exchange") == 1
        assert "partial_" in plan[plan.index("Exchange"):]


def test_country_panel_cleans_each_reading_once(emissions, readings):
    plan = plan_of(op.country_panel(emissions, op.country_temperatures(readings)))
    assert plan.count("initcap") == 1
    assert plan.count("try_cast(replace(AverageTemperature") == 1


def test_country_panel_with_settled_temperatures_needs_no_shuffle(spark, emissions, readings):
    temperatures = settled(op.country_temperatures(readings), "temperatures")
    panel = op.country_panel(emissions, temperatures)
    assert panel.dtypes[-1] == ("AverageTemperature", "float")
    plan = plan_of(panel)
    assert "BroadcastHashJoin" in plan and count_nodes(plan, "Exchange") == 0
    with no_broadcast(spark):
        assert count_nodes(plan_of(op.country_panel(emissions, temperatures)), "Exchange") == 2


def test_panel_of_bucketed_tables_needs_no_shuffle(spark, emissions, readings, tmp_path):
    temperatures = op.country_temperatures(readings)
    sinks.create_database(spark, "bucketed_db", str(tmp_path / "bucketed"))
    try:
        for name, rows in (("e", emissions), ("t", temperatures)):
            sinks.write_table(
                rows, name, database="bucketed_db", bucket_by=["Year", "Country"], buckets=4
            )
        e, t = spark.table("bucketed_db.e"), spark.table("bucketed_db.t")
        with no_broadcast(spark):
            joined = op.country_panel(e, t, colocated=True)
            plan = plan_of(joined)
            assert count_nodes(plan, "Exchange") == 0 and count_nodes(plan, "SortMergeJoin") == 1
            expected = op.country_panel(emissions, temperatures)
            assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, expected.collect()))
            # With one of them in buckets, only the other moves.
            half = plan_of(op.country_panel(emissions, t, colocated=True))
            assert count_nodes(half, "Exchange") == 1
    finally:
        sinks.drop_database(spark, "bucketed_db")


def test_anomalies_scan_the_readings_once(readings):
    anomalies = op.temperature_anomalies(op.country_temperatures(readings), 1995, 1997)
    plan = final_plan_of(anomalies)
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


LOW_SKEW_LIMITS = {
    "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "1KB",
    "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "2",
    "spark_sql_adaptive_advisoryPartitionSizeInBytes": "2KB",
}


def hot_rows(spark, n):
    """Two thirds of the rows under one key, in 16 partitions."""
    key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100))
    return spark.range(0, n, numPartitions=16).select(key.alias("k"), F.lit("x" * 20).alias("v"))


def tasks_of_hot_key(df):
    rows = df.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    return [r["count"] for r in rows]


def assert_same_as_plain_join(joined, many, few, how):
    plain = many.join(few, "k", how)
    assert sorted(joined.columns) == sorted(plain.columns)
    assert_rows(
        joined.groupBy("k", "x").count(),
        "k string, x int, count bigint",
        *[tuple(r) for r in plain.groupBy("k", "x").count().collect()],
    )


@pytest.mark.parametrize("how, few_rows", [("inner", 1), ("left", 2)])
def test_salts_spread_a_hot_key(spark, how, few_rows):
    many = hot_rows(spark, 20_000)
    few = frame(spark, "k string, x int", *[("hot", i) for i in range(few_rows)], ("k3", 7))
    with no_broadcast(spark), settings(spark, spark_sql_adaptive_enabled="false"):
        joined = op.skew_safe_join(many, few, ["k"], how, salts=16)
        sizes = tasks_of_hot_key(joined)
        assert_same_as_plain_join(joined, many, few, how)
    assert sum(sizes) == many.filter("k = 'hot'").count() * few_rows
    assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 2


@pytest.mark.parametrize("how", ["inner", "left"])
def test_adaptive_execution_splits_a_hot_key(spark, how):
    many = hot_rows(spark, 200_000)
    # Aggregated on the join key, as temperatures and baselines are.
    few = many.groupBy("k").agg(F.max(F.length("v")).alias("x"))
    with no_broadcast(spark), settings(spark, **LOW_SKEW_LIMITS):
        joined = op.skew_safe_join(many, few, ["k"], how)
        assert "skew=true" in final_plan_of(joined)
        sizes = tasks_of_hot_key(joined)
        assert_same_as_plain_join(joined, many, few, how)
    assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 2


def test_skew_safe_join_refuses_other_joins(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        op.skew_safe_join(df, df, ["id"], "full")


def test_condition_of_the_panel_lies_below_both_inputs(emissions, readings):
    where = F.col("Country").isin("France") & (F.col("Year") > 1996)
    temperatures = op.country_temperatures(readings)
    plan = plan_of(op.country_panel(emissions, temperatures, where=where))
    assert "EqualTo(Entity,France)" in plan and "GreaterThan(Year,1996)" in plan
    # Of the readings too: the names cleaned for the condition, above the scan.
    cleaned = [line for line in plan.splitlines() if "Condition" in line and "initcap" in line.lower()]
    without = plan_of(op.country_panel(emissions, temperatures))
    assert plan.count("Filter") > without.count("Filter")
    assert cleaned or "= France" in plan.replace("(", " ").replace(")", " ")


def test_ranks_beyond_any_number_use_bounded_windows(spark):
    rows = spark.range(0, 3000).select(
        F.lit(2000).alias("Year"),
        F.concat(F.lit("c"), "id").alias("Country"),
        F.col("id").cast("float").alias("TotalEmissions"),
    )
    ranked = op.rank_polluters(rows, ["TotalEmissions"], k=2000)
    assert "TakeOrderedAndProject" in plan_of(ranked) or "GlobalLimit" in plan_of(ranked)
    assert sorted(r.Rank for r in ranked.collect()) == list(range(1, 2001))


def test_order_splits_equal_rows(spark):
    rows = hot_rows(spark, 20_000)
    with settings(spark, spark_sql_adaptive_coalescePartitions_enabled="false"):
        ordered = op.in_order(rows, ["k"])
        sizes = tasks_of_hot_key(ordered)
        keys = [r.k for r in ordered.collect()]
    assert keys == sorted(keys)
    assert max(sizes) < sum(sizes) / 2


def test_shared_rank_is_one_row_in_the_window(spark):
    same = spark.range(0, 5000).select(
        F.lit(2000).alias("Year"),
        F.concat(F.lit("c"), "id").alias("Country"),
        F.when(F.col("id") < 3, 9.0).otherwise(1.0).cast("float").alias("TotalEmissions"),
    )
    ranked = op.rank_polluters(same, ["TotalEmissions"], k=4)
    assert_rows(ranked.groupBy("Rank").count(), "Rank int, count bigint", (1, 3), (4, 4997))
    assert op.rank_polluters(same, ["TotalEmissions"], k=3).count() == 3


def test_broadcast_of_the_lookup(spark, emissions, tmp_path):
    lookup = stored(op.continent_lookup(views.raw_lookup(spark, SMALL)), tmp_path / "lookup")
    assert op.fits_broadcast(lookup)
    assert not op.fits_broadcast(lookup, max_bytes=10)
    with no_broadcast(spark):
        assert "SortMergeJoin" in plan_of(op.with_continent(emissions, lookup))
        forced = op.with_continent(emissions, lookup, broadcast=True)
        assert "BroadcastHashJoin" in plan_of(forced) and count_nodes(plan_of(forced), "Exchange") == 0
        too_large = op.with_continent(emissions, lookup, broadcast=True, max_bytes=10)
        plan = plan_of(too_large)
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in plan_of(op.with_continent(emissions, lookup))


def test_reports_keep_only_the_best_rows_of_each_task(emissions):
    assert "TakeOrderedAndProject" in plan_of(op.top_observations(emissions))
    ranked = plan_of(op.rank_polluters(emissions))
    # One for each yardstick, and the window sees no more than they let through.
    assert ranked.count("TakeOrderedAndProject(limit=10") >= 3 or ranked.count("TakeOrderedAndProject") >= 3


def test_join_of_yearly_sides_adds_no_shuffle(spark, emissions):
    readings = views.global_readings(spark, SMALL)
    with no_broadcast(spark):
        plan = plan_of(op.global_panel(op.yearly_total(emissions), op.yearly_temperatures(readings)))
    assert count_nodes(plan, "Exchange") == 2


def test_whole_schema_of_emissions(emissions):
    expected = emissions.sparkSession.createDataFrame([], EMISSION_COLUMNS)
    assert emissions.dtypes == expected.dtypes
