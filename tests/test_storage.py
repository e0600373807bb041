"""Readers, writers, tables, checks and the whole run."""

import json
from pathlib import Path

import pytest
from conftest import TESTDATA
from helpers import emission_rows, frame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StringType, StructField, StructType

from testbed import registry
from yearloom import fixed, plans, sinks, sources
from yearloom.scratch import scratch_dir

SEN = fixed.SENTINEL
DATASETS = ("a.parquet", "b.parquet")


@pytest.fixture(scope="module")
def emissions(spark):
    return emission_rows(spark, (2001, "B", 1.0), (2000, "B", 3.0), (2000, "A", 2.0)).repartition(3)


def data_files(path):
    return sorted(p for p in path.iterdir() if p.name.endswith(".parquet"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("single_file", [False, True])
@pytest.mark.parametrize("sort_by", [(), ("Year",), ("Year", "Country")])
def test_write_parquet(spark, emissions, tmp_path, single_file, sort_by):
    path = tmp_path / "out"
    for _ in range(2):  # the second write replaces the first
        sinks.write_parquet(emissions, str(path), sort_by, single_file)
    back = sources.read_parquet(spark, str(path))
    assert back.schema == emissions.schema
    assert rows(back) == rows(emissions)
    assert (path / "_SUCCESS").exists()
    if single_file or sort_by:
        [only] = data_files(path)
        assert only.name.endswith(".snappy.parquet")
        years = [r.Year for r in back.collect()]
        assert not sort_by or years == sorted(years)


def test_sorted_files_split_a_year_with_most_rows(spark, tmp_path):
    n = 30_000
    df = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1000 + F.col("id") % 50).otherwise(2000).cast("int").alias("Year"),
        F.lit("copy").alias("Country"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_parquet(df, str(tmp_path / "out"), ["Year"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges, sizes = [], []
    for file in data_files(tmp_path / "out"):
        years = [r.Year for r in spark.read.parquet(str(file)).collect()]
        assert years == sorted(years)
        ranges.append((years[0], years[-1]))
        sizes.append(len(years))
    assert sum(sizes) == n
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    # Two thirds of the rows, all equal, are not in one file.
    assert max(sizes) < n / 3


def test_write_partitioned(spark, emissions, tmp_path):
    for strict in (True, False):
        path = tmp_path / f"out{strict}"
        sinks.write_partitioned(emissions, str(path), ["Year"], one_file_each=strict)
        directories = {p.name: data_files(p) for p in path.iterdir() if p.is_dir()}
        assert {name: len(files) for name, files in directories.items()} == {"Year=2000": 1, "Year=2001": 1}
        back = sources.read_parquet(spark, str(path)).select(*emissions.columns)
        assert rows(back) == rows(emissions)
        assert sources.is_complete(spark, str(path))


def test_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Name,Some Value,When\nx,1.5,2001-02-03\n y ,,\n", encoding="utf-8")
    inferred = sources.read_csv(spark, str(path))
    assert inferred.dtypes == [("Name", "string"), ("Some Value", "double"), ("When", "date")]
    assert [r.Name for r in inferred.collect()] == ["x", " y "]
    schema = StructType([StructField(n, StringType()) for n in ("Name", "Some Value", "When")])
    declared = sources.read_csv(spark, str(path), schema)
    assert [tuple(r) for r in declared.collect()] == [("x", "1.5", "2001-02-03"), (" y ", None, None)]
    swapped = StructType([StructField(n, StringType()) for n in ("Some Value", "Name", "When")])
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(path), swapped).collect()


HALF_GOOD = """\
Name,Some Value,When
x,1.5,2001-02-03
short,2.5
long,3.5,2001-02-03,more
wrong,abc,2001-02-03
,,
"no, date",4.5,someday
"""


def test_bad_records_are_told_from_good_rows(spark, tmp_path):
    for name, text in (("a.csv", HALF_GOOD), ("b.csv", "Name,Some Value,When\ny,1,2001-02-03\n")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    schema = StructType.fromDDL("Name string, `Some Value` double, When date")
    checked = sources.read_csv_checked(spark, str(tmp_path), schema)
    good = sources.good_rows(checked)
    assert good.schema == schema
    assert {(r.Name, r["Some Value"]) for r in good.collect()} == {("x", 1.5), (None, None), ("y", 1.0)}
    # Few columns in use or all: the same rows are good.
    assert good.select("Name").count() == good.count() == 3
    bad = sources.bad_records(checked)
    assert {(r.record, r.fields_read) for r in bad.collect()} == {
        ("short,2.5", 2),
        ("long,3.5,2001-02-03,more", 3),
        ("wrong,abc,2001-02-03", 2),
        ('"no, date",4.5,someday', 2),
    }
    [row] = sources.bad_records_by_file(bad).collect()
    assert row.file.endswith("/a.csv") and row.bad_records == 4
    swapped = StructType.fromDDL("`Some Value` double, Name string, When date")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv_checked(spark, str(tmp_path), swapped).collect()


def test_ingestion_keeps_bad_records_apart(spark, tmp_path):
    (tmp_path / "in.csv").write_text(HALF_GOOD, encoding="utf-8")
    schema = StructType.fromDDL("Name string, `Some Value` double, When date")
    target, aside = str(tmp_path / "target"), str(tmp_path / "aside")
    ingest = lambda **how: plans.run_ingestion(
        spark, {"d": str(tmp_path / "in.csv")}, target, {"d": schema}, quarantine=aside, **how
    )
    with pytest.raises(plans.IngestionRefused, match="4 bad records, at most 3"):
        ingest(most_bad=3)
    assert not Path(target, "d").exists() and spark.read.parquet(f"{aside}/d").count() == 4
    ingest(most_bad=4)
    assert spark.read.parquet(f"{target}/d").columns == ["Name", "Some_Value", "When"]
    assert spark.read.parquet(f"{target}/d").count() == 2
    # Without a schema all of it fits, as text.
    plans.run_ingestion(spark, {"e": str(tmp_path / "in.csv")}, target, quarantine=aside)
    assert spark.read.parquet(f"{aside}/e").count() == 2


def test_commit_markers(spark, emissions, tmp_path):
    def directory(name, parts, **markers):
        path = tmp_path / name
        path.mkdir()
        for part in [*parts, "_SUCCESS"]:
            (path / part).touch()
        for number, said in markers.items():
            (path / f"_committed_{number[1:]}").write_text(said if isinstance(said, str) else json.dumps(said))
        return sources.is_complete(spark, str(path))

    added = lambda *parts, removed=(): {"added": list(parts), "removed": list(removed)}
    a, b = "part-0.snappy.parquet", "part-1.snappy.parquet"
    assert directory("no-marker", [a])
    assert directory("all", [a, b], n1=added(a, b))
    assert not directory("missing", [a], n1=added(a, b))
    assert directory("removed", [b], n1=added(a), n2=added(b, removed=[a]))
    assert not directory("new-missing", [a], n1=added(a), n2=added(b, removed=[a]))
    assert not directory("all-removed", [a], n1=added(a), n2=added(removed=[a]))
    assert not directory("unreadable", [a], n1="{")
    assert not directory("other-form", [a], n1="[]")
    assert directory("other-name", [a], vacuum="{")
    (tmp_path / "all" / "_SUCCESS").unlink()
    assert not sources.is_complete(spark, str(tmp_path / "all"))
    # Of a partitioned dataset, the markers lie in its folders.
    inside = tmp_path / "parts" / "Year=2000"
    inside.mkdir(parents=True)
    (tmp_path / "parts" / "_SUCCESS").touch()
    (inside / "_committed_7").write_text(json.dumps(added(a)))
    assert not sources.is_complete(spark, str(tmp_path / "parts"))
    (inside / a).touch()
    assert sources.is_complete(spark, str(tmp_path / "parts"))


def jobs_of(spark, run):
    """How many jobs ``run`` starts."""
    group = f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_write_checked(spark, emissions, tmp_path):
    path, schema = str(tmp_path / "out"), emissions.schema
    seen = sinks.write_checked(emissions, path, schema, ["Year"], count=3, unique=["Year", "Country"])
    assert (seen.rows, seen.nulls["Year"]) == (3, 0)
    assert rows(spark.read.parquet(path)) == rows(emissions)
    one = sinks.write_checked(emissions, path, schema, ["Year"], single_file=True)
    assert one.rows == 3 and len(data_files(tmp_path / "out")) == 1
    holes = emissions.withColumn("Country", F.when(F.col("Year") == 2001, F.col("Country")))
    assert sinks.write_checked(holes, path, schema).nulls["Country"] == 2
    # All faults at once, and the same as of a dataset that is read again.
    wrong = StructType([*schema.fields[:-1], StructField("Other", FloatType())])
    with pytest.raises(sinks.ContractBroken) as fault:
        sinks.write_checked(holes, path, wrong, count=4, required=["Country"])
    with pytest.raises(sinks.ContractBroken) as read_again:
        sinks.check_output(spark, path, wrong, 4)
    assert str(read_again.value) in str(fault.value) and "2 NULLs in Country" in str(fault.value)
    copies = spark.range(1000).select((F.col("id") % 500).alias("Key"))
    with pytest.raises(sinks.ContractBroken, match="different"):
        sinks.write_checked(copies, path, copies.schema, unique=["Key"])
    many = spark.range(5000).select(F.col("id").alias("Key"), F.lit(None).cast("int").alias("a.b"))
    assert sinks.write_checked(many, path, many.schema, unique=["Key"]).nulls["a.b"] == 5000
    nothing = emissions.filter("Year < 0")
    assert sinks.write_checked(nothing, path, schema, count=0).rows == 0


def test_write_checked_takes_one_job(spark, emissions, tmp_path):
    path, schema = str(tmp_path / "out"), emissions.schema

    def twice():
        sinks.write_parquet(emissions, path)
        sinks.check_output(spark, path, schema)

    once = jobs_of(spark, lambda: sinks.write_checked(emissions, path, schema))
    assert once < jobs_of(spark, twice)


def files_by_year(path):
    return {p.name: sorted(f.name for f in data_files(p)) for p in path.iterdir() if p.is_dir()}


def test_refresh_replaces_changed_years_only(spark, tmp_path):
    path = tmp_path / "panel"
    old = emission_rows(spark, (2000, "A", 1.0), (2001, "A", 2.0), (2002, "A", 3.0), (2003, None, 4.0))
    report = sinks.refresh_partitioned(old, str(path), ["Year"])
    assert {(r.Year, r.old_rows, r.new_rows, r.state) for r in report.collect()} == {
        (y, 0, 1, "added") for y in range(2000, 2004)
    }
    before = files_by_year(path)
    new = emission_rows(
        spark, (2001, "A", 2.0), (2002, "A", 3.5), (2003, "A", 4.0), (2004, "B", 5.0), (2004, "B", 5.0)
    )
    report = sinks.refresh_partitioned(new, str(path), ["Year"])
    assert {(r.Year, r.old_rows, r.new_rows, r.state) for r in report.collect()} == {
        (2000, 1, 0, "absent"),
        (2001, 1, 1, "same"),
        (2002, 1, 1, "changed"),
        (2003, 1, 1, "changed"),
        (2004, 0, 2, "added"),
    }
    after = files_by_year(path)
    for year in (2000, 2001):
        assert after[f"Year={year}"] == before[f"Year={year}"]
    for year in (2002, 2003):
        assert after[f"Year={year}"] != before[f"Year={year}"]
    expected = rows(new.select("Country", "TotalEmissions", "Year")) + [("A", 1.0, 2000)]
    back = sources.read_parquet(spark, str(path)).select("Country", "TotalEmissions", "Year")
    assert rows(back) == sorted(expected)
    # Nothing to do the second time, and nothing is written.
    again = sinks.refresh_partitioned(new, str(path), ["Year"])
    assert {r.state for r in again.collect()} == {"same", "absent"}
    assert files_by_year(path) == after


def test_refresh_tells_nulls_from_each_other_and_refuses(spark, tmp_path):
    path = str(tmp_path / "panel")
    schema = "Year int, a int, b int"
    sinks.refresh_partitioned(frame(spark, schema, (1, None, 5), (None, 1, 1), (2, 1, 1), (2, 2, 2)), path, ["Year"])
    swapped = frame(spark, schema, (1, 5, None), (None, 1, 1), (2, 1, 1))
    with pytest.raises(sinks.RefreshRefused, match="1 partitions .* such as 2"):
        sinks.refresh_partitioned(swapped, path, ["Year"], most_lost=0.4)
    assert spark.read.parquet(path).count() == 4
    report = sinks.refresh_partitioned(swapped, path, ["Year"], most_lost=0.5)
    assert {(r.Year, r.state) for r in report.collect()} == {(1, "changed"), (None, "same"), (2, "changed")}
    back = spark.read.parquet(path).select("Year", "a", "b")
    assert {tuple(r) for r in back.collect()} == {(1, 5, None), (None, 1, 1), (2, 1, 1)}
    with pytest.raises(ValueError, match="columns"):
        sinks.refresh_partitioned(swapped.drop("b"), path, ["Year"])


def test_bucketed_table_is_published_again(spark, emissions, database):
    publish = lambda df: sinks.write_table(
        df, "b", database="published_db", bucket_by=["Year", "Country"], buckets=4
    )
    publish(emissions)
    publish(emissions.filter("Year = 2000"))
    assert rows(spark.table("published_db.b")) == rows(emissions.filter("Year = 2000"))
    sinks.write_table(emissions, "b", database="published_db")
    assert rows(spark.table("published_db.b")) == rows(emissions)
    described = [r["col_name"] for r in spark.sql("DESCRIBE TABLE EXTENDED published_db.b").collect()]
    assert "Num Buckets" not in described


CONTINENT_CSV = """\
Continent_Name,Continent_Code,Country_Name,Two_Letter_Country_Code,Three_Letter_Country_Code,Country_Number
Asia,AS,"Afghanistan, Islamic Republic of",AF,AFG,4
Africa,AF,"Namibia, Republic of",NA,NAM,516
Asia,AS,Disputed Territory,XX,,
"""


def test_continents_csv(spark, tmp_path):
    path = tmp_path / "continents.csv"
    path.write_text(CONTINENT_CSV, encoding="utf-8")
    df = sources.read_continents(spark, str(path))
    assert df.schema == fixed.CONTINENT_CSV_SCHEMA
    assert [r.Two_Letter_Country_Code for r in df.collect()] == ["AF", "NA", "XX"]
    assert [r.Country_Number for r in df.collect()] == [4, 516, None]


def test_resolve_source(spark, emissions, tmp_path):
    primary, fallback = str(tmp_path / "primary"), str(tmp_path / "fallback")
    resolve = lambda: sources.resolve_source(spark, primary, fallback, DATASETS)
    assert resolve() == fallback
    sinks.write_parquet(emissions, f"{primary}/a.parquet")
    assert resolve() == fallback
    sinks.write_parquet(emissions, f"{primary}/b.parquet")
    assert resolve() == primary
    # A success mark without data, and data without a success mark, do not count.
    for keep in ("_SUCCESS", "part-0.snappy.parquet"):
        other = tmp_path / f"only-{keep}"
        for name in DATASETS:
            (other / name).mkdir(parents=True)
            (other / name / keep).touch()
        assert sources.resolve_source(spark, str(other), fallback, DATASETS) == fallback


def test_check_output(spark, emissions, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_parquet(emissions, path, single_file=True)
    check = lambda *more, **how: sinks.check_output(spark, path, *more, **how)
    assert check(emissions.schema) == 3
    assert check(emissions.schema, 3, single_file=True) == 3
    wrong = StructType([*emissions.schema.fields[:-1], StructField("Other", FloatType())])
    with pytest.raises(sinks.ContractBroken, match="schema.*; 3 rows, not 4"):
        check(wrong, 4)
    sinks.write_parquet(emissions, path)
    with pytest.raises(sinks.ContractBroken, match="data files"):
        check(emissions.schema, single_file=True)
    (tmp_path / "out" / "_SUCCESS").unlink()
    with pytest.raises(sinks.ContractBroken, match="_SUCCESS"):
        check(emissions.schema)
    with pytest.raises(sinks.ContractBroken, match="no such"):
        sinks.check_output(spark, str(tmp_path / "nowhere"), wrong)


def test_tables(spark, emissions, tmp_path):
    current = spark.catalog.currentDatabase()
    location = str(tmp_path / "o'hara")
    for _ in range(2):
        written = sinks.write_tables(
            spark, "janedoe42", {"t_one": emissions}, ["Year"], location=location
        )
    assert written == ["janedoe42.t_one"]
    assert rows(spark.table("janedoe42.t_one")) == rows(emissions)
    assert spark.catalog.getTable("janedoe42.t_one").tableType == "MANAGED"
    assert spark.catalog.currentDatabase() == current


def location_of(spark, table):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location").removeprefix("file:")


@pytest.fixture
def database(spark, tmp_path):
    sinks.create_database(spark, "published_db", str(tmp_path / "d b"))
    yield tmp_path / "d b"
    sinks.drop_database(spark, "published_db")


def test_table_is_published_again(spark, emissions, database):
    publish = lambda df, **how: sinks.write_tables(spark, "published_db", {"t": df}, ["Year"], **how)
    publish(emissions)
    first = location_of(spark, "published_db.t")
    before = spark.table("published_db.t")
    publish(emissions.filter("Year = 2000"), keep_replaced=True)
    # A reader that began before still reads all that it began with.
    assert rows(before) == rows(emissions)
    assert rows(spark.table("published_db.t")) == rows(emissions.filter("Year = 2000"))
    second = location_of(spark, "published_db.t")
    assert first != second and sorted(p.name for p in database.iterdir()) == sorted(["t", Path(second).name])
    # The new rows may come from those they replace; the kept ones go now.
    publish(spark.table("published_db.t").filter("Country = 'B'"))
    assert rows(spark.table("published_db.t").select("Year", "TotalEmissions")) == [(2000, 3.0)]
    assert [p.name for p in database.iterdir()] == [Path(location_of(spark, "published_db.t")).name]
    assert spark.catalog.getTable("published_db.t").tableType == "MANAGED"


def test_failed_publication_leaves_the_old_rows(spark, emissions, database):
    sinks.write_table(emissions, "t", database="published_db")
    broken = emissions.withColumn("Country", F.raise_error(F.lit("stopped half-way")))
    for bad in (broken, broken.withColumn("More", F.lit(1))):
        with pytest.raises(Exception, match="half-way"):
            sinks.write_table(bad, "t", database="published_db")
        assert rows(spark.table("published_db.t")) == rows(emissions)
    sinks.write_table(emissions.filter("Year = 2001"), "t", database="published_db")
    assert rows(spark.table("published_db.t")) == rows(emissions.filter("Year = 2001"))
    assert len(list(database.iterdir())) == 1
    assert [t.name for t in spark.catalog.listTables("published_db")] == ["t"]


def test_new_table_after_a_stopped_run(spark, emissions, database):
    left = database / "t" / "_temporary" / "0"
    left.mkdir(parents=True)
    (database / "t" / "part-0.snappy.parquet").touch()
    (database / f"t__published_{'0' * 32}").mkdir()
    sinks.write_table(emissions, "t", database="published_db")
    assert rows(spark.table("published_db.t")) == rows(emissions)
    assert [p.name for p in database.iterdir()] == ["t"]
    # What is no writer's work in a table's place is not removed.
    (database / "other").mkdir()
    (database / "other" / "letter.txt").touch()
    with pytest.raises(Exception, match="(?i)location"):
        sinks.write_table(emissions, "other", database="published_db")
    assert (database / "other" / "letter.txt").exists()


def test_new_columns_and_a_run_stopped_between_renamings(spark, emissions, database):
    sinks.write_table(emissions.select("Year"), "t", database="published_db")
    sinks.write_table(emissions, "t", database="published_db")
    assert rows(spark.table("published_db.t")) == rows(emissions)
    retired = f"published_db.t__published_{'a' * 32}_retired"
    spark.sql(f"ALTER TABLE published_db.t RENAME TO {retired}")
    broken = emissions.withColumn("Country", F.raise_error(F.lit("stopped half-way")))
    with pytest.raises(Exception, match="half-way"):
        sinks.write_table(broken, "t", database="published_db")
    assert rows(spark.table("published_db.t")) == rows(emissions)
    sinks.write_table(emissions.select("Year"), "t", database="published_db")
    assert spark.table("published_db.t").columns == ["Year"]
    assert [t.name for t in spark.catalog.listTables("published_db")] == ["t"]


def test_external_tables_are_not_replaced(spark, emissions, database, tmp_path):
    emissions.write.option("path", str(tmp_path / "own")).saveAsTable("published_db.outside")
    with pytest.raises(ValueError, match="managed"):
        sinks.write_table(emissions, "outside", database="published_db")


def test_unlocated_call_takes_the_database_where_it_is(spark, emissions, database):
    sinks.create_database(spark, "published_db")
    sinks.write_tables(spark, "published_db", {"t": emissions})
    assert location_of(spark, "published_db.t").startswith(str(database))


@pytest.mark.parametrize("name", ["managed_table", "managed_table_again", "whole_run"])
def test_queries_that_publish_run_twice(spark, name):
    databases = {d.name for d in spark.catalog.listDatabases()}
    first, second = (rows(registry.queries()[name](spark, str(TESTDATA / "sf0.001"))) for _ in range(2))
    assert len(first) == len(second) > 0
    assert {d.name for d in spark.catalog.listDatabases()} == databases


def test_scratch_dir(spark, monkeypatch):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/")


def test_scratch_without_checkpoint_folder(spark):
    class Conf:
        def get(self, name, *default):
            return {"spark.sql.warehouse.dir": "file:/shared/warehouse"}.get(name, *default)

    class Session:
        conf = Conf()

    assert scratch_dir(Session(), "x").startswith("file:/shared/warehouse/scratch/")

    class Cluster(Conf):
        def get(self, name, *default):
            return "yarn" if name == "spark.master" else super().get(name, *default)

    Session.conf = Cluster()
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(Session(), "x")


def test_partitioned_output_is_checked(spark, emissions, tmp_path):
    path = str(tmp_path / "partitioned")
    sinks.write_partitioned(emissions, path, ["Year"])
    schema = spark.read.parquet(path).schema
    assert sinks.check_output(spark, path, schema, count=3) == 3
    with pytest.raises(sinks.ContractBroken):
        sinks.check_output(spark, path, schema, count=4)


def test_database_at_another_place_is_refused(spark, tmp_path):
    sinks.create_database(spark, "placed_db", str(tmp_path / "one\\'s"))
    sinks.create_database(spark, "placed_db", str(tmp_path / "one\\'s"))
    with pytest.raises(ValueError, match="is at"):
        sinks.create_database(spark, "placed_db", str(tmp_path / "other"))


# The whole run, from CSV files with untidy names and values to the panels.

EMISSIONS_CSV = """\
Year,Entity,Annual CO2 emissions,Per capita CO2 emissions,Share of global CO2 emissions
1999,World,100,1,100
1999,Brazil,10,1,10
1999,France,20,2,20
2000,France,21,2.1,21
1999,Australia,30,3,30
2000,Australia,31,3.1,31
2020,New Zealand,40,4,40
2020,New Caledonia,50,5,50
"""
GLOBAL_CSV = """\
Date,LandAverageTemperature,LandAverageTemperatureUncertainty,LandMaxTemperature,LandMinTemperature,LandAndOceanAverageTemperature
1999-01-01,1.0,0.1,8.0,-3.0,2.0
1999-02-01,2.0,0.1,9.0,-4.0,4.0
2020-01-01,3.0,0.1,7.0,-2.0,6.0
1850-01-01,,,,,
"""
COUNTRY_CSV = f"""\
Date,Country,AverageTemperature
01-31-1999, bRAZIL ,{SEN}20.5{SEN}
02-28-1999,brazil,-
01-31-2020,NEW zealand,{SEN}10.0{SEN}
02-29-2020,NEW ZEALAND,{SEN}12.0{SEN}
01-31-1999,france,?
"""


@pytest.fixture(scope="module")
def csv_paths(tmp_path_factory):
    base = tmp_path_factory.mktemp("csv")
    texts = {
        fixed.EMISSIONS_DATASET: EMISSIONS_CSV,
        fixed.GLOBAL_TEMPERATURES_DATASET: GLOBAL_CSV,
        fixed.TEMPERATURES_DATASET: COUNTRY_CSV,
    }
    paths = {}
    for name, text in texts.items():
        paths[name] = base / name.replace(".parquet", ".csv")
        paths[name].write_text(text, encoding="utf-8")
    return {name: str(path) for name, path in paths.items()}


@pytest.mark.parametrize("how", [{}, {"single_file": True, "persist": True}])
def test_whole_run(spark, csv_paths, tmp_path, how):
    counts = plans.run_pipeline(
        spark, csv_paths, str(tmp_path), user=f"jane.doe{len(how)}@example.com",
        location=str(tmp_path / "tables"), **how,
    )
    assert counts == {
        fixed.GLOBAL_PANEL_DATASET: 2,
        fixed.COUNTRY_PANEL_DATASET: 3,
        fixed.EUROPE_DATASET: 3,
        fixed.OCEANIA_DATASET: 3,
    }
    target = tmp_path / "dataTransformation"
    panels = {n: spark.read.parquet(str(target / n)) for n in counts}
    assert rows(panels[fixed.GLOBAL_PANEL_DATASET]) == [
        (1999, 60.0, 1.5, 9.0, -4.0, 3.0),
        (2020, 90.0, 3.0, 7.0, -2.0, 6.0),
    ]
    country = panels[fixed.COUNTRY_PANEL_DATASET].select("Year", "Country", "AverageTemperature")
    assert {tuple(r) for r in country.collect()} == {
        (1999, "Brazil", 20.5),
        (1999, "France", None),
        (2020, "New Zealand", 11.0),
    }
    assert {tuple(r) for r in panels[fixed.OCEANIA_DATASET].collect()} == {
        (1999, "Australia", 30.0),
        (2000, "Australia", 30.0),
        (2020, "New Zealand", None),
    }
    for name, suffix in fixed.TABLE_SUFFIXES.items():
        # Small panels come out as one file even when that is not asked for.
        assert len(data_files(target / name)) == 1
        table = spark.table(f"janedoe{len(how)}.{fixed.TABLE_PREFIX}_{suffix}")
        assert table.schema == fixed.OUTPUT_SCHEMAS[name]
        assert table.count() == counts[name]


def test_transformation_checks_counts_and_falls_back(spark, csv_paths, tmp_path):
    good, target = str(tmp_path / "good"), str(tmp_path / "target")
    plans.run_ingestion(spark, csv_paths, good)
    missing = str(tmp_path / "missing")
    counts = plans.run_transformation(spark, missing, target, fallback=good)
    assert plans.run_transformation(spark, good, target, counts=counts) == counts
    with pytest.raises(sinks.ContractBroken, match="rows, not"):
        plans.run_transformation(spark, good, target, counts=fixed.HISTORICAL_ROW_COUNTS)


def test_enrichment(spark, csv_paths, tmp_path):
    plans.run_pipeline(spark, csv_paths, str(tmp_path))
    continents = tmp_path / "continents.csv"
    continents.write_text(
        CONTINENT_CSV + 'South America,SA,"Brazil, Federative Republic of",BR,BRA,76\n', encoding="utf-8"
    )
    target = str(tmp_path / "dataTransformation")
    for broadcast in (True, False):
        enriched = plans.run_enrichment(spark, target, str(continents), broadcast)
        found = {r.Country: r.Continent for r in enriched.collect()}
        assert found == {"Brazil": "South America", "France": None, "New Zealand": None}
