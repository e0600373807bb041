"""Panel operators on small frames with known results."""

import datetime

import pytest
from helpers import EMISSION_COLUMNS, assert_rows, emission_rows, frame

from yearloom import fixed
from yearloom import operators as op

SEN = fixed.SENTINEL
RAW_EMISSIONS = (
    "Year int, Entity string, Annual_CO2_emissions float, Per_capita_CO2_emissions float,"
    " Share_of_global_CO2_emissions float"
)
YEARLY_TEMPERATURES = (
    "Year int, LandAverageTemperature float, LandMaxTemperature float,"
    " LandMinTemperature float, LandAndOceanAverageTemperature float"
)
TEMPERATURES = "Year int, Country string, AverageTemperature float"


@pytest.fixture(scope="module")
def readings(spark):
    return frame(
        spark,
        "Date string, Country string, AverageTemperature string",
        ("11-30-1999", " bRaZiL  ", f"{SEN}1.0{SEN}"),
        ("12-31-1999", "   BrAzIl ", f"{SEN}0.0{SEN}"),
        ("01-01-2020", "japaN", "-"),
        ("02-01-2020", "OMAN", "?"),
        ("03-01-2020", "oman", f"{SEN}3.0{SEN}"),
    )


def test_country_emissions(spark):
    raw = frame(
        spark,
        RAW_EMISSIONS,
        (1999, "World", 1.0, 1.0, 0.5),
        (2000, "World", 2.0, 2.0, 0.5),
        (2001, "World", 3.0, 3.0, 0.5),
        (2020, "Fiji", 4.0, 4.0, 0.5),
        (2021, "Argentina", 5.0, 5.0, 0.5),
        (2021, None, 6.0, 6.0, 0.5),
        (2021, "world", 7.0, 7.0, 0.5),
    )
    expected = [
        (2020, "Fiji", 4.0, 4.0, 0.5),
        (2021, "Argentina", 5.0, 5.0, 0.5),
        (2021, "world", 7.0, 7.0, 0.5),
    ]
    assert_rows(op.country_emissions(raw), EMISSION_COLUMNS, *expected)
    without = op.country_emissions(raw, discard=["World", "Fiji", "world"])
    assert_rows(without, EMISSION_COLUMNS, expected[1])


def test_country_emissions_of_text_with_junk(spark):
    text = RAW_EMISSIONS.replace("float", "string")
    raw = frame(spark, text, (2020, "Fiji", "4", "n/a", ""))
    assert_rows(op.country_emissions(raw), EMISSION_COLUMNS, (2020, "Fiji", 4.0, None, None))


def test_yearly_total(spark):
    emissions = emission_rows(
        spark,
        (1999, "Tuvalu", 1.0),
        (1999, "Lichtenstein", 2.0),
        (1999, "Togo", 3.0),
        (2020, "Singapore", 4.0),
        (2020, "Fiji", 5.0),
        (2021, "Argentina", 6.0),
    )
    total = op.yearly_total(emissions)
    assert_rows(total, "Year int, TotalEmissions float", (1999, 6.0), (2020, 9.0), (2021, 6.0))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_yearly_temperatures(spark, kind):
    day = datetime.date if kind == "date" else datetime.datetime
    readings = frame(
        spark,
        f"Date {kind}, LandAverageTemperature float, LandMaxTemperature float,"
        " LandMinTemperature float, LandAndOceanAverageTemperature float",
        (day(1999, 11, 1), 1.0, 6.0, -6.0, 1.0),
        (day(1999, 12, 1), 0.0, 9.0, -9.0, 0.0),
        (day(2020, 1, 1), 1.0, 6.9, -6.9, 1.0),
        (day(2020, 2, 1), 2.0, 4.20, -4.20, 2.0),
        (day(2020, 3, 1), 3.0, 6.9420, -6.9420, 3.0),
    )
    assert_rows(
        op.yearly_temperatures(readings),
        YEARLY_TEMPERATURES,
        (1999, 0.5, 9.0, -9.0, 0.5),
        (2020, 2.0, 6.942, -6.942, 2.0),
    )


def test_global_panel(spark):
    totals = frame(spark, "Year int, TotalEmissions float", (1999, 6.0), (2020, 9.0), (2021, 6.0))
    temperatures = frame(
        spark, YEARLY_TEMPERATURES, (1999, 0.5, 9.0, -9.0, 0.5), (2020, 2.0, 6.942, -6.942, 2.0)
    )
    panel = op.global_panel(totals, temperatures)
    assert panel.schema == fixed.OUTPUT_SCHEMAS[fixed.GLOBAL_PANEL_DATASET]
    assert [tuple(r)[:3] for r in panel.orderBy("Year").collect()] == [(1999, 6.0, 0.5), (2020, 9.0, 2.0)]


def test_country_temperatures(spark, readings):
    assert_rows(
        op.country_temperatures(readings),
        TEMPERATURES,
        (1999, "Brazil", 0.5),
        (2020, "Japan", None),
        (2020, "Oman", 3.0),
    )


def test_unwrapped_numbers_and_bad_dates(spark):
    readings = frame(
        spark,
        "Date string, Country string, AverageTemperature string",
        ("01-01-2000", "peru", "2.5"),
        ("02-30-2000", "peru", "3.5"),
        (None, "peru", "4.5"),
        ("01-01-2000", None, "1.5"),
        ("01-01-2000", "peru", None),
    )
    assert_rows(
        op.country_temperatures(readings),
        TEMPERATURES,
        (2000, "Peru", 2.5),
        (None, "Peru", 4.0),
        (2000, None, 1.5),
    )


def test_country_panel(spark, readings):
    emissions = emission_rows(
        spark,
        (1999, "Brazil", 1.0),
        (2000, "Tunisia", 2.0),
        (2001, "Russia", 3.0),
        (2020, "Oman", 4.0),
        (2021, "Indonesia", 5.0),
        (None, "Oman", 6.0),
        (2020, None, 7.0),
    )
    panel = op.country_panel(emissions, op.country_temperatures(readings))
    assert panel.schema == fixed.OUTPUT_SCHEMAS[fixed.COUNTRY_PANEL_DATASET]
    assert_rows(
        panel,
        EMISSION_COLUMNS + ", AverageTemperature float",
        (1999, "Brazil", 1.0, 0.1, 0.5, 0.5),
        (2020, "Oman", 4.0, 0.4, 0.5, 3.0),
    )


def test_widen(spark):
    emissions = emission_rows(
        spark,
        (1999, "France", 1.0),
        (1999, "Germany", 2.0),
        (1999, "United Kingdom", 3.0),
        (2020, "France", 4.0),
        (2020, "Germany", 5.0),
        (2021, "United Kingdom", 6.0),
        (2100, "India", 7.0),
        (1899, "France", 8.0),
        (1900, "France", 9.0),
    )
    wide = op.widen(emissions)
    schema = fixed.OUTPUT_SCHEMAS[fixed.EUROPE_DATASET]
    assert wide.schema == schema
    no = None
    expected = [
        (1900, 9.0, 0.9, no, no, no, no),
        (1999, 1.0, 0.1, 2.0, 0.2, 3.0, 0.3),
        (2020, 4.0, 0.4, 5.0, 0.5, no, no),
        (2021, no, no, no, no, 6.0, 0.6),
        (2100, no, no, no, no, no, no),
    ]
    assert wide.orderBy("Year").collect() == spark.createDataFrame(expected, schema).collect()
    # The same cells as Spark's own pivot.
    from pyspark.sql import functions as F

    measures = [F.first(m).alias(m) for m in ("TotalEmissions", "PerCapitaEmissions")]
    pivoted = (
        emissions.filter("Year >= 1900")
        .groupBy("Year")
        .pivot("Country", list(fixed.EUROPE_THREE))
        .agg(*measures)
    )
    assert op.with_compact_names(pivoted).orderBy("Year").collect() == wide.orderBy("Year").collect()


def test_lengthen_gives_back_the_series(spark):
    emissions = emission_rows(spark, (1999, "France", 1.0), (1999, "United Kingdom", 3.0))
    assert_rows(
        op.lengthen(op.widen(emissions)),
        "Year int, Country string, TotalEmissions float",
        (1999, "France", 1.0),
        (1999, "Germany", None),
        (1999, "United Kingdom", 3.0),
    )


def test_column_names(spark):
    df = frame(spark, "`My Awesome Column` int, `(Another) Awesome Column` int, `a.b` int", (1, 2, 3))
    clean = op.with_storable_names(df)
    assert clean.columns == ["My_Awesome_Column", "Another_Awesome_Column", "a.b"]
    assert clean.collect()[0] == (1, 2, 3)
    with pytest.raises(ValueError, match="a b"):
        op.with_storable_names(frame(spark, "`a b` int, `A-b` int", (1, 2)))


def test_filters(spark):
    panel = emission_rows(
        spark, (1900, "Asia", 1.0), (1901, "Oceania", 2.0), (1901, "Peru", 3.0), (1902, None, 4.0)
    )
    left = lambda df: sorted(r.TotalEmissions for r in df.collect())
    assert left(op.without_continents(panel)) == [2.0, 3.0]
    assert left(op.without_continents(panel, after=1901)) == []
    assert left(op.from_year(panel, 1901)) == [2.0, 3.0, 4.0]
    assert left(op.after_year(panel, 1901)) == [4.0]
    assert left(op.keep_entities(panel, ["Peru", "Asia"])) == [1.0, 3.0]


def test_rankings_break_ties_by_name(spark):
    averages = frame(
        spark,
        "Country string, AverageTemperatureByCountry double, TotalEmissionsByCountry double",
        ("C", 1.0, 5.0),
        ("A", 1.0, 5.0),
        ("B", None, 9.0),
        ("D", 2.0, None),
    )
    names = lambda df: [r.Country for r in df.collect()]
    assert names(op.top_emitters(averages)) == ["B", "A", "C", "D"]
    assert names(op.top_emitters(averages, k=2)) == ["B", "A"]
    assert names(op.hottest_countries(averages)) == ["D", "A", "C", "B"]


def test_series(spark):
    panel = emission_rows(spark, (2001, "B", 1.0), (2000, "B", 3.0), (2000, "A", 2.0))
    totals = lambda df: [r.TotalEmissions for r in df.collect()]
    assert totals(op.country_series(panel)) == [2.0, 3.0, 1.0]
    assert totals(op.country_series(panel, by="TotalEmissions")) == [1.0, 2.0, 3.0]
    with pytest.raises(ValueError):
        op.country_series(panel, by="PerCapitaEmissions")


LOOKUP = "Country string, Continent string"


@pytest.fixture(scope="module")
def raw_lookup(spark):
    return frame(
        spark,
        "Continent_Name string, Country_Name string",
        ("Asia", "Afghanistan, Islamic Republic of"),
        ("Antarctica", "Antarctica (the territory South of 60 deg S)"),
        ("Europe", "Georgia"),
        ("Asia", "Georgia"),
    )


def test_continent_lookup(spark, raw_lookup):
    rows = [("Afghanistan", "Asia"), ("Antarctica", "Antarctica"), ("Georgia", "Asia"), ("Georgia", "Europe")]
    assert_rows(op.continent_lookup(raw_lookup), LOOKUP, *rows)
    assert_rows(op.continent_lookup(raw_lookup, unique=True), LOOKUP, *rows[:3])


@pytest.mark.parametrize("how", [{}, {"broadcast": True}, {"broadcast": True, "max_bytes": 1}])
def test_with_continent(spark, raw_lookup, how):
    panel = frame(spark, "Year int, Country string", (1, "Georgia"), (2, "Atlantis"), (3, None), (4, "Afghanistan"))
    enriched = op.with_continent(panel, op.continent_lookup(raw_lookup), **how)
    assert sorted(enriched.columns) == ["Continent", "Country", "Year"]
    assert_rows(
        enriched.select("Year", "Country", "Continent"),
        "Year int, Country string, Continent string",
        (1, "Georgia", "Asia"),
        (1, "Georgia", "Europe"),
        (2, "Atlantis", None),
        (3, None, None),
        (4, "Afghanistan", "Asia"),
    )


def test_temperature_anomalies(spark):
    temperatures = frame(
        spark,
        TEMPERATURES,
        (2000, "A", 1.0),
        (2001, "A", 3.0),
        (2002, "A", 7.0),
        (2002, "B", 4.0),
        (2001, "C", None),
        (2001, None, 1.0),
    )
    anomalies = op.temperature_anomalies(temperatures, 2000, 2001)
    assert_rows(
        anomalies,
        TEMPERATURES + ", Baseline float, Anomaly float",
        (2000, "A", 1.0, 2.0, -1.0),
        (2001, "A", 3.0, 2.0, 1.0),
        (2002, "A", 7.0, 2.0, 5.0),
        (2002, "B", 4.0, None, None),
        (2001, "C", None, None, None),
        (2001, None, 1.0, None, None),
    )
    assert_rows(op.worst_anomalies(anomalies, 3), "Country string, WorstAnomaly float", ("A", 5.0))


def test_rank_polluters_shares_ranks(spark):
    emissions = emission_rows(spark, (2000, "A", 4.0), (2001, "A", 2.0), (2000, "B", 3.0), (2000, "C", 1.0))
    ranked = op.rank_polluters(emissions, ["TotalEmissions"], k=2)
    assert_rows(
        ranked,
        "Country string, Yardstick string, Mean float, Rank int",
        ("A", "TotalEmissions", 3.0, 1),
        ("B", "TotalEmissions", 3.0, 1),
    )


def test_largest_and_worst(spark):
    emissions = emission_rows(
        spark, (2000, "France", 1.0), (2001, "France", 5.0), (2000, "Germany", 4.0), (2000, "Peru", 9.0)
    )
    names = lambda df: [r.Country for r in df.collect()]
    assert names(op.largest_emitters(emissions, k=2)) == ["Peru", "France"]
    assert names(op.worst_of_widened(op.widen(emissions))) == ["France", "Germany", "United Kingdom"]
