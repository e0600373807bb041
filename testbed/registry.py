"""Every query by name, with the SQL that must give the same rows."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from testbed import views as v
from yearloom import operators as op
from yearloom import plans, sinks, sources
from yearloom.fixed import (
    CONTINENT_CSV_SCHEMA,
    CONTINENT_NAMES,
    COUNTRY_PANEL_DATASET,
    EMISSIONS_DATASET,
    EUROPE_DATASET,
    EUROPE_THREE,
    GLOBAL_PANEL_DATASET,
    GLOBAL_TEMPERATURES_DATASET,
    OCEANIA_DATASET,
    OCEANIA_TWO,
    OUTPUT_SCHEMAS,
    SENTINEL,
    TABLE_PREFIX,
    TABLE_SUFFIXES,
    TEMPERATURES_DATASET,
)
from yearloom.functions import (
    cleaned_year,
    database_name,
    is_leap_year,
    measure_in_text,
    title_name,
    without_sentinel,
)
from yearloom.scratch import scratch_dir, settled

# The generated years run from 1995 to 2001.
AFTER = 1996
BASELINE = (1995, 1997)

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


REGISTRY: dict[str, Query] = {}


def _register(name: str, sql: str) -> Callable[[Run], Run]:
    def keep(run: Run) -> Run:
        REGISTRY[name] = Query(run, sql)
        return run

    return keep


def _in_list(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


# SQL building blocks, each a common table expression that may use others.

_LEAP = "(Year % 4 = 0 AND (Year % 100 <> 0 OR Year % 400 = 0))"
_TITLE = (
    "array_to_string(list_transform(string_split(lower(trim({0}, ' ')), ' '),"
    " lambda w: upper(w[1]) || w[2:]), ' ')"
)
_SHORT = "trim(split_part(split_part({0}, ',', 1), '(', 1))"
_YEAR = "CAST(year(try_strptime(Date, '%m-%d-%Y')) AS integer)"
_CLEAN = f"replace(AverageTemperature, '{SENTINEL}', '')"


def _emissions(panel: str) -> str:
    return f"""
SELECT Year, Entity AS Country, CAST(Annual_CO2_emissions AS float) AS TotalEmissions,
  CAST(Per_capita_CO2_emissions AS float) AS PerCapitaEmissions,
  CAST(Share_of_global_CO2_emissions AS float) AS ShareOfGlobalEmissions
FROM {panel} WHERE Entity <> 'World'"""


def _temperatures(readings: str) -> str:
    return f"""
SELECT {_YEAR} AS Year, {_TITLE.format('Country')} AS Country,
  CAST(avg(TRY_CAST({_CLEAN} AS float)) AS float) AS AverageTemperature
FROM {readings} GROUP BY 1, 2"""


def _fill(rows: str, columns: str) -> str:
    return f"""
SELECT {columns}, CASE WHEN {_LEAP} THEN coalesce(
    last_value(steps.v IGNORE NULLS) OVER (PARTITION BY Country ORDER BY Year RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING),
    first_value(steps.v IGNORE NULLS) OVER (PARTITION BY Country ORDER BY Year RANGE BETWEEN 1 FOLLOWING AND 3 FOLLOWING))
  ELSE TotalEmissions END AS TotalEmissions
FROM {rows} JOIN (SELECT Country, Year, max(TotalEmissions) AS v FROM {rows} GROUP BY 1, 2) steps
  USING (Country, Year)"""


def _anomalies(temperatures: str) -> str:
    first, last = BASELINE
    return f"""
SELECT Year, Country, AverageTemperature, CAST(b AS float) AS Baseline,
  CAST(CAST(AverageTemperature AS double) - b AS float) AS Anomaly
FROM {temperatures} LEFT JOIN (
  SELECT Country, avg(AverageTemperature) FILTER (Year BETWEEN {first} AND {last}) AS b
  FROM {temperatures} GROUP BY 1) USING (Country)"""


def _continents(raw: str) -> str:
    return f"SELECT {_SHORT.format('Country_Name')} AS Country, Continent_Name AS Continent FROM {raw}"


_WIDE_CELLS = ", ".join(
    f"max(CASE WHEN Country = '{e}' THEN {m} END) AS \"{e.replace(' ', '')}_{m}\""
    for e in EUROPE_THREE
    for m in op.reshape.WIDE_MEASURES
)

_PARTS = {
    **v.SQL_VIEWS,
    "emissions": _emissions("emissions_panel"),
    "gapped_emissions": _emissions("gapped_panel"),
    "customer_emissions": _emissions("customer_emissions_panel"),
    "total_emissions": """
SELECT Year, CAST(sum(CAST(TotalEmissions AS double)) AS float) AS TotalEmissions
FROM emissions GROUP BY 1""",
    "yearly_temperatures": """
SELECT CAST(year(Date) AS integer) AS Year,
  CAST(avg(LandAverageTemperature) AS float) AS LandAverageTemperature,
  CAST(max(LandMaxTemperature) AS float) AS LandMaxTemperature,
  CAST(min(LandMinTemperature) AS float) AS LandMinTemperature,
  CAST(avg(LandAndOceanAverageTemperature) AS float) AS LandAndOceanAverageTemperature
FROM global_readings GROUP BY 1""",
    "temperatures": _temperatures("dirty_readings"),
    "customer_temperatures": _temperatures("customer_readings"),
    "global_panel": "SELECT * FROM total_emissions JOIN yearly_temperatures USING (Year)",
    "country_panel": "SELECT * FROM emissions JOIN temperatures USING (Year, Country)",
    "customer_panel": "SELECT * FROM customer_emissions JOIN customer_temperatures USING (Year, Country)",
    "wide": f"SELECT Year, {_WIDE_CELLS} FROM emissions WHERE Year >= 1900 GROUP BY 1",
    "gapped_wide": f"SELECT Year, {_WIDE_CELLS} FROM gapped_emissions WHERE Year >= 1900 GROUP BY 1",
    "countries": f"SELECT * FROM country_panel WHERE Country NOT IN {_in_list(CONTINENT_NAMES)}",
    "averages": f"""
SELECT Country, avg(AverageTemperature) AS AverageTemperatureByCountry,
  avg(TotalEmissions) AS TotalEmissionsByCountry
FROM countries WHERE Year > {AFTER} GROUP BY 1""",
    "continents": _continents("raw_lookup"),
    "customer_continents": _continents("raw_customer_lookup"),
    "partial_continents": _continents("partial_customer_lookup"),
}


def _sql(select: str) -> str:
    """``select`` after the building blocks it needs, directly or through others."""
    names = list(_PARTS)
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(pending.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in names:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(_PARTS[name])
    parts = [f"{name} AS ({_PARTS[name]})" for name in names if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


# Sums of decimal notations, each of which both engines read in the same way.
_DECIMAL = "CAST(CAST(CAST({0} AS double) AS varchar) AS decimal(38,18))"
_EXACT_SUM = f"CAST(CAST(sum({_DECIMAL}) AS varchar) AS double)"
_EXACT_AVG = _EXACT_SUM + " / count({0})"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        "Country",
        *[F.round(c, 2).alias(c) for c in df.columns if c != "Country"],
    )


_ROUNDED = """Country, round(AverageTemperatureByCountry, 2) AS AverageTemperatureByCountry,
  round(TotalEmissionsByCountry, 2) AS TotalEmissionsByCountry"""


# Frames that several queries start from.


def emissions(spark, sf_dir):
    return op.country_emissions(v.emissions_panel(spark, sf_dir))


def gapped_emissions(spark, sf_dir):
    return op.country_emissions(v.gapped_panel(spark, sf_dir))


def customer_emissions(spark, sf_dir):
    return op.country_emissions(v.customer_emissions_panel(spark, sf_dir))


def temperatures(spark, sf_dir):
    return op.country_temperatures(v.dirty_readings(spark, sf_dir))


def customer_temperatures(spark, sf_dir):
    return op.country_temperatures(v.customer_readings(spark, sf_dir))


def country_panel(spark, sf_dir, where=None):
    return op.country_panel(emissions(spark, sf_dir), temperatures(spark, sf_dir), where=where)


def averages(spark, sf_dir):
    return op.country_averages(country_panel(spark, sf_dir, op.countries_only(AFTER)))


# Emissions and temperatures, per year and per country.


@_register("global_emissions", _sql("SELECT * FROM total_emissions"))
def _(spark, sf_dir):
    return op.yearly_total(emissions(spark, sf_dir))


_register("country_emissions", _sql("SELECT * FROM emissions"))(emissions)
_register("customer_emissions", _sql("SELECT * FROM customer_emissions"))(customer_emissions)


@_register("annual_temperature", _sql("SELECT * FROM yearly_temperatures"))
def _(spark, sf_dir):
    return op.yearly_temperatures(v.global_readings(spark, sf_dir))


_register("country_temperature", _sql("SELECT * FROM temperatures"))(temperatures)
_register("customer_temperature", _sql("SELECT * FROM customer_temperatures"))(
    customer_temperatures
)


@_register("global_panel", _sql("SELECT * FROM global_panel"))
def global_panel(spark, sf_dir):
    return op.global_panel(
        op.yearly_total(emissions(spark, sf_dir)),
        op.yearly_temperatures(v.global_readings(spark, sf_dir)),
    )


_register("country_panel", _sql("SELECT * FROM country_panel"))(country_panel)


@_register("customer_panel", _sql("SELECT * FROM customer_panel"))
def _(spark, sf_dir):
    return op.country_panel(
        customer_emissions(spark, sf_dir), customer_temperatures(spark, sf_dir)
    )


# Cleaning expressions, on every untidy reading.


@_register(
    "strip_sentinel",
    _sql(f"SELECT {_CLEAN} AS Cleaned, count(*) AS readings FROM dirty_readings GROUP BY 1"),
)
def _(spark, sf_dir):
    cleaned = without_sentinel(F.col("AverageTemperature")).alias("Cleaned")
    return v.dirty_readings(spark, sf_dir).groupBy(cleaned).agg(F.count("*").alias("readings"))


@_register(
    "fix_country",
    _sql(f"""SELECT {_TITLE.format('Country')} AS Fixed, count(*) AS readings
FROM customer_readings GROUP BY 1"""),
)
def _(spark, sf_dir):
    fixed = title_name(F.col("Country")).alias("Fixed")
    return v.customer_readings(spark, sf_dir).groupBy(fixed).agg(F.count("*").alias("readings"))


@_register(
    "parse_year",
    _sql(f"SELECT {_YEAR} AS Year, count(*) AS readings FROM dirty_readings GROUP BY 1"),
)
def _(spark, sf_dir):
    year = cleaned_year(F.col("Date")).alias("Year")
    return v.dirty_readings(spark, sf_dir).groupBy(year).agg(F.count("*").alias("readings"))


@_register(
    "leap_flag",
    _sql(f"SELECT Year, {_LEAP} AS Leap, count(*) AS records FROM emission_records GROUP BY 1, 2"),
)
def _(spark, sf_dir):
    leap = is_leap_year(F.col("Year")).alias("Leap")
    return v.emission_records(spark, sf_dir).groupBy("Year", leap).agg(F.count("*").alias("records"))


@_register(
    "cast_quality",
    _sql(f"""SELECT count(*) - count(x) AS missing, count(x) AS present
FROM (SELECT TRY_CAST({_CLEAN} AS float) AS x FROM dirty_readings )"""),
)
def _(spark, sf_dir):
    value = measure_in_text(without_sentinel(F.col("AverageTemperature"))).alias("x")
    return op.null_counts(v.dirty_readings(spark, sf_dir).select(value), "x")


# Pivot and fill.


@_register("pivot_entities", _sql("SELECT * FROM gapped_wide"))
def gapped_wide(spark, sf_dir):
    return op.widen(gapped_emissions(spark, sf_dir))


@_register(
    "pivot_long",
    _sql(
        "SELECT Year, unnest(['France', 'Germany', 'United Kingdom']) AS Country,"
        " unnest([France_TotalEmissions, Germany_TotalEmissions, UnitedKingdom_TotalEmissions])"
        " AS TotalEmissions FROM gapped_wide"
    ),
)
def _(spark, sf_dir):
    return op.lengthen(gapped_wide(spark, sf_dir))


_OCEANIA = _in_list(OCEANIA_TWO)


@_register(
    "leap_year_fill",
    _sql(_fill(f"(SELECT * FROM gapped_emissions WHERE Country IN {_OCEANIA} )", "Year, Country")),
)
def _(spark, sf_dir):
    # The view groups by year and entity, so no pair occurs twice.
    return op.leap_year_fill(gapped_emissions(spark, sf_dir), unique=True)


@_register("leap_year_fill_all", _sql(_fill("customer_emissions", "Year, Country")))
def _(spark, sf_dir):
    return op.leap_year_fill(customer_emissions(spark, sf_dir), entities=None, unique=True)


@_register("leap_year_fill_repeated", _sql(_fill("gapped_records", "Record, Year, Country")))
def _(spark, sf_dir):
    return op.fill_flagged(v.gapped_records(spark, sf_dir), is_leap_year(F.col("Year")))


@_register("leap_year_fill_bucketed", _sql(_fill("customer_emissions", "Year, Country")))
def _(spark, sf_dir):
    rows = customer_emissions(spark, sf_dir)
    return op.leap_year_fill(rows, entities=None, unique=True, bucket=2)


@_register(
    "daily_fill",
    _sql("""SELECT Day, Place, CASE WHEN Day % 7 IN (2, 3) THEN coalesce(
    last_value(Total IGNORE NULLS) OVER (ORDER BY Day RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING),
    first_value(Total IGNORE NULLS) OVER (ORDER BY Day RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING))
  ELSE Total END AS Total FROM daily_totals"""),
)
def _(spark, sf_dir):
    # One key with as many order values as there are days.
    return op.fill_flagged(
        v.daily_totals(spark, sf_dir), (F.col("Day") % 7).isin(2, 3), "Place", "Day", "Total",
        back=1, ahead=2, unique=True, bucket=60,
    )


# Series and rankings.


@_register("exclude_aggregates", _sql(f"SELECT * FROM countries WHERE Year > {AFTER}"))
def _(spark, sf_dir):
    return country_panel(spark, sf_dir, op.countries_only(AFTER))


@_register("exclude_aggregates_all_years", _sql("SELECT * FROM countries "))
def _(spark, sf_dir):
    return op.without_continents(country_panel(spark, sf_dir, op.countries_only()))


@_register(
    "country_series",
    _sql("SELECT Year, Country, TotalEmissions FROM country_panel ORDER BY 1, 2, 3"),
)
def _(spark, sf_dir):
    return op.country_series(country_panel(spark, sf_dir))


@_register(
    "country_series_by_emissions",
    _sql("SELECT Year, Country, TotalEmissions FROM customer_emissions ORDER BY 3, 1, 2"),
)
def _(spark, sf_dir):
    return op.country_series(customer_emissions(spark, sf_dir), by="TotalEmissions")


@_register(
    "country_temperature_series",
    _sql(f"""SELECT Year, Country, AverageTemperature FROM countries
WHERE Country IN {_OCEANIA} ORDER BY 1, 2, 3"""),
)
def _(spark, sf_dir):
    panel = op.country_panel(
        op.keep_entities(emissions(spark, sf_dir), OCEANIA_TWO),
        op.keep_entities(temperatures(spark, sf_dir), OCEANIA_TWO),
    )
    return op.country_temperature_series(op.without_continents(panel))


@_register(
    "emissions_temperature_curve",
    _sql("SELECT Year, TotalEmissions, LandMaxTemperature FROM global_panel ORDER BY 2, 1"),
)
def _(spark, sf_dir):
    return op.emissions_temperature_curve(global_panel(spark, sf_dir))


@_register("avg_by_country", _sql(f"SELECT {_ROUNDED} FROM averages"))
def _(spark, sf_dir):
    return _rounded(averages(spark, sf_dir))


@_register(
    "avg_by_country_exact",
    _sql(f"""SELECT Country, {_EXACT_AVG.format('AverageTemperature')} AS AverageTemperatureByCountry,
  {_EXACT_AVG.format('TotalEmissions')} AS TotalEmissionsByCountry
FROM countries WHERE Year > {AFTER} GROUP BY 1"""),
)
def _(spark, sf_dir):
    panel = country_panel(spark, sf_dir, op.countries_only(AFTER))
    return op.country_averages(panel, exact=True)


@_register(
    "global_panel_exact",
    _sql(f"""SELECT * FROM (
  SELECT Year, CAST({_EXACT_SUM.format('TotalEmissions')} AS float) AS TotalEmissions FROM emissions GROUP BY 1)
JOIN (SELECT CAST(year(Date) AS integer) AS Year,
  CAST({_EXACT_AVG.format('LandAverageTemperature')} AS float) AS LandAverageTemperature,
  CAST(max(LandMaxTemperature) AS float) AS LandMaxTemperature,
  CAST(min(LandMinTemperature) AS float) AS LandMinTemperature,
  CAST({_EXACT_AVG.format('LandAndOceanAverageTemperature')} AS float) AS LandAndOceanAverageTemperature
FROM global_readings GROUP BY 1) USING (Year)"""),
)
def _(spark, sf_dir):
    return op.global_panel(
        op.yearly_total(emissions(spark, sf_dir), exact=True),
        op.yearly_temperatures(v.global_readings(spark, sf_dir), exact=True),
    )


# Names that are spelt differently on both sides.

_OTHER = "CAST(replace(Country, 'Customer#', '') AS bigint) % {0} = {1}"
_MARKED = f"""SELECT * REPLACE (CASE WHEN {_OTHER.format(10, 3)} THEN concat('Nowhere ', Country)
  WHEN {_OTHER.format(10, 4)} THEN concat('The Land of ', replace(Country, 'Customer#', ''))
  ELSE replace(Country, 'Customer#', 'Cüstomér-') END AS Country) FROM customer_emissions"""
_LOUD = f"""SELECT * REPLACE (CASE WHEN {_OTHER.format(10, 5)} THEN concat('Elsewhere ', Country)
  ELSE replace(Country, 'Customer#', 'CUSTOMER  ') END AS Country) FROM customer_temperatures"""
_KEY = "trim(regexp_replace(strip_accents(lower(Country)), '[\\s\\-_.''’]+', ' ', 'g'))"


def _respelt(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    country = F.col("Country")
    number = F.replace(country, F.lit("Customer#"), F.lit("")).cast("long")
    plain = F.replace(country, F.lit("Customer#"), F.lit(""))
    marked = (
        F.when(number % 10 == 3, F.concat(F.lit("Nowhere "), country))
        .when(number % 10 == 4, F.concat(F.lit("The Land of "), plain))
        .otherwise(F.replace(country, F.lit("Customer#"), F.lit("Cüstomér-")))
    )
    loud = F.when(number % 10 == 5, F.concat(F.lit("Elsewhere "), country)).otherwise(
        F.replace(country, F.lit("Customer#"), F.lit("CUSTOMER  "))
    )
    return (
        customer_emissions(spark, sf_dir).withColumn("Country", marked),
        customer_temperatures(spark, sf_dir).withColumn("Country", loud),
    )


@_register(
    "reconciled_panel",
    _sql(f"""SELECT e.Year, e.Country, TotalEmissions, PerCapitaEmissions, ShareOfGlobalEmissions, AverageTemperature
FROM (SELECT *, {_KEY} AS k FROM ({_MARKED} ) ) e JOIN (SELECT *, {_KEY} AS k FROM ({_LOUD} ) ) t
ON e.Year = t.Year AND (e.k = t.k OR (e.k = 'the land of 000000004' AND t.k = 'customer 000000004'))"""),
)
def _(spark, sf_dir):
    aliases = {"The Land-of 000000004": "Customer 000000004"}
    return op.reconciled_panel(*_respelt(spark, sf_dir), aliases)


@_register(
    "unmatched_names",
    _sql(f"""SELECT 'emissions' AS side, Country, {_KEY} AS match_key, count(*) AS rows FROM ({_MARKED} )
WHERE {_KEY} NOT IN (SELECT {_KEY} FROM ({_LOUD} ) ) GROUP BY Country
UNION ALL SELECT 'temperatures', Country, {_KEY}, count(*) FROM ({_LOUD} )
WHERE {_KEY} NOT IN (SELECT {_KEY} FROM ({_MARKED} ) ) GROUP BY Country"""),
)
def _(spark, sf_dir):
    return op.unmatched_names(*_respelt(spark, sf_dir))


def _top(measure: str, k: int) -> str:
    return _sql(
        f"SELECT {_ROUNDED} FROM"
        f" (SELECT * FROM averages ORDER BY {measure} DESC NULLS LAST, Country LIMIT {k})"
    )


@_register("top_emitters", _top("TotalEmissionsByCountry", 15))
def _(spark, sf_dir):
    return _rounded(op.top_emitters(averages(spark, sf_dir)))


@_register("hottest_countries", _top("AverageTemperatureByCountry", 8))
def _(spark, sf_dir):
    return _rounded(op.hottest_countries(averages(spark, sf_dir), 8))


@_register(
    "top_observations",
    _sql("""SELECT * FROM customer_emissions
ORDER BY TotalEmissions DESC NULLS LAST, Country, Year LIMIT 5000"""),
)
def _(spark, sf_dir):
    return op.top_observations(customer_emissions(spark, sf_dir))


# Continents.


@_register("continent_lookup", _sql("SELECT * FROM customer_continents"))
def customer_continents(spark, sf_dir):
    return op.continent_lookup(v.raw_customer_lookup(spark, sf_dir))


@_register(
    "continent_lookup_unique",
    _sql("SELECT Country, min(Continent) AS Continent FROM customer_continents GROUP BY 1"),
)
def _(spark, sf_dir):
    return op.continent_lookup(v.raw_customer_lookup(spark, sf_dir), unique=True)


@_register(
    "continent_enrich", _sql("SELECT * FROM emissions LEFT JOIN continents USING (Country)")
)
def _(spark, sf_dir):
    lookup = op.continent_lookup(v.raw_lookup(spark, sf_dir))
    return op.with_continent(emissions(spark, sf_dir), lookup)


@_register(
    "continent_enrich_broadcast",
    _sql("SELECT * FROM country_panel LEFT JOIN continents USING (Country)"),
)
def _(spark, sf_dir):
    lookup = op.continent_lookup(v.raw_lookup(spark, sf_dir))
    return op.with_continent(country_panel(spark, sf_dir), lookup, broadcast=True)


@_register(
    "continent_enrich_large",
    _sql("SELECT * FROM customer_emissions LEFT JOIN partial_continents USING (Country)"),
)
def _(spark, sf_dir):
    # A lookup that grows with the data: past the limit it is not broadcast.
    return op.with_continent(
        customer_emissions(spark, sf_dir),
        op.continent_lookup(v.partial_customer_lookup(spark, sf_dir)),
        broadcast=True,
        max_bytes=16 * 1024,
    )


# Questions.


@_register("temperature_anomaly", _sql(_anomalies("temperatures")))
def _(spark, sf_dir):
    return op.temperature_anomalies(temperatures(spark, sf_dir), *BASELINE)


@_register(
    "worst_anomalies",
    _sql(f"""SELECT Country, max(Anomaly) AS WorstAnomaly
FROM ({_anomalies("customer_temperatures")}) GROUP BY 1
HAVING max(Anomaly) IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 100"""),
)
def _(spark, sf_dir):
    anomalies = op.temperature_anomalies(customer_temperatures(spark, sf_dir), *BASELINE)
    return op.worst_anomalies(anomalies, 100)


@_register(
    "largest_emitters",
    _sql("""SELECT Country, sum(CAST(TotalEmissions AS double)) AS TotalEmissions
FROM countries GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""),
)
def _(spark, sf_dir):
    return op.largest_emitters(country_panel(spark, sf_dir, op.countries_only()))


@_register(
    "largest_emitting_continents",
    _sql("""SELECT Continent, sum(CAST(TotalEmissions AS double)) AS TotalEmissions
FROM customer_emissions
JOIN (SELECT Country, min(Continent) AS Continent FROM customer_continents GROUP BY 1) USING (Country)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""),
)
def _(spark, sf_dir):
    lookup = op.continent_lookup(v.raw_customer_lookup(spark, sf_dir), unique=True)
    panel = op.with_continent(customer_emissions(spark, sf_dir), lookup)
    return op.largest_emitters(panel, "Continent")


_MEASURES = ("TotalEmissions", "PerCapitaEmissions", "ShareOfGlobalEmissions")
_YARDSTICKS = " UNION ALL ".join(
    f"SELECT Country, '{m}' AS Yardstick, CAST(avg({m}) AS float) AS Mean"
    " FROM customer_emissions GROUP BY 1"
    for m in _MEASURES
)


def _ranked(k: int) -> str:
    return _sql(f"""SELECT Country, Yardstick, Mean, Rank FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY Yardstick ORDER BY Mean DESC) AS integer) AS Rank
  FROM ({_YARDSTICKS}) WHERE Mean IS NOT NULL) WHERE Rank <= {k}""")


@_register("rank_polluters", _ranked(10))
def _(spark, sf_dir):
    return op.rank_polluters(customer_emissions(spark, sf_dir))


@_register("rank_polluters_deep", _ranked(1200))
def _(spark, sf_dir):
    return op.rank_polluters(customer_emissions(spark, sf_dir), k=1200)


@_register(
    "worst_of_widened",
    _sql(f"""SELECT Country, sum(CAST(TotalEmissions AS double)) AS TotalEmissions
FROM emissions WHERE Year >= 1900 AND Country IN {_in_list(EUROPE_THREE)}
GROUP BY 1 ORDER BY 2 DESC, 1"""),
)
def _(spark, sf_dir):
    return op.worst_of_widened(op.widen(emissions(spark, sf_dir)))


# Column names, files and tables. Each writes to a new scratch folder.

_AWKWARD = {
    "Year": "Year",
    "Entity": "{Entity}",
    "Annual_CO2_emissions": "Annual CO2 emissions",
    "Per_capita_CO2_emissions": "Per-capita;CO2=emissions",
    "Share_of_global_CO2_emissions": "Share,of\tglobal CO2 emissions",
}


def _awkward(df: DataFrame) -> DataFrame:
    return df.toDF(*[_AWKWARD[c] for c in df.columns])


@_register(
    "normalise_columns",
    _sql("""SELECT Year, Entity, Annual_CO2_emissions, Per_capita_CO2_emissions,
  Share_of_global_CO2_emissions FROM customer_emissions_panel"""),
)
def _(spark, sf_dir):
    return op.with_storable_names(_awkward(v.customer_emissions_panel(spark, sf_dir)))


_READINGS = """SELECT CAST(CAST(Date AS date) AS varchar) AS Date, LandAverageTemperature,
  LandMaxTemperature, LandMinTemperature, LandAndOceanAverageTemperature FROM global_readings"""


def _write_csv(df: DataFrame, path: str) -> str:
    # Untidy text must come back as it was, blanks at its ends included.
    writer = df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _with_date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", F.col("Date").cast("date").cast("string"))


@_register("csv_scan", _sql(_READINGS))
def _(spark, sf_dir):
    path = _write_csv(v.global_readings(spark, sf_dir), scratch_dir(spark, "csv"))
    return _with_date_text(sources.read_csv(spark, path))


@_register("csv_scan_schema", _sql(_READINGS))
def _(spark, sf_dir):
    readings = v.global_readings(spark, sf_dir)
    path = _write_csv(readings, scratch_dir(spark, "csv"))
    return _with_date_text(sources.read_csv(spark, path, readings.schema))


# Every 97th record has a year that is none, and every 101st no readable total.
_BAD_CSV = """SELECT o_orderkey AS Record,
  CASE WHEN o_orderkey % 97 = 0 THEN 'unknown' ELSE CAST(year(o_orderdate) AS varchar) END AS Year,
  CASE WHEN o_orderkey % 101 = 0 THEN '12,5' ELSE CAST(CAST(floor(o_totalprice) AS bigint) AS varchar) END AS Total
FROM orders"""
_CSV_SCHEMA = "Record bigint, Year int, Total bigint"
_BAD = "o_orderkey % 97 = 0 OR o_orderkey % 101 = 0"


def _half_good_csv(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    records = v.table(spark, sf_dir, "orders").select(
        key.alias("Record"),
        F.when(key % 97 == 0, "unknown").otherwise(F.year("o_orderdate").cast("string")).alias("Year"),
        F.when(key % 101 == 0, "12,5")
        .otherwise(F.floor("o_totalprice").cast("string"))
        .alias("Total"),
    )
    path = _write_csv(records, scratch_dir(spark, "half-good"))
    return sources.read_csv_checked(spark, path, StructType.fromDDL(_CSV_SCHEMA))


@_register(
    "csv_good_rows",
    f"""SELECT Record, CAST(Year AS integer) AS Year, CAST(Total AS bigint) AS Total
FROM ({_BAD_CSV} WHERE NOT ({_BAD}))""",
)
def _(spark, sf_dir):
    return sources.good_rows(_half_good_csv(spark, sf_dir))


@_register(
    "csv_bad_records",
    f"""SELECT concat_ws(',', CAST(Record AS varchar), Year,
    CASE WHEN Total = '12,5' THEN '"12,5"' ELSE Total END) AS record,
  CAST(1 + (Year <> 'unknown')::integer + (Total <> '12,5')::integer AS integer) AS fields_read
FROM ({_BAD_CSV} WHERE {_BAD})""",
)
def _(spark, sf_dir):
    return sources.bad_records(_half_good_csv(spark, sf_dir)).drop("file")


@_register(
    "csv_bad_records_counted",
    f"SELECT CAST(count(*) AS bigint) AS bad_records FROM orders WHERE {_BAD}",
)
def _(spark, sf_dir):
    by_file = sources.bad_records_by_file(sources.bad_records(_half_good_csv(spark, sf_dir)))
    return by_file.agg(F.sum("bad_records").alias("bad_records"))


@_register("parquet_roundtrip", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "parquet")
    sinks.write_parquet(customer_emissions(spark, sf_dir), path)
    return sources.read_parquet(spark, path)


@_register("sorted_roundtrip", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "sorted")
    sinks.write_parquet(customer_emissions(spark, sf_dir), path, ["Year"])
    return sources.read_parquet(spark, path)


@_register("single_file_roundtrip", _sql("SELECT * FROM country_panel"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "single")
    sinks.write_parquet(country_panel(spark, sf_dir), path, ["Year"], single_file=True)
    return sources.read_parquet(spark, path)


@_register("partitioned_roundtrip", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    sinks.write_partitioned(customer_emissions(spark, sf_dir), path, ["Year"])
    return sources.read_parquet(spark, path)


@_register("partitioned_one_file_each", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "one-file-each")
    frame = customer_emissions(spark, sf_dir)
    sinks.write_partitioned(frame, path, ["Year"], one_file_each=True)
    written = sources.read_parquet(spark, path)
    sinks.check_output(spark, path, written.schema)
    return written


def _published(spark: SparkSession, *versions: DataFrame, keep_replaced: bool = False) -> DataFrame:
    """The rows of a table published once for each of ``versions``, in a database of its own."""
    database, name = f"yearloom_testbed_{uuid4().hex}", None
    sinks.create_database(spark, database, scratch_dir(spark, "warehouse"))
    try:
        for rows in versions:
            [name] = sinks.write_tables(
                spark, database, {"panel": rows}, ["Year"], keep_replaced=keep_replaced
            )
        return settled(spark.table(name), "published")
    finally:
        sinks.drop_database(spark, database)


@_register("managed_table", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    return _published(spark, customer_emissions(spark, sf_dir))


@_register("managed_table_again", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    # Rows of the same form take the place of others in one step of the catalog.
    rows = customer_emissions(spark, sf_dir)
    return _published(spark, op.after_year(rows, AFTER), rows, keep_replaced=True)


@_register("managed_table_new_columns", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    rows = customer_emissions(spark, sf_dir)
    return _published(spark, rows.select("Year", "Country"), rows)


@_register(
    "bucketed_panel",
    _sql("SELECT * FROM customer_emissions JOIN customer_temperatures USING (Year, Country)"),
)
def _(spark, sf_dir):
    # Both tables lie in buckets by the keys, so their join moves no rows.
    database = f"yearloom_testbed_{uuid4().hex}"
    sinks.create_database(spark, database, scratch_dir(spark, "warehouse"))
    try:
        sides = {"e": customer_emissions(spark, sf_dir), "t": customer_temperatures(spark, sf_dir)}
        for name, rows in sides.items():
            sinks.write_table(
                rows, name, database=database, bucket_by=["Year", "Country"], buckets=8
            )
        e, t = (spark.table(f"{database}.{name}") for name in sides)
        return settled(op.country_panel(e, t, colocated=True), "bucketed")
    finally:
        sinks.drop_database(spark, database)


def _refreshed(spark, sf_dir) -> tuple[str, DataFrame]:
    """A dataset with a year too few, one too short and one of other values, brought up to date."""
    path, rows = scratch_dir(spark, "refreshed"), customer_emissions(spark, sf_dir)
    year, total = F.col("Year"), F.col("TotalEmissions")
    before = rows.filter((year != 1998) & ((year != 1997) | (F.col("ShareOfGlobalEmissions") > 1)))
    before = before.withColumn("TotalEmissions", F.when(year == 1996, -total).otherwise(total))
    sinks.write_partitioned(before, path, ["Year"])
    return path, sinks.refresh_partitioned(rows.filter(year != 1995), path, ["Year"])


@_register("refreshed_years", _sql("SELECT * FROM customer_emissions"))
def _(spark, sf_dir):
    path, _ = _refreshed(spark, sf_dir)
    return sources.read_parquet(spark, path)


@_register(
    "refresh_report",
    _sql("""SELECT Year, old_rows, CASE WHEN Year = 1995 THEN 0 ELSE n END AS new_rows,
  CASE WHEN Year = 1995 THEN 'absent' WHEN Year = 1998 THEN 'added'
       WHEN Year IN (1996, 1997) THEN 'changed' ELSE 'same' END AS state
FROM (SELECT Year, count(*) AS n, count(*) FILTER (Year <> 1998 AND (Year <> 1997 OR ShareOfGlobalEmissions > 1))
  AS old_rows FROM customer_emissions GROUP BY 1)"""),
)
def _(spark, sf_dir):
    return _refreshed(spark, sf_dir)[1]


@_register("continent_csv", _sql("SELECT * FROM customer_continents"))
def _(spark, sf_dir):
    raw = v.raw_customer_lookup(spark, sf_dir)
    given = [
        F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in CONTINENT_CSV_SCHEMA
    ]
    path = _write_csv(raw.select(*given), scratch_dir(spark, "continents"))
    return op.continent_lookup(sources.read_continents(spark, path))


@_register("source_fallback", _sql("SELECT * FROM emissions_panel"))
def _(spark, sf_dir):
    # The primary place is never written, so the fallback is read.
    primary, fallback = scratch_dir(spark, "primary"), scratch_dir(spark, "fallback")
    sinks.write_parquet(v.emissions_panel(spark, sf_dir), f"{fallback}/{EMISSIONS_DATASET}")
    chosen = sources.resolve_source(spark, primary, fallback, [EMISSIONS_DATASET])
    return sources.read_parquet(spark, f"{chosen}/{EMISSIONS_DATASET}")


@_register("source_primary", _sql("SELECT * FROM emissions_panel"))
def _(spark, sf_dir):
    # The primary place is complete, so the fallback, never written, is not read.
    primary, fallback = scratch_dir(spark, "primary"), scratch_dir(spark, "fallback")
    sinks.write_parquet(v.emissions_panel(spark, sf_dir), f"{primary}/{EMISSIONS_DATASET}")
    chosen = sources.resolve_source(spark, primary, fallback, [EMISSIONS_DATASET])
    return sources.read_parquet(spark, f"{chosen}/{EMISSIONS_DATASET}")


@_register(
    "enrichment_run", _sql("SELECT * FROM country_panel LEFT JOIN continents USING (Country)")
)
def _(spark, sf_dir):
    target = scratch_dir(spark, "enrichment")
    sinks.write_parquet(country_panel(spark, sf_dir), f"{target}/{COUNTRY_PANEL_DATASET}")
    raw = v.raw_lookup(spark, sf_dir)
    given = [
        F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in CONTINENT_CSV_SCHEMA
    ]
    csv = _write_csv(raw.select(*given), f"{target}/continents-csv")
    return plans.run_enrichment(spark, target, csv)


@_register("checked_output", _sql("SELECT count(*) AS records FROM emission_records"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "checked")
    records = v.emission_records(spark, sf_dir)
    sinks.write_parquet(records, path)
    rows = sinks.check_output(spark, path, records.schema)
    written = sources.read_parquet(spark, path)
    return written.agg(F.count("*").alias("records")).filter(F.col("records") == rows)


@_register(
    "observed_output",
    _sql(f"""SELECT count(*) AS readings, count(*) - count(Year) AS no_year,
  count(*) - count(Country) AS no_country, count(*) - count(x) AS no_temperature
FROM (SELECT {_YEAR} AS Year, Country, TRY_CAST({_CLEAN} AS float) AS x FROM dirty_readings )"""),
)
def _(spark, sf_dir):
    # What the writing job saw of its rows; the dataset is not read again.
    path = scratch_dir(spark, "observed")
    readings = op.clean_readings(v.dirty_readings(spark, sf_dir))
    seen = sinks.write_checked(readings, path, readings.schema)
    counts = [seen.rows, *(seen.nulls[c] for c in ("Year", "Country", "AverageTemperature"))]
    names = ("readings", "no_year", "no_country", "no_temperature")
    return spark.range(1).select(*[F.lit(n).cast("long").alias(c) for n, c in zip(counts, names)])


# The whole run: CSV files with awkward names in, four managed tables out.


def _whole_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    base = scratch_dir(spark, "run")
    frames = {
        EMISSIONS_DATASET: _awkward(v.emissions_panel(spark, sf_dir)),
        GLOBAL_TEMPERATURES_DATASET: v.global_readings(spark, sf_dir),
        TEMPERATURES_DATASET: v.dirty_readings(spark, sf_dir),
    }
    csv_paths = {
        name: _write_csv(df, f"{base}/csv/{name.removesuffix('.parquet')}")
        for name, df in frames.items()
    }
    schemas = {name: df.schema for name, df in frames.items()}
    user = f"testbed.{uuid4().hex}@example.com"
    try:
        plans.run_pipeline(spark, csv_paths, base, schemas, user, f"{base}/tables")
        prefix = f"{database_name(user)}.{TABLE_PREFIX}"
        return {
            name: settled(spark.table(f"{prefix}_{end}"), end) for name, end in TABLE_SUFFIXES.items()
        }
    finally:
        sinks.drop_database(spark, database_name(user))


def _long(panel: DataFrame, dataset: str) -> DataFrame:
    keys = [c for c in ("Year", "Country") if c in panel.columns]
    measures = [c for c in panel.columns if c not in keys]
    country = F.col("Country") if "Country" in keys else F.lit(None).cast("string")
    return panel.unpivot(keys, measures, "Measure", "Value").select(
        F.lit(dataset).alias("Dataset"), "Year", country.alias("Country"), "Measure", "Value"
    )


_RUN_OUTPUTS = {
    GLOBAL_PANEL_DATASET: "global_panel",
    COUNTRY_PANEL_DATASET: "country_panel",
    EUROPE_DATASET: "wide",
    OCEANIA_DATASET: "("
    + _fill(f"(SELECT * FROM emissions WHERE Country IN {_OCEANIA} )", "Year, Country")
    + ")",
}


def _long_sql() -> str:
    selects = []
    for dataset, source in _RUN_OUTPUTS.items():
        names = OUTPUT_SCHEMAS[dataset].names
        country = "Country" if "Country" in names else "CAST(NULL AS varchar)"
        selects += [
            f"SELECT '{dataset}' AS Dataset, Year, {country} AS Country, '{m}' AS Measure,"
            f" {m} AS Value FROM {source}"
            for m in names
            if m not in ("Year", "Country")
        ]
    return " UNION ALL ".join(selects)


@_register("whole_run", _sql(_long_sql()))
def _(spark, sf_dir):
    tables = _whole_run(spark, sf_dir)
    return reduce(DataFrame.unionByName, [_long(df, name) for name, df in tables.items()])


def queries() -> dict[str, Run]:
    return {name: query.run for name, query in REGISTRY.items()}


def oracle_sql() -> Mapping[str, str]:
    return {name: query.sql for name, query in REGISTRY.items()}
