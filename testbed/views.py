"""Inputs of the right form, derived from the generated star-schema tables.

Each view exists twice: as a DataFrame here and as SQL in ``SQL_VIEWS``, which
another engine runs. Orders stand for emissions and line items for temperature
readings; countries are made from nations, or one from each customer where the
number of countries should grow with the data.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.fixed import SENTINEL

# The names of the first nations; gaps in their years lead to
# every outcome of a fill and to a year without any pivoted country.
NATION_NAMES = {
    0: "World",
    1: "France",
    2: "Germany",
    3: "United Kingdom",
    4: "Australia",
    5: "New Zealand",
    6: "Asia",
    7: "Nation Seven",
}
_NO_YEARS = {4: (1997, 1998, 1999, 2001), 5: (1995,), 1: (2001,), 2: (2001,), 3: (2001,)}
JUNK_NATION, UNLISTED_NATION, TWICE_LISTED_NATION = 8, 9, 10


# The columns in use. With them given, opening a table reads no file footer.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _nation_name(key: Column) -> Column:
    name = F.concat(F.lit("Nation"), key.cast("string"))
    for number, text in NATION_NAMES.items():
        name = F.when(key == number, text).otherwise(name)
    return name


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey").alias("c_custkey"),
        F.year("o_orderdate").alias("Year"),
        F.col("o_totalprice"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return orders.join(customers, "c_custkey")


def _has_gap(key: Column, year: Column) -> Column:
    gap = F.lit(False)
    for number, years in _NO_YEARS.items():
        gap = gap | ((key == number) & year.isin(*years))
    return gap


def _exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def gapped_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly emissions without some years of five nations, for pivots and fills."""
    return emissions_panel(spark, sf_dir, gaps=True)


def emissions_panel(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Yearly emissions of each nation, per head of its customers, and a share."""
    population = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("heads")
    )
    nation, year = F.col("c_nationkey"), F.col("Year")
    yearly = (
        _orders_by_customer(spark, sf_dir)
        .filter(~_has_gap(nation, year) if gaps else F.lit(True))
        .groupBy("Year", "c_nationkey")
        .agg(
            _exact_sum("o_totalprice").alias("Annual_CO2_emissions"),
            F.count("*").cast("double").alias("Share_of_global_CO2_emissions"),
        )
    )
    return yearly.join(population, "c_nationkey").select(
        "Year",
        _nation_name(nation).alias("Entity"),
        "Annual_CO2_emissions",
        (F.col("Annual_CO2_emissions") / F.col("heads")).alias("Per_capita_CO2_emissions"),
        "Share_of_global_CO2_emissions",
    )


def customer_emissions_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns with each customer as an entity."""
    total = _exact_sum("o_totalprice")
    return (
        _orders_by_customer(spark, sf_dir)
        .groupBy("Year", F.col("c_name").alias("Entity"))
        .agg(
            total.alias("Annual_CO2_emissions"),
            (total / F.count("*")).alias("Per_capita_CO2_emissions"),
            F.count("*").cast("double").alias("Share_of_global_CO2_emissions"),
        )
    )


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' total of each day, all under one key; ``Day`` counts from 1970."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).alias("Day"))
        .agg(_exact_sum("o_totalprice").alias("Total"))
        .select("Day", F.lit("everywhere").alias("Place"), "Total")
    )


def gapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records without some years of five nations, for fills."""
    return emission_records(spark, sf_dir, gaps=True)


def emission_records(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Every order as an emission record: many rows per year and country."""
    nation = F.col("c_nationkey")
    return (
        _orders_by_customer(spark, sf_dir)
        .filter(~_has_gap(nation, F.col("Year")) if gaps else F.lit(True))
        .select(
            F.col("o_orderkey").alias("Record"),
            "Year",
            _nation_name(nation).alias("Country"),
            F.col("o_totalprice").cast("float").alias("TotalEmissions"),
        )
    )


def _spellings(name: Column, all_junk: Column) -> list[Column]:
    # On the small side of a join, so that it is not done again for each reading.
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    return [
        F.upper(padded).alias("loud"),
        F.lower(padded).alias("quiet"),
        all_junk.alias("all_junk"),
    ]


def _dirty(lines: DataFrame) -> DataFrame:
    line = F.col("l_linenumber")
    wrapped = F.concat(
        F.lit(SENTINEL),
        F.col("l_quantity").cast("decimal(10,2)").cast("string"),
        F.lit(SENTINEL),
    )
    reading = (
        F.when(F.col("all_junk"), "?")
        .when(line % 7 == 0, "-")
        .when(line % 5 == 0, "#")
        .otherwise(wrapped)
    )
    return lines.select(
        F.date_format("l_shipdate", "MM-dd-yyyy").alias("Date"),
        F.when(line % 2 == 0, F.col("loud")).otherwise(F.col("quiet")).alias("Country"),
        reading.alias("AverageTemperature"),
    )


def _lines(spark: SparkSession, sf_dir: str, key: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col(key).alias(name), "l_linenumber", "l_quantity", "l_shipdate"
    )


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy temperature readings of the supplier's nation, one per line item."""
    nation = F.col("s_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", *_spellings(_nation_name(nation), nation == JUNK_NATION)
    )
    return _dirty(_lines(spark, sf_dir, "l_suppkey", "s_suppkey").join(suppliers, "s_suppkey"))


def customer_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy temperature readings of the ordering customer, one per line item."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", *_spellings(F.col("c_name"), F.col("c_nationkey") == JUNK_NATION)
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey")
    )
    lines = _lines(spark, sf_dir, "l_orderkey", "o_orderkey")
    return _dirty(lines.join(orders.join(customers, "c_custkey"), "o_orderkey"))


def global_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tidy worldwide temperature readings, one per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("Date"),
        F.col("l_discount").alias("LandAverageTemperature"),
        F.col("l_quantity").alias("LandMaxTemperature"),
        F.col("l_tax").alias("LandMinTemperature"),
        F.col("l_extendedprice").alias("LandAndOceanAverageTemperature"),
    )


def _formal(name: Column, key: Column) -> Column:
    return F.concat(
        name,
        F.when(key % 3 == 0, ", Republic of").when(key % 3 == 1, " (Formal Name)").otherwise(""),
    )


def raw_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations under formal names; one is missing and one is listed twice."""
    nations = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    name = _nation_name(key)
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    listed = (
        nations.filter(key != UNLISTED_NATION)
        .join(regions, "n_regionkey")
        .select(_formal(name, key).alias("Country_Name"), F.col("r_name").alias("Continent_Name"))
    )
    twins = nations.filter(key == TWICE_LISTED_NATION).select(
        F.concat(name, F.lit(" (Twin)")).alias("Country_Name"),
        F.lit("EXTRA").alias("Continent_Name"),
    )
    return listed.unionByName(twins)


def partial_customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' lookup without every eleventh, for joins that find nothing."""
    return raw_customer_lookup(spark, sf_dir, partial=True)


def raw_customer_lookup(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """Customers under formal names with their region as continent, every seventh twice."""
    key = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey")
    )
    regions = table(spark, sf_dir, "region")
    copies = F.when(F.lit(partial) & (key % 11 == 0), 0).when(key % 7 == 0, 2).otherwise(1)
    return (
        customers.join(nations, "c_nationkey")
        .join(regions, "r_regionkey")
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
        .select(
            _formal(F.col("c_name"), key).alias("Country_Name"),
            F.col("r_name").alias("Continent_Name"),
        )
    )


def _sql_name(key: str) -> str:
    cases = " ".join(f"WHEN {number} THEN '{text}'" for number, text in NATION_NAMES.items())
    return f"CASE {key} {cases} ELSE concat('Nation', CAST({key} AS varchar)) END"


def _sql_formal(name: str, key: str) -> str:
    return (
        f"concat({name}, CASE {key} % 3 WHEN 0 THEN ', Republic of'"
        " WHEN 1 THEN ' (Formal Name)' ELSE '' END)"
    )


def _sql_dirty(name: str, all_junk: str) -> str:
    return f"""strftime(l_shipdate, '%m-%d-%Y') AS Date,
  concat('  ', CASE WHEN l_linenumber % 2 = 0 THEN upper({name}) ELSE lower({name}) END, ' ') AS Country,
  CASE WHEN {all_junk} THEN '?' WHEN l_linenumber % 7 = 0 THEN '-' WHEN l_linenumber % 5 = 0 THEN '#'
       ELSE concat('{SENTINEL}', CAST(CAST(l_quantity AS decimal(10,2)) AS varchar), '{SENTINEL}')
  END AS AverageTemperature"""


_SQL_NO_GAP = " AND ".join(
    f"NOT (c_nationkey = {number} AND year(o_orderdate) IN ({', '.join(map(str, years))}))"
    for number, years in _NO_YEARS.items()
)
_SQL_SUM = "CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double)"



def _sql_panel(where: str) -> str:
    return f"""
SELECT Year, {_sql_name('y.c_nationkey')} AS Entity, Annual_CO2_emissions,
  Annual_CO2_emissions / heads AS Per_capita_CO2_emissions, Share_of_global_CO2_emissions
FROM (SELECT CAST(year(o_orderdate) AS integer) AS Year, c_nationkey,
        {_SQL_SUM} AS Annual_CO2_emissions, CAST(count(*) AS double) AS Share_of_global_CO2_emissions
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE {where} GROUP BY 1, 2) y
JOIN (SELECT c_nationkey, count(*) AS heads FROM customer GROUP BY 1) p ON y.c_nationkey = p.c_nationkey"""


def _sql_records(where: str) -> str:
    return f"""
SELECT o_orderkey AS Record, CAST(year(o_orderdate) AS integer) AS Year,
  {_sql_name('c_nationkey')} AS Country, CAST(o_totalprice AS float) AS TotalEmissions
FROM orders JOIN customer ON o_custkey = c_custkey WHERE {where}"""


def _sql_customer_lookup(copies: str) -> str:
    return f"""
SELECT {_sql_formal('c_name', 'c_custkey')} AS Country_Name, r_name AS Continent_Name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN (VALUES (1), (2)) AS copies(n) ON n <= CASE {copies} WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END"""


SQL_VIEWS = {
    "emissions_panel": _sql_panel("true"),
    "gapped_panel": _sql_panel(_SQL_NO_GAP),
    "customer_emissions_panel": f"""
SELECT CAST(year(o_orderdate) AS integer) AS Year, c_name AS Entity, {_SQL_SUM} AS Annual_CO2_emissions,
  {_SQL_SUM} / count(*) AS Per_capita_CO2_emissions, CAST(count(*) AS double) AS Share_of_global_CO2_emissions
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "emission_records": _sql_records("true"),
    "gapped_records": _sql_records(_SQL_NO_GAP),
    "daily_totals": f"""
SELECT CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS date)) AS integer) AS Day,
  'everywhere' AS Place, {_SQL_SUM} AS Total
FROM orders GROUP BY 1""",
    "dirty_readings": f"""
SELECT {_sql_dirty(_sql_name('s_nationkey'), f's_nationkey = {JUNK_NATION}')}
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "customer_readings": f"""
SELECT {_sql_dirty('c_name', f'c_nationkey = {JUNK_NATION}')}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "global_readings": """
SELECT l_shipdate AS Date, l_discount AS LandAverageTemperature, l_quantity AS LandMaxTemperature,
  l_tax AS LandMinTemperature, l_extendedprice AS LandAndOceanAverageTemperature
FROM lineitem""",
    "raw_lookup": f"""
SELECT {_sql_formal(_sql_name('n_nationkey'), 'n_nationkey')} AS Country_Name, r_name AS Continent_Name
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> {UNLISTED_NATION}
UNION ALL
SELECT concat({_sql_name('n_nationkey')}, ' (Twin)'), 'EXTRA' FROM nation
WHERE n_nationkey = {TWICE_LISTED_NATION}""",
    "raw_customer_lookup": _sql_customer_lookup(""),
    "partial_customer_lookup": _sql_customer_lookup("WHEN c_custkey % 11 = 0 THEN 0"),
}
