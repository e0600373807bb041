"""Names, lists, formats and schemas that the results depend on."""

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Cleaning rules.
SENTINEL = "( ͡° ͜ʖ ͡°)"
DATE_PATTERN = "MM-dd-yyyy"
CHARS_TO_UNDERSCORE = " ,;\n\t=-"
CHARS_TO_DROP = "{}()"

# Entities.
NOT_A_COUNTRY = ("World",)
CONTINENT_NAMES = ("Asia", "North America", "Europe", "Africa", "South America")
EUROPE_THREE = ("France", "Germany", "United Kingdom")
OCEANIA_TWO = ("Australia", "New Zealand")

# Years and frames.
FIRST_MODERN_YEAR = 1900
FILL_BACK_YEARS = 3
FILL_AHEAD_YEARS = 3

# Report sizes.
TOP_EMITTERS = 15
TOP_TEMPERATURES = 30
TOP_OBSERVATIONS = 5000
TOP_QUESTION = 3

# Dataset and table names.
EMISSIONS_DATASET = "EmissionsByCountry.parquet"
TEMPERATURES_DATASET = "TemperaturesByCountry.parquet"
GLOBAL_TEMPERATURES_DATASET = "GlobalTemperatures.parquet"
GLOBAL_PANEL_DATASET = "GlobalEmissionsVsTemperatures.parquet"
COUNTRY_PANEL_DATASET = "CountryEmissionsVsTemperatures.parquet"
EUROPE_DATASET = "EuropeBigThreeEmissions.parquet"
OCEANIA_DATASET = "OceaniaEmissionsEdited.parquet"
TABLE_PREFIX = "data_transformation"
TABLE_SUFFIXES = {
    GLOBAL_PANEL_DATASET: "global_emissions",
    OCEANIA_DATASET: "oceania_emissions",
    EUROPE_DATASET: "europe_big_three",
    COUNTRY_PANEL_DATASET: "country_emissions",
}

# Columns of the emissions, temperature and continent tables.
ENTITY = "Entity"
EMISSION_MEASURES = {
    "Annual_CO2_emissions": "TotalEmissions",
    "Per_capita_CO2_emissions": "PerCapitaEmissions",
    "Share_of_global_CO2_emissions": "ShareOfGlobalEmissions",
}
CONTINENT_CSV_SCHEMA = StructType(
    [
        StructField("Continent_Name", StringType()),
        StructField("Continent_Code", StringType()),
        StructField("Country_Name", StringType()),
        StructField("Two_Letter_Country_Code", StringType()),
        StructField("Three_Letter_Country_Code", StringType()),
        StructField("Country_Number", IntegerType()),
    ]
)


# Schemas of the four published datasets, and the row counts
# they have when built from the full historical inputs.
OUTPUT_SCHEMAS = {
    GLOBAL_PANEL_DATASET: StructType(
        [
            StructField("Year", IntegerType()),
            StructField("TotalEmissions", FloatType()),
            StructField("LandAverageTemperature", FloatType()),
            StructField("LandMaxTemperature", FloatType()),
            StructField("LandMinTemperature", FloatType()),
            StructField("LandAndOceanAverageTemperature", FloatType()),
        ]
    ),
    COUNTRY_PANEL_DATASET: StructType(
        [
            StructField("Year", IntegerType()),
            StructField("Country", StringType()),
            StructField("TotalEmissions", FloatType()),
            StructField("PerCapitaEmissions", FloatType()),
            StructField("ShareOfGlobalEmissions", FloatType()),
            StructField("AverageTemperature", FloatType()),
        ]
    ),
    EUROPE_DATASET: StructType(
        [
            StructField("Year", IntegerType()),
            StructField("France_TotalEmissions", FloatType()),
            StructField("France_PerCapitaEmissions", FloatType()),
            StructField("Germany_TotalEmissions", FloatType()),
            StructField("Germany_PerCapitaEmissions", FloatType()),
            StructField("UnitedKingdom_TotalEmissions", FloatType()),
            StructField("UnitedKingdom_PerCapitaEmissions", FloatType()),
        ]
    ),
    OCEANIA_DATASET: StructType(
        [
            StructField("Year", IntegerType()),
            StructField("Country", StringType()),
            StructField("TotalEmissions", FloatType()),
        ]
    ),
}
HISTORICAL_ROW_COUNTS = {
    GLOBAL_PANEL_DATASET: 266,
    COUNTRY_PANEL_DATASET: 18529,
    EUROPE_DATASET: 120,
    OCEANIA_DATASET: 302,
}
