"""Continents for the country panel."""

from pyspark.sql import DataFrame, SparkSession

from yearloom.fixed import COUNTRY_PANEL_DATASET
from yearloom.operators import continent_lookup, with_continent
from yearloom.sinks import write_parquet
from yearloom.sources import read_continents, read_parquet, stored_bytes

CONTINENTS_DATASET = "continents.parquet"


def run_enrichment(
    spark: SparkSession,
    target: str,
    continents_csv: str,
    broadcast: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Write the cleaned lookup beside the panels and join it to the country panel."""
    path = f"{target}/{CONTINENTS_DATASET}"
    write_parquet(continent_lookup(read_continents(spark, continents_csv), unique), path)
    panel = read_parquet(spark, f"{target}/{COUNTRY_PANEL_DATASET}")
    lookup = read_parquet(spark, path)
    return with_continent(panel, lookup, broadcast, stored=stored_bytes(spark, path))
