"""From the ingested datasets to the four published panels."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from yearloom.fixed import (
    COUNTRY_PANEL_DATASET,
    EMISSIONS_DATASET,
    EUROPE_DATASET,
    GLOBAL_PANEL_DATASET,
    GLOBAL_TEMPERATURES_DATASET,
    NOT_A_COUNTRY,
    OCEANIA_DATASET,
    OUTPUT_SCHEMAS,
    TABLE_PREFIX,
    TABLE_SUFFIXES,
    TEMPERATURES_DATASET,
)
from yearloom.functions import database_name
from yearloom.operators import (
    country_emissions,
    country_panel,
    country_temperatures,
    global_panel,
    leap_year_fill,
    widen,
    yearly_temperatures,
    yearly_total,
)
from yearloom.scratch import remove, scratch_dir, settled
from yearloom.sinks import ContractBroken, write_checked, write_tables
from yearloom.sources import read_parquet, resolve_source

INGESTED = (EMISSIONS_DATASET, GLOBAL_TEMPERATURES_DATASET, TEMPERATURES_DATASET)


def published_panels(
    emissions: DataFrame, global_readings: DataFrame, temperatures: DataFrame
) -> dict[str, DataFrame]:
    """The four panels by dataset name.

    ``temperatures`` are those per year and country.
    """
    return {
        GLOBAL_PANEL_DATASET: global_panel(
            yearly_total(emissions), yearly_temperatures(global_readings)
        ),
        COUNTRY_PANEL_DATASET: country_panel(emissions, temperatures),
        EUROPE_DATASET: widen(emissions),
        OCEANIA_DATASET: leap_year_fill(emissions),
    }


def run_transformation(
    spark: SparkSession,
    source: str,
    target: str,
    fallback: str | None = None,
    discard: Iterable[str] = NOT_A_COUNTRY,
    persist: bool = False,
    single_file: bool = False,
    counts: Mapping[str, int] | None = None,
) -> dict[str, int]:
    """Write the panels under ``target``, sorted by year, and check them.

    Inputs come from ``source``, or from ``fallback`` if given and ``source``
    is incomplete. ``persist`` keeps the country emissions between the four
    writes; without it each write scans just the columns it needs. ``counts``
    are row counts the outputs must have. Returns the row counts they do have.
    """
    if fallback is not None:
        source = resolve_source(spark, source, fallback, INGESTED)
    raw, global_readings, country_readings = (
        read_parquet(spark, f"{source}/{name}") for name in INGESTED
    )
    emissions = country_emissions(raw, discard)
    # Settled first, their size decides how the panel is joined: while they are
    # small enough to broadcast, the emissions need no shuffle for it.
    scratch = scratch_dir(spark, "temperatures")
    if persist:
        emissions = emissions.persist()
    try:
        temperatures = settled(country_temperatures(country_readings), "temperatures", scratch)
        panels = published_panels(emissions, global_readings, temperatures)
        written, broken, counts = {}, [], counts or {}
        for name, panel in panels.items():
            keys = [c for c in ("Year", "Country") if c in panel.columns]
            try:
                written[name] = write_checked(
                    panel, f"{target}/{name}", OUTPUT_SCHEMAS[name], keys, single_file, counts.get(name)
                ).rows
            except ContractBroken as fault:
                broken.append(str(fault))
    finally:
        if persist:
            emissions.unpersist()
        remove(spark, scratch)
    if broken:
        raise ContractBroken("; ".join(broken))
    return written


def publish_tables(
    spark: SparkSession,
    target: str,
    user: str,
    location: str | None = None,
    single_file: bool = False,
) -> list[str]:
    """Copy the written panels into managed tables of the user's database.

    The panels are sorted as they are written, and the tables take their rows
    file by file; only a single file is sorted again.
    """
    tables = {
        f"{TABLE_PREFIX}_{suffix}": read_parquet(spark, f"{target}/{name}")
        for name, suffix in TABLE_SUFFIXES.items()
    }
    sort_by = ["Year"] if single_file else ()
    return write_tables(spark, database_name(user), tables, sort_by, single_file, location)
