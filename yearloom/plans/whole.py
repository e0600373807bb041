"""All steps in one call."""

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from yearloom.fixed import NOT_A_COUNTRY
from yearloom.plans.enrichment import run_enrichment
from yearloom.plans.ingestion import run_ingestion
from yearloom.plans.transformation import publish_tables, run_transformation
from yearloom.sinks import write_parquet

ENRICHED_DATASET = "CountryPanelWithContinents.parquet"


def run_pipeline(
    spark: SparkSession,
    csv_paths: Mapping[str, str],
    workdir: str,
    schemas: Mapping[str, StructType] | None = None,
    user: str | None = None,
    location: str | None = None,
    persist: bool = False,
    single_file: bool = False,
    fallback: str | None = None,
    discard: Iterable[str] = NOT_A_COUNTRY,
    counts: Mapping[str, int] | None = None,
    continents_csv: str | None = None,
    quarantine: str | None = None,
    most_bad: int | None = None,
) -> dict[str, int]:
    """Ingest the CSV files, then build, check and, for a ``user``, publish the panels.

    ``fallback``, ``discard`` and ``counts`` are those of the transformation.
    With ``continents_csv`` the country panel is also written with continents,
    as ``ENRICHED_DATASET`` beside the panels. ``quarantine`` and ``most_bad``
    are those of the ingestion.

    Ingested datasets go under ``workdir/dataIngestion`` and panels under
    ``workdir/dataTransformation``. Returns the row count of each panel.
    """
    ingested, target = f"{workdir}/dataIngestion", f"{workdir}/dataTransformation"
    run_ingestion(spark, csv_paths, ingested, schemas, single_file, quarantine, most_bad)
    written = run_transformation(
        spark, ingested, target, fallback, discard, persist, single_file, counts
    )
    if continents_csv is not None:
        enriched = run_enrichment(spark, target, continents_csv)
        write_parquet(enriched, f"{target}/{ENRICHED_DATASET}", single_file=single_file)
    if user is not None:
        publish_tables(spark, target, user, location, single_file)
    return written
