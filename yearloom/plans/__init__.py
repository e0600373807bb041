"""Complete jobs: read datasets, apply the operators, write and check results."""

from yearloom.plans.enrichment import run_enrichment
from yearloom.plans.ingestion import IngestionRefused, run_ingestion
from yearloom.plans.transformation import publish_tables, published_panels, run_transformation
from yearloom.plans.whole import run_pipeline

__all__ = [
    "IngestionRefused",
    "publish_tables",
    "published_panels",
    "run_enrichment",
    "run_ingestion",
    "run_pipeline",
    "run_transformation",
]
