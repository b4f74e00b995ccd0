"""All runnable queries. Importing the package fills the registry."""

from settleflow.catalogue.base import REGISTRY, Query
from settleflow.catalogue import relational, numbering_scalars, billing_jobs, importing_jobs, result_jobs, payback_jobs, listing_jobs, report_jobs, quality_jobs  # noqa: F401

__all__ = ["REGISTRY", "Query"]
