"""All registered queries."""

from shelfmark.plans import (  # noqa: F401
    aggregates,
    catalog,
    documents,
    hierarchy,
    lineage,
    lookups,
    relational,
    scalars,
    sources,
)
from shelfmark.plans.registry import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
