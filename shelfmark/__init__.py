"""Spark operators for metadata: catalogs, trees, articles, query logs and lineage."""

__version__ = "0.1.0"
