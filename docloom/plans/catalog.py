"""All registered queries over the driver's tables, and their SQL."""

from . import document_queries, pipeline_queries, relational_queries, retrieval_queries, window_queries  # noqa: F401  each registers its own
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
