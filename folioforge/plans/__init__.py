"""The catalogue of queries: QUERIES by name, and SQL that gives the same rows."""

from . import chunk_queries, corpus_queries, extraction_queries, flow_queries, metric_queries, record_queries, settings_queries, structure_queries, vector_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
