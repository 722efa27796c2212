"""All registered queries."""

from tessella.catalog import document_queries, flow_queries, page_queries, source_queries, text_queries  # noqa: F401
from tessella.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
