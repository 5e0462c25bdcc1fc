"""All queries of the document-analysis operators with their SQL."""

from __future__ import annotations

from .plans import box_queries, chain_queries, evaluation_queries, layout_queries, ontology_queries, pdf_queries, raster_queries, structure_queries, table_queries, text_queries  # noqa: F401  registers the queries
from .plans.registry import ORACLE, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
