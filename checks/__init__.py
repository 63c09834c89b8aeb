"""Registered queries with their SQL counterparts, one module per operator family."""

from checks.registry import QUERIES, SQL

from checks import ingest, keywords, quality, ranking, report, text, trends, vectors  # noqa: F401, E402, I001

__all__ = ["QUERIES", "SQL"]
