"""Imports the modules that register a query; `QUERIES` and `SQL` hold all of them."""

from corpuslens.llm import (  # noqa: F401
    binary, contamination, language_model, lines, minhash, nearest, packing, passages, pieces, pii, prefix_trie, quality, search,
)
from corpuslens.llm.tables import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
