from corpuslens.sources.files import (
    read_citation_ids,
    read_csv,
    read_jsonl,
    read_text_folder,
    spread,
    with_row_idx,
)
from corpuslens.sources.ingest import assign_doc_id, id_quality, map_columns
from corpuslens.sources.vectors import load_embeddings
from corpuslens.sources.xml import citation_rows, load_atom_feed, load_citations, parse_citations, read_atom_feed, read_citations

__all__ = [
    "assign_doc_id",
    "citation_rows",
    "id_quality",
    "load_embeddings",
    "map_columns",
    "load_atom_feed",
    "load_citations",
    "parse_citations",
    "read_atom_feed",
    "read_citation_ids",
    "read_citations",
    "read_csv",
    "read_jsonl",
    "read_text_folder",
    "spread",
    "with_row_idx",
]
