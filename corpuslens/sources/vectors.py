"""Stored document vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_embeddings(vectors: DataFrame, docs: DataFrame | None = None, *, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, embedding) of the documents that have a vector, checked for one dimension.

    Vectors and documents are aligned by id, never by position.
    """
    keyed = vectors.select(F.col(id_col).cast("long").alias("doc_id"), F.col("embedding"))
    bounds = keyed.agg(F.min(F.size("embedding")).alias("lo"), F.max(F.size("embedding")).alias("hi")).first()
    if bounds.lo != bounds.hi:
        raise ValueError(f"embeddings differ in dimension: {bounds.lo}..{bounds.hi}")
    return keyed if docs is None else keyed.join(docs.select("doc_id"), "doc_id", "left_semi")
