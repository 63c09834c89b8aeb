"""From a user's table to the corpus schema: column mapping and document ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.numeric import plain_double
from corpuslens.functions.text import blank_to_null

# Largest double below 2^63; larger ids are treated as non-numeric.
_MAX_ID = 9.2e18


def map_columns(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Map user columns to the corpus columns; the raw id stays text for `assign_doc_id`.

    `columns` maps schema names (text, abstract, doc_id, pmid, year, title, keywords) to the
    user's names; an unmapped name is looked up as it is. Text is required, the rest optional.
    """
    columns = dict(columns or {})

    def pick(name: str) -> Column | None:
        user = columns.get(name, name)
        return F.col(f"`{user}`") if user in df.columns else None

    def optional(name: str) -> Column:
        found = pick(name)
        return F.lit(None).cast("string") if found is None else blank_to_null(found.cast("string"))

    text = pick("text")
    text = pick("abstract") if text is None else text
    if text is None:
        raise ValueError(f"no text column: map 'text' to one of {df.columns}")
    raw_id = pick("doc_id")
    raw_id = pick("pmid") if raw_id is None else raw_id
    kept = [F.col("row_idx")] if "row_idx" in df.columns else []
    return df.select(
        (F.lit(None) if raw_id is None else raw_id).cast("string").alias("raw_id"),
        *kept,
        optional("year").alias("year"),
        optional("title").alias("title"),
        blank_to_null(text.cast("string")).alias("abstract"),
        optional("keywords").alias("author_keywords"),
        F.lit(None).cast("string").alias("mesh_terms"),
    )


def numeric_id(raw: Column) -> Column:
    """The id as BIGINT (decimals truncated), NULL if it is not a number."""
    trimmed = F.trim(raw)
    as_double = plain_double(trimmed)
    in_range = as_double.isNotNull() & ~F.isnan(as_double) & (F.abs(as_double) < _MAX_ID)
    return F.when(trimmed.rlike(r"^[+-]?\d{1,18}$"), trimmed.try_cast("long")).otherwise(
        F.when(in_range, as_double.cast("long"))
    )


def id_quality(df: DataFrame, raw: str = "raw_id") -> DataFrame:
    """One row: how many ids are not numeric and how many repeat an earlier one."""
    ids = df.select(numeric_id(F.col(raw)).alias("id"))
    return ids.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("id").isNull()).alias("n_non_numeric"),
        (F.count("id") - F.count_distinct("id")).alias("n_duplicate"),
    )


def assign_doc_id(df: DataFrame, raw: str = "raw_id") -> DataFrame:
    """Replace the raw id by `doc_id`.

    Ids are kept if all are numeric and distinct; otherwise every row gets row_idx + 1, so
    that later joins on the id never fan out. Needs `row_idx` (see `with_row_idx`).
    """
    quality = id_quality(df, raw).first()
    keep = quality.n_non_numeric == 0 and quality.n_duplicate == 0
    doc_id = numeric_id(F.col(raw)) if keep else F.col("row_idx") + 1
    others = [c for c in df.columns if c != raw]
    return df.select(doc_id.alias("doc_id"), *others)
