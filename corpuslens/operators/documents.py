"""Row-level operators on the corpus and its joins with topics and keywords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions import text as tx
from corpuslens.functions.numeric import plain_double
from corpuslens.session import durable, small_side

_MAX_INT = 2147483647


def clean_documents(docs: DataFrame, source: str = "abstract") -> DataFrame:
    """Add `abstract_clean`; the original text stays."""
    if source not in docs.columns:
        raise ValueError(f"no column {source!r} (columns={docs.columns})")
    return docs.withColumn("abstract_clean", tx.clean_text(F.col(source)))


def clean_empty_count(cleaned: DataFrame) -> DataFrame:
    """How many documents have no text left after cleaning."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.length("abstract_clean") == 0).alias("n_empty")
    )


def pick_text(docs: DataFrame) -> DataFrame:
    """Add `text`: the cleaned abstract if the table has one, else the abstract."""
    source = "abstract_clean" if "abstract_clean" in docs.columns else "abstract"
    return docs.withColumn("text", F.col(source))


def drop_blank(docs: DataFrame, text: str = "abstract") -> DataFrame:
    """Documents whose text is more than whitespace."""
    return docs.where(F.col(text).rlike(r"(?U)\S"))


def valid_years(docs: DataFrame, *, require_rows: bool = True) -> DataFrame:
    """Documents with a positive year, the year as INT; an integer column is filtered in the scan."""
    if isinstance(docs.schema["year"].dataType, (T.IntegerType, T.ShortType, T.ByteType)):
        kept = docs.where(F.col("year") > 0)
    else:
        number = plain_double(F.col("year"))
        kept = docs.withColumn(
            "year", F.when((number >= 1) & (number <= _MAX_INT), number.cast("int"))
        ).where(F.col("year").isNotNull())
    if require_rows and kept.isEmpty():
        raise ValueError("no document has a year > 0: map a year column, or leave out trends and report")
    return kept


def document_tokens(docs: DataFrame, text: str = "abstract", stop_words: Sequence[str] | str | None = None) -> DataFrame:
    """(doc_id, pos, term): one row per token in reading order."""
    return docs.select("doc_id", F.posexplode(tx.tokens(F.col(text), stop_words)).alias("pos", "term"))


def document_ngrams(
    docs: DataFrame,
    text: str = "abstract",
    stop_words: Sequence[str] | str | None = None,
    smallest: int = 1,
    largest: int = 3,
) -> DataFrame:
    """(doc_id, term, tf): word n-grams of every document with their frequency.

    Each text is counted by itself, where it is: its n-grams are sorted and equal ones stand together. Only texts that
    share their id with others (NULL is one id) have their counts shuffled and added up.
    """
    rows = docs.select("doc_id", F.col(text).alias("_text"))
    shared = durable(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or doc_id is null").select(F.col("doc_id").alias("_id")))
    each = lambda part: _text_ngrams(part, stop_words, smallest, largest)
    if shared.isEmpty():
        return each(rows)
    known, same = small_side(shared), F.col("doc_id").eqNullSafe(F.col("_id"))
    added = each(rows.join(known, same, "left_semi")).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    return each(rows.join(known, same, "left_anti")).unionByName(added)


def _text_ngrams(rows: DataFrame, stop_words: Sequence[str] | str | None, smallest: int, largest: int) -> DataFrame:
    """(doc_id, term, tf) of each row (doc_id, _text) by itself."""
    words = rows.select("doc_id", tx.tokens(F.col("_text"), stop_words).alias("_words"))
    ordered = words.select("doc_id", F.sort_array(tx.word_ngrams("_words", smallest, largest)).alias("_sorted"))
    places = F.when(F.size("_sorted") > 0, F.sequence(F.lit(0), F.size("_sorted") - 1))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)))
    runs = F.transform("_starts", lambda i, k: F.struct(
        F.get("_sorted", i).alias("term"), (F.coalesce(F.get("_starts", k + 1), F.size("_sorted")) - i).cast("long").alias("tf"),
    ))
    return ordered.withColumn("_starts", starts).select("doc_id", F.inline(runs))


def document_keywords(docs: DataFrame, column: str = "author_keywords") -> DataFrame:
    """(doc_id, pos, keyword): keywords of every document in their order."""
    return docs.select("doc_id", F.posexplode(tx.keyword_array(F.col(column))).alias("pos", "keyword"))


def labeled_docs(docs: DataFrame, assignment: DataFrame) -> DataFrame:
    """Documents with their topic; documents without one are left out."""
    return docs.join(assignment.select("doc_id", "topic"), "doc_id")


def docs_keywords(assignment: DataFrame, keywords: DataFrame) -> DataFrame:
    """Topic rows with the keyword columns; a table without one of them gives NULL."""
    wanted = [
        F.col(c) if c in keywords.columns else F.lit(None).cast("string").alias(c)
        for c in ("author_keywords", "mesh_terms")
    ]
    return assignment.select("doc_id", "topic").join(keywords.select("doc_id", *wanted), "doc_id", "left")


def with_author_keywords(docs: DataFrame, keywords: DataFrame | None) -> DataFrame | None:
    """Documents with author keywords, joined from a second table if they lack the column.

    Without either there is nothing to follow over the years: None.
    """
    if "author_keywords" in docs.columns:
        return docs
    if keywords is None:
        return None
    return docs.join(keywords.select("doc_id", "author_keywords"), "doc_id", "left")


def topics_labels(topics: DataFrame, labels: DataFrame) -> DataFrame:
    """Topic table with its labels, topics without a label kept."""
    return topics.join(small_side(labels), "topic", "left")


def name_lookup(rows: DataFrame, labels: DataFrame, name: str = "label_kr") -> DataFrame:
    """Add `label`: the topic's name, or 'Topic <id>' where it has none."""
    names = labels.select("topic", F.col(name).alias("_name"))
    fallback = F.concat(F.lit("Topic "), F.col("topic").cast("string"))
    return rows.join(small_side(names), "topic", "left").withColumn(
        "label", F.coalesce("_name", fallback)
    ).drop("_name")


def points_table(vectors: DataFrame, assignment: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Vector (or coordinates), topic and optionally title of every document, joined by id."""
    points = vectors.join(assignment.select("doc_id", "topic"), "doc_id")
    return points if titles is None else points.join(titles.select("doc_id", "title"), "doc_id", "left")
