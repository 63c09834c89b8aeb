"""The corpus every check runs on: whole `documents`, with years, keywords and topics derived by SQL.

The same SELECT runs in Spark and, as a CTE, in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslens.sources import spread

CORPUS_SQL = """
SELECT d.doc_id AS doc_id, d.doc_id AS row_idx,
  CASE WHEN d.doc_id % 41 = 0 THEN NULL
       ELSE CAST(2000 + CAST(floor(d.doc_id / 5) AS BIGINT) % 12 AS INT) END AS year,
  concat(d.source, ' ', CAST(d.doc_id AS VARCHAR(20))) AS title,
  d.text AS abstract,
  concat_ws('; ',
    concat('Kw', CAST(d.doc_id % 13 AS VARCHAR(20))), d.lang,
    CASE WHEN (d.doc_id * 7919) % 101 < 10 * (CAST(floor(d.doc_id / 5) AS BIGINT) % 12) THEN 'Rising' END,
    CASE WHEN (d.doc_id * 6101) % 97 < 110 - 10 * (CAST(floor(d.doc_id / 5) AS BIGINT) % 12) THEN ' falling ' END,
    CASE WHEN d.doc_id % 97 = 0 THEN 'Rare' END,
    CASE WHEN d.doc_id % 29 = 0 THEN 'rising' END) AS author_keywords,
  concat_ws('; ',
    CASE WHEN d.doc_id % 3 = 0 THEN 'Humans' END, concat('Source ', d.source),
    CASE WHEN d.doc_id % 7 = 0 THEN ' humans ' END, CASE WHEN d.doc_id % 11 = 0 THEN upper(d.lang) END) AS mesh_terms,
  d.source AS run_id,
  coalesce(e.label, -1) AS topic
FROM {documents} d LEFT JOIN {embeddings} e ON e.vec_id = d.doc_id
"""

LABELS_SQL = """
SELECT DISTINCT label AS topic,
  concat('theme ', CAST(label AS VARCHAR(20))) AS label_en,
  concat('주제 ', CAST(label AS VARCHAR(20))) AS label_kr,
  concat('about ', CAST(label AS VARCHAR(20))) AS description
FROM {embeddings} WHERE label <> 7
"""

# Words removed where a check asks for stop words.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "die", "der", "und", "das", "les", "des", "que", "de", "la", "el"]

TABLES = {"documents": "documents", "embeddings": "embeddings"}
STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(CORPUS_SQL, documents=table(spark, sf, "documents"), embeddings=table(spark, sf, "embeddings"))


def text_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows for queries that work on the texts: a small table is spread over the cores."""
    documents = spread(table(spark, sf, "documents"))
    return spark.sql(CORPUS_SQL, documents=documents, embeddings=table(spark, sf, "embeddings"))


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LABELS_SQL, embeddings=table(spark, sf, "embeddings"))


def assignment(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf).select("doc_id", "topic")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, embedding, topic) of the stored vectors."""
    e = table(spark, sf, "embeddings")
    return e.selectExpr("vec_id AS doc_id", "embedding", "label AS topic")


def with_sql(body: str, **ctes: str) -> str:
    """A DuckDB statement over the corpus with further named CTEs."""
    parts = {"corpus": CORPUS_SQL.format(**TABLES), "labels": LABELS_SQL.format(**TABLES), **ctes}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + body


def keyword_rows(column: str) -> str:
    """DuckDB: one row per keyword mention."""
    return f"""SELECT doc_id, row_idx, year, topic, run_id, pos, lower(trim(k)) AS keyword FROM (
      SELECT *, unnest(string_split({column}, '; ')) AS k,
             generate_subscripts(string_split({column}, '; '), 1) AS pos
      FROM corpus WHERE {column} IS NOT NULL) WHERE trim(k) <> ''"""


def token_rows(stop: bool = True) -> str:
    """DuckDB: one row per token."""
    kept = f"WHERE term NOT IN ({STOP_LIST})" if stop else ""
    return f"""SELECT doc_id, topic, pos, term FROM (
      SELECT doc_id, topic, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM (
        SELECT doc_id, topic, regexp_extract_all(lower(abstract), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM corpus)) {kept}"""


CTFIDF = """SELECT c.topic, c.term, c.tf, ln(1 + a.a / f.f) AS idf, c.tf / w.w * ln(1 + a.a / f.f) AS score
  FROM counts c JOIN (SELECT term, sum(tf) AS f FROM counts GROUP BY term) f ON f.term = c.term
  JOIN (SELECT topic, sum(tf) AS w FROM counts GROUP BY topic) w ON w.topic = c.topic
  CROSS JOIN (SELECT CAST(floor(avg(w)) AS DOUBLE) AS a FROM (SELECT sum(tf) AS w FROM counts GROUP BY topic)) a"""
COUNTS = "SELECT topic, term, count(*) AS tf FROM tok GROUP BY topic, term"
