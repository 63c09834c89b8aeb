"""Cleaning, tokens, keyword lists, joins with topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.corpus import (
    STOP_LIST, STOP_WORDS, assignment, corpus, keyword_rows, labels, text_corpus, token_rows, vectors,
    with_sql,
)
from checks.registry import check
from corpuslens.operators import documents as d
from corpuslens.operators import keywords as k

# Every cleaning rule occurs in this text, which some documents get appended.
NOISE = " see https://x.org/a [3, 4-5] 10.1234/ab.c 7.5 www.y.z [12] 42% End"
NOISY = f"CASE WHEN doc_id % 3 = 0 THEN concat(abstract, '{NOISE}') ELSE abstract END"
CLEANED = (
    f"SELECT doc_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace({NOISY}, "
    r"'https?://\S+|www\.\S+', ' ', 'g'), '\b10\.\d{4,}/\S+', ' ', 'g'), '\[\s*\d+(?:\s*[-,]\s*\d+)*\s*\]', ' ', 'g'), "
    r"'\b\d+(?:\.\d+)?\b', ' ', 'g')), '\s+', ' ', 'g')) AS abstract_clean FROM corpus"
)


def noisy(spark, sf):
    return text_corpus(spark, sf).withColumn("abstract", F.expr(NOISY))


@check("clean_text", with_sql("SELECT * FROM cleaned", cleaned=CLEANED))
def clean_text(spark, sf):
    return d.clean_documents(noisy(spark, sf)).select("doc_id", "abstract_clean")


# One document in twenty keeps nothing but what cleaning removes.
MOSTLY = "CASE WHEN doc_id % 20 = 0 THEN ' [1, 2] 42 www.a.b ' ELSE abstract END"


@check("clean_empty_count", with_sql("""SELECT count(*) AS n_docs, count(*) FILTER (doc_id % 20 = 0 OR NOT regexp_matches(abstract, '[^\\s\\d.]')) AS n_empty
  FROM corpus"""))
def clean_empty_count(spark, sf):
    docs = text_corpus(spark, sf).withColumn("abstract", F.expr(MOSTLY))
    return d.clean_empty_count(d.clean_documents(docs))


@check("pick_text", with_sql("SELECT doc_id, abstract_clean AS text FROM cleaned", cleaned=CLEANED))
def pick_text(spark, sf):
    return d.pick_text(d.clean_documents(noisy(spark, sf))).select("doc_id", "text")


@check("drop_blank", with_sql("SELECT doc_id, abstract FROM corpus WHERE doc_id % 9 NOT IN (1, 2)"))
def drop_blank(spark, sf):
    blank = "CASE doc_id % 9 WHEN 1 THEN NULL WHEN 2 THEN concat(' ', chr(10), chr(9)) ELSE abstract END"
    docs = corpus(spark, sf).withColumn("abstract", F.expr(blank))
    return d.drop_blank(docs).select("doc_id", "abstract")


@check("year_filter", with_sql("SELECT doc_id, year FROM corpus WHERE year > 0 AND doc_id % 6 NOT IN (1, 2)"))
def year_filter(spark, sf):
    """Years come as text: some with decimals, some not numeric, some zero or negative."""
    text = """CASE doc_id % 6 WHEN 1 THEN 'n.d.' WHEN 2 THEN concat('-', year) WHEN 3 THEN concat(year, '.0')
              ELSE CAST(year AS STRING) END"""
    return d.valid_years(corpus(spark, sf).withColumn("year", F.expr(text))).select("doc_id", "year")


@check("split_keywords", with_sql("""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INT) AS pos, keyword
  FROM kw""", kw=keyword_rows("author_keywords")))
def split_keywords(spark, sf):
    return d.document_keywords(corpus(spark, sf))


@check("tokenize", with_sql("""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INT) AS pos, term FROM tok""",
                            tok=token_rows()))
def tokenize(spark, sf):
    return d.document_tokens(text_corpus(spark, sf), stop_words=STOP_WORDS)


NGRAMS = f"""SELECT doc_id, topic, unnest(list_concat(t,
    list_transform(range(1, len(t)), lambda i: concat(t[i], ' ', t[i + 1])),
    list_transform(range(1, len(t) - 1), lambda i: concat(t[i], ' ', t[i + 1], ' ', t[i + 2])))) AS term
  FROM (SELECT doc_id, topic, list_filter(regexp_extract_all(lower(abstract), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
        lambda w: w NOT IN ({STOP_LIST})) AS t FROM corpus)"""


@check("ngrams_1_3", with_sql("SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term", grams=NGRAMS))
def ngrams_1_3(spark, sf):
    return d.document_ngrams(text_corpus(spark, sf), stop_words=STOP_WORDS)


@check("labeled_docs", with_sql("SELECT c.doc_id, c.year, c.title, e.label AS topic FROM corpus c JOIN embeddings e ON e.vec_id = c.doc_id"))
def labeled_docs(spark, sf):
    docs = corpus(spark, sf).select("doc_id", "year", "title")
    return d.labeled_docs(docs, vectors(spark, sf))


@check("docs_keywords", with_sql("""SELECT doc_id, topic, CASE WHEN doc_id % 4 > 0 THEN author_keywords END AS author_keywords,
  CAST(NULL AS VARCHAR) AS mesh_terms FROM corpus"""))
def docs_keywords(spark, sf):
    """A quarter of the documents has no row, and the table has no controlled terms."""
    keywords = corpus(spark, sf).where("doc_id % 4 > 0").select("doc_id", "author_keywords")
    return d.docs_keywords(assignment(spark, sf), keywords)


COUNTED = "SELECT topic, count(*) AS doc_count FROM corpus GROUP BY topic"


@check("topics_labels", with_sql("""SELECT t.topic, t.doc_count, label_en, label_kr, description FROM counted t
  LEFT JOIN labels l ON l.topic = t.topic""", counted=COUNTED))
def topics_labels(spark, sf):
    return d.topics_labels(k.topic_doc_counts(corpus(spark, sf)), labels(spark, sf))


@check("name_lookup", with_sql("""SELECT c.doc_id, c.topic, coalesce(l.label_kr, concat('Topic ', CAST(c.topic AS VARCHAR))) AS label
  FROM corpus c LEFT JOIN labels l ON l.topic = c.topic"""))
def name_lookup(spark, sf):
    return d.name_lookup(assignment(spark, sf), labels(spark, sf))


@check("points_table", with_sql("""SELECT e.vec_id AS doc_id, e.label AS topic, c.title, round(CAST(e.embedding[1] AS DOUBLE), 6) AS x
  FROM embeddings e JOIN corpus c ON c.doc_id = e.vec_id"""))
def points_table(spark, sf):
    v = vectors(spark, sf)
    points = d.points_table(v.select("doc_id", "embedding"), assignment(spark, sf), corpus(spark, sf))
    return points.selectExpr("doc_id", "topic", "title", "round(CAST(embedding[0] AS DOUBLE), 6) AS x")


@check("topic_set_difference", with_sql("SELECT DISTINCT topic FROM corpus WHERE topic <> -1"))
def topic_set_difference(spark, sf):
    return k.distinct_topics(corpus(spark, sf))
