"""Keyword tables, class-based TF-IDF and keyword labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.corpus import COUNTS, CTFIDF, STOP_WORDS, corpus, keyword_rows, text_corpus, token_rows, vectors, with_sql
from checks.registry import check
from checks.text import COUNTED, NGRAMS
from corpuslens.operators import keywords as k
from corpuslens.operators import labels as lb
from corpuslens.operators import vectors as v
from corpuslens.operators import weights as w

TOP = """SELECT topic, CAST(rank AS INT) AS rank, keyword, n FROM (
  SELECT topic, keyword, count(*) AS n, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, min(row_idx * 1000 + pos)) AS rank
  FROM {kw} WHERE topic <> -1 GROUP BY topic, keyword) WHERE rank <= {n}"""
TOP_TERMS = """SELECT topic, CAST(rank AS INT) AS rank, term, score FROM (
  SELECT topic, term, score, row_number() OVER (PARTITION BY topic ORDER BY round(score, 9) DESC, term) AS rank
  FROM weights WHERE topic <> -1) WHERE rank <= {n}"""
TERM_CTES = {"tok": token_rows(), "counts": COUNTS, "weights": CTFIDF}


def weights(spark, sf, seeds=None):
    return w.ctfidf(w.term_counts(text_corpus(spark, sf), stop_words=STOP_WORDS), seeds)


@check("topic_doc_counts", with_sql(COUNTED))
def topic_doc_counts(spark, sf):
    return k.topic_doc_counts(corpus(spark, sf))


@check("author_keyword_topn", with_sql(TOP.format(kw="kw", n=10), kw=keyword_rows("author_keywords")))
def author_keyword_topn(spark, sf):
    return k.keyword_topn(corpus(spark, sf), "author_keywords")


@check("mesh_topn", with_sql(TOP.format(kw="kw", n=10), kw=keyword_rows("mesh_terms")))
def mesh_topn(spark, sf):
    return k.keyword_topn(corpus(spark, sf), "mesh_terms")


@check("topn_per_group", with_sql("""SELECT run_id, doc_id, abstract_len, CAST(rank AS INT) AS rank FROM (
  SELECT run_id, doc_id, length(abstract) AS abstract_len, row_number() OVER (PARTITION BY run_id ORDER BY length(abstract) DESC, doc_id) AS rank
  FROM corpus) WHERE rank <= 5""".replace("abstract_len,", "CAST(abstract_len AS INT) AS abstract_len,", 1)))
def topn_per_group(spark, sf):
    docs = corpus(spark, sf).select("run_id", "doc_id", F.length("abstract").alias("abstract_len"))
    return k.top_n_per_group(docs, "run_id", [F.col("abstract_len").desc(), F.col("doc_id")], 5)


@check("ctfidf", with_sql("SELECT topic, term, tf, round(score, 6) AS score FROM weights", **TERM_CTES))
def ctfidf(spark, sf):
    return weights(spark, sf).select("topic", "term", "tf", F.round("score", 6).alias("score"))


@check("ctfidf_topn", with_sql(f"SELECT topic, rank, term, round(score, 6) AS score FROM ({TOP_TERMS.format(n=10)})", **TERM_CTES))
def ctfidf_topn(spark, sf):
    return w.ctfidf_topn(weights(spark, sf)).withColumn("score", F.round("score", 6))


@check("heaviest_ngrams", with_sql("""SELECT topic, term, tf, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 9) DESC, term) AS rank FROM weights WHERE topic <> -1)
  WHERE rank <= 100""", tok=NGRAMS, counts=COUNTS, weights=CTFIDF))
def heaviest_ngrams(spark, sf):
    docs = text_corpus(spark, sf)
    return w.heaviest_ngrams(docs, stop_words=STOP_WORDS).withColumn("score", F.round("score", 6))


@check("guided_terms", with_sql("""SELECT topic, term, round(CASE WHEN term IN (SELECT lower(lang) FROM documents) THEN 1.2 ELSE 1.0 END * score, 6) AS score
  FROM weights""", **TERM_CTES))
def guided_terms(spark, sf):
    """Seed words are the language codes, which occur as words in the texts."""
    seeds = spark.read.parquet(f"{sf}/documents.parquet").select(F.lower("lang").alias("term")).distinct()
    return weights(spark, sf, seeds).select("topic", "term", F.round("score", 6).alias("score"))


COMPARISON = {
    "akw": keyword_rows("author_keywords"), "mkw": keyword_rows("mesh_terms"), **TERM_CTES,
    "ctop": TOP_TERMS.format(n=10), "atop": TOP.format(kw="akw", n=10), "mtop": TOP.format(kw="mkw", n=10),
    "comparison": """SELECT t.topic, t.doc_count, coalesce(c_tf_idf, '') AS c_tf_idf, '' AS keybert,
      coalesce(author_keywords_freq, '') AS author_keywords_freq, coalesce(mesh_freq, '') AS mesh_freq
      FROM (SELECT topic, count(*) AS doc_count FROM corpus WHERE topic <> -1 GROUP BY topic) t
      LEFT JOIN (SELECT topic, string_agg(term, '; ' ORDER BY rank) AS c_tf_idf FROM ctop GROUP BY topic) a ON a.topic = t.topic
      LEFT JOIN (SELECT topic, string_agg(concat(keyword, '(', n, ')'), '; ' ORDER BY rank) AS author_keywords_freq FROM atop GROUP BY topic) b ON b.topic = t.topic
      LEFT JOIN (SELECT topic, string_agg(concat(keyword, '(', n, ')'), '; ' ORDER BY rank) AS mesh_freq FROM mtop GROUP BY topic) c ON c.topic = t.topic""",
}


def comparison(spark, sf):
    """The comparison without nearest terms, which have no SQL counterpart."""
    docs = corpus(spark, sf)
    terms = w.ctfidf_topn(weights(spark, sf))
    return k.keyword_comparison(
        k.topic_doc_counts(docs), terms, terms.where("false"),
        k.keyword_topn(docs, "author_keywords"), k.keyword_topn(docs, "mesh_terms"),
    )


@check("keyword_comparison", with_sql("SELECT * FROM comparison", **COMPARISON))
def keyword_comparison(spark, sf):
    return comparison(spark, sf)


KEYWORD_LABELS = """SELECT topic, array_to_string(t[1:3], ', ') AS label_en, array_to_string(t[1:3], ', ') AS label_kr,
  concat('주요 키워드: ', array_to_string(t[1:6], ', ')) AS description
  FROM (SELECT topic, string_split(c_tf_idf, '; ') AS t FROM comparison)"""


@check("keyword_labels", with_sql(KEYWORD_LABELS, **COMPARISON))
def keyword_labels(spark, sf):
    return lb.keyword_labels(comparison(spark, sf))


@check("reassign_outliers", with_sql("""SELECT c.doc_id, coalesce(b.best, c.topic) AS topic FROM corpus c LEFT JOIN (
    SELECT doc_id, arg_max(topic, sim) AS best FROM (
      SELECT d.doc_id, d.topic, struct_pack(s := round(d.dot / n.norm, 9), t := -d.topic) AS sim FROM (
        SELECT o.doc_id, w.topic, sum(o.tf * w.idf * w.score) AS dot
        FROM (SELECT doc_id, term, count(*) AS tf FROM tok WHERE topic = -1 GROUP BY doc_id, term) o
        JOIN weights w ON w.term = o.term AND w.topic <> -1 GROUP BY o.doc_id, w.topic) d
      JOIN (SELECT topic, sqrt(sum(score * score)) AS norm FROM weights GROUP BY topic) n ON n.topic = d.topic)
    GROUP BY doc_id) b ON b.doc_id = c.doc_id""", **TERM_CTES))
def reassign_outliers(spark, sf):
    return w.reassign_outliers(corpus(spark, sf), weights(spark, sf), stop_words=STOP_WORDS)


@check("keybert_terms")
def keybert_terms(spark, sf):
    vecs = vectors(spark, sf).select("doc_id", "embedding")
    return v.keybert_terms(text_corpus(spark, sf), vecs, stop_words=STOP_WORDS)
