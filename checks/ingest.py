"""Readers and ids. Files are written by Spark from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.corpus import corpus, table, with_sql
from checks.registry import check
from corpuslens import sources
from corpuslens.session import scratch_path

CORPUS_COLUMNS = "doc_id, year, title, abstract, author_keywords, mesh_terms"


def _escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@check("src_csv", with_sql("""SELECT CAST(doc_id AS VARCHAR) AS id, title, abstract AS body, CAST(year AS VARCHAR) AS pub_year,
  author_keywords AS tags, doc_id AS row_idx FROM corpus"""))
def src_csv(spark, sf):
    """Quotes and line breaks inside fields survive, and rows keep their order."""
    path = scratch_path(spark, "csv")
    docs = corpus(spark, sf).selectExpr("doc_id AS id", "title", "abstract AS body", "year AS pub_year", "author_keywords AS tags")
    docs.repartitionByRange("id").sortWithinPartitions("id").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return sources.with_row_idx(sources.read_csv(spark, path))


@check("src_jsonl", with_sql("SELECT doc_id AS id, abstract AS text, year, doc_id AS row_idx FROM corpus"))
def src_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    docs = corpus(spark, sf).selectExpr("doc_id AS id", "abstract AS text", "year")
    docs.repartitionByRange("id").sortWithinPartitions("id").write.json(path)
    return sources.with_row_idx(sources.read_jsonl(spark, path, "id LONG, text STRING, year INT"))


@check("src_id_list", with_sql("SELECT doc_id, title FROM corpus WHERE doc_id % 3 = 1"))
def src_id_list(spark, sf):
    path = scratch_path(spark, "ids")
    ids = table(spark, sf, "documents").where("doc_id % 3 = 1 OR doc_id % 10 = 5")
    ids.selectExpr("CASE WHEN doc_id % 3 = 1 THEN doc_id END AS pmid", "source").write.option("header", True).csv(path)
    return corpus(spark, sf).join(sources.read_citation_ids(spark, path), "doc_id", "left_semi").select("doc_id", "title")


@check("src_pubmed_xml", with_sql("""SELECT doc_id + 1 AS doc_id, year, title, concat('BACKGROUND: ', abstract, ' ', run_id) AS abstract,
  array_to_string(list_transform(list_filter(string_split(author_keywords, '; '), lambda k: trim(k) <> ''), lambda k: trim(k)), '; ') AS author_keywords,
  concat('Source ', run_id) AS mesh_terms FROM corpus WHERE doc_id % 17 <> 3"""))
def src_pubmed_xml(spark, sf):
    """Nested markup, labelled abstract parts, escaped text; records without an id are skipped."""
    path = scratch_path(spark, "citations")
    keywords = F.array_join(
        F.transform(F.split("author_keywords", "; "), lambda k: F.concat(F.lit("<Keyword>"), _escape(k), F.lit("</Keyword>"))), ""
    )
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation Status=\"x\">"),
        F.when(F.expr("doc_id % 17 <> 3"), F.concat(F.lit("<PMID>"), F.col("doc_id") + 1, F.lit("</PMID>"))).otherwise(""),
        F.lit("<Article><Journal><JournalIssue><PubDate>"),
        F.when(F.expr("doc_id % 2 = 0"), F.concat(F.lit("<Year>"), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit("</Year>")))
        .otherwise(F.concat(F.lit("<MedlineDate>"), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit(" Jan-Feb</MedlineDate>"))),
        F.lit("</PubDate></JournalIssue></Journal><ArticleTitle><i>"), _escape(F.col("title")), F.lit("</i></ArticleTitle>"),
        F.lit('<Abstract><AbstractText Label="BACKGROUND">'), _escape(F.col("abstract")),
        F.lit("</AbstractText><AbstractText><sub>"), F.col("run_id"), F.lit("</sub></AbstractText></Abstract></Article>"),
        F.lit("<KeywordList>"), keywords, F.lit("</KeywordList><MeshHeadingList><MeshHeading><DescriptorName>Source "),
        F.col("run_id"), F.lit("</DescriptorName><QualifierName>q</QualifierName></MeshHeading></MeshHeadingList>"),
        F.lit("</MedlineCitation></PubmedArticle>"),
    )
    corpus(spark, sf).select(xml.alias("value")).write.text(path)
    return sources.read_citations(spark, path).selectExpr(*CORPUS_COLUMNS.split(", "))


@check("src_arxiv_atom", with_sql("""SELECT title, abstract, CAST(year AS VARCHAR) AS year, concat('cs.', run_id, '; all') AS keywords
  FROM (SELECT title, trim(abstract, ' \n\t\r') AS abstract, year, run_id FROM corpus WHERE year IS NOT NULL)"""))
def src_arxiv_atom(spark, sf):
    path = scratch_path(spark, "atom")
    xml = F.concat(
        F.lit("<entry><title>"), _escape(F.col("title")), F.lit("</title><summary>"), _escape(F.col("abstract")),
        F.lit("</summary><published>"), F.col("year"), F.lit('-01-01T00:00:00Z</published><category term="cs.'), F.col("run_id"),
        F.lit('"/><category term="all"/></entry>'),
    )
    corpus(spark, sf).where("year IS NOT NULL").select(xml.alias("value")).write.text(path)
    return sources.read_atom_feed(spark, path).select("title", "abstract", "year", "keywords")


@check("map_columns", with_sql("""SELECT CAST(doc_id AS VARCHAR) AS raw_id, CAST(year AS VARCHAR) AS year, title, abstract,
  CAST(NULL AS VARCHAR) AS author_keywords, CAST(NULL AS VARCHAR) AS mesh_terms FROM corpus"""))
def map_columns(spark, sf):
    docs = corpus(spark, sf).selectExpr("doc_id AS id", "title", "abstract AS body", "year AS pub_year")
    return sources.map_columns(docs, {"text": "body", "doc_id": "id", "year": "pub_year"})


@check("assign_doc_id", """SELECT row_number() OVER (ORDER BY doc_id) AS doc_id, text AS abstract,
  CASE WHEN doc_id % 50 = 7 THEN concat('PMC', doc_id) ELSE CAST(doc_id AS VARCHAR) END AS given FROM documents""")
def assign_doc_id(spark, sf):
    """Some ids are not numeric, so all documents get 1..N in file order."""
    docs = table(spark, sf, "documents").select("*", *sources.files.origin_columns())
    docs = sources.with_row_idx(docs).withColumn(
        "given", F.expr("CASE WHEN doc_id % 50 = 7 THEN concat('PMC', doc_id) ELSE CAST(doc_id AS STRING) END")
    )
    mapped = docs.selectExpr("given AS raw_id", "given", "row_idx", "text AS abstract")
    return sources.assign_doc_id(mapped).drop("row_idx")


@check("id_quality", """SELECT count(*) AS n_rows, count(*) - count(id) AS n_non_numeric, count(id) - count(DISTINCT id) AS n_duplicate
  FROM (SELECT CASE WHEN doc_id % 50 = 7 THEN NULL ELSE doc_id // 2 END AS id FROM documents)""")
def id_quality(spark, sf):
    raw = F.expr("CASE WHEN doc_id % 50 = 7 THEN 'x1' ELSE CAST(doc_id DIV 2 AS STRING) END")
    return sources.id_quality(table(spark, sf, "documents").select(raw.alias("raw_id")))


@check("embeddings_load", """SELECT vec_id AS doc_id, CAST(len(embedding) AS INT) AS dim, round(CAST(embedding[1] AS DOUBLE), 6) AS x1,
  round(CAST(embedding[64] AS DOUBLE), 6) AS x64 FROM embeddings JOIN documents ON vec_id = doc_id""")
def embeddings_load(spark, sf):
    loaded = sources.load_embeddings(table(spark, sf, "embeddings"), table(spark, sf, "documents"), id_col="vec_id")
    return loaded.selectExpr("doc_id", "size(embedding) AS dim", "round(CAST(embedding[0] AS DOUBLE), 6) AS x1",
                             "round(CAST(embedding[63] AS DOUBLE), 6) AS x64")
