"""Keyword tables per topic: author keywords, controlled terms, and the comparison of all kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import keyword_array, keyword_occurrences
from corpuslens.schema import OUTLIER

TOP_N = 10
LANES = 64


def top_n_per_group(df: DataFrame, group: str, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First `n` rows of every group.

    Up to a limit of Spark's, 1000 rows, only `n` rows per task and group are shuffled to the group. Above it the rows
    are ranked by group and partition first, then by group and lane, so that no task gets more of a group than a
    partition, what the partitions of a lane kept, or LANES * n rows.
    """
    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        columns = df.columns
        df = df.withColumn("_part", F.spark_partition_id())
        for lane in (F.col("_part"), F.col("_part") % LANES):
            inside = Window.partitionBy(group, "_lane").orderBy(*order)
            df = df.withColumn("_lane", lane).withColumn("_r", F.row_number().over(inside)).where(F.col("_r") <= n)
        df = df.select(columns)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def topic_doc_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("topic").agg(F.count(F.lit(1)).alias("doc_count"))


def distinct_topics(docs: DataFrame) -> DataFrame:
    """Topic ids in use, the outlier id excluded."""
    return docs.where(F.col("topic") != OUTLIER).select("topic").distinct()


def keyword_counts(docs: DataFrame, column: str) -> DataFrame:
    """(topic, keyword, n, first_row, first_pos): occurrences per topic, outliers excluded.

    The first appearance settles ties like an insertion-ordered counter does. Both halves of it
    are plain numbers, which keeps the count a hash aggregate that combines before the shuffle.
    """
    words = docs.where(F.col("topic") != OUTLIER).select("topic", "row_idx", keyword_array(F.col(column)).alias("_words"))
    found = words.select("topic", "row_idx", F.inline(keyword_occurrences("_words")))
    return found.groupBy("topic", "keyword").agg(
        F.sum("occurrences").alias("n"),
        F.min("row_idx").alias("first_row"),
        F.min_by("pos", "row_idx").alias("first_pos"),
    )


def keyword_topn(docs: DataFrame, column: str, n: int = TOP_N) -> DataFrame:
    """(topic, rank, keyword, n): most frequent keywords of every topic."""
    order = [F.col("n").desc(), F.col("first_row"), F.col("first_pos")]
    top = top_n_per_group(keyword_counts(docs, column), "topic", order, n)
    return top.select("topic", "rank", "keyword", "n")


def term_list(ranked: DataFrame, name: str, term: Column, delimiter: str = "; ") -> DataFrame:
    """(topic, name): the ranked terms of a topic as one string."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank"), term.alias("_term"))))
    return ranked.groupBy("topic").agg(
        F.array_join(F.transform(ordered, lambda t: t["_term"]), delimiter).alias(name)
    )


def keyword_comparison(
    doc_counts: DataFrame,
    ctfidf_terms: DataFrame,
    keybert_terms: DataFrame,
    author_keywords: DataFrame,
    mesh_terms: DataFrame,
) -> DataFrame:
    """One row per topic with the four keyword lists; a missing list is ''.

    The inputs are top-N tables (topic, rank, term) and (topic, rank, keyword, n).
    """
    counted = F.concat(F.col("keyword"), F.lit("("), F.col("n").cast("string"), F.lit(")"))
    lists = {
        "c_tf_idf": term_list(ctfidf_terms, "c_tf_idf", F.col("term")),
        "keybert": term_list(keybert_terms, "keybert", F.col("term")),
        "author_keywords_freq": term_list(author_keywords, "author_keywords_freq", counted),
        "mesh_freq": term_list(mesh_terms, "mesh_freq", counted),
    }
    table = doc_counts.where(F.col("topic") != OUTLIER).select("topic", "doc_count")
    for name, terms in lists.items():
        table = table.join(terms, "topic", "left").withColumn(name, F.coalesce(name, F.lit("")))
    return table
