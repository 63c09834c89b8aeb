"""Table schemas shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

OUTLIER = -1

CORPUS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("row_idx", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("author_keywords", T.StringType()),
    T.StructField("mesh_terms", T.StringType()),
])

TREND_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("label_kr", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("total_count", T.LongType()),
    T.StructField("year_min", T.IntegerType()),
    T.StructField("year_max", T.IntegerType()),
    T.StructField("mk_tau", T.DoubleType()),
    T.StructField("mk_p", T.DoubleType()),
    T.StructField("sen_slope", T.DoubleType()),
    T.StructField("cagr_pct", T.DoubleType()),
    T.StructField("trend_label", T.StringType()),
])

LABEL_ANSWER_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("topic", T.IntegerType()),
    T.StructField("label_en", T.StringType()),
    T.StructField("label_kr", T.StringType()),
    T.StructField("description", T.StringType()),
]))
