"""Topic labels made from keywords alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import strip

# Label delimiter inside a keyword list, description prefix, list lengths.
LIST_DELIMITER = ";"
DESCRIPTION_PREFIX = "주요 키워드: "
LABEL_TERMS = 3
DESCRIPTION_TERMS = 6


def _terms(comparison_column: str) -> Column:
    """Keyword list as an array; blank and 'nan' lists give NULL."""
    text = strip(F.col(comparison_column))
    parts = F.filter(F.transform(F.split(text, LIST_DELIMITER), strip), lambda t: t != "")
    return F.when((text != "") & (F.lower(text) != "nan"), parts)


def keyword_labels(comparison: DataFrame) -> DataFrame:
    """(topic, label_en, label_kr, description) from the first c-TF-IDF (else KeyBERT) terms."""
    terms = F.coalesce(_terms("c_tf_idf"), _terms("keybert"), F.array().cast("array<string>"))
    label = F.when(
        F.size("_terms") > 0, F.array_join(F.slice("_terms", 1, LABEL_TERMS), ", ")
    ).otherwise(F.concat(F.lit("Topic "), F.col("topic").cast("string")))
    description = F.when(
        F.size("_terms") > 0,
        F.concat(F.lit(DESCRIPTION_PREFIX), F.array_join(F.slice("_terms", 1, DESCRIPTION_TERMS), ", ")),
    ).otherwise(F.lit(""))
    return comparison.withColumn("_terms", terms).select(
        "topic", label.alias("label_en"), label.alias("label_kr"), description.alias("description")
    )
