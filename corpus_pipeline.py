"""Training-data pipeline: quality rules, line dedup, near-dedup, PII redaction, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.lines import dedup_lines
from corpuslens.llm.listed import parted
from corpuslens.llm.minhash import first_copies
from corpuslens.llm.packing import pack_documents
from corpuslens.llm.pii import redact
from corpuslens.llm.quality import quality_rules
from corpuslens.llm.tables import packed_rows
from corpuslens.session import durable


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, follows the text."""
    names = docs.columns
    plain = docs.toDF(*(f"_{k}" for k in range(len(names))))
    length = F.char_length(f"_{names.index('text')}").cast("long")
    return plain.select(*((length if n == "n_chars" else F.col(f"_{k}")).alias(n) for k, n in enumerate(names)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules reject go, each by its own text, lang and source: doc_id may be NULL or repeated.

    NULL and empty texts have no words and go. Other columns stay as they are, whatever their names.
    """
    names = docs.columns
    judged = [F.coalesce(F.col("_row")[f"_{names.index(n)}"].cast("string"), F.lit("")) for n in ("lang", "source")]
    packed, unpacked = packed_rows(docs)
    parts = [F.coalesce("text", F.lit("")), *judged]
    keyed = packed.withColumn("key", F.concat_ws(":", F.xxhash64(*parts), F.hash(*parts)))
    named = keyed.select(F.col("key").alias("doc_id"), "text", judged[0].alias("lang"), judged[1].alias("source"))
    rejected = durable(quality_rules(named).where("not kept").select(F.col("doc_id").alias("key")).distinct())
    return unpacked(parted(keyed, rejected, ["key"])[1])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go. All rows stay; NULL texts become empty. doc_id is not looked at."""
    packed, unpacked = packed_rows(docs)
    return _recounted(unpacked(dedup_lines(packed)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest doc_id, of equal rows any one. Rows
    without doc_id stay if their group has no other, one of them; texts without words all stay."""
    return first_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in a text is replaced by its kind in brackets. All rows stay, NULL texts too."""
    return _recounted(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids, in sequences; the last stage, so its columns are its own."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_dedup),
    ("pii_redaction", pii),
    ("packing", packing),
]
#: Robust estimates, signatures, trees and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
