"""Readers for text corpora kept in files.

Every reader adds where a row came from (`src_file`, `src_block`, `src_row`), from which
`with_row_idx` derives the position in file order without sorting the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.session import small_side
from corpuslens.sources.order import running_offset

ORIGIN = ["src_file", "src_block", "src_row"]


def origin_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    ]


def _with_origin(df: DataFrame) -> DataFrame:
    return df.select("*", *origin_columns())


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    multi_line: bool = True,
    na_values: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header; all columns STRING unless a schema is given.

    Quoted line breaks need `multi_line`, which reads each file in one task: keep such files
    small, or switch it off for one-line records so that Spark can split large files.
    `na_values` lists texts to read as missing besides the empty field.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"', **options)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    if na_values:
        df = df.select(*[
            F.when(~F.col(f"`{c}`").isin(na_values), F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ] + origin_columns())
        return df
    return _with_origin(df)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line; the schema is given so that the data is read once."""
    return _with_origin(spark.read.schema(schema).json(path))


def read_text_folder(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """Every matching file is a document: (doc_id, title, text), file stem as id and title."""
    files = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    if not files.inputFiles():
        raise ValueError(f"no file matches {glob} in {path}")
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"(?<=.)\.[^.]*$", "")
    return files.select(
        stem.alias("doc_id"),
        stem.alias("title"),
        F.expr("make_valid_utf8(value)").alias("text"),
        *origin_columns(),
    )


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table stored in a few blocks.

    A scan with at least two partitions per core, like that of any large table, stays as it is;
    only a smaller one is redistributed before costly work on its rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(cores)


def read_citation_ids(spark: SparkSession, path: str, column: str = "pmid") -> DataFrame:
    """Id list from a CSV: nulls dropped, cast to BIGINT; use it as a semi-join filter."""
    df = spark.read.options(header=True).csv(path)
    if column not in df.columns:
        raise ValueError(f"no column {column!r} in {path} (columns={df.columns})")
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").cast("long").alias("doc_id"))


def with_row_idx(df: DataFrame) -> DataFrame:
    """Add `row_idx` = 0.. in file order: files by path, rows by position.

    Rows of one block stay in order inside one partition, so counting the blocks and adding
    up the counts is enough; the rows themselves are neither sorted nor shuffled.
    """
    blocks = df.groupBy("src_file", "src_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("src_row").alias("_first")
    )
    offsets = running_offset(blocks, ["src_file", "src_block"], "_rows", "_offset").drop("_rows")
    joined = df.join(small_side(offsets), ["src_file", "src_block"])
    return joined.withColumn("row_idx", F.col("_offset") + F.col("src_row") - F.col("_first")).drop(
        "_offset", "_first", *ORIGIN
    )
