"""Reading the driver's tables and registering the queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def exact(table: DataFrame, *names: str) -> DataFrame:
    """The first column of exactly each name; columns whose names differ in case or repeat stay out of the way."""
    there = table.columns
    plain = table.toDF(*(f"_{k}" for k in range(len(there))))
    return plain.select(*(F.col(f"_{there.index(n)}").alias(n) for n in names))


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator works on."""
    return exact(docs, "doc_id", "text", *more)


def packed_rows(docs: DataFrame, *made: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(`_row`, `text`) with all other columns in the struct `_row`, and the way back.

    The way back, given a table with `_row`, `text` and the columns `made`, returns the columns of `docs` in their
    order, with the new text, and the made columns; made ones replace columns of `docs` of the same name.
    """
    names = docs.columns
    at = names.index("text")
    plain = docs.toDF(*(f"_{k}" for k in range(len(names))))
    others = [F.col(f"_{k}") for k in range(len(names)) if k != at] or [F.lit(0).alias("_none")]
    rows = plain.select(F.struct(*others).alias("_row"), F.col(f"_{at}").alias("text"))

    def unpacked(table: DataFrame) -> DataFrame:
        kept = [F.col("text") if k == at else F.col("_row")[f"_{k}"].alias(n) for k, n in enumerate(names) if n not in made]
        return table.select(*kept, *made)

    return rows, unpacked
