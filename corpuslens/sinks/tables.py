"""Stage tables, kept apart by run."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


MANIFEST = T.StructType([T.StructField("table", T.StringType()), T.StructField("folder", T.StringType())])


def resolve_run_id(run_id: str) -> str:
    """'auto' gives the current time; resolve it once for all tables of a run."""
    return datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S") if run_id == "auto" else run_id


def run_path(base: str, run_id: str) -> str:
    """Folder of one run; run id 'auto' stands for the current time."""
    return f"{base.rstrip('/')}/run_id={resolve_run_id(run_id)}"


def write_table(df: DataFrame, base: str, run_id: str, table: str, partition_by: list[str] | None = None) -> str:
    """Write one stage table as Parquet and return its path."""
    path = f"{run_path(base, run_id)}/{table}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def read_table(spark: SparkSession, base: str, run_id: str, table: str, schema: T.StructType) -> DataFrame:
    """Read a stage table; a table that was never written reads as empty."""
    path = f"{run_path(base, run_id)}/{table}"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def saved_run(spark: SparkSession, base: str, run_id: str) -> dict[str, DataFrame]:
    """The tables of a published run by name; none if the run was never finished.

    The manifest is one small file that is written last, so a run that was stopped half-way reads as absent.
    """
    listed = read_table(spark, base, run_id, "manifest", MANIFEST).collect()
    return {r.table: spark.read.parquet(f"{run_path(base, run_id)}/{r.folder}") for r in listed}


def publish_run(tables: dict[str, DataFrame], base: str, run_id: str) -> dict[str, str]:
    """Write all tables of a run, then its manifest; returns the paths.

    Each attempt has a folder of its own, so a second writer or what a stopped one left can't mix with it. A run that is
    published already is refused.
    """
    if not tables:
        raise ValueError("a run needs at least one table")
    spark = next(iter(tables.values())).sparkSession
    refused = f"run {run_id} is published already below {base}"
    if saved_run(spark, base, run_id):
        raise FileExistsError(refused)
    attempt = f"attempt={uuid.uuid4().hex}"
    paths = {name: write_table(df, base, run_id, f"{attempt}/{name}") for name, df in tables.items()}
    if saved_run(spark, base, run_id):
        raise FileExistsError(refused)
    write_table(spark.createDataFrame([(n, f"{attempt}/{n}") for n in paths], MANIFEST).coalesce(1), base, run_id, "manifest")
    return paths


def export_csv(df: DataFrame, path: str, *, bom: bool = False, list_delimiter: str = "; ") -> None:
    """CSV with a header for other programs; arrays of strings are joined.

    `bom` puts a byte-order mark before the header of every part file, as spreadsheet
    programs like to see.
    """
    flat = [
        F.array_join(c, list_delimiter).alias(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c)
        for c in df.columns
    ]
    out = df.select(*flat)
    if bom and out.columns:
        out = out.withColumnRenamed(out.columns[0], "﻿" + out.columns[0])
    out.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
