"""Session settings, checkpointing and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
BROADCAST_ROWS = 200_000


def build_session(app: str = "corpuslens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application, whatever their working directory.

    The archive is built on the driver and served by Spark; executors on the driver's own machine use it as well.
    """
    context = spark.sparkContext
    if getattr(context, "_corpuslens_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="corpuslens-package-"), "corpuslens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, str(path.relative_to(package.parent)))
    context.addPyFile(archive)
    context._corpuslens_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a single-machine session that names none gets its own."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="corpuslens-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, so that every executor can read what is written."""
    return f"{shared_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from there.

    This cuts the lineage: a lost executor does not lose the rows, and what follows reads a
    Parquet table whose size the optimizer knows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `df` only after counting that it has at most `limit` rows.

    Meant for stored or checkpointed tables, where the count is cheap. A larger table is
    left to a shuffle join that adaptive execution may split.
    """
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """`df` for a join that doesn't broadcast it.

    Spark goes by the bytes of the stored table, which tell little of the rows made from it: a few MB of compressed
    numbers, exploded, are hundreds of MB on the driver.
    """
    return df.hint("merge")
