"""Running totals over an order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.session import durable

_ROW_BITS = 33


def running_offset(df: DataFrame, order_by: list[str], value: str, name: str) -> DataFrame:
    """Add `name`: the sum of `value` over all rows before this one in the given order.

    The rows are range-partitioned once and stored; then only one number per partition
    has to be accumulated centrally.
    """
    stored = durable(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() % F.lit(1 << _ROW_BITS))
    )
    per_partition = stored.groupBy("_pid").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_partition.select("_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.join(F.broadcast(starts), "_pid")
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_pid", "_pos", "_start")
    )


def sequential_index(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Add `name` = 0, 1, 2, ... in the given order."""
    return running_offset(df.withColumn("_one", F.lit(1).cast("long")), order_by, "_one", name).drop("_one")
