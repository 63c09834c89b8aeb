"""Tables behind the report: summary, cards, scatter points, density contours, result bundle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.documents import name_lookup, points_table
from corpuslens.operators.quality import BLOCK_ROWS
from corpuslens.schema import OUTLIER
from corpuslens.session import durable, small_side
from corpuslens.sources.order import sequential_index

# Fixed values of the density contour: grid points per axis, margin, own-point quantile, least points.
GRID = 100
MARGIN = 1.0
LEVEL = 0.20
LEAST_POINTS = 10
_HELD_GRIDS = 64


def corpus_summary(docs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents, classified, outliers (and percent), topics and year range, per group of `by`."""
    sizes = docs.groupBy(*by, "topic").agg(
        F.count(F.lit(1)).alias("n"), F.min("year").alias("lo"), F.max("year").alias("hi")
    )
    inside = F.when(F.col("topic") != OUTLIER, F.col("n"))
    total, classified = F.sum("n"), F.coalesce(F.sum(inside), F.lit(0).cast("long"))
    return sizes.groupBy(*by).agg(
        total.alias("total_docs"),
        classified.alias("n_classified"),
        (total - classified).alias("n_outliers"),
        (100.0 * (total - classified) / total).alias("outlier_pct"),
        F.count(inside).alias("n_topics"),
        F.min("lo").alias("year_min"),
        F.max("hi").alias("year_max"),
    )


def docs_per_year(docs: DataFrame) -> DataFrame:
    return docs.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def topics_by_size(topics: DataFrame) -> DataFrame:
    return topics.orderBy(F.col("doc_count").desc(), "topic")


def topic_cards(comparison: DataFrame, labels: DataFrame) -> DataFrame:
    """Topics by size with labels, description and the four keyword lists."""
    names = labels.select("topic", "label_en", "label_kr", "description")
    return topics_by_size(comparison.join(small_side(names), "topic", "left").select(
        "topic", "doc_count", "label_en", "label_kr", "description",
        "c_tf_idf", "keybert", "author_keywords_freq", "mesh_freq",
    ))


def scatter_points(coords: DataFrame, assignment: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, x, y, topic, label, topic_docs) of every document, outliers included.

    Topic sizes are counted once and looked up; the documents are not gathered by topic.
    """
    points = points_table(coords, assignment)
    sizes = small_side(durable(points.groupBy("topic").agg(F.count(F.lit(1)).alias("topic_docs"))))
    named = name_lookup(points.join(sizes, "topic", "left"), labels)
    label = F.when(F.col("topic") == OUTLIER, F.lit("Outlier")).otherwise(F.col("label"))
    return named.select(
        "doc_id", F.col("coords")[0].alias("x"), F.col("coords")[1].alias("y"), "topic",
        label.alias("label"), "topic_docs",
    )


def _kernel_parameters(points: DataFrame) -> DataFrame:
    """Scott bandwidth of every topic with enough points: the inverse covariance and the scale."""
    stats = points.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("vxy"),
        F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"),
    ).where(F.col("n") >= LEAST_POINTS)
    factor = F.pow(F.col("n").cast("double"), F.lit(-1.0 / 6.0))
    det = F.col("vx") * F.col("vy") - F.col("vxy") * F.col("vxy")
    return stats.where(det > 0).select(
        "topic", "n",
        (F.col("vy") / (det * factor * factor)).alias("ixx"),
        (F.col("vx") / (det * factor * factor)).alias("iyy"),
        (-F.col("vxy") / (det * factor * factor)).alias("ixy"),
        (1.0 / (F.col("n") * 2.0 * F.lit(np.pi) * factor * factor * F.sqrt(det))).alias("scale"),
        (F.col("x_lo") - MARGIN).alias("gx"), ((F.col("x_hi") - F.col("x_lo") + 2 * MARGIN) / (GRID - 1)).alias("dx"),
        (F.col("y_lo") - MARGIN).alias("gy"), ((F.col("y_hi") - F.col("y_lo") + 2 * MARGIN) / (GRID - 1)).alias("dy"),
    )


def _kernel_sums(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, p) -> np.ndarray:
    """Sum over b of the unscaled Gaussian kernel at every a."""
    total = np.empty(len(ax))
    step = max(1, 2_000_000 // max(1, len(bx)))
    for i in range(0, len(ax), step):
        ux, uy = ax[i:i + step, None] - bx[None, :], ay[i:i + step, None] - by[None, :]
        total[i:i + step] = np.exp(-0.5 * (p.ixx * ux * ux + p.iyy * uy * uy + 2 * p.ixy * ux * uy)).sum(1)
    return total


def _grid_partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Density of a task's points on their topics' grids."""
    axis = np.arange(GRID)
    ix, iy = (a.ravel() for a in np.meshgrid(axis, axis))
    held: dict[int, np.ndarray] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for topic, total in held.items():
            yield pd.DataFrame({"topic": topic, "ix": ix, "iy": iy, "part": total})
        held.clear()

    for pdf in batches:
        for topic, rows in pdf.groupby("topic"):
            p = rows.iloc[0]
            sums = _kernel_sums(
                p.gx + ix * p.dx, p.gy + iy * p.dy, rows["x"].to_numpy(), rows["y"].to_numpy(), p
            )
            held[topic] = held[topic] + p["scale"] * sums if topic in held else p["scale"] * sums
            if len(held) > _HELD_GRIDS:
                yield from flush()
    yield from flush()


def _block_densities(pdf: pd.DataFrame) -> pd.DataFrame:
    """Kernel sums between two blocks of one topic's points, per point."""
    lo, hi = pdf["_lo"].iloc[0], pdf["_hi"].iloc[0]
    p = pdf.iloc[0]
    first, second = pdf[pdf["_block"] == lo], pdf[pdf["_block"] == hi]
    pairs = [(first, second)] if lo == hi else [(first, second), (second, first)]
    return pd.concat([
        pd.DataFrame({
            "topic": a["topic"], "doc_id": a["doc_id"],
            "part": p["scale"] * _kernel_sums(
                a["x"].to_numpy(), a["y"].to_numpy(), b["x"].to_numpy(), b["y"].to_numpy(), p
            ),
        })
        for a, b in pairs
    ])


def own_densities(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(topic, doc_id, density): the topic's kernel density at each of its own points.

    Points are hashed into even blocks within their topic, and two blocks at a time are
    compared in numpy; the work of a large topic is spread over its pairs of blocks.
    """
    params = small_side(durable(_kernel_parameters(points)))
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    spread = (
        points.join(params, "topic")
        .withColumn("_block", F.pmod(F.xxhash64("doc_id"), blocks.cast("long")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("_lo", F.least("_block", "_with"))
        .withColumn("_hi", F.greatest("_block", "_with"))
        .drop("_with")
    )
    partial = spread.groupBy("topic", "_lo", "_hi").applyInPandas(
        _block_densities, "topic int, doc_id long, part double"
    )
    return partial.groupBy("topic", "doc_id").agg(F.sum("part").alias("density"))


def contour_levels(densities: DataFrame, level: float = LEVEL) -> DataFrame:
    """(topic, threshold): interpolated quantile of every topic's own densities.

    The densities are sorted over the cluster and only the two rows around the quantile are
    read, so no topic is gathered in one task.
    """
    indexed = sequential_index(densities.select("topic", "density"), ["topic", "density"], "_idx")
    spans = indexed.groupBy("topic").agg(F.min("_idx").alias("_from"), F.count(F.lit(1)).alias("_n"))
    position = F.col("_from") + (F.col("_n") - 1) * F.lit(level)
    spans = small_side(durable(spans.select(
        "topic", F.floor(position).alias("_low"), F.ceil(position).alias("_high"),
        (position - F.floor(position)).alias("_part"),
    )))
    around = indexed.join(spans, "topic").where(F.col("_idx").isin(F.col("_low"), F.col("_high")))
    low = F.min("density")
    return around.groupBy("topic").agg(
        (low + F.first("_part") * (F.max("density") - low)).alias("threshold")
    )


def density_grid(points: DataFrame, level: float = LEVEL) -> DataFrame:
    """(topic, ix, iy, x, y, density, threshold): kernel density of every topic on a 100 x 100 grid.

    `points` is (doc_id, topic, x, y). Topics under ten points or without spread have no rows.
    A task adds up the density of its own points on each grid, so the grids, not the points,
    are shuffled. `threshold` is the density that encloses 1 - `level` of the topic's points.
    """
    inside = points.where(F.col("topic") != OUTLIER).select("doc_id", F.col("topic").cast("int").alias("topic"), "x", "y")
    params = small_side(durable(_kernel_parameters(inside)))
    partial = inside.join(params, "topic").mapInPandas(
        _grid_partials, "topic int, ix int, iy int, part double"
    )
    grid = partial.groupBy("topic", "ix", "iy").agg(F.sum("part").alias("density"))
    thresholds = contour_levels(own_densities(inside), level)
    origin = params.select("topic", "gx", "dx", "gy", "dy")
    return grid.join(origin, "topic").join(thresholds, "topic", "left").select(
        "topic", "ix", "iy",
        (F.col("gx") + F.col("ix") * F.col("dx")).alias("x"),
        (F.col("gy") + F.col("iy") * F.col("dy")).alias("y"),
        "density", "threshold",
    )


def results_bundle(summary: DataFrame, metrics: DataFrame, ranking: DataFrame) -> DataFrame:
    """(run_id, bundle): one JSON document per run with summary, metrics and topics in rank order.

    `summary` and `metrics` have one row per run, `ranking` has (run_id, rank, topic, label_kr,
    label_en, description, tier). NaN becomes null, which JSON can hold.
    """

    def packed(df: DataFrame, name: str) -> DataFrame:
        fields = [
            F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes if c != "run_id"
        ]
        return df.select("run_id", F.struct(*fields).alias(name))

    topic = F.struct("rank", "topic", "label_kr", "label_en", "description", "tier")
    topics = ranking.groupBy("run_id").agg(F.array_sort(F.collect_list(topic)).alias("topics"))
    runs = packed(summary, "summary").join(packed(metrics, "metrics"), "run_id", "left").join(topics, "run_id", "left")
    content = F.struct("summary", "metrics", "topics")
    return runs.select("run_id", F.to_json(content, {"ignoreNullFields": "false"}).alias("bundle"))
