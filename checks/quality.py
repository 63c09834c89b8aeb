"""Metrics of given topics, and a sweep over minimum sizes made from the corpus.

For every size of the grid, (language, source) groups of at least that size are topics and all
other documents are outliers.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.corpus import corpus, table, vectors, with_sql
from checks.registry import check
from corpuslens.operators import cells
from corpuslens.operators import quality as q
from corpuslens.operators.vectors import reduce_dims
from corpuslens.session import durable

GRID = """SELECT CAST(idx AS INT) AS grid_idx, CAST(round_even(CASE WHEN c <= 10 THEN 10.0 WHEN idx < 5 THEN 10 * pow(r, idx) ELSE c * pow(r, idx - 4) END, 0) AS INT) AS mts
  FROM (SELECT c, pow(c / 10, 0.25) AS r FROM (SELECT greatest(10.0, round_even(sqrt(CAST(count(*) AS DOUBLE)) / 2, 0)) AS c FROM documents))
  CROSS JOIN (SELECT unnest(range(8)) AS idx) WHERE c > 10 OR idx = 0"""
SWEEP = {
    "grid": GRID,
    "groups": "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source",
    "metrics": """SELECT grid_idx, mts, count(*) FILTER (n >= mts) AS n_topics,
      max(n) FILTER (n >= mts) / CAST(min(n) FILTER (n >= mts) AS DOUBLE) AS imbalance,
      coalesce(min(n) FILTER (n >= mts), 0) AS min_count,
      coalesce(CAST(sum(n) FILTER (n < mts) AS DOUBLE), 0) / sum(n) AS outlier_ratio,
      CASE WHEN count(*) FILTER (n >= mts) >= 2 THEN 0.2 + count(*) FILTER (n >= mts) / 400.0 END AS silhouette
      FROM grid CROSS JOIN groups GROUP BY grid_idx, mts""",
    "gated": """SELECT *, len(reasons) = 0 AS passed FROM (SELECT *, list_filter([
      CASE WHEN n_topics < 4 THEN 'n_topics<4' END, CASE WHEN n_topics > 150 THEN 'n_topics>150' END,
      CASE WHEN NOT coalesce(silhouette >= 0.25, false) THEN 'silhouette<0.25' END,
      CASE WHEN coalesce(imbalance >= 4, false) THEN 'imbalance≥4' END,
      CASE WHEN min_count < 12 THEN 'min_count<12' END], lambda x: x IS NOT NULL) AS reasons FROM metrics)""",
    "chosen": "SELECT quantile_disc(mts, 0.5) AS mts FROM gated WHERE passed",
}
CUTOFF = q.Cutoff(n_topics_max=150, imbalance_max=4, min_count_in_topics=12)


def sweep(spark, sf):
    """Gated rows. The silhouette is a stand-in that grows with the number of topics."""
    docs = table(spark, sf, "documents")
    group = F.dense_rank().over(Window.orderBy("lang", "source"))
    groups = docs.groupBy("lang", "source").agg(F.count("*").alias("n")).withColumn("group", group)
    grid = F.array(*[F.struct(F.lit(r.grid_idx).alias("grid_idx"), F.lit(r.mts).alias("mts")) for r in q.sweep_grid(docs).collect()])
    named = docs.select("doc_id", "lang", "source").join(groups, ["lang", "source"])
    candidates = named.select("doc_id", "n", "group", F.inline(grid)).select(
        "grid_idx", "mts", "doc_id", F.when(F.col("n") >= F.col("mts"), F.col("group")).otherwise(-1).alias("topic")
    )
    metrics = q.topic_metrics(candidates, ["grid_idx", "mts"])
    silhouette = F.when(F.col("n_topics") >= 2, F.lit(0.2).cast("double") + F.col("n_topics") / 400.0)
    return q.sweep_gate(metrics.withColumn("silhouette", silhouette), CUTOFF)


@check("topic_metrics", with_sql("""SELECT count(*) FILTER (topic <> -1) AS n_topics,
  round(max(n) FILTER (topic <> -1) / CAST(min(n) FILTER (topic <> -1) AS DOUBLE), 6) AS imbalance,
  coalesce(min(n) FILTER (topic <> -1), 0) AS min_count,
  round(CAST(coalesce(sum(n) FILTER (topic = -1), 0) AS DOUBLE) / sum(n), 6) AS outlier_ratio
  FROM (SELECT topic, count(*) AS n FROM corpus GROUP BY topic)"""))
def topic_metrics(spark, sf):
    rows = q.topic_metrics(corpus(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("imbalance", "outlier_ratio")})


SILHOUETTE = """WITH v AS (SELECT vec_id AS i, label AS topic, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
  sizes AS (SELECT topic, count(*) AS n FROM v GROUP BY topic),
  sums AS (SELECT a.i, a.topic, b.topic AS other, sum({distance}) AS s FROM v a CROSS JOIN v b GROUP BY a.i, a.topic, b.topic),
  ab AS (SELECT i, max(CASE WHEN s.topic = other THEN s / (n - 1) END) AS a, min(CASE WHEN s.topic <> other THEN s / n END) AS b
    FROM sums s JOIN sizes z ON z.topic = s.other GROUP BY i)
  SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab"""


@check("silhouette", SILHOUETTE.format(distance="list_distance(a.x, b.x)"))
def silhouette(spark, sf):
    return q.silhouette(vectors(spark, sf)).withColumn("silhouette", F.round("silhouette", 6))


@check("silhouette_tree")
def silhouette_tree(spark, sf):
    """Bounds on the silhouette of the labels in projected vectors; tests hold them against the exact one."""
    points = vectors(spark, sf)
    coords = reduce_dims(points.select("doc_id", "embedding"), 3)
    return cells.silhouette_bounds(durable(coords.join(points.select("doc_id", "topic"), "doc_id")), "coords").drop("pairs")


@check("silhouette_squared", SILHOUETTE.format(distance="pow(list_distance(a.x, b.x), 2)"))
def silhouette_squared(spark, sf):
    return q.silhouette_squared(vectors(spark, sf)).withColumn("silhouette", F.round("silhouette", 6))


@check("sweep_grid", f"SELECT * FROM ({GRID})")
def sweep_grid(spark, sf):
    return q.sweep_grid(table(spark, sf, "documents"))


@check("sweep_gate", with_sql("SELECT grid_idx, mts, n_topics, passed, array_to_string(reasons, '; ') AS reasons FROM gated", **SWEEP))
def sweep_gate(spark, sf):
    return sweep(spark, sf).select("grid_idx", "mts", "n_topics", "passed", F.array_join("reasons", "; ").alias("reasons"))


@check("sweep_select_median_low", with_sql("SELECT mts FROM chosen WHERE mts IS NOT NULL", **SWEEP))
def sweep_select_median_low(spark, sf):
    return q.select_median_low(sweep(spark, sf))


@check("sweep_select_target", with_sql("SELECT mts FROM gated WHERE passed ORDER BY abs(n_topics - 40), n_topics DESC, grid_idx LIMIT 1", **SWEEP))
def sweep_select_target(spark, sf):
    return q.select_target(sweep(spark, sf), 40)


REPORT = """SELECT grid_idx, mts, n_topics, round_even(silhouette, 4) AS silhouette, round_even(imbalance, 2) AS imbalance, min_count,
  round_even(outlier_ratio, 4) AS outlier_ratio, passed, array_to_string(reasons, '; ') AS reasons FROM gated"""


@check("sweep_report", with_sql(REPORT, **SWEEP))
def sweep_report(spark, sf):
    return q.sweep_report(sweep(spark, sf))


@check("sweep_table", with_sql(f"SELECT g.*, coalesce(g.mts = c.mts, false) AS selected FROM ({REPORT}) g CROSS JOIN chosen c", **SWEEP))
def sweep_table(spark, sf):
    rows = durable(sweep(spark, sf))
    found = q.select_median_low(rows).first()
    return q.sweep_table(rows, found.mts if found else -1)


def _scaled(name: str) -> str:
    span = f"(max({name}) OVER () - min({name}) OVER ())"
    return f"""round(CASE WHEN {name} IS NULL THEN NULL ELSE coalesce(({name} - min({name}) OVER ()) / nullif(CAST({span} AS DOUBLE), 0), 0.0) END, 6) AS {name}"""


@check("sweep_heatmap", with_sql(f"SELECT grid_idx, mts, {', '.join(_scaled(m) for m in q.SWEEP_METRICS)} FROM gated", **SWEEP))
def sweep_heatmap(spark, sf):
    rows = q.sweep_heatmap(sweep(spark, sf))
    return rows.withColumns({m: F.round(m, 6) for m in q.SWEEP_METRICS})
