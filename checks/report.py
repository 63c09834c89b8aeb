"""Report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.corpus import assignment, corpus, labels, vectors, with_sql
from checks.keywords import COMPARISON, comparison
from checks.ranking import RANKED, ranked
from checks.registry import check
from checks.text import COUNTED
from checks.trends import dated
from corpuslens.operators import documents as d
from corpuslens.operators import keywords as k
from corpuslens.operators import quality as q
from corpuslens.operators import ranking as rk
from corpuslens.operators import report as r

SUMMARY = """SELECT {by} count(*) AS total_docs, count(*) FILTER (topic <> -1) AS n_classified, count(*) FILTER (topic = -1) AS n_outliers,
  round(100.0 * count(*) FILTER (topic = -1) / count(*), 6) AS outlier_pct, count(DISTINCT topic) FILTER (topic <> -1) AS n_topics,
  min(year) AS year_min, max(year) AS year_max FROM corpus WHERE year > 0"""


@check("corpus_summary", with_sql(SUMMARY.format(by="")))
def corpus_summary(spark, sf):
    return r.corpus_summary(dated(spark, sf)).withColumn("outlier_pct", F.round("outlier_pct", 6))


@check("docs_per_year", with_sql("SELECT year, count(*) AS n FROM corpus WHERE year > 0 GROUP BY year ORDER BY year"))
def docs_per_year(spark, sf):
    return r.docs_per_year(dated(spark, sf))


@check("topics_by_size", with_sql(f"SELECT * FROM ({COUNTED}) ORDER BY doc_count DESC, topic"))
def topics_by_size(spark, sf):
    return r.topics_by_size(k.topic_doc_counts(corpus(spark, sf)))


@check("topic_cards", with_sql("""SELECT c.topic, doc_count, label_en, label_kr, description, c_tf_idf, keybert, author_keywords_freq, mesh_freq
  FROM comparison c LEFT JOIN labels l ON l.topic = c.topic""", **COMPARISON))
def topic_cards(spark, sf):
    return r.topic_cards(comparison(spark, sf), labels(spark, sf))


def flat_coords(spark, sf):
    """Two coordinates of every document: its size and how far into the corpus it stands."""
    return corpus(spark, sf).select("doc_id", F.array(
        F.length("abstract") / F.lit(1000.0), (F.col("doc_id") % 97) / F.lit(10.0)
    ).alias("coords"))


@check("scatter_points", with_sql("""SELECT c.doc_id, round(length(abstract) / 1000.0, 6) AS x, round((c.doc_id % 97) / 10.0, 6) AS y, c.topic,
  CASE WHEN c.topic = -1 THEN 'Outlier' ELSE coalesce(label_kr, concat('Topic ', c.topic)) END AS label,
  count(*) OVER (PARTITION BY c.topic) AS topic_docs FROM corpus c LEFT JOIN labels l ON l.topic = c.topic"""))
def scatter_points(spark, sf):
    rows = r.scatter_points(flat_coords(spark, sf), assignment(spark, sf), labels(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("x", "y")})


@check("density_grid", """WITH p AS (SELECT label AS topic, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
  s AS (SELECT topic, count(*) AS n, pow(count(*), -1.0 / 6) AS f, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy,
    min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p GROUP BY topic HAVING count(*) >= 10),
  k AS (SELECT *, (vx * vy - vxy * vxy) AS det FROM s),
  own AS (SELECT a.topic, a.x, a.y, a.rowid, sum(exp(-0.5 * (k.vy * pow(a.x - b.x, 2) + k.vx * pow(a.y - b.y, 2) - 2 * k.vxy * (a.x - b.x) * (a.y - b.y)) / (k.det * k.f * k.f)))
      / (any_value(k.n) * 2 * pi() * any_value(k.f * k.f) * sqrt(any_value(k.det))) AS d
    FROM (SELECT *, row_number() OVER () AS rowid FROM p) a JOIN p b ON a.topic = b.topic JOIN k ON k.topic = a.topic GROUP BY a.topic, a.x, a.y, a.rowid),
  lv AS (SELECT topic, quantile_cont(d, 0.2) AS threshold FROM own GROUP BY topic),
  g AS (SELECT k.topic, ix, iy, x0 - 1 + ix * (x1 - x0 + 2) / 99 AS gx, y0 - 1 + iy * (y1 - y0 + 2) / 99 AS gy
    FROM k CROSS JOIN (SELECT unnest(range(100)) AS ix) CROSS JOIN (SELECT unnest(range(100)) AS iy))
  SELECT g.topic, CAST(ix AS INT) AS ix, CAST(iy AS INT) AS iy, round(gx, 6) AS x, round(gy, 6) AS y,
    round(sum(exp(-0.5 * (k.vy * pow(gx - p.x, 2) + k.vx * pow(gy - p.y, 2) - 2 * k.vxy * (gx - p.x) * (gy - p.y)) / (k.det * k.f * k.f)))
      / (any_value(k.n) * 2 * pi() * any_value(k.f * k.f) * sqrt(any_value(k.det))), 6) AS density, round(any_value(threshold), 6) AS threshold
  FROM g JOIN p ON p.topic = g.topic JOIN k ON k.topic = g.topic JOIN lv ON lv.topic = g.topic GROUP BY g.topic, ix, iy, gx, gy""")
def density_grid(spark, sf):
    points = vectors(spark, sf).selectExpr(
        "doc_id", "topic", "CAST(embedding[0] AS DOUBLE) AS x", "CAST(embedding[1] AS DOUBLE) AS y"
    )
    return r.density_grid(points).withColumns({c: F.round(c, 6) for c in ("x", "y", "density", "threshold")})


@check("results_bundle", with_sql("""SELECT s.run_id, CAST(to_json(struct_pack(
    summary := struct_pack(total_docs := total_docs, n_classified := n_classified, n_outliers := n_outliers, outlier_pct := outlier_pct,
      n_topics := s.n_topics, year_min := year_min, year_max := year_max),
    metrics := struct_pack(n_topics := m.n_topics, min_count := m.min_count), topics := t.topics)) AS VARCHAR) AS bundle
  FROM summary s JOIN (SELECT run_id, count(*) FILTER (topic <> -1) AS n_topics, coalesce(min(n) FILTER (topic <> -1), 0) AS min_count
      FROM (SELECT run_id, topic, count(*) AS n FROM corpus GROUP BY run_id, topic) GROUP BY run_id) m ON m.run_id = s.run_id
  LEFT JOIN (SELECT run_id, list(struct_pack(rank := rank, topic := topic, label_kr := label_kr, label_en := label_en,
      description := description, tier := tier) ORDER BY rank) AS topics FROM tiered GROUP BY run_id) t ON t.run_id = s.run_id""",
    summary=SUMMARY.format(by="run_id,") + " GROUP BY run_id", ranked=RANKED,
    tiered="""SELECT r.run_id, r.rank, r.topic, l.label_kr, l.label_en, l.description,
      (ARRAY['high', 'low'])[ntile(2) OVER (PARTITION BY run_id ORDER BY rank)] AS tier FROM ranked r LEFT JOIN labels l ON l.topic = r.topic"""))
def results_bundle(spark, sf):
    summary = r.corpus_summary(dated(spark, sf), ["run_id"]).withColumn("outlier_pct", F.round("outlier_pct", 6))
    metrics = q.topic_metrics(corpus(spark, sf), ["run_id"]).select("run_id", "n_topics", "min_count")
    tiered = rk.assign_tiers(ranked(spark, sf), ("high", "low"))
    return r.results_bundle(summary, metrics, d.topics_labels(tiered, labels(spark, sf)))
