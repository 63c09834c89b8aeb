"""Topics and keywords over the years."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.corpus import corpus, keyword_rows, labels, with_sql
from checks.registry import check
from corpuslens.operators import documents as d
from corpuslens.operators import keywords as k
from corpuslens.operators import ranking as rk
from corpuslens.operators import trends as t
from corpuslens.session import durable

RANKS = tuple(range(1, 11))
TOP_N = 25
TOPICS = list(range(-1, 10))
ERFC = """(0.254829592 * t + -0.284496736 * pow(t, 2) + 1.421413741 * pow(t, 3) + -1.453152027 * pow(t, 4)
  + 1.061405429 * pow(t, 5)) * exp(-z * z / 2)"""
SERIES = {
    "kw": keyword_rows("author_keywords"),
    "series": "SELECT topic, keyword, year, count(DISTINCT doc_id) AS n FROM kw WHERE year > 0 GROUP BY topic, keyword, year",
    "pts": "SELECT *, row_number() OVER (PARTITION BY topic, keyword ORDER BY year) AS i FROM series",
    "pairs": """SELECT a.topic, a.keyword, sign(b.n - a.n) AS s, (b.n - a.n) / CAST(b.i - a.i AS DOUBLE) AS slope
      FROM pts a JOIN pts b ON a.topic = b.topic AND a.keyword = b.keyword AND a.i < b.i""",
    "totals": """SELECT topic, keyword, count(*) AS points, CAST(sum(n) AS BIGINT) AS total_count, min(year) AS year_min, max(year) AS year_max,
      arg_min(n, year) AS n_first, arg_max(n, year) AS n_last FROM series GROUP BY topic, keyword""",
    "ties": """SELECT topic, keyword, sum(c * (c - 1) * (2 * c + 5)) AS corr FROM (
      SELECT topic, keyword, n, count(*) AS c FROM series GROUP BY topic, keyword, n) GROUP BY topic, keyword""",
    "mk0": """SELECT t.topic, t.keyword, t.points, CAST(p.s AS DOUBLE) AS mk_s,
      (t.points * (t.points - 1.0) * (2 * t.points + 5) - x.corr) / 18 AS mk_var, p.sen
      FROM totals t JOIN ties x ON x.topic = t.topic AND x.keyword = t.keyword
      JOIN (SELECT topic, keyword, sum(s) AS s, median(slope) AS sen FROM pairs GROUP BY topic, keyword) p
        ON p.topic = t.topic AND p.keyword = t.keyword WHERE t.points >= 3""",
    "mk1": """SELECT *, CASE WHEN mk_s = 0 THEN 0.0 ELSE (mk_s - sign(mk_s)) / sqrt(mk_var) END AS mk_z,
      mk_s / (points * (points - 1) / 2.0) AS mk_tau FROM mk0""",
    "mk": f"SELECT *, {ERFC} AS mk_p FROM (SELECT *, abs(mk_z) AS z, 1 / (1 + 0.3275911 * abs(mk_z) / sqrt(2.0)) AS t FROM mk1)",
    "stats": """SELECT t.*, mk_tau, mk_p, sen AS sen_slope,
      CASE WHEN mk_p IS NOT NULL AND year_max > year_min THEN (pow(n_last / CAST(n_first AS DOUBLE), 1.0 / (year_max - year_min)) - 1) * 100 END AS cagr_pct,
      CASE WHEN mk_p IS NULL THEN 'insufficient' WHEN mk_p < 0.05 AND sen > 0 THEN 'emerging'
           WHEN mk_p < 0.05 AND sen < 0 THEN 'declining' ELSE 'stable' END AS trend_label
      FROM totals t LEFT JOIN mk ON mk.topic = t.topic AND mk.keyword = t.keyword""",
    "ranked": """SELECT topic, CAST(row_number() OVER (ORDER BY count(*) DESC, topic) AS INT) AS rank FROM corpus
      WHERE topic <> -1 GROUP BY topic""",
    "followed": f"""SELECT rank, topic, keyword, CAST(kw_rank AS INT) AS kw_rank FROM (
      SELECT r.rank, k.topic, k.keyword, row_number() OVER (PARTITION BY k.topic ORDER BY count(*) DESC, min(k.row_idx * 1000 + k.pos)) AS kw_rank
      FROM kw k JOIN ranked r ON r.topic = k.topic AND r.rank <= {max(RANKS)} WHERE k.year > 0 GROUP BY r.rank, k.topic, k.keyword)
      WHERE kw_rank <= {TOP_N}""",
}


def dated(spark, sf):
    return d.valid_years(corpus(spark, sf), require_rows=False)


def series(spark, sf):
    return t.keyword_year_counts(dated(spark, sf))


def order(spark, sf):
    sizes = k.topic_doc_counts(corpus(spark, sf)).where("topic <> -1").withColumn("run_id", F.lit("all"))
    return rk.topic_rank_by_size(sizes).select(F.col("rank").alias("position"), "topic")


def targets(spark, sf, ranks=RANKS):
    return rk.target_topics(order(spark, sf), corpus(spark, sf), ranks)


def followed(spark, sf):
    years = t.keyword_years(dated(spark, sf))
    return years, durable(t.trend_keywords(years, targets(spark, sf), TOP_N))


@check("year_topic_counts", with_sql("SELECT year, topic, count(*) AS n FROM corpus WHERE year > 0 GROUP BY year, topic"))
def year_topic_counts(spark, sf):
    return t.year_topic_counts(dated(spark, sf))


@check("year_topic_share", with_sql("""SELECT year, topic, n, round(100.0 * n / sum(n) OVER (PARTITION BY year), 6) AS share FROM (
  SELECT year, topic, count(*) AS n FROM corpus WHERE year > 0 GROUP BY year, topic)"""))
def year_topic_share(spark, sf):
    return t.year_topic_share(t.year_topic_counts(dated(spark, sf))).withColumn("share", F.round("share", 6))


def _pivot_column(topic: int) -> str:
    name = topic if topic in (-1, 7) else f"주제 {topic}"
    return f'count(*) FILTER (topic = {topic}) AS "T{topic}_{name}"'


@check("year_topic_pivot", with_sql(f"SELECT year, {', '.join(_pivot_column(x) for x in TOPICS)} FROM corpus WHERE year > 0 GROUP BY year"))
def year_topic_pivot(spark, sf):
    return t.year_topic_pivot(t.year_topic_counts(dated(spark, sf)), labels(spark, sf), TOPICS)


@check("keyword_year_counts", with_sql("SELECT * FROM series", **SERIES))
def keyword_year_counts(spark, sf):
    return series(spark, sf)


@check("trend_keyword_totals", with_sql("SELECT topic, keyword, total_count, year_min, year_max FROM totals", **SERIES))
def trend_keyword_totals(spark, sf):
    return t.trend_keyword_totals(series(spark, sf))


@check("series_pairs", with_sql("""SELECT t.topic, t.keyword, t.points, count(p.s) AS pairs, count(*) FILTER (p.s > 0) AS up,
  count(*) FILTER (p.s < 0) AS down, count(*) FILTER (p.s = 0) AS ties
  FROM totals t LEFT JOIN pairs p ON p.topic = t.topic AND p.keyword = t.keyword GROUP BY ALL""", **SERIES))
def series_pairs(spark, sf):
    return t.series_pairs(series(spark, sf))


@check("target_topics", with_sql("SELECT rank, topic FROM ranked WHERE rank IN (1, 2, 3, 5)", **SERIES))
def target_topics(spark, sf):
    """Ranks below one and beyond the ranking are skipped."""
    return targets(spark, sf, (1, 2, 3, 5, 0, -1, 99))


@check("trend_keywords", with_sql("SELECT * FROM followed", **SERIES))
def trend_keywords(spark, sf):
    return followed(spark, sf)[1]


@check("mann_kendall", with_sql("""SELECT t.topic, t.keyword, t.points, mk_s, round(mk_var, 6) AS mk_var, round(mk_z, 6) AS mk_z,
  round(mk_p, 6) AS mk_p, round(mk_tau, 6) AS mk_tau FROM totals t LEFT JOIN mk ON mk.topic = t.topic AND mk.keyword = t.keyword""", **SERIES))
def mann_kendall(spark, sf):
    rows = t.mann_kendall(series(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("mk_var", "mk_z", "mk_p", "mk_tau")})


@check("sen_slope", with_sql("""SELECT t.topic, t.keyword, round(median(p.slope), 6) AS sen_slope FROM totals t
  LEFT JOIN pairs p ON p.topic = t.topic AND p.keyword = t.keyword GROUP BY ALL""", **SERIES))
def sen_slope(spark, sf):
    return t.sen_slope(series(spark, sf)).withColumn("sen_slope", F.round("sen_slope", 6))


@check("cagr", with_sql("""SELECT topic, keyword, CASE WHEN year_max > year_min THEN
  round((pow(n_last / CAST(n_first AS DOUBLE), 1.0 / (year_max - year_min)) - 1) * 100, 6) END AS cagr_pct FROM totals""", **SERIES))
def cagr(spark, sf):
    return t.cagr(series(spark, sf)).withColumn("cagr_pct", F.round("cagr_pct", 6))


@check("trend_label", with_sql("SELECT topic, keyword, trend_label FROM stats", **SERIES))
def trend_label(spark, sf):
    return t.trend_label(series(spark, sf))


@check("trend_stats", with_sql("""SELECT f.rank, s.topic AS topic_id, coalesce(l.label_kr, concat('Topic ', s.topic)) AS label_kr, s.keyword,
  total_count, year_min, year_max, round_even(mk_tau, 4) AS mk_tau, round_even(mk_p, 4) AS mk_p,
  round_even(sen_slope, 4) AS sen_slope, round_even(cagr_pct, 2) AS cagr_pct, trend_label
  FROM stats s JOIN followed f ON f.topic = s.topic AND f.keyword = s.keyword LEFT JOIN labels l ON l.topic = s.topic""", **SERIES))
def trend_stats(spark, sf):
    years, chosen = followed(spark, sf)
    return t.trend_stats(years, chosen, labels(spark, sf))


AVERAGE = """CASE WHEN count(*) OVER w = 5 THEN round(avg(n) OVER w, 6) END AS moving_avg"""
AROUND = "WINDOW w AS (PARTITION BY topic, keyword ORDER BY year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"


@check("centered_moving_avg", with_sql(f"SELECT topic, keyword, year, n, {AVERAGE} FROM series {AROUND}", **SERIES))
def centered_moving_avg(spark, sf):
    rows = t.centered_moving_average(series(spark, sf))
    return rows.withColumn("moving_avg", F.round("moving_avg", 6))


@check("trend_series", with_sql(f"""SELECT topic, keyword, year, n, {AVERAGE}
  FROM (SELECT s.* FROM series s JOIN followed f ON f.topic = s.topic AND f.keyword = s.keyword) {AROUND}""", **SERIES))
def trend_series(spark, sf):
    years, chosen = followed(spark, sf)
    return t.trend_series(years, chosen).withColumn("moving_avg", F.round("moving_avg", 6))
