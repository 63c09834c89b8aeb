"""Topics and keywords over the years, with trend statistics.

A keyword series holds one point per year in which the keyword occurs; years without it are
skipped, not zero. The statistics compare all pairs of a series inside one array, so a series
costs one row; it is never longer than the number of distinct years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.functions.numeric import array_median, array_total, two_sided_p
from corpuslens.operators.keywords import top_n_per_group
from corpuslens.session import small_side

TOP_KEYWORDS = 7
P_THRESHOLD = 0.05
WINDOW = 5
MIN_POINTS = 3


def year_topic_counts(docs: DataFrame) -> DataFrame:
    """(year, topic, n), outliers included."""
    return docs.groupBy("year", "topic").agg(F.count(F.lit(1)).alias("n"))


def year_topic_share(counts: DataFrame) -> DataFrame:
    """Add `share`: percent of the year's documents."""
    total = F.sum("n").over(Window.partitionBy("year"))
    return counts.withColumn("share", 100.0 * F.col("n") / total)


def year_topic_pivot(counts: DataFrame, names: DataFrame, topics: Sequence[int] | None = None) -> DataFrame:
    """One row per year, one column `T<id>_<label>` per topic, 0 where a topic has no document.

    `names` is (topic, label_kr). Without `topics` the ids are looked up, which Spark limits to
    `spark.sql.pivotMaxValues` columns.
    """
    if topics is None:
        limit = int(counts.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        rows = counts.select("topic").distinct().orderBy("topic").limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} topics: name the ones to show")
        topics = [r.topic for r in rows]
    wanted = names.where(F.col("topic").isin(list(topics))).select("topic", "label_kr").collect()
    label = {r.topic: r.label_kr for r in wanted}
    wide = counts.groupBy("year").pivot("topic", list(topics)).agg(F.sum("n"))
    return wide.select(
        "year",
        *[F.coalesce(F.col(f"`{t}`"), F.lit(0).cast("long")).alias(f"T{t}_{label.get(t, t)}") for t in topics],
    )


def keyword_years(docs: DataFrame, column: str = "author_keywords") -> DataFrame:
    """(topic, keyword, year, occurrences, n, first_row, first_pos) from one pass over the documents.

    `occurrences` counts every mention, `n` counts documents.
    """
    words = docs.select("topic", "year", "row_idx", tx.keyword_array(F.col(column)).alias("_words"))
    rows = words.select("topic", "year", "row_idx", F.explode(tx.keyword_occurrences("_words")).alias("k"))
    return rows.groupBy("topic", F.col("k.keyword").alias("keyword"), "year").agg(
        F.sum("k.occurrences").alias("occurrences"),
        F.count(F.lit(1)).alias("n"),
        F.min("row_idx").alias("first_row"),
        F.min_by("k.pos", "row_idx").alias("first_pos"),
    )


def keyword_year_counts(docs: DataFrame, column: str = "author_keywords") -> DataFrame:
    """(topic, keyword, year, n): documents of a topic and year that hold the keyword."""
    return keyword_years(docs, column).select("topic", "keyword", "year", "n")


def trend_keywords(years: DataFrame, targets: DataFrame, n: int = TOP_KEYWORDS) -> DataFrame:
    """(rank, topic, keyword, kw_rank): most mentioned keywords of the target topics.

    `years` comes from `keyword_years`, `targets` is (rank, topic) from `target_topics`.
    """
    totals = years.join(targets.select("topic"), "topic", "left_semi")
    totals = totals.groupBy("topic", "keyword").agg(
        F.sum("occurrences").alias("occurrences"),
        F.min("first_row").alias("first_row"),
        F.min_by("first_pos", "first_row").alias("first_pos"),
    )
    order = [F.col("occurrences").desc(), F.col("first_row"), F.col("first_pos")]
    top = top_n_per_group(totals, "topic", order, n, "kw_rank")
    return top.join(targets, "topic").select("rank", "topic", "keyword", "kw_rank")


def trend_keyword_totals(series: DataFrame) -> DataFrame:
    """(topic, keyword, total_count, year_min, year_max)."""
    return series.groupBy("topic", "keyword").agg(
        F.sum("n").alias("total_count"), F.min("year").alias("year_min"), F.max("year").alias("year_max")
    )


def keyword_series(series: DataFrame) -> DataFrame:
    """(topic, keyword, points): the series as an array of (year, n) in year order."""
    points = F.array_sort(F.collect_list(F.struct("year", "n")))
    return series.groupBy("topic", "keyword").agg(points.alias("points"))


def _later(values: Column, i: Column) -> Column:
    """The values after position i (0-based)."""
    return F.slice(values, i + 2, F.size(values))


def _signs(values: Column) -> Column:
    """For every point the sum of signs of all later differences."""
    return F.transform(
        values, lambda x, i: array_total(F.transform(_later(values, i), lambda y: F.signum(y - x)))
    )


def _slopes(values: Column) -> Column:
    """Slopes of all pairs per observation step."""
    return F.flatten(F.transform(
        values, lambda x, i: F.transform(_later(values, i), lambda y, j: (y - x) / (j + 1))
    ))


def _values(points: str = "points") -> Column:
    return F.transform(points, lambda p: p["n"].cast("double"))


def series_pairs(series: DataFrame) -> DataFrame:
    """How the pairs i < j of a series compare: (topic, keyword, points, pairs, up, down, ties)."""
    rows = keyword_series(series).withColumn("_v", _values())
    size = F.size("_v").cast("long")
    compare = F.flatten(F.transform(
        "_v", lambda x, i: F.transform(_later(F.col("_v"), i), lambda y: F.signum(y - x))
    ))
    rows = rows.withColumn("_c", compare)

    def how_many(sign: int) -> Column:
        return F.size(F.filter("_c", lambda s: s == sign)).cast("long")

    return rows.select(
        "topic", "keyword", size.alias("points"), (size * (size - 1) / 2).cast("long").alias("pairs"),
        how_many(1).alias("up"), how_many(-1).alias("down"), how_many(0).alias("ties"),
    )


def _mann_kendall(rows: DataFrame) -> DataFrame:
    """Add mk_s, mk_var, mk_z, mk_p, mk_tau to rows with the values `_v`; NULL below three points."""
    v = F.col("_v")
    n = F.size(v).cast("double")
    enough = F.size(v) >= MIN_POINTS
    ties = F.transform(
        F.array_distinct(v),
        lambda x: F.size(F.filter(v, lambda y: y == x)).cast("double"),
    )
    correction = array_total(F.transform(ties, lambda t: t * (t - 1) * (2 * t + 5)))
    rows = rows.withColumn("mk_s", F.when(enough, array_total(_signs(v))))
    rows = rows.withColumn("mk_var", F.when(enough, (n * (n - 1) * (2 * n + 5) - correction) / 18))
    s = F.col("mk_s")
    z = F.when(s == 0, F.lit(0.0)).otherwise((s - F.signum(s)) / F.sqrt("mk_var"))
    rows = rows.withColumn("mk_z", F.when(enough, z))
    return rows.withColumn("mk_p", two_sided_p(F.col("mk_z"))).withColumn(
        "mk_tau", F.when(enough, s / (n * (n - 1) / 2))
    )


def mann_kendall(series: DataFrame) -> DataFrame:
    """(topic, keyword, points, mk_s, mk_var, mk_z, mk_p, mk_tau) of every series."""
    rows = _mann_kendall(keyword_series(series).withColumn("_v", _values()))
    return rows.select(
        "topic", "keyword", F.size("_v").cast("long").alias("points"), "mk_s", "mk_var", "mk_z", "mk_p", "mk_tau"
    )


def sen_slope(series: DataFrame) -> DataFrame:
    """(topic, keyword, sen_slope): median slope of all pairs, per observation step."""
    rows = keyword_series(series).withColumn("_v", _values())
    return rows.select("topic", "keyword", array_median(_slopes(F.col("_v"))).alias("sen_slope"))


def _growth(first: Column, last: Column) -> Column:
    years = (last["year"] - first["year"]).cast("double")
    ratio = last["n"].cast("double") / first["n"].cast("double")
    defined = (first["n"] > 0) & (last["n"] > 0) & (years > 0)
    return F.when(defined, (F.pow(ratio, 1.0 / years) - 1) * 100)


def cagr(series: DataFrame) -> DataFrame:
    """(topic, keyword, cagr_pct): compound growth per calendar year from first to last point."""
    ends = series.groupBy("topic", "keyword").agg(
        F.min_by(F.struct("year", "n"), "year").alias("first"), F.max_by(F.struct("year", "n"), "year").alias("last")
    )
    return ends.select("topic", "keyword", _growth(F.col("first"), F.col("last")).alias("cagr_pct"))


def _label(p: Column, slope: Column, threshold: float) -> Column:
    return (
        F.when(p.isNull(), "insufficient")
        .when((p < threshold) & (slope > 0), "emerging")
        .when((p < threshold) & (slope < 0), "declining")
        .otherwise("stable")
    )


def series_statistics(series: DataFrame, p_threshold: float = P_THRESHOLD) -> DataFrame:
    """Unrounded statistics of every series: mk_*, sen_slope, cagr_pct, trend_label.

    Below three points everything is NULL and the label is 'insufficient'.
    """
    rows = _mann_kendall(keyword_series(series).withColumn("_v", _values()))
    enough = (F.size("_v") >= MIN_POINTS) & (array_total(F.col("_v")) > 0)
    first, last = F.element_at("points", 1), F.element_at("points", -1)
    rows = rows.withColumn("sen_slope", F.when(enough, array_median(_slopes(F.col("_v")))))
    rows = rows.withColumn("cagr_pct", F.when(enough, _growth(first, last)))
    rows = rows.withColumn("mk_p", F.when(enough, F.col("mk_p"))).withColumn("mk_tau", F.when(enough, F.col("mk_tau")))
    return rows.select(
        "topic", "keyword",
        array_total(F.col("_v")).cast("long").alias("total_count"),
        first["year"].alias("year_min"), last["year"].alias("year_max"),
        "mk_tau", "mk_p", "sen_slope", "cagr_pct",
        _label(F.col("mk_p"), F.col("sen_slope"), p_threshold).alias("trend_label"),
    )


def trend_label(series: DataFrame, p_threshold: float = P_THRESHOLD) -> DataFrame:
    """(topic, keyword, trend_label) of every series."""
    return series_statistics(series, p_threshold).select("topic", "keyword", "trend_label")


def trend_stats(
    years: DataFrame, keywords: DataFrame, labels: DataFrame, p_threshold: float = P_THRESHOLD
) -> DataFrame:
    """The trend table of the chosen keywords; only the output is rounded, never the decision.

    `years` comes from `keyword_years`, `keywords` from `trend_keywords`.
    """
    series = years.join(keywords.select("topic", "keyword"), ["topic", "keyword"], "left_semi")
    stats = series_statistics(series, p_threshold).join(keywords, ["topic", "keyword"])
    names = small_side(labels.select("topic", F.col("label_kr").alias("_name")))
    fallback = F.concat(F.lit("Topic "), F.col("topic").cast("string"))
    return stats.join(names, "topic", "left").select(
        "rank",
        F.col("topic").alias("topic_id"),
        F.coalesce("_name", fallback).alias("label_kr"),
        "keyword", "total_count", "year_min", "year_max",
        F.bround("mk_tau", 4).alias("mk_tau"),
        F.bround("mk_p", 4).alias("mk_p"),
        F.bround("sen_slope", 4).alias("sen_slope"),
        F.bround("cagr_pct", 2).alias("cagr_pct"),
        "trend_label",
    )


def centered_moving_average(series: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add `moving_avg`: mean over `window` observed points around each, NULL if not all exist."""
    order = Window.partitionBy("topic", "keyword").orderBy("year")
    around = order.rowsBetween(-(window // 2), (window - 1) // 2)
    full = F.count(F.lit(1)).over(around) == window
    return series.withColumn("moving_avg", F.when(full, F.avg("n").over(around)))


def trend_series(years: DataFrame, keywords: DataFrame, window: int = WINDOW) -> DataFrame:
    """(topic, keyword, year, n, moving_avg) of the chosen keywords, ready to draw."""
    chosen = keywords.select("topic", "keyword")
    series = years.join(chosen, ["topic", "keyword"], "left_semi").select("topic", "keyword", "year", "n")
    return centered_moving_average(series, window)
