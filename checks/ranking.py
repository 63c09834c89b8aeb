"""Rankings of topics per run. A run is one `source`; its answers are written by Spark from its topic sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.corpus import corpus, labels, with_sql
from checks.keywords import COMPARISON, comparison
from checks.registry import check
from corpuslens.operators import documents as d
from corpuslens.operators import ranking as rk

# Document counts are shown in thousands, so that the answers hold thousands separators.
RANKED = """SELECT run_id, topic, CAST(row_number() OVER (PARTITION BY run_id ORDER BY n DESC, topic) AS INT) AS rank, n * 1000 AS doc_count
  FROM (SELECT run_id, topic, count(*) AS n FROM corpus WHERE topic <> -1 GROUP BY run_id, topic)"""
RANKING = {"ranked": RANKED}


def ranked(spark, sf):
    sizes = corpus(spark, sf).where("topic <> -1").groupBy("run_id", "topic").agg((F.count("*") * 1000).alias("doc_count"))
    return rk.topic_rank_by_size(sizes)


def answers(spark, sf):
    """(run_id, answer): a Markdown table; topic 3 is written as 'Topic 3' and so cannot be read back."""
    row = F.format_string(
        "| %d | %s | theme %d | %s | why %d |", F.col("rank"),
        F.when(F.col("topic") == 3, F.lit("Topic 3")).otherwise(F.col("topic").cast("string")),
        F.col("topic"), F.format_number("doc_count", 0), F.col("topic"),
    )
    lines = F.array_sort(F.collect_list(F.struct("rank", row.alias("line"))))
    head = "# Ranking\n\n| rank | topic | label | doc_count | rationale |\n|---|---|---|---|---|\n"
    return ranked(spark, sf).groupBy("run_id").agg(
        F.concat(F.lit(head), F.array_join(F.transform(lines, lambda r: r["line"]), "\n")).alias("answer")
    )


@check("topic_rank_by_size", with_sql("SELECT run_id, topic, rank, doc_count, '문서수 순' AS rationale FROM ranked", **RANKING))
def topic_rank_by_size(spark, sf):
    return ranked(spark, sf)


@check("parse_ranking_order", with_sql("""SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY rank) AS INT) AS position, topic
  FROM ranked WHERE topic <> 3""", **RANKING))
def parse_ranking_order(spark, sf):
    return rk.parse_ranking_order(answers(spark, sf))


@check("parse_ranking_table", with_sql("""SELECT run_id, rank, topic, concat('theme ', topic) AS label, doc_count, concat('why ', topic) AS rationale
  FROM ranked WHERE topic <> 3""", **RANKING))
def parse_ranking_table(spark, sf):
    return rk.parse_ranking_table(answers(spark, sf))


@check("ranking_missing_topics", with_sql("SELECT run_id, topic FROM ranked WHERE topic = 3", **RANKING))
def ranking_missing_topics(spark, sf):
    return rk.ranking_missing_topics(ranked(spark, sf), rk.parse_ranking_order(answers(spark, sf)))


@check("parse_label_json", with_sql("""SELECT run_id, topic, concat('theme ', topic) AS label_en, CAST(NULL AS VARCHAR) AS label_kr,
  concat('[', doc_count, ']') AS description FROM ranked WHERE right(run_id, 1) <> '3'""", **RANKING))
def parse_label_json(spark, sf):
    """Pure JSON, JSON inside other text, and answers (runs ending in 3) that hold none."""
    item = F.struct("topic", F.format_string("theme %d", "topic").alias("label_en"),
                    F.format_string("[%d]", "doc_count").alias("description"))
    packed = ranked(spark, sf).groupBy("run_id").agg(F.to_json(F.collect_list(item)).alias("json"))
    answer = (
        F.when(F.col("run_id").endswith("3"), F.lit("I cannot say."))
        .when(F.col("run_id").endswith("5"), F.concat(F.lit("Here you are:\n```json\n"), F.col("json"), F.lit("\n```")))
        .otherwise(F.col("json"))
    )
    return rk.parse_label_json(packed.select("run_id", answer.alias("answer")))[0]


@check("rank_groups_3", with_sql("""SELECT run_id, topic, rank, CAST(CASE WHEN rank <= third THEN 0 WHEN rank <= third + greatest(1, n - 2 * third) THEN 1 ELSE 2 END AS INT) AS tier_no
  FROM (SELECT *, greatest(1, n // 3) AS third FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS n FROM ranked))""", **RANKING))
def rank_groups_3(spark, sf):
    return rk.assign_tiers(ranked(spark, sf)).select("run_id", "topic", "rank", "tier_no")


@check("rank_groups_k", with_sql("""SELECT run_id, topic, rank, CAST(ntile(4) OVER (PARTITION BY run_id ORDER BY rank) - 1 AS INT) AS tier_no,
  (ARRAY['a', 'b', 'c', 'd'])[ntile(4) OVER (PARTITION BY run_id ORDER BY rank)] AS tier FROM ranked""", **RANKING))
def rank_groups_k(spark, sf):
    return rk.assign_tiers(ranked(spark, sf), "abcd").select("run_id", "topic", "rank", "tier_no", "tier")


@check("rank_groups_weighted", with_sql("""SELECT run_id, topic, rank, CAST((CASE WHEN rank > end1 THEN 1 ELSE 0 END) + (CASE WHEN rank > end2 THEN 1 ELSE 0 END)
  + (CASE WHEN rank > end3 THEN 1 ELSE 0 END) AS INT) AS tier_no
  FROM (SELECT *, greatest(end2 + 1, least(n - 1, CAST(round(n * 0.875) AS BIGINT))) AS end3
  FROM (SELECT *, greatest(end1 + 1, least(n - 2, CAST(round(n * 0.75) AS BIGINT))) AS end2
  FROM (SELECT *, greatest(1, least(n - 3, CAST(round(n * 0.5) AS BIGINT))) AS end1
  FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS n FROM ranked))))""", **RANKING))
def rank_groups_weighted(spark, sf):
    tiered = rk.assign_tiers(ranked(spark, sf), "abcd", [4, 2, 1, 1])
    return tiered.select("run_id", "topic", "rank", "tier_no")


@check("relevance_table", with_sql("""SELECT r.run_id, r.topic, r.rank, r.doc_count, '문서수 순' AS rationale,
  CASE WHEN r.topic <> 5 THEN t.tier_no END AS tier_no, CASE WHEN r.topic <> 5 THEN (ARRAY['직접 관련', '간접 관련', '낮은 관련도'])[t.tier_no + 1] END AS tier
  FROM ranked r LEFT JOIN (
    SELECT *, CAST(CASE WHEN rank <= third THEN 0 WHEN rank <= third + greatest(1, n - 2 * third) THEN 1 ELSE 2 END AS INT) AS tier_no
    FROM (SELECT *, greatest(1, n // 3) AS third FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS n FROM ranked))) t
  ON t.run_id = r.run_id AND t.topic = r.topic""", **RANKING))
def relevance_table(spark, sf):
    """Topic 5 is outside the tiered ranking."""
    rows = ranked(spark, sf)
    return rk.relevance_table(rows, rk.assign_tiers(rows).where("topic <> 5"))


@check("label_prompts", with_sql("""SELECT 'all' AS run_id, concat('Name the topics of a corpus about 문서: ', format('{:,}', CAST(sum(doc_count) AS BIGINT)), ' documents in ',
  count(*), ' topics.', chr(10), chr(10), string_agg(concat('Topic ', topic, ' (', doc_count, ' docs)', chr(10), '- c-TF-IDF: ', c_tf_idf, chr(10),
  '- KeyBERT: ', keybert, chr(10), '- author keywords: ', author_keywords_freq, chr(10), '- MeSH: ', mesh_freq), chr(10) || chr(10) ORDER BY topic),
  chr(10), chr(10), 'Answer with a JSON array only, one object per topic: {"topic": <integer>, "label_en": <at most 5 words>, "label_kr": <Korean name>, "description": <2-3 Korean sentences>}') AS prompt
  FROM comparison""", **COMPARISON))
def label_prompts(spark, sf):
    return rk.label_prompts(comparison(spark, sf).withColumn("run_id", F.lit("all")), rk.resolve_domain())


@check("ranking_prompts", with_sql("""SELECT run_id, concat('Order these ', count(*), ' topics by their relevance to: impact', chr(10), chr(10),
  string_agg(concat('Topic ', r.topic, ' (', doc_count, ' docs)', chr(10), '- label_en: ', coalesce(label_en, ''), chr(10), '- label_kr: ', coalesce(label_kr, ''),
  chr(10), '- description: ', coalesce(description, '')), chr(10) || chr(10) ORDER BY r.topic), chr(10), chr(10),
  'Answer with one Markdown row per topic: | rank | topic | label_kr | doc_count | rationale |. The topic column holds the bare integer; ranks run from 1 without gaps.') AS prompt
  FROM ranked r LEFT JOIN labels l ON l.topic = r.topic GROUP BY run_id""", **RANKING))
def ranking_prompts(spark, sf):
    return rk.ranking_prompts(d.topics_labels(ranked(spark, sf), labels(spark, sf)), "impact")
