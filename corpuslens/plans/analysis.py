"""The whole analysis of a corpus, from documents to report tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import density, documents, keywords, labels, quality, ranking, report, trends, vectors, weights
from corpuslens.session import durable
from corpuslens.sinks import publish_run, resolve_run_id


@dataclass(frozen=True)
class Settings:
    """Parameters of an analysis, with the usual defaults."""

    clean: bool = False
    stop_words: Sequence[str] | str | None = "english"
    dims: int = 2
    vector_dim: int = 16
    vector_features: int = vectors.HASH_FEATURES
    min_topic_size: int | None = None
    grid: Sequence[int] | None = None
    cutoff: quality.Cutoff = field(default_factory=quality.Cutoff)
    tie_break: str = "median_low"
    target_topics: int = 10
    reassign_outliers: bool = False
    shape: Callable[..., DataFrame] | None = None
    seeds: DataFrame | None = None
    top_n: int = keywords.TOP_N
    target_ranks: Sequence[int] = (1, 2, 3)
    trend_keywords: int = trends.TOP_KEYWORDS
    p_threshold: float = trends.P_THRESHOLD
    window: int = trends.WINDOW
    tiers: Sequence[str] = ranking.TIERS
    contours: bool = False


def analyze(
    docs: DataFrame, embeddings: DataFrame | None = None, settings: Settings = Settings(), run_id: str = "run",
    given_labels: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables of one run, by name. `docs` has the corpus schema with unique `doc_id`.

    `given_labels` (topic, label_en, label_kr, description), for instance parsed from a model's answers, name the topics
    they list; the others are named after their keywords. `contours` is only made if the settings ask for it.
    """
    s = settings
    corpus = documents.clean_documents(docs) if s.clean else docs
    corpus = documents.drop_blank(documents.pick_text(corpus), "text")
    if embeddings is None:
        embeddings = vectors.embed_text(corpus, "text", s.vector_dim, s.stop_words, s.vector_features)
    embeddings = durable(embeddings)
    coords = durable(vectors.reduce_dims(embeddings, s.dims))

    grid = [s.min_topic_size] if s.min_topic_size else s.grid

    def moved(assignment: DataFrame) -> DataFrame:
        """Outliers of one size moved to the topics whose words they use."""
        labeled = documents.labeled_docs(corpus, assignment)
        term_weights = weights.ctfidf(weights.term_counts(labeled, "text", s.stop_words), s.seeds)
        return weights.reassign_outliers(labeled, term_weights, "text", s.stop_words)

    rows, assignments = density.topic_sweep(coords, grid, s.cutoff, s.shape, moved if s.reassign_outliers else None)
    if s.min_topic_size:
        # A single given size is taken as it is.
        chosen = s.min_topic_size
    else:
        chosen = quality.choose_size(rows, s.tie_break, s.target_topics)
    assignment = assignments.where(F.col("mts") == chosen).select("doc_id", "topic")

    labeled = documents.labeled_docs(corpus, assignment)
    term_weights = weights.ctfidf(weights.term_counts(labeled, "text", s.stop_words), s.seeds)

    comparison = durable(keywords.keyword_comparison(
        keywords.topic_doc_counts(labeled),
        weights.ctfidf_topn(term_weights, s.top_n),
        vectors.keybert_terms(labeled, embeddings, "text", s.stop_words, n=s.top_n),
        keywords.keyword_topn(labeled, "author_keywords", s.top_n),
        keywords.keyword_topn(labeled, "mesh_terms", s.top_n),
    ))
    names = labels.keyword_labels(comparison)
    if given_labels is not None:
        given = durable(given_labels.select(names.columns).dropDuplicates(["topic"]))
        names = given.join(comparison.select("topic"), "topic", "left_semi").select(names.columns).unionByName(names.join(given.select("topic"), "topic", "left_anti"))
    names = durable(names)
    ranked = durable(ranking.assign_tiers(ranking.topic_rank_by_size(
        documents.topics_labels(comparison.select("topic", "doc_count"), names).withColumn("run_id", F.lit(run_id))
    ), s.tiers))

    dated = documents.valid_years(labeled)
    by_year = trends.year_topic_counts(dated)
    years = durable(trends.keyword_years(dated))
    order = ranked.select(F.col("rank").alias("position"), "topic")
    targets = durable(ranking.target_topics(order, dated, s.target_ranks))
    followed = durable(trends.trend_keywords(years, targets, s.trend_keywords))

    summary = report.corpus_summary(dated.withColumn("run_id", F.lit(run_id)), ["run_id"])
    metrics = quality.topic_metrics(labeled.withColumn("run_id", F.lit(run_id)), ["run_id"])
    scatter = report.scatter_points(coords, assignment, names)
    more = {"contours": report.density_grid(scatter)} if s.contours else {}
    return {
        "assignment": assignment,
        "coords": coords,
        "embeddings": embeddings,
        "sweep": quality.sweep_table(rows, chosen),
        "sweep_heatmap": quality.sweep_heatmap(rows),
        "keywords": comparison,
        "labels": names,
        "ranking": ranked,
        "year_topic": trends.year_topic_share(by_year),
        "year_topic_pivot": trends.year_topic_pivot(by_year, names),
        "docs_per_year": report.docs_per_year(dated),
        "trend_stats": trends.trend_stats(years, followed, names, s.p_threshold),
        "trend_series": trends.trend_series(years, followed, s.window),
        "cards": report.topic_cards(comparison, names),
        "scatter": scatter,
        "results": report.results_bundle(summary, metrics, ranked),
        **more,
    }


def save(tables: dict[str, DataFrame], base: str, run_id: str) -> dict[str, str]:
    """Write every table of a run below `base` and publish the run; returns their paths.

    The run id 'auto' is replaced once, so that all tables of the run share one folder. `sinks.saved_run` reads a run
    back; one that was stopped half-way is absent, and a published one is not written again.
    """
    return publish_run(tables, base, resolve_run_id(run_id))
