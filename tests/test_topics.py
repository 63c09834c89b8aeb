import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens import sinks
from corpuslens.operators import keywords as k
from corpuslens.operators import labels as lb
from corpuslens.operators import report as r
from corpuslens.operators import weights as w
from corpuslens.plans import Settings, analyze, save
from corpuslens.schema import TREND_SCHEMA


def test_keyword_counts_break_ties_by_first_appearance(spark):
    docs = spark.createDataFrame(
        [(0, 0, "beta; alpha"), (1, 0, "Alpha; gamma; beta"), (2, 0, "gamma"), (3, -1, "x")], "row_idx long, topic int, author_keywords string"
    )
    got = [(x.keyword, x.n) for x in k.keyword_topn(docs, "author_keywords", 2).orderBy("rank").collect()]
    assert got == [("beta", 2), ("alpha", 2)]


COMPARISON = "topic int, doc_count long, c_tf_idf string, keybert string, author_keywords_freq string, mesh_freq string"


def test_keyword_labels(spark):
    df = spark.createDataFrame([
        (0, 5, "glacier; moraine; firn; scree", "x", "", ""), (1, 4, " ", "lantern; wick", "", ""), (2, 3, "", None, "", ""), (3, 1, "nan", "", "", ""),
    ], COMPARISON)
    got = {x.topic: x for x in lb.keyword_labels(df).collect()}
    assert got[0].label_en == got[0].label_kr == "glacier, moraine, firn"
    assert got[0].description == "주요 키워드: glacier, moraine, firn, scree"
    assert got[1].label_en == "lantern, wick"
    assert (got[2].label_en, got[2].description) == ("Topic 2", "") and got[3].label_en == "Topic 3"


def test_comparison_without_keywords(spark):
    counts = spark.createDataFrame([(0, 5), (-1, 2)], "topic int, doc_count long")
    terms = spark.createDataFrame([(0, 2, "b"), (0, 1, "a")], "topic int, rank int, term string")
    none = spark.createDataFrame([], "topic int, rank int, keyword string, n long")
    row = k.keyword_comparison(counts, terms, terms.where("false"), none, none).collect()
    assert [tuple(x) for x in row] == [(0, 5, "a; b", "", "", "")]


def test_ctfidf_formula_and_seeds(spark):
    docs = spark.createDataFrame([(0, "aa aa bb"), (1, "bb cc cc cc"), (-1, "dd")], "topic int, abstract string")
    got = {(x.topic, x.term): x.score for x in w.ctfidf(w.term_counts(docs)).collect()}
    average = int((3 + 4 + 1) / 3)
    assert got[0, "aa"] == pytest.approx(2 / 3 * math.log(1 + average / 2))
    assert got[1, "bb"] == pytest.approx(1 / 4 * math.log(1 + average / 2))
    seeds = spark.createDataFrame([("bb",)], "term string")
    seeded = {(x.topic, x.term): x.score for x in w.ctfidf(w.term_counts(docs), seeds).collect()}
    assert seeded[1, "bb"] == pytest.approx(1.2 * got[1, "bb"]) and seeded[0, "aa"] == pytest.approx(got[0, "aa"])


@pytest.mark.parametrize(("ngrams", "n"), [((1, 3), 5), ((2, 4), 40)])
def test_heaviest_ngrams_are_those_of_a_full_count(spark, ngrams, n):
    rng = np.random.default_rng(4)
    words = [f"w{i:02d}" for i in range(60)]

    def text(topic):
        share = 1.0 / (1 + (np.arange(60) + 11 * topic) % 60)
        return " ".join(rng.choice(words, rng.integers(0, 40), p=share / share.sum()))

    rows = [(t, text(t)) for t in range(-1, 5) for _ in range(30)] + [(7, "w01 w02"), (8, ""), (9, None), (7, "w01 w02")]
    docs = spark.createDataFrame(rows, "topic int, abstract string")
    full = w.ctfidf(w.term_counts(docs, ngrams=ngrams)).where("topic <> -1")
    want = k.top_n_per_group(full, "topic", [F.round("score", 9).desc(), F.col("term")], n).select("topic", "term", "tf", "score")
    got = w.heaviest_ngrams(docs, ngrams=ngrams, n=n)
    key = lambda table: sorted((x.topic, x.term, x.tf, round(x.score, 12)) for x in table.collect())
    assert key(got) == key(want)
    assert w.heaviest_ngrams(docs.limit(0), ngrams=ngrams, n=n).count() == 0


def test_outliers_move_to_the_most_similar_topic(spark):
    docs = spark.createDataFrame([
        (1, 0, "fish river water"), (2, 1, "star moon orbit"), (3, -1, "moon star fish"), (4, -1, "nothing shared"), (5, -1, ""),
    ], "doc_id long, topic int, abstract string")
    weights = w.ctfidf(w.term_counts(docs))
    looked_up = {x.doc_id: x.topic for x in w.reassign_outliers(docs, weights).collect()}
    joined = {x.doc_id: x.topic for x in w.reassign_outliers(docs, weights, salts=3, lookup_terms=0).collect()}
    assert looked_up == joined == {1: 0, 2: 1, 3: 1, 4: -1, 5: -1}


def brute_density(points):
    n = len(points)
    cov = np.cov(points.T) * n ** (-1 / 3)
    inv, scale = np.linalg.inv(cov), 1 / (n * 2 * np.pi * np.sqrt(np.linalg.det(cov)))

    def at(q):
        d = q[:, None, :] - points[None]
        return scale * np.exp(-0.5 * np.einsum("abi,ij,abj->ab", d, inv, d)).sum(1)

    return at


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_density_grid_matches_brute_force(spark, block_rows, monkeypatch):
    """A dominant topic, a small one, one below ten points and one without spread."""
    monkeypatch.setattr(r.own_densities, "__defaults__", (block_rows,))
    rng = np.random.default_rng(5)
    sizes = {0: 60, 1: 12, 2: 9, 3: 20, -1: 5}
    rows, clouds = [], {}
    for topic, n in sizes.items():
        xy = rng.normal(size=(n, 2)) @ np.array([[1.0, 0.4], [0.0, 0.7]]) + topic
        if topic == 3:
            xy[:] = [1.0, 2.0]
        clouds[topic] = xy
        rows += [(len(rows) + i, topic, float(a), float(b)) for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "doc_id long, topic int, x double, y double").repartition(3)
    pdf = r.density_grid(df).toPandas()
    assert set(pdf["topic"]) == {0, 1} and len(pdf) == 20000
    for topic in (0, 1):
        at, part = brute_density(clouds[topic]), pdf[pdf["topic"] == topic]
        assert np.allclose(at(part[["x", "y"]].to_numpy()), part["density"], atol=1e-9)
        assert part["threshold"].iloc[0] == pytest.approx(np.percentile(at(clouds[topic]), 20), abs=1e-9)
        xs = clouds[topic][:, 0]
        assert part["x"].min() == pytest.approx(xs.min() - 1) and part["x"].max() == pytest.approx(xs.max() + 1)


def test_results_bundle_has_null_for_nan(spark):
    summary = spark.createDataFrame([("r", 10)], "run_id string, total_docs long")
    metrics = spark.createDataFrame([("r", float("nan"))], "run_id string, silhouette double")
    ranking = spark.createDataFrame(
        [("r", 2, 4, "나", "b", "d4", "low"), ("r", 1, 5, "가", "a", "d5", "high")],
        "run_id string, rank int, topic int, label_kr string, label_en string, description string, tier string",
    )
    data = json.loads(r.results_bundle(summary, metrics, ranking).first().bundle)
    assert data["summary"]["total_docs"] == 10 and data["metrics"]["silhouette"] is None
    assert data["topics"][0] == {"rank": 1, "topic": 5, "label_kr": "가", "label_en": "a", "description": "d5", "tier": "high"}


def test_tables_by_run(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, ["a", "b"], "x\ny")], "id int, k array<string>, t string")
    sinks.write_table(df, base, "one", "docs")
    assert sinks.read_table(spark, base, "one", "docs", df.schema).first().k == ["a", "b"]
    assert sinks.read_table(spark, base, "two", "docs", df.schema).isEmpty()
    empty = spark.createDataFrame([], TREND_SCHEMA)
    sinks.write_table(empty, base, "one", "trend_stats")
    assert sinks.read_table(spark, base, "one", "trend_stats", TREND_SCHEMA).isEmpty()
    assert "run_id=20" in sinks.run_path(base, "auto")
    paths = save({"a": df, "b": df}, base, "auto")
    assert len({p.rsplit("/", 1)[0] for p in paths.values()}) == 1
    sinks.export_csv(df.coalesce(1), f"{base}/csv", bom=True)
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "csv").glob("*.csv"))
    assert text == "﻿id,k,t\n1,a; b,\"x\ny\"\n"


def test_a_run_is_whole_or_absent(spark, tmp_path):
    base = str(tmp_path)
    good = spark.range(3)
    bad = good.select(F.raise_error(F.lit("stopped")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        sinks.publish_run({"a": good, "b": bad}, base, "one")
    assert sinks.saved_run(spark, base, "one") == {}
    sinks.publish_run({"a": good, "b": good.where("id = 1")}, base, "one")
    read = sinks.saved_run(spark, base, "one")
    assert {n: t.count() for n, t in read.items()} == {"a": 3, "b": 1}
    with pytest.raises(FileExistsError):
        sinks.publish_run({"a": good}, base, "one")
    assert sinks.saved_run(spark, base, "one")["a"].count() == 3


def test_whole_analysis(spark, tmp_path):
    """Three themes with their own words come out as three topics, through to the report tables."""
    themes = ["river fish water boat lake stream", "star moon planet orbit comet sun", "bread flour oven yeast dough salt"]
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        words = rng.choice(themes[i % 3].split(), 12)
        rows.append((i, i, 2000 + i % 7, f"t{i}", " ".join(words), f"K{i % 3}; all", "Humans"))
    docs = spark.createDataFrame(
        rows, "doc_id long, row_idx long, year int, title string, abstract string, author_keywords string, mesh_terms string"
    )
    given = spark.createDataFrame([(0, "first", "처음", "given"), (99, "none", "none", "no such topic")], "topic int, label_en string, label_kr string, description string")
    settings = Settings(min_topic_size=25, clean=True, stop_words=["the"], reassign_outliers=True, contours=True)
    tables = analyze(docs, settings=settings, given_labels=given)
    paths = save(tables, str(tmp_path), "one")
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    pdf = read["assignment"].toPandas()
    pdf = pdf[pdf["topic"] >= 0]
    names = {r.topic: r.label_en for r in read["labels"].collect()}
    assert names[0] == "first" and set(names) == {0, 1, 2} and "first" not in (names[1], names[2])
    assert any(c.endswith("처음") for c in read["year_topic_pivot"].columns)
    assert sum(r.n for r in read["docs_per_year"].collect()) == read["year_topic"].groupBy().sum("n").first()[0]
    assert read["sweep_heatmap"].count() == 1 and {r.topic for r in read["contours"].select("topic").distinct().collect()} <= {0, 1, 2}
    assert len(pdf) > 200 and pdf.groupby("topic")["doc_id"].agg(lambda s: len(set(s % 3))).tolist() == [1, 1, 1]
    cards = read["cards"].collect()
    assert len(cards) == 3 and all("all(" in c.author_keywords_freq and c.keybert and "humans(" in c.mesh_freq for c in cards)
    assert read["trend_stats"].count() == 6
    assert json.loads(read["results"].first().bundle)["summary"]["n_topics"] == 3
    assert read["scatter"].count() == 240 and read["sweep"].where("selected").count() == 1


def test_top_n_above_the_limit_of_a_window(spark):
    """One group holds nearly all rows, many of them the same."""
    df = spark.range(60_000).repartition(7).selectExpr("if(id < 40, 'b', 'a') AS g", "if(id % 3 = 0, 5, id) AS v")
    got = {}
    for r in k.top_n_per_group(df, "g", [F.col("v").desc()], 5000).collect():
        got.setdefault(r.g, []).append((r["rank"], r.v))
    values = sorted((5 if i % 3 == 0 else i for i in range(40, 60_000)), reverse=True)[:5000]
    assert sorted(got["a"]) == list(zip(range(1, 5001), values, strict=True))
    assert len(got["b"]) == 40
