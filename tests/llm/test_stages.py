"""The filtering stages of the pipeline on rows with odd ids and column names."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from corpuslens.session import ship_package  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, N_LINES string, Key string"


def prose(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(80))


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    clean = [prose(i) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(clean)] + [(3, "too short"), (None, "short as well"), (None, clean[5]), (7, clean[7]), (7, clean[7]), (None, prose(99))]
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y") for i, t in rows], SCHEMA)


def test_quality_judges_rows(spark, docs):
    kept = corpus_pipeline.quality(spark, docs, "")
    assert kept.columns == docs.columns
    texts = [r[1] for r in kept.collect()]
    assert len(texts) == 16 and not [t for t in texts if "short" in t]
    assert sum(r[0] == 3 for r in kept.collect()) == 1


def test_lines_and_near_dedup(spark, docs):
    plain = corpus_pipeline.lines(spark, docs, "")
    assert plain.columns == docs.columns and plain.count() == docs.count()
    assert all(r[4] == len(r[1]) and r[5] == "x" for r in plain.collect())
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns
    found = [(r[0], r[1]) for r in left.collect()]
    assert len(found) == len(set(found)) == 15
    assert (5, prose(5)) in found and (None, prose(5)) not in found and (None, prose(99)) in found
    assert found.count((7, prose(7))) == 1


def test_empty_tables(spark, docs):
    for stage in (corpus_pipeline.quality, corpus_pipeline.lines, corpus_pipeline.near_dedup, corpus_pipeline.pii):
        assert stage(spark, docs.limit(0), "").count() == 0
