"""Rows told apart by a list of keys."""

import pytest

from corpuslens.llm import listed
from corpuslens.session import durable, ship_package


@pytest.fixture(scope="module")
def tables(spark):
    ship_package(spark)
    rows = [(None if i % 7 == 0 else i % 500, f"t{i % 300}", i) for i in range(3000)] + [(None, None, -1), (1, None, -2), (1, None, -3)]
    keys = [(a, b) for a, b, _ in rows if (a or 0) % 5 == 1 or b is None or b == "t7"] + [(10**9, "absent")]
    return spark.createDataFrame(rows, "a long, b string, nr long"), durable(spark.createDataFrame(keys, "a long, b string").distinct()), rows, set(keys)


@pytest.mark.parametrize(("per_block", "most"), [(32, 200_000), (1, 200_000), (32, 1)])
def test_parted_is_exact(tables, monkeypatch, per_block, most):
    frame, keys, rows, wanted = tables
    monkeypatch.setattr(listed, "KEYS_PER_BLOCK", per_block)
    monkeypatch.setattr(listed, "MOST_BLOCKS", most)
    inside, outside = listed.parted(frame, keys, ["a", "b"])
    assert sorted(r.nr for r in inside.collect()) == sorted(n for a, b, n in rows if (a, b) in wanted)
    assert sorted(r.nr for r in outside.collect()) == sorted(n for a, b, n in rows if (a, b) not in wanted)
    assert outside.columns == inside.columns == frame.columns


def test_nothing_listed(tables):
    frame, keys, rows, _ = tables
    inside, outside = listed.parted(frame, keys.limit(0), ["a", "b"])
    assert inside.count() == 0 and outside.count() == len(rows)


def test_stages_do_not_shuffle_texts(spark, tmp_path):
    """Whatever Spark would broadcast by itself, rows that stay are filtered where they are."""
    import random

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    ship_package(spark)
    rng = random.Random(1)
    prose = [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60)) for _ in range(40)]
    rows = [(i, t, "en", "s") for i, t in enumerate([*prose, *prose[:9], "short"])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, left in ((corpus_pipeline.quality, 49), (corpus_pipeline.near_dedup, 41)):
            kept = stage(spark, docs, "")
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
            assert kept.count() == left
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
