from collections import Counter

import numpy as np
import pytest

from corpuslens.llm import language_model as lm
from corpuslens.session import ship_package


def scores(spark, texts):
    ship_package(spark)
    rows = lm.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    return {r.doc_id: r for r in rows}


def test_the_context_of_a_word_is_the_whole_word_before_it(spark):
    """Two words of one ending, each with a follower of its own."""
    seen = ["alphaxy one", "betaxy two"] * 40
    got = scores(spark, [*seen, "alphaxy one", "alphaxy two", "betaxy one", "betaxy two"])
    right, wrong = got[len(seen)].score, got[len(seen) + 1].score
    assert right - wrong > 0.8 and got[len(seen) + 3].score - got[len(seen) + 2].score > 0.8


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_scores_are_those_of_the_model_where_no_seat_is_left_to_chance(spark, partitions):
    """Every pair occurs at most once in training: one table each, so the prediction is a formula."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    words = [f"w{i}" for i in range(30)]
    # Steps of their own for each text, so that no pair comes twice; the text in place 6 is held out.
    texts = [" ".join(words[step * (j + 1) % 29] for j in range(6)) for step in range(1, 20)] + [None]
    texts.insert(6, "w1 unheard w29 W2")
    try:
        got = scores(spark, texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tokens = [[*(t or "").lower().split(), "<end>"] for t in texts]
    pairs = [list(zip(["<start>", *t[:-1]], t, strict=True)) for t in tokens]
    count = Counter(p for i, ps in enumerate(pairs) if not lm.held_out(i) for p in ps)
    assert lm.held_out(6) and max(count.values()) == 1
    customers, served = Counter(u for u, _ in count), Counter(w for _, w in count)
    ones, twos = (sum(n == k for n in served.values()) for k in (1, 2))
    d, e = 0.95, min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
    total = 1 + len(count)

    def chance(u, w):
        parent = (served[w] - e) / total if served[w] else (1 + e * len(served)) / total
        return (count[u, w] * (1 - d) + (1 + d * customers[u]) * parent) / (1 + customers[u])

    for i, ps in enumerate(pairs):
        assert got[i].score == pytest.approx(sum(np.log10(chance(u, w)) for u, w in ps), abs=1e-4)
