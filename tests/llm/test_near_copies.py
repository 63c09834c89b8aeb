"""Near-dedup against all pairs, rows with odd ids, and the pairs that a large group below the threshold costs."""

import random
from collections import Counter

import pytest

from corpuslens.llm import minhash
from corpuslens.session import ship_package


def bag(text):
    w = text.split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None


def similarity(x, y):
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def all_pairs(texts):
    """Position of the first text of each component."""
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [bag(t or "") for t in texts]
    for i, x in enumerate(bags):
        for j in range(i):
            if x and bags[j] and similarity(x, bags[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def family(seed, copies, words=200, rates=(0.0, 0.005, 0.01, 0.02, 0.03, 0.05)):
    rng = random.Random(seed)
    base = [f"s{seed}w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for c in range(copies):
        rate = rates[c % len(rates)]
        out.append(" ".join(f"own{seed}x{c}y{k}" if rng.random() < rate else w for k, w in enumerate(base)))
    return out


@pytest.fixture(scope="module")
def session(spark):
    ship_package(spark)
    return spark


def test_same_groups_as_all_pairs(session):
    texts = [None, "", " \n", "one two", "one two", "one two three", "in in in in in in in in " * 4]
    texts += family(1, 90) + family(2, 30, rates=(0.03, 0.04)) + family(3, 12, words=30) + family(4, 6, words=6000)
    random.Random(9).shuffle(texts)
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    want = all_pairs(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_copies_below_the_threshold_are_not_paired(session, monkeypatch):
    copies = 2000
    texts = family(5, copies, words=100, rates=(0.05,))
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared = []
    verified = minhash._verified

    def counted(pairs, sets, least):
        compared.append(pairs.count())
        return verified(pairs, sets, least)

    monkeypatch.setattr(minhash, "_verified", counted)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert len(got) == copies
    print(compared, len(set(got.values())))
    assert sum(compared) < 30 * copies


def test_rows_with_odd_ids(session):
    a, b, c = family(6, 1)[0], family(7, 1)[0], family(8, 1)[0]
    rows = [("1", a, 1, "x"), ("1", a, 2, "x"), (None, a, 3, "x"), (None, b, 4, "x"), ("2", c, 5, "x"), ("2", a, 6, "x"),
            ("1", None, 7, "x"), (None, "", 8, "x"), (None, b, 9, "x")]
    docs = session.createDataFrame(rows, "doc_id string, text string, Text_ long, TEXT string").withColumnRenamed("Text_", "H1")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([("1", "1"), ("1", "1"), (None, "1"), (None, None), (None, None), ("2", "2"), ("2", "1"), ("1", "1"), (None, None)], key=str)
    kept = minhash.first_copies(docs)
    assert kept.columns == docs.columns
    assert {(r[0], r[1]) for r in kept.collect() if r[0] is not None} == {("1", a), ("2", c), ("1", None)}
    assert sorted(r[1] for r in kept.collect() if r[0] is None) == sorted([b, ""])
    assert kept.count() == 5
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.first_copies(docs.limit(0)).count() == 0
