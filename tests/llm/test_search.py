"""Ranked search and decontamination against plain Python, on odd rows and over several blocks of items."""

import math
import re

import numpy as np
import pytest

from corpuslens.llm.contamination import decontaminate
from corpuslens.llm.search import search
from corpuslens.llm.terms import HashTable, same_words, texts_of
from corpuslens.session import ship_package

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PASSAGE = " ".join(f"Word{i}" for i in range(14))
LONG = " ".join(f"w{(i * 7919) % 503}" for i in range(30000))
TEXTS = [
    None, "", " ... \n", "the cat, THE dog", "the cat, THE dog", "the cat the dog", "a dog: été", "cat" * 3, "É été", LONG, LONG + " cat",
    "before " + PASSAGE + " after", PASSAGE.upper(), PASSAGE.replace(" ", "--"), "the", "é" * 5000 + " cat", "x Word3 Word4 y short item here z",
    PASSAGE + "\n" + PASSAGE, "word9 word10 word11 word12 word13 word0", "1 2 3 4 5 6 7 8 9 10 11",
] + ["copies of the cat"] * 30 + [f"the cat number {i}" for i in range(30)]
ITEMS = [
    (1, "The cat"), (2, None), (3, "..."), (4, PASSAGE + " tail"), (5, "short item HERE"), (None, "dog"), (1, "another w7 cat cat"), (10, "été unknownword"),
    (6, "1 2 3 4 5 6 7 8 9 10"), (7, PASSAGE),
]


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(None if i == 6 else 3 if i == 5 else i, t, "x", 5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, TEXT string, n_hit long").repartition(4)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "y") for i, t in ITEMS], "item_id long, text string, Item_Id string")


def ranked(k):
    bags = [words(t) for t in TEXTS]
    n, total = sum(map(bool, bags)), sum(map(len, bags))
    out = []
    for item, text in ITEMS:
        scores = []
        for i, bag in enumerate(bags):
            m, score = 50 + 50 * len(bag) * n // total, 0
            for t in set(words(text)):
                tf, df = bag.count(t), sum(t in set(b) for b in bags)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            doc = None if i == 6 else 3 if i == 5 else i
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(str(item), r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k, block_bytes", [(7, 10**6), (50, 100)])
def test_search(docs, items, k, block_bytes):
    got = sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in search(docs, items, k, block_bytes).collect()), key=str)
    assert got == ranked(k)


def test_search_of_nothing(docs, items):
    assert search(docs.limit(0), items).count() == 0
    assert search(docs, items.limit(0)).count() == 0
    assert search(docs.where("doc_id < 3"), items).count() == 0


def test_search_by_text_ids(docs, items):
    named = docs.toDF("doc_id", "text", "a", "b").selectExpr("cast(doc_id as string) doc_id", "text")
    first = search(named, docs.sparkSession.createDataFrame([(5, "short item HERE")], "item_id long, text string"), 3).collect()
    assert [(r["rank"], r.doc_id) for r in first] == [(1, "16")]


def marks(text, window=10):
    found = list(TERM.finditer(text or ""))
    ws = [words(m[0])[0] for m in found]
    hit, held = set(), set()
    for item, t in ITEMS:
        iw = words(t)
        for k in range(max(len(iw) - window + 1, 1) if iw else 0):
            win = iw[k : k + window]
            for p in range(len(ws) - len(win) + 1):
                if ws[p : p + len(win)] == win:
                    hit |= {*range(p, p + len(win))}
                    held.add("" if item is None else str(item))
    spans = [(found[i].start(), found[j].end()) for i, j in zip(
        [i for i in sorted(hit) if i - 1 not in hit], [i for i in sorted(hit) if i + 1 not in hit], strict=True)]
    return len(ws), len(hit), sorted(held), spans


@pytest.mark.parametrize("block_bytes", [10**6, 100])
def test_decontaminate(docs, items, block_bytes):
    got = {}
    out = decontaminate(docs, items, remove=None, block_bytes=block_bytes)
    assert out.columns == ["doc_id", "text", "TEXT", "n_words", "n_hit", "n_items", "items", "spans", "contaminated"]
    for r in out.collect():
        got.setdefault(r.text, set()).add((r.n_words, r.n_hit, tuple(r["items"]), tuple((s.start, s.end) for s in r.spans), r.contaminated, r.n_items))
        assert r.TEXT == "x"
    for t in TEXTS:
        n, hit, held, spans = marks(t)
        assert got[t] == {(n, hit, tuple(held), tuple(spans), hit > 0, len(held))}


def test_removal(docs, items):
    cut = sorted(r.text or "" for r in decontaminate(docs, items).collect())
    expected = []
    for t in TEXTS:
        for a, b in reversed(marks(t)[3]):
            t = t[:a] + t[b:]
        expected.append(t or "")
    assert cut == sorted(expected)
    left = decontaminate(docs, items, remove="documents")
    assert left.count() == sum(not marks(t)[1] for t in TEXTS)
    assert decontaminate(docs, items, remove="text").columns == ["doc_id", "TEXT", "n_words", "n_hit", "n_items", "items", "spans", "contaminated"]
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


def test_equal_hashes_are_told_apart():
    table = HashTable(np.array([5, 5, 9], np.uint64))
    i, e = table.find(np.array([9, 5, 1], np.uint64))
    assert sorted(zip(i.tolist(), e.tolist(), strict=True)) == [(0, 2), (1, 0), (1, 1)]
    a = texts_of(["one two", "TWO six"])
    assert same_words(a, np.array([1, 0, 3]), a, np.array([2, 3, 3])).tolist() == [True, False, True]
