"""The automaton's segmentations against the sentencepiece library."""

import random

import numpy as np
import pytest

from corpuslens.llm import pieces
from corpuslens.llm.pieces import UNIGRAM, Pieces, encode_documents
from corpuslens.session import ship_package

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")


def texts(n=300):
    rng = random.Random(1)
    parts = ["the", "of", "ting", "erst", "Größe", " ", " ", "  ", "\n", "é", "12", "日本", "😀", "aaaa", ".", "thing", "heit", "ción"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_merge_model_equals_library():
    ours, theirs = Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in texts():
        assert ours.encode(t) == theirs.encode(t), t
        assert ours.decode(ours.encode(t)) == t


def test_unigram_finds_the_best_of_all_segmentations():
    ours = Pieces(PATH)
    ours.kind = UNIGRAM

    def best(text):
        if not text:
            return 0.0
        heads = [text[:k] for k in range(1, len(text) + 1) if text[:k] in ours.id]
        return max((ours.score[h] + best(text[len(h):]) for h in heads), default=float("-inf"))

    for t in ["▁thing", "▁heitening", "▁ander", "tingting", "▁thonble"]:
        assert sum(ours.score[x] for x in ours.segment(t)) == pytest.approx(best(t))


def test_texts_in_step_equal_the_library():
    ours, theirs = Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    some = texts() + ["", " ", "\ud7ff\U0010ffff x", "Привет мир, שלום", "a" * 400 + " " + "the" * 300, "ab\ncd " * 50]
    for _ in range(2):
        got = [np.frombuffer(x, "<i4").tolist() for x in ours.encode_all(some)]
        assert got == theirs.encode(some)
    assert max(map(len, ours._known)) <= pieces.LONG_STRETCH


def test_unigram_in_step_equals_one_by_one():
    ours = Pieces(PATH)
    ours.kind = UNIGRAM
    some = list({s for t in texts() for s in pieces._STRETCH.findall(t.replace(" ", pieces.SPACE))})
    value = lambda ids: sum(ours._scores[ids])
    for s, raw in zip(some, ours._segment_all(some), strict=True):
        ids, alone = np.frombuffer(raw, "<i4"), np.frombuffer(ours._ids(ours.segment(s)), "<i4")
        assert value(ids) == pytest.approx(value(alone)) and ours.decode(ids.tolist()) == ours.decode(alone.tolist())


def test_oldest_stretches_are_forgotten(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 10)
    monkeypatch.setattr(pieces, "PAIR_BITS", 3)
    ours, theirs = Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in texts(60):
        assert ours.encode(t) == theirs.encode(t)
    assert len(ours._known) < 100


def test_documents(spark):
    ship_package(spark)
    table = spark.createDataFrame([(0, None, 1), (1, "", 2), (2, "a  b\n", 3), (2, "a  b\n", 3)], "doc_id long, text string, ids int")
    got = encode_documents(table, PATH).collect()
    assert [r["decoded"] for r in got] == ["", "", "a  b\n", "a  b\n"] and got[0]["ids"] == []
    assert encode_documents(table.limit(0), PATH).count() == 0
