"""Stretches are found and told apart as spans of bytes, for many texts at once."""

import numpy as np
import pytest

from corpuslens.llm import binary, encoding

public_tokenizers = pytest.importorskip("public_tokenizers")
KINDS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
TEXTS = ["it's", "'s 's\n'll'd '", "", "x", "  \n ", "a\n\nb  c ", "'", "s", "Straße'S 12ab", "ΑΣ 'll", "a<|b", "re've''ve"]


def _parts(encoder, texts):
    ids, at = encoder.encode(texts)
    return [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)]


@pytest.mark.parametrize("name, keep_space", KINDS)
def test_a_repeated_word_is_looked_up_once(name, keep_space, monkeypatch):
    asked = []
    look_up = encoding.Encoder._look_up
    monkeypatch.setattr(encoding.Encoder, "_look_up", lambda self, some, latin: asked.extend(some) or look_up(self, some, latin))
    encoder = encoding.Encoder(public_tokenizers.path(name), keep_space)
    ids, at = encoder.encode(["word " * 50_000] * 3)
    assert len(asked) <= 3 and np.diff(at).tolist() == [len(ids) // 3] * 3


@pytest.mark.parametrize("name, keep_space", KINDS)
def test_stretches_do_not_go_over_texts_and_equal_hashes_are_told_apart(name, keep_space, monkeypatch):
    encoder = encoding.Encoder(public_tokenizers.path(name), keep_space)
    whole = [x.ids for x in encoder._tokenizer.encode_batch_fast(TEXTS, add_special_tokens=False)]
    assert _parts(encoder, TEXTS) == whole
    monkeypatch.setattr(encoding, "span_hashes", lambda data, start, stop: np.zeros(len(start), np.uint64))
    assert _parts(encoding.Encoder(public_tokenizers.path(name), keep_space), TEXTS) == whole


def test_what_is_met_again_and_again_stays_known(monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_ENTRIES", 40)
    encoder = encoding.Encoder(public_tokenizers.path("word_bpe_49k.json"), False)
    learnt = []
    ids = encoder._ids
    encoder._ids = lambda texts, latin=False: learnt.extend(texts) or ids(texts, latin)
    for k in range(100):
        encoder.encode([f"common x{'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}"])
    assert learnt.count("common") == 1 and len(encoder._known) + len(encoder._before) <= 40


@pytest.mark.parametrize("top", [1, 2, 60_000, 70_000, 2**32 - 1])
def test_segments_hold_all_ids(top):
    rng = np.random.default_rng(3)
    ids = np.where(rng.random(1000) < 0.9, rng.integers(0, top, 1000), rng.integers(0, 2**32 - 1, 1000)).astype(np.uint32)
    image = binary.encode_segment(np.arange(1), np.array([1000]), ids)
    assert np.array_equal(binary.read_blocks(image), ids) and np.array_equal(binary.read_blocks(image, 2, 4), ids[256:512])
