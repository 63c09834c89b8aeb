import tracemalloc

import numpy as np

from corpuslens.llm import language_model as lm

WORDS = [bytes([97 + a, 97 + b, 97 + c]) for a in range(26) for b in range(26) for c in range(3)]


def _texts(n):
    rng = np.random.default_rng(2)
    text = np.frombuffer(b" ".join(WORDS[k] for k in rng.integers(0, len(WORDS), n)), np.uint8)
    return text, np.append(np.arange(0, len(text), 4000), len(text))


def test_tokens_are_numbered_by_steps():
    """Bytes held at a time for each token of a chunk: only a step's tokens are sorted together."""
    text, offsets = _texts(1_000_000)
    held = np.zeros(len(offsets) - 1, bool)
    lm._chunk(text[:4000], np.array([0, 4000]), held[:1], 8)
    tracemalloc.start()
    lm._chunk(text, offsets, held, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / 1_000_000 < 60


def test_steps_change_nothing(monkeypatch):
    text, offsets = _texts(5000)
    held = np.arange(len(offsets) - 1) % 3 == 0
    found = lm._chunk(text, offsets, held, 8)
    monkeypatch.setattr(lm, "STEP_TOKENS", 7)
    stepped = lm._chunk(text, offsets, held, 8)
    assert np.array_equal(found.pop("sizes"), stepped.pop("sizes")) and found == stepped
