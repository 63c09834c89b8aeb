import tracemalloc

import numpy as np

from corpuslens.llm import language_model as lm


def test_a_slice_of_tokens_takes_bounded_memory():
    """Bytes held at a time for each token of a slice of very short words, where tokens are most."""
    text = np.frombuffer(b"ab c de f " * 200_000, np.uint8)
    offsets = np.array([0, len(text) // 2, len(text)])
    lm._chunk(text[:1000], np.array([0, 1000]), np.array([False]), 8)
    tracemalloc.start()
    found = lm._chunk(text, offsets, np.array([False, True]), 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["sizes"].tolist() == [400_001, 400_001]
    assert peak / 800_002 < 110
