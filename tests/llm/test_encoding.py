"""Ids made from stretches of a text equal the library's ids of the whole text."""

import random

import pytest

from corpuslens.llm.encoding import Encoder

public_tokenizers = pytest.importorskip("public_tokenizers")

CHARACTERS = "aB zé'sÀİŉſß 12²½ªµ\n\t \r.,-«»“”—…!'llＡñÑŸ\u0301ǅȺ°×÷&<|>_\xa0"


@pytest.mark.parametrize("name, keep_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_library(name, keep_space):
    rng = random.Random(5)
    texts = ["", " ", "it's 10 o'clock", "Größe  der\n\n Straße", "<|endoftext|>x", "İstanbul Ⱥ"]
    texts += ["".join(rng.choice(CHARACTERS) for _ in range(rng.randrange(40))) for _ in range(4000)]
    encoder = Encoder(public_tokenizers.path(name), keep_space)
    for _ in range(2):  # the second time from the cache
        ids, at = encoder.encode(texts)
        whole = [x.ids for x in encoder._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == whole
