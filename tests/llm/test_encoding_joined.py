"""Latin stretches go to the library many at a time."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from corpuslens.llm.encoding import Encoder  # noqa: E402


class Counted:
    """Passes on to a tokenizer and counts the texts it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


@pytest.mark.parametrize(("name", "keep_space"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_few_library_texts(name, keep_space):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéüÀß") for _ in range(9)) for _ in range(2000)]
    odd = ["", "ab  c", "don't \x00 we'll 12 345 --\n\n x  ", "", " ", "日本  word", "<|endoftext|> a"]
    texts = [" ".join(words), *odd, " ".join(words[::-1])]
    made = Encoder(public_tokenizers.path(name), keep_space)
    counted = made.__dict__["_plain"] = Counted(made._plain)
    ids, at = made.encode(texts)
    # The stretches of the texts of words and a few others; each was a text for the library.
    assert 0 < counted.texts < 200
    whole = made._tokenizer
    for text, a, b in zip(texts, at[:-1], at[1:], strict=True):
        assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids
