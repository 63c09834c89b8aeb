"""Terms of benchmark items and documents, compared byte by byte inside Arrow tasks.

A term is a run of ASCII letters, digits and non-ASCII bytes, with A-Z in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from corpuslens.llm.tables import exact
from corpuslens.llm.words import LOWER, Words
from corpuslens.session import durable
from corpuslens.sources.order import running_offset

#: Item texts that one pass over the documents looks for; a block holds at most this and one text more.
BLOCK_BYTES = 16_000_000
_COMPARED = 4_000_000
_BITS = 20

FOLD = LOWER.copy()
FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def terms_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The terms of several texts; their `data` is in lower case."""
    return Words(FOLD[data], offsets)


def texts_of(texts: list[str]) -> Words:
    """The terms of a list of texts."""
    parts = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return terms_of(np.frombuffer(b"".join(parts), np.uint8), offsets)


def spread_out(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, value): every begin[i], begin[i] + 1, ... of count[i] values, and its i."""
    which = np.repeat(np.arange(len(count)), count)
    ends = np.cumsum(count)
    return which, np.arange(len(which)) - np.repeat(ends - count, count) + np.repeat(begin, count)


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether word i[k] of `a` has the bytes of word j[k] of `b`."""
    length = a.stop[i] - a.start[i]
    same = length == b.stop[j] - b.start[j]
    todo = np.flatnonzero(same)
    total = np.cumsum(length[todo])
    k = 0
    while k < len(todo):
        done = total[k - 1] if k else 0
        end = max(k + 1, int(np.searchsorted(total, done + _COMPARED, "right")))
        part = todo[k:end]
        which, at = spread_out(a.start[i[part]], length[part])
        other = at + (b.start[j[part]] - a.start[i[part]])[which]
        differs = a.data[at] != b.data[other]
        same[part[which[differs]]] = False
        k = end
    return same


class HashTable:
    """Sorted 64-bit hashes behind a bitmap of their leading bits; equal hashes are all found."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[hashes >> np.uint64(64 - _BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, entry): every position of `hashes` with every entry of its hash."""
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _BITS)])
        low = np.searchsorted(self.hashes, hashes[maybe], "left")
        which, entry = spread_out(low, np.searchsorted(self.hashes, hashes[maybe], "right") - low)
        return maybe[which], entry


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Row]]:
    """The rows (item_id, text) of `items` with a text, as lists that start every `block_bytes` of text.

    One list at a time is on the driver; however many items there are, a list holds at most `block_bytes` and one text.
    """
    rows = exact(items, "item_id", "text").where("text is not null").withColumn("_bytes", F.octet_length("text").cast("long"))
    stored = durable(running_offset(durable(rows), ["item_id", "text"], "_bytes", "_from"))
    stored = stored.withColumn("_block", F.expr(f"_from div {block_bytes}"))
    last = stored.agg(F.max("_block")).first()[0]
    for block in range(0 if last is None else last + 1):
        yield stored.where(F.col("_block") == block).orderBy("item_id", "text").select("item_id", "text").collect()
