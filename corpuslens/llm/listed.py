"""Rows told apart by a list of keys, without a shuffle of the rows that are not listed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.session import BROADCAST_ROWS, durable, small_side

#: A block of the Bloom filter is a row of WORDS 64-bit words; a key sets PROBES bits of one block.
WORDS, PROBES = 8, 5
KEYS_PER_BLOCK = 32
#: With more keys than fill these, blocks get fuller: more rows are looked up, and the result is the same.
MOST_BLOCKS = BROADCAST_ROWS


def _places(names: list[str]) -> list[Column]:
    """The places of a key's bits in its block."""
    hashed = F.xxhash64(*names)
    return [F.shiftrightunsigned(hashed, 9 * k).bitwiseAND(F.lit(64 * WORDS - 1)).cast("int") for k in range(PROBES)]


def _block(names: list[str], blocks: int) -> Column:
    return F.pmod(F.hash(*names), F.lit(blocks))


def _filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(_block, _words) of the blocks that hold keys."""
    names = listed.columns
    bits = listed.select(_block(names, blocks).alias("_block"), F.explode(F.array(*_places(names))).alias("p"))
    bits = bits.select("_block", F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, p & 63)").alias("bit"))
    words = [F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("bit"))), F.lit(0).cast("long")) for w in range(WORDS)]
    return bits.groupBy("_block").agg(F.array(*words).alias("_words"))


def _equal(names: list[str], others: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(names, others, strict=True)])


def parted(rows: DataFrame, listed: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the rows whose columns `names` are a row of `listed`, the others); NULL equals NULL.

    `listed` is a stored table of different keys with these columns. A broadcast Bloom filter tells most other rows;
    it has some 2 bytes a key and ends at MOST_BLOCKS. The keys alone of those it cannot tell are compared with
    `listed`, and the few found unlisted are let through by name, so the result is exact.
    """
    count = listed.count()
    if not count:
        return rows.limit(0), rows
    blocks = min(-(-count // KEYS_PER_BLOCK), MOST_BLOCKS)
    marks = durable(_filter(listed.select(*names), blocks))
    held = [F.getbit(F.get("_words", F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1 for p in _places(names)]
    tested = rows.join(F.broadcast(marks), _block(names, blocks) == F.col("_block"), "left")
    tested = tested.select(*rows.columns, (F.col("_words").isNotNull() & reduce(Column.__and__, held)).alias("_maybe"))
    maybe, others = tested.where("_maybe").drop("_maybe"), tested.where("not _maybe").drop("_maybe")
    there = [f"_listed{k}" for k in range(len(names))]
    known, same = listed.select(*names).toDF(*there), _equal(names, there)
    free = durable(maybe.select(*names).distinct().join(small_side(known), same, "left_anti")).toDF(*there)
    return maybe.join(small_side(known), same, "left_semi"), others.unionByName(maybe.join(small_side(free), same, "left_semi"))
