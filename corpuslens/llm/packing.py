"""Packing: shortest-pack-first over the histogram of lengths, joined back to the documents by rank."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.encoding import encoder
from corpuslens.llm.tables import documents, id_and_text, query
from corpuslens.llm.words import slices, text_buffers
from corpuslens.session import durable

SEQUENCE = 2048
END_ID = 1


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most `capacity` ids of every whole text: doc_id, start, length, ids (little-endian 32-bit),
    doc_tokens. A document has at least its end id; all its pieces but the last are full."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keep_space=False).encode
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for i, j in slices(text_buffers(texts)[1], 2_000_000):
                ids, at = encode(texts.slice(i, j - i).to_pylist())
                rows = j - i
                # Every document's ids, then its end.
                place = np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(at))
                full = np.full(len(ids) + rows, end_id, "<u4")
                full[place] = ids
                begin = at + np.arange(rows + 1)
                size = np.diff(begin)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(rows), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * capacity
                length = np.minimum(size[row] - start, capacity)
                where = begin[row] + start
                blobs = [full[a : a + n].tobytes() for a, n in zip(where, length, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, rows).take(pa.array(row)), pa.array(start), pa.array(length),
                     pa.array(blobs, pa.binary()), pa.array(size[row])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    part = id_and_text(docs)
    kind = part.schema["doc_id"].dataType.simpleString()
    return part.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")


def packing_patterns(histogram: dict[int, int], capacity: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """(copies, {length: times}) of all packs, for `histogram` {length: pieces}.

    Lengths are placed longest first. Each goes to the shortest pack (the one with the most room), all packs of a
    pattern at once; if it fits nowhere, new packs take as many of it as they can hold. The work depends on the
    number of different lengths only.
    """
    open_packs: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and (room := max((r for r, packs in open_packs.items() if packs), default=-1)) >= length:
            copies, pattern = open_packs[room].pop()
            used = min(copies, left)
            if used < copies:
                open_packs[room].append((copies - used, pattern))
            open_packs[room - length].append((used, pattern | {length: pattern.get(length, 0) + 1}))
            left -= used
        each = capacity // length
        packs, rest = divmod(left, each)
        if packs:
            open_packs[capacity - each * length].append((packs, {length: each}))
        if rest:
            open_packs[capacity - rest * length].append((1, {length: rest}))
    return [x for room in sorted(open_packs) for x in open_packs[room]]


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """Ranges of ranks by (length, first rank): times per pack, the first pack's number, the offset in the pack."""
    taken: dict[int, int] = defaultdict(int)
    rows, first_pack = [], 0
    for copies, pattern in patterns:
        offset = 0
        for length, times in sorted(pattern.items(), reverse=True):
            rows.append((length, taken[length], times, first_pack, offset))
            taken[length] += copies * times
            offset += length * times
        first_pack += copies
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return tuple(table[:, k] for k in range(5))


def place_pieces(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """`pieces` (doc_id, start, length, ...) with sequence_id and offset.

    Only the histogram, of at most `capacity` rows, and the patterns made from it are on the driver. Ranks within
    a length are counted per (bucket of rows, length), so a length that most pieces share is spread over buckets.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    length_of, first_rank, times, first_pack, offset_of = _slots(packing_patterns(histogram, capacity))
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start")
    ranked = (
        dealt.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, ["length", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before")
    )
    names = [c for c in pieces.columns]
    step = 1 << 44  # ranks of a length are below
    keys = length_of * step + first_rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            slot = np.searchsorted(keys, length * step + rank, "right") - 1
            nth = rank - first_rank[slot]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(first_pack[slot] + nth // times[slot]), pa.array(offset_of[slot] + nth % times[slot] * length)],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "_rank").mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Every id of every document, and its end id, lies in exactly one piece; sequences are numbered from 0 and filled
    from offset 0 without gaps. NULL and empty texts are one piece with the end id. Repeated rows are packed each;
    rows that are equal in doc_id and text are interchangeable. Other columns are ignored. An empty table gives an
    empty table. Places are found without the ids, which join them by the number of their stored row.
    """
    pieces = durable(cut_documents(docs, tokenizer, capacity).withColumn("_piece", F.monotonically_increasing_id()))
    placed = durable(place_pieces(pieces.drop("ids"), capacity))
    return placed.join(pieces.select("_piece", "ids"), "_piece").select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces, with the checksum of their ids instead of the ids."""
    import public_tokenizers

    packed = pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
