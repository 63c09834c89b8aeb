"""Token ids in binary files: patched frame-of-reference blocks behind an index of block starts.

A file is a Parquet file whose rows are segments; a segment image is self-contained:

    "PFR2" | ids u64 | documents u32 | blocks u32 | documents without doc_id u32, which come first
    | doc_id i64 x documents | ids per document u32 x documents | block start u32 x (blocks + 1) | blocks

and a block of up to BLOCK ids is

    minimum u32 | count u16 | width u8 | exceptions u8 | low bits, packed | positions u8 | high bits u32

The width covers the PERCENTILE of the block's differences to its minimum; larger ones keep their low bits in place
and their high bits in the exception list. Parquet only carries the images, so that any store Spark knows will do.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.encoding import encoder
from corpuslens.llm.tables import documents, id_and_text, query
from corpuslens.llm.words import slices, text_buffers
from corpuslens.session import durable, scratch_path

BLOCK = 128
PERCENTILE = 90
END_ID = 0
_HEAD = struct.Struct("<4sQIII")
_BLOCK_HEAD = np.dtype([("low", "<u4"), ("count", "<u2"), ("width", "u1"), ("exceptions", "u1")])


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _holds(width: int) -> np.dtype:
    """Little-endian numbers of 16 bits, or 32 if these are too few."""
    return np.dtype("<u2" if width <= 16 else "<u4")


def encode_segment(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, unnamed: int = 0) -> bytes:
    """The image of documents with the given ids and numbers of token ids; the first `unnamed` ones have no id."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    padded[len(ids) :] = ids[-1] if len(ids) else 0
    table = padded.reshape(blocks, BLOCK)
    low = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    gap = table - low[:, None]
    kth = BLOCK * PERCENTILE // 100 - 1
    width = _bit_length(np.partition(gap, kth, axis=1)[:, kth]) if blocks else np.zeros(0, np.int64)
    over = gap.astype(np.uint64) >> width.astype(np.uint64)[:, None]
    outlier = over > 0
    head = np.zeros(blocks, _BLOCK_HEAD)
    head["low"], head["count"], head["width"] = low, BLOCK, width
    if blocks:
        head["count"][-1] = len(ids) - (blocks - 1) * BLOCK
    head["exceptions"] = outlier.sum(axis=1)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w == 0:
            continue
        for at in range(0, len(rows), 2048):
            some = rows[at : at + 2048]
            kind = _holds(w)
            bits = np.unpackbits(gap[some].astype(kind).view(np.uint8).reshape(len(some), BLOCK, -1), axis=2, count=w, bitorder="little")
            made = np.packbits(bits.reshape(len(some), -1), axis=1, bitorder="little")
            for r, image in zip(some, made, strict=True):
                packed[r] = image.tobytes()
    row, position = np.nonzero(outlier)
    cut = np.searchsorted(row, np.arange(blocks + 1))
    position, high = position.astype(np.uint8), over[outlier].astype("<u4")
    body = [
        head[b : b + 1].tobytes() + packed[b] + position[cut[b] : cut[b + 1]].tobytes() + high[cut[b] : cut[b + 1]].tobytes()
        for b in range(blocks)
    ]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in body], dtype=np.int64)]).astype("<u4")
    return b"".join([
        _HEAD.pack(b"PFR2", len(ids), len(doc_ids), blocks, unnamed), doc_ids.astype("<i8").tobytes(),
        sizes.astype("<u4").tobytes(), starts.tobytes(), *body,
    ])


def _layout(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """(doc_ids, sizes, block starts, where the blocks begin, documents without id)."""
    magic, _, docs, blocks, unnamed = _HEAD.unpack_from(image)
    if magic != b"PFR2":
        raise ValueError("not a segment of token ids")
    at = _HEAD.size
    doc_ids = np.frombuffer(image, "<i8", docs, at)
    sizes = np.frombuffer(image, "<u4", docs, at + 8 * docs)
    starts = np.frombuffer(image, "<u4", blocks + 1, at + 12 * docs)
    return doc_ids, sizes, starts, at + 12 * docs + 4 * (blocks + 1), unnamed


def read_blocks(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks first..last-1, found by the index; the others are not touched."""
    _, _, starts, origin, _ = _layout(image)
    last = len(starts) - 1 if last is None else min(last, len(starts) - 1)
    data = np.frombuffer(image, np.uint8)
    at = starts[first:last].astype(np.int64) + origin
    if not len(at):
        return np.zeros(0, np.uint32)
    head = data[at[:, None] + np.arange(_BLOCK_HEAD.itemsize)].copy().view(_BLOCK_HEAD)[:, 0]
    out = np.zeros((len(at), BLOCK), np.uint64)
    width = head["width"].astype(np.int64)
    at += _BLOCK_HEAD.itemsize
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w == 0:
            continue
        for k in range(0, len(rows), 2048):
            some = rows[k : k + 2048]
            raw = data[at[some][:, None] + np.arange(BLOCK * w // 8)]
            kind = _holds(w)
            bits = np.zeros((len(some), BLOCK, 8 * kind.itemsize), np.uint8)
            bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(some), BLOCK, w)
            out[some] = np.packbits(bits.reshape(len(some), -1), axis=1, bitorder="little").view(kind)
    at += BLOCK * width // 8
    many = head["exceptions"].astype(np.int64)
    row = np.repeat(np.arange(len(at)), many)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    high = data[(at[row] + many[row] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0].astype(np.uint64)
    out[row, data[at[row] + nth]] |= high << width[row].astype(np.uint64)
    ids = (out + head["low"].astype(np.uint64)[:, None]).astype(np.uint32)
    return ids[np.arange(BLOCK) < head["count"].astype(np.int64)[:, None]]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole text, append `end_id`, and write segments in ascending doc_id order below `path`.

    NULL and empty texts have the end id alone. Rows without doc_id, or with one that is no 64-bit integer, come first
    and have no id in the file. Rows of one id are ordered by a hash of the text, equal rows by their place in `docs`,
    so that one frequent id is dealt to many tasks; `docs` must therefore be a stored table or another one whose rows
    come in the same order whenever a task runs again. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer, keep_space=True).encode
        nth = 0
        for batch in batches:
            texts = batch.column("text").fill_null("")
            named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            numbers = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in slices(text_buffers(texts)[1], 2_000_000):
                ids, at = encode_texts(texts.slice(i, j - i).to_pylist())
                full = np.full(len(ids) + j - i, end_id, np.uint32)
                full[np.arange(len(ids)) + np.repeat(np.arange(j - i), np.diff(at))] = ids
                image = encode_segment(numbers[i:j], np.diff(at) + 1, full, int((~named[i:j]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(numbers[i]) if named[i] else None], pa.int64()), pa.array([nth]), pa.array([len(full)]), pa.array([image], pa.large_binary())],
                    names=["first_doc", "segment", "n_ids", "image"],
                )
                nth += 1

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "_tie", "_place"]
    rows = id_and_text(docs).select(F.col("doc_id").try_cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"),
                                    F.monotonically_increasing_id().alias("_place"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    segments = ordered.select("doc_id", "text").mapInArrow(encode, "first_doc long, segment long, n_ids long, image binary")
    segments.withColumn("shard", F.spark_partition_id().cast("long")).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (little-endian 32-bit) from the files."""
    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(
        files.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside"))
        .join(shards, "shard").select("shard", "segment", (F.col("inside") + F.col("shard_start")).alias("start"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image, start in zip(batch.column("image"), batch.column("start").to_pylist(), strict=True):
                raw = image.as_py()
                doc_ids, sizes, _, _, unnamed = _layout(raw)
                ids = read_blocks(raw).astype("<u4")
                ends = np.cumsum(sizes.astype(np.int64))
                begin = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=np.arange(len(doc_ids)) < unnamed), pa.array(begin + start), pa.array(sizes.astype(np.int64)),
                     pa.array([ids[a:b].tobytes() for a, b in zip(begin, ends, strict=True)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return files.select("shard", "segment", "image").join(starts, ["shard", "segment"]).select("image", "start").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary"
    )


@query("op10_token_binary")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
