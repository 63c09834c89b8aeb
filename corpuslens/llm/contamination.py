"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned windows, verified hits, removal."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.tables import documents, packed_rows, query
from corpuslens.llm.terms import BLOCK_BYTES, HashTable, item_blocks, same_words, spread_out, terms_of, texts_of
from corpuslens.llm.words import Words, slices, text_buffers, window_hashes
from corpuslens.session import durable

WINDOW = 10
_CANDIDATES = 200_000
MARKS = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated")


def _same_runs(a: Words, i: np.ndarray, b: Words, j: np.ndarray, size: int) -> np.ndarray:
    """Whether the `size` words of `a` from i[k] are those of `b` from j[k]."""
    same = np.ones(len(i), bool)
    for k in range(size):
        left = np.flatnonzero(same)
        same[left] = same_words(a, i[left] + k, b, j[left] + k)
    return same


class Windows:
    """The different windows of a block of items, by their number of words: where each is found, and whose it is."""

    def __init__(self, items: list[Row], window: int):
        self.words = texts_of([r.text for r in items])
        # Rows of one id are one item.
        self.names = sorted({_name(r.item_id) for r in items})
        place = {n: k for k, n in enumerate(self.names)}
        item_of = np.array([place[_name(r.item_id)] for r in items], np.int64)
        hashed, owner, counts = self.words.hashes(), self.words.texts(), self.words.counts()
        self.sizes: dict[int, tuple[HashTable, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({int(min(c, window)) for c in counts if c}):
            runs = window_hashes(hashed, size)
            # Shorter items are one window, from their first word.
            start = np.flatnonzero(owner[: len(runs)] == owner[size - 1 :])
            start = start[(counts[owner[start]] == size) | (size == window)]
            start = start[np.argsort(runs[start], kind="stable")]
            run = np.concatenate([[True], runs[start][1:] != runs[start][:-1]])
            leader = np.flatnonzero(run)[np.cumsum(run) - 1]
            other = ~_same_runs(self.words, start, self.words, start[leader], size)
            leader[other] = np.flatnonzero(other)
            kept, entry = np.unique(leader, return_inverse=True)
            pairs = np.unique(entry * len(self.names) + item_of[owner[start]])
            first = np.searchsorted(pairs // len(self.names), np.arange(len(kept) + 1))
            self.sizes[size] = (HashTable(runs[start[kept]]), start[kept], first, pairs % len(self.names))

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Per word whether a window covers it, and pairs text * items + item as sorted different numbers."""
        hashed, text = words.hashes(), words.texts()
        edge, found = np.zeros(len(text) + 1, np.int64), []
        for size, (table, start, first, item) in self.sizes.items():
            runs = window_hashes(hashed, size)
            at, entry = table.find(runs)
            inside = text[at] == text[at + size - 1] if len(at) else np.zeros(0, bool)
            at, entry = at[inside], entry[inside]
            for k in range(0, len(at), _CANDIDATES):
                i, e = at[k : k + _CANDIDATES], entry[k : k + _CANDIDATES]
                same = _same_runs(words, i, self.words, start[e], size)
                i, e = i[same], e[same]
                np.add.at(edge, i, 1)
                np.add.at(edge, i + size, -1)
                pair = np.unique(text[i] * len(start) + e)
                which, place = spread_out(first[pair % len(start)], np.diff(first)[pair % len(start)])
                found.append(np.unique((pair // len(start))[which] * len(self.names) + item[place]))
        return np.cumsum(edge[:-1]) > 0, np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _name(item_id: object) -> str:
    return "" if item_id is None else str(item_id)


def _runs(covered: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) word of every longest run of covered words inside one text."""
    new = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
    before = np.concatenate([[False], covered[:-1]]) & ~new
    after = np.concatenate([covered[1:], [False]]) & ~np.concatenate([new[1:], [True]]) if len(text) else before
    return np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after)


def _strings(names: list[str], offsets: np.ndarray, which: np.ndarray) -> pa.Array:
    values = pa.array(names, pa.string()).take(pa.array(which)) if len(which) else pa.array([], pa.string())
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _marked(windows: Broadcast, earlier: bool, last: bool, cut: bool, text_kept: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Marks of one block of items, added to those of the blocks before it (`_from`, `_to`: words, `items`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = windows.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in slices(offsets):
                part = batch.slice(i, j - i)
                raw, ends = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                words = terms_of(raw, ends)
                text = words.texts()
                covered, pairs = block.hits(words)
                owner, names = pairs // max(1, len(block.names)), block.names
                if earlier:
                    edge = np.zeros(len(text) + 1, np.int64)
                    for column, step in (("_from", 1), ("_to", -1)):
                        held = part.column(column)
                        rows = np.repeat(np.arange(j - i), held.value_lengths().to_numpy())
                        np.add.at(edge, words.first[rows] + held.flatten().to_numpy(), step)
                    covered |= np.cumsum(edge[:-1]) > 0
                items = _strings(names, np.searchsorted(owner, np.arange(j - i + 1)), pairs % max(1, len(names)))
                if earlier:
                    both = [sorted({*old, *new}) for old, new in zip(part.column("items").to_pylist(), items.to_pylist(), strict=True)]
                    items = pa.array(both, pa.list_(pa.string()))
                first, stop = _runs(covered, text)
                held = np.searchsorted(text[first], np.arange(j - i + 1)).astype(np.int32)
                out = {"_row": part.column("_row")}
                if not last:
                    base = words.first[text[first]]
                    out["text"] = part.column("text").cast(pa.string())
                    out["_from"] = pa.ListArray.from_arrays(pa.array(held), pa.array(first - base))
                    out["_to"] = pa.ListArray.from_arrays(pa.array(held), pa.array(stop + 1 - base))
                    out["items"] = items
                    yield pa.RecordBatch.from_pydict(out)
                    continue
                a, b = words.start[first], words.stop[stop]
                if text_kept:
                    out["text"] = _without(raw, ends, a, b) if cut else part.column("text").cast(pa.string())
                # Code points before a byte: bytes that don't continue one.
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                base = points[ends[:-1]][text[first]]
                spans = pa.StructArray.from_arrays([pa.array(points[a] - base), pa.array(points[b] - base)], ["start", "end"])
                out["n_words"] = pa.array(words.counts().astype(np.int64))
                out["n_hit"] = pa.array(np.bincount(text[covered], minlength=j - i).astype(np.int64))
                out["n_items"] = pa.array(items.value_lengths().to_numpy().astype(np.int64))
                out["items"] = items
                out["spans"] = pa.ListArray.from_arrays(pa.array(held), spans)
                out["contaminated"] = pa.array(np.diff(held) > 0)
                yield pa.RecordBatch.from_pydict(out)

    return run


def _without(raw: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """The texts without the bytes a..b."""
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, b, -1)
    kept = np.cumsum(edge[:-1]) == 0
    bounds = np.concatenate([[0], np.cumsum(kept)])[ends].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(ends) - 1, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw[kept].tobytes())]
    ).cast(pa.string())


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, remove: str | None = "spans", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, items, spans and contaminated, and what occurs in `items` removed.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the texts with A-Z in lower case. A window is `window`
    consecutive words of an item's text; an item of fewer words, but not none, is one window. Words inside an
    occurrence of a window are hit; `n_hit` counts them, `spans` lists the longest runs of hit words as (start, end) in
    code points of the given text, `items` the sorted ids (as strings) of the items whose windows occur.

    `remove`: "spans" cuts these spans out of the text, "documents" leaves contaminated rows out, None leaves the
    texts; "text" leaves the text column out, for callers that only need the marks.

    Hashes of windows only name candidates; hits are verified byte by byte. Documents are scanned where they are,
    without a shuffle. Items are broadcast in blocks of about `block_bytes` of text; with more than one, the documents
    are stored between the passes. NULL texts have no words and stay NULL unless cut, when they become empty. An item
    without text or words has no window; a NULL item_id is reported as the empty string, and rows of one id are one
    item. Rows may repeat; columns named like the new ones are replaced; empty tables give no rows, or no hits.
    """
    spark = docs.sparkSession
    kept_text = remove != "text"
    rows, unpacked = packed_rows(docs, *MARKS)
    rows = rows.select("_row", "text")
    fields = {f.name: f for f in rows.schema.fields}
    long_list = T.ArrayType(T.LongType())
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    final = T.StructType([
        fields["_row"], *([fields["text"]] if kept_text else []), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", span),
        T.StructField("contaminated", T.BooleanType()),
    ])
    between = T.StructType([fields["_row"], fields["text"], T.StructField("_from", long_list), T.StructField("_to", long_list),
                            T.StructField("items", T.ArrayType(T.StringType()))])
    blocks, held, table, earlier = item_blocks(items, block_bytes), [], rows, False
    held = next(blocks, [])
    while True:
        # One block is looked ahead, to know the last one.
        after = next(blocks, None)
        step = _marked(spark.sparkContext.broadcast(Windows(held, window)), earlier, after is None, remove == "spans", kept_text)
        table = table.mapInArrow(step, final if after is None else between)
        if after is None:
            break
        table, held, earlier = durable(table), after, True
    if not kept_text:
        table = table.withColumn("text", F.lit(None).cast("string"))
    out = unpacked(table)
    if not kept_text:
        # By place: drop() would take columns whose names differ in case as well.
        names = out.columns
        others = [k for k, n in enumerate(names) if n != "text"]
        out = out.toDF(*(f"_{k}" for k in range(len(names)))).select(*(F.col(f"_{k}").alias(names[k]) for k in others))
    return out.where("not contaminated") if remove == "documents" else out


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS size, unnest(list_transform(
         range(1, greatest(len(ws) - {WINDOW}, 0) + 2), lambda i: array_to_string(ws[i : i + {WINDOW - 1}], ' '))) AS win
       FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS win FROM (
         SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d CROSS JOIN sizes WHERE len(ws) >= size)),
hit AS (SELECT DISTINCT doc_id, size, i FROM dw WHERE EXISTS (SELECT 1 FROM bw WHERE bw.win = dw.win AND bw.size = dw.size)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
         SELECT DISTINCT dw.doc_id, CAST(bw.item_id AS VARCHAR) AS id FROM dw JOIN bw ON bw.win = dw.win AND bw.size = dw.size) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""


@query("op13_decontamination", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="text")
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )
