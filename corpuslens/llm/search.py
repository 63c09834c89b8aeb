"""Ranked lexical search by bag deduplication: equal restricted documents are scored once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.tables import documents, id_and_text, query
from corpuslens.llm.terms import BLOCK_BYTES, HashTable, item_blocks, same_words, spread_out, terms_of, texts_of
from corpuslens.llm.words import slices, text_buffers
from corpuslens.session import durable, small_side

TOP_K = 50
LANES = 64
_SCORED = 2_000_000


class Vocabulary:
    """The distinct terms of a block of items, and for every term the items that hold it."""

    def __init__(self, items: list[Row]):
        words = texts_of([r.text for r in items])
        hashed, owner = words.hashes(), words.texts()
        order = np.argsort(hashed, kind="stable")
        run = np.concatenate([[True], hashed[order][1:] != hashed[order][:-1]]) if len(order) else np.zeros(0, bool)
        leader = np.empty(len(order), np.int64)
        leader[order] = order[run][np.cumsum(run) - 1]
        other = ~same_words(words, np.arange(len(leader)), words, leader)
        leader[other] = np.flatnonzero(other)
        kept = np.unique(leader)
        kept = kept[np.argsort(hashed[kept], kind="stable")]
        number = np.empty(len(hashed), np.int64)
        number[kept] = np.arange(len(kept))
        pairs = np.unique(number[leader] * max(1, len(items)) + owner)
        self.words, self.kept, self.table = words, kept, HashTable(hashed[kept])
        self.size, self.n_items = len(kept), len(items)
        self.items = pairs % max(1, len(items))
        self.first = np.searchsorted(pairs // max(1, len(items)), np.arange(len(kept) + 1))

    def find(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term): the words that are terms of the items, compared byte by byte."""
        word, term = self.table.find(words.hashes())
        same = same_words(words, word, self.words, self.kept[term])
        return word[same], term[same]


def _binary(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """Binary values cut from one array at `bounds` (bytes)."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]
    ).cast(pa.binary())


def _restricted(vocabulary: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every document's number of terms, and its (term, tf) pairs in order of the term as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets):
                words = terms_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                word, term = v.find(words)
                pair, tf = np.unique(words.texts()[word] * max(1, v.size) + term, return_counts=True)
                bag = np.empty((len(pair), 2), np.int32)
                bag[:, 0], bag[:, 1] = pair % max(1, v.size), tf
                bounds = np.searchsorted(pair // max(1, v.size), np.arange(j - i + 1)) * 8
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts().astype(np.int64)), _binary(bounds, bag)], ["doc_id", "n", "bag"]
                )

    return run


def _bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of a column of bags."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    pairs = np.frombuffer(data, np.int32)[ends[0] // 4 : ends[-1] // 4].reshape(-1, 2) if data is not None else np.zeros((0, 2), np.int32)
    return np.repeat(np.arange(len(column)), np.diff(ends) // 8), pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64)


def _frequencies(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents of the task that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_bags(batch.column(0))[1], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    return run


class _Best:
    """The k best classes of every item, of those offered so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.parts, self.held = k, [], 0
        self.least = np.ones(n_items, np.int64)

    def offer(self, part: pa.Table) -> None:
        self.parts.append(part)
        self.held += part.num_rows
        if self.held > max(_SCORED, 2 * self.k * len(self.least)):
            self.parts = [self.best()]
            self.held = self.parts[0].num_rows
            item, score = (self.parts[0].column(c).to_numpy() for c in ("item", "score"))
            size = np.bincount(item, minlength=len(self.least))
            full = np.flatnonzero(size >= self.k)
            self.least[full] = score[np.cumsum(size)[full] - 1]

    def best(self) -> pa.Table:
        """By item, then the highest score, then the smallest first doc_id (NULL last)."""
        table = pa.concat_tables(self.parts)
        order = [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending"), ("class", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_end"))
        item = table.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        return table.filter(pa.array(rank < self.k))


def _scored(index: Broadcast, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task's k best classes of every item; integer scores of a chunk of classes times all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, weight = index.value
        best = _Best(v.n_items, k)
        holders = np.diff(v.first)
        for batch in batches:
            row, term, tf = _bags(batch.column(3))
            m = batch.column(2).to_numpy()
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
            work = np.cumsum(np.bincount(row, holders[term], batch.num_rows) + v.n_items)
            at = 0
            while at < batch.num_rows:
                done = work[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(work, done + _SCORED, "right")))
                a, b = np.searchsorted(row, [at, end])
                which, place = spread_out(v.first[term[a:b]], holders[term[a:b]])
                score = np.zeros((end - at, v.n_items), np.int64)
                np.add.at(score.reshape(-1), (row[a:b][which] - at) * v.n_items + v.items[place], value[a:b][which])
                found, item = np.nonzero(score >= best.least)
                rows = pa.array(found + at)
                best.offer(pa.table({
                    "item": item, "score": score[found, item],
                    "class": batch.column(0).take(rows), "doc_id": batch.column(1).take(rows),
                }))
                at = end
        if best.parts:
            yield from best.best().to_batches()

    return run


def _block_search(docs: DataFrame, items: list[Row], k: int) -> DataFrame:
    """(item, rank, doc_id, score) for one block of items; `item` is the place in the block."""
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    vocabulary = Vocabulary(items)
    restricted = docs.mapInArrow(_restricted(spark.sparkContext.broadcast(vocabulary)), f"doc_id {id_type}, n long, bag binary")
    bags = durable(restricted.withColumn("class", F.monotonically_increasing_id()))
    total = bags.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    df = np.zeros(vocabulary.size, np.int64)
    # One row for each term of the block.
    for r in bags.select("bag").mapInArrow(_frequencies(vocabulary.size), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weight = np.floor(1000 * np.log((2 * total.N + 2) / (2 * df + 1))).astype(np.int64)
    m = F.expr(f"50 + (50 * n * {total.N}L) div {max(1, total.L)}L")
    used = bags.where("octet_length(bag) > 0").select("doc_id", "class", m.alias("m"), "bag").withColumn("hash", F.xxhash64("bag", "m"))
    # Documents of one hash whose bag and m are the same are a class. All members score alike, so beyond its k smallest
    # ids no member can be among an item's k best.
    by = Window.partitionBy("hash", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last(), "class")
    members = used.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)
    members = durable(members.withColumn("class", F.first("class").over(by)))
    index = spark.sparkContext.broadcast((vocabulary, weight))
    classes = members.where("place = 1").select("class", "doc_id", "m", "bag")
    scored = classes.mapInArrow(_scored(index, k), f"item long, score long, class long, doc_id {id_type}")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("class")]
    # The classes of all tasks are merged in two steps, so that no task gets what all tasks found for an item.
    lanes = Window.partitionBy("item", "lane").orderBy(*order)
    few = scored.withColumn("lane", F.pmod("class", F.lit(LANES))).withColumn("r", F.row_number().over(lanes)).where(F.col("r") <= k)
    top = Window.partitionBy("item").orderBy(*order)
    chosen = durable(few.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k).select("item", "class", "score"))
    listed = members.select("class", "doc_id", "place").join(small_side(chosen), "class")
    last = Window.partitionBy("item").orderBy(*order, "place")
    return listed.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` highest-scoring documents of every item, scores above 0.

    `docs` has doc_id and text, `items` item_id and text. Documents are restricted to the terms of the items; those
    with the same terms, frequencies and length norm are found by a hash, verified and scored once. Items are read in
    blocks of about `block_bytes` of text, one pass over the documents for each, so what is broadcast stays bounded.

    Equal scores go by ascending doc_id, NULL last. NULL and empty texts have no terms: such documents are never found,
    and such items have no rows. Repeated rows are documents, or items, of their own, each with ranks from 1 for
    items. Other columns are ignored; empty tables give an empty table.
    """
    spark = docs.sparkSession
    source = id_and_text(docs)
    types = (exact_type(items, "item_id"), source.schema["doc_id"].dataType.simpleString())
    out = spark.createDataFrame([], f"item_id {types[0]}, rank int, doc_id {types[1]}, score long")
    for block in item_blocks(items, block_bytes):
        found = durable(_block_search(source, block, k))
        # As many names as the block has items, which are on the driver already.
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"item long, item_id {types[0]}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def exact_type(table: DataFrame, name: str) -> str:
    """The type of the first column of exactly this name."""
    return table.schema.fields[table.columns.index(name)].dataType.simpleString()


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
tot AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM len),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY t) CROSS JOIN tot),
m AS (SELECT doc_id, 50 + (50 * n * nn) // ll AS m FROM len CROSS JOIN tot),
s AS (SELECT q.item_id, tf.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m))) AS BIGINT) AS score
      FROM q JOIN tf ON tf.t = q.t JOIN w ON w.t = q.t JOIN m ON m.doc_id = tf.doc_id GROUP BY q.item_id, tf.doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= {TOP_K}
"""


@query("op11_ranked_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
