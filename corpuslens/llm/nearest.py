"""Exact top-k by inner product: a KD-tree per shard, searched best first with box bounds and a known kth score."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.tables import exact, query
from corpuslens.session import durable

K = 5
SCALE = 256
EVERY = 50
SHARD_ROWS = 16_384
QUERY_BLOCK = 512
LEAF_ROWS = 128
_TREE = "dim int, shard long, ids binary, points binary, low binary, high binary, child binary, span binary"


def _build(points: np.ndarray) -> tuple[np.ndarray, ...]:
    """(order, low, high, child, span): nodes with tight boxes; child < 0 marks a leaf, whose rows are span."""
    order = np.arange(len(points))
    low, high, child, span = [], [], [], []

    def node(first: int, stop: int) -> int:
        me, rows = len(low), points[order[first:stop]]
        low.append(rows.min(axis=0))
        high.append(rows.max(axis=0))
        child.append((-1, -1))
        span.append((first, stop))
        width = high[me] - low[me]
        if stop - first > LEAF_ROWS and len(width) and width.max() > 0:
            axis, middle = int(width.argmax()), (stop - first) // 2
            order[first:stop] = order[first:stop][np.argpartition(rows[:, axis], middle)]
            child[me] = (node(first, first + middle), node(first + middle, stop))
        return me

    node(0, len(points))
    return order, np.array(low), np.array(high), np.array(child, np.int32), np.array(span, np.int32)


def _tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    points = np.floor(SCALE * np.array(rows["x"].tolist(), np.float64).reshape(len(rows), key[0]))
    order, low, high, child, span = _build(points)
    return pd.DataFrame({
        "dim": [key[0]], "shard": [key[1]], "ids": [rows["vec_id"].to_numpy(np.int64)[order].tobytes()], "points": [points[order].tobytes()],
        "low": [low.tobytes()], "high": [high.tobytes()], "child": [child.tobytes()], "span": [span.tobytes()],
    })


def _block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    points = np.floor(SCALE * np.array(rows["x"].tolist(), np.float64).reshape(len(rows), key[0]))
    return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "query_ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "query_points": [points.tobytes()]})


def _best_first(q: np.ndarray, own: int, bounds: np.ndarray, tree: dict, k: int, least: float) -> list[tuple[int, int]]:
    """The k best (score, -id) of a tree that reach `least`. Nodes are opened by falling bound; what cannot reach the
    kth score any more ends the search, while equal scores are still looked at, as the smaller id wins."""
    best: list[tuple[int, int]] = []  # a heap with the kth on top
    front = [(-bounds[0], 0)]
    child, span, ids, points, whole = tree["child"], tree["span"], tree["ids"], tree["points"], tree["whole"]
    while front:
        bound, at = heapq.heappop(front)
        kth = max(least, best[0][0]) if len(best) == k else least
        if -bound < kth:
            break
        if child[at, 0] >= 0:
            for c in child[at]:
                if bounds[c] >= kth:
                    heapq.heappush(front, (-bounds[c], int(c)))
            continue
        first, stop = span[at]
        if whole:
            scores = [int(x) for x in points[first:stop] @ q]
        else:
            exact_q = [int(x) for x in q]
            scores = [sum(int(a) * b for a, b in zip(p, exact_q, strict=True)) for p in points[first:stop]]
        for score, i in zip(scores, ids[first:stop].tolist(), strict=True):
            if i != own and score >= kth and (len(best) < k or (score, -i) > best[0]):
                heapq.heappush(best, (score, -i)) if len(best) < k else heapq.heapreplace(best, (score, -i))
    return best


def _search(k: int, seeds: bool):
    """Search each row's block of queries in its tree; `seeds` asks for the kth scores, else for the neighbours."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                shape = lambda raw, kind, n: np.frombuffer(raw, kind).reshape(-1, n)
                tree = {"ids": np.frombuffer(r.ids, np.int64), "child": shape(r.child, np.int32, 2), "span": shape(r.span, np.int32, 2)}
                n = len(tree["ids"])
                tree["points"] = np.frombuffer(r.points).reshape(n, r.dim)
                low, high = (np.frombuffer(x).reshape(len(tree["child"]), r.dim) for x in (r.low, r.high))
                ids = np.frombuffer(r.query_ids, np.int64)
                queries = np.frombuffer(r.query_points).reshape(len(ids), r.dim)
                reach = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
                largest = float(np.abs(tree["points"]).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(r.dim, 1)
                tree["whole"] = largest < 2**53  # else integers of any size, and room for rounding in the bounds
                if not tree["whole"]:
                    reach = reach + largest * 1e-12
                least = np.full(len(ids), -np.inf) if seeds or r.least is None else np.frombuffer(r.least)
                found = [_best_first(queries[i], int(ids[i]), reach[i], tree, k, least[i]) for i in range(len(ids))]
                if seeds:
                    kth = np.array([f[0][0] if len(f) == k else -np.inf for f in found])
                    yield pd.DataFrame({"dim": [r.dim], "block": [r.block], "least": [np.nextafter(kth, -np.inf).tobytes() if not tree["whole"] else kth.tobytes()]})
                else:
                    flat = [(int(ids[i]), -j, s) for i, f in enumerate(found) for s, j in f]
                    yield pd.DataFrame(flat, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best integer inner products of each query with all other vectors.

    `vectors` and `queries` have vec_id and embedding; components become floor(256 * x). Rows whose vec_id or
    embedding is NULL, or whose embedding holds NULL or non-finite components, take no part. Vectors meet those of
    the same length only; an empty vector scores 0. Ties go to the smaller vec_id; a query has fewer rows if there
    are fewer candidates; repeated rows are candidates each, but none with the query's own id. Scores are exact;
    one that does not fit 64 bits raises an error. Other columns are ignored; empty tables give an empty table.

    Vectors are dealt by hash into shards of about SHARD_ROWS, queries into blocks of QUERY_BLOCK. Each block first
    searches one shard; its kth scores then bound the search of every other shard.
    """
    spark = vectors.sparkSession

    def sound(table: DataFrame) -> DataFrame:
        part = exact(table, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"))
        finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        return part.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("dim", F.size("x"))

    def dealt(table: DataFrame, rows: int, name: str) -> DataFrame:
        sizes = table.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / rows).alias("parts"))
        return table.join(F.broadcast(sizes), "dim").withColumn(name, F.pmod(F.xxhash64("vec_id"), "parts"))

    every, asked = sound(vectors), sound(queries)
    trees = durable(dealt(every, SHARD_ROWS, "shard").groupBy("dim", "shard").applyInPandas(_tree, _TREE))
    blocks = durable(dealt(asked, QUERY_BLOCK, "block").groupBy("dim", "block").applyInPandas(
        _block, "dim int, block long, query_ids binary, query_points binary"))
    # The numbers of the shards of each length, in lists; a handful of values per length.
    shards = trees.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    routed = durable(blocks.join(shards, "dim"))
    home = F.get("shards", F.pmod(F.col("block"), F.size("shards")).cast("int"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = routed.withColumn("shard", home).drop("shards").join(trees, ["dim", "shard"]).repartition(parts, "dim", "block")
    least = durable(near.mapInPandas(_search(k, seeds=True), "dim int, block long, least binary"))
    bounded = routed.join(least, ["dim", "block"], "left").withColumn("shard", F.explode("shards")).drop("shards")
    met = bounded.join(trees, ["dim", "shard"]).repartition(parts, "dim", "block", "shard")
    found = durable(met.mapInPandas(_search(k, seeds=False), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query("op9_exact_top_k", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
