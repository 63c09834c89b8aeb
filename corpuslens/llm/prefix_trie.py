"""Trie of the shared beginnings of conversations, from sorted LCPs and range minima.

Conversations are sorted by their sequences of turns. With lcp[i], the number of first turns that i shares with the
one before it, a prefix of depth d that is new at i has the members i..j-1, where j is the next place with lcp < d, and
the prefix around one new at i with lcp[i] = d begins at the last place before i with lcp < d. Both ends are found by
binary search in a sparse table of range minima, for every prefix by itself.

The sorted rows are dealt into blocks, each with a table of its own. A prefix that goes on behind its block leaves one
partial row per block; where it began is found in a sparse table over the blocks' minima, in as many levels as the
number of blocks needs, and partial rows are then added up. All a node needs are sums and minima over its interval.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.tables import exact, query
from corpuslens.session import durable, small_side

BLOCK = 1024
LEVEL = 4096
ID_CHUNK = 64
SEQUENCE = "array<struct<h:bigint,g:bigint,words:int>>"


@dataclass(frozen=True)
class Trie:
    """`order`: (position, conv_id), conversations by their turns. `nodes`: one row per different prefix, whose members
    are the conversations at positions first..last."""

    order: DataFrame
    nodes: DataFrame


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order of `turn`, each as two hashes of role and text (together
    128 bits) and its number of words `[^\\x20\\x09-\\x0D]+`.

    NULL roles and texts become empty, NULL turns come first, rows of one turn are ordered by their hashes, and rows
    without conv_id are left out. Texts stay where they are; a conversation takes 24 bytes a turn in one row.
    """
    rows = exact(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct("turn", F.xxhash64(role, text).alias("h"), F.xxhash64(F.lit("second"), text, role).alias("g"),
                    F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    grouped = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("_t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_t"))
    return grouped.select("conv_id", F.transform("_t", lambda t: F.struct(t["h"].alias("h"), t["g"].alias("g"), t["words"].alias("words"))).alias("turns"))


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values."""
    table = [values]
    while 2 << len(table) - 1 <= len(values):
        half = 1 << len(table) - 1
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def _next_below(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first place from `at` on with a value < depth, or the length."""
    at, n = at.copy(), len(table[0])
    for k in reversed(range(len(table))):
        run = table[k]
        fits = at + (1 << k) <= n
        fits[fits] = run[at[fits]] >= depth[fits]
        at[fits] += 1 << k
    return at


def _last_below(table: list[np.ndarray], before: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last place in front of `before` with a value < depth, or -1."""
    at = before.copy()
    for k in reversed(range(len(table))):
        run = table[k]
        fits = at >= 1 << k
        fits[fits] = run[at[fits] - (1 << k)] >= depth[fits]
        at[fits] -= 1 << k
    return at - 1


def _least(table: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of the values a..b-1."""
    k = np.frexp((b - a).astype(np.float64))[1] - 1
    out = np.empty(len(a), np.int64)
    for level in np.unique(k):
        i = np.flatnonzero(k == level)
        out[i] = np.minimum(table[level][a[i]], table[level][b[i] - (1 << int(level))])
    return out


def _shared(first: np.ndarray, h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """How many first turns each row shares with the row before; -1 for the first one."""
    length = np.diff(first)
    out = np.full(len(length), -1, np.int64)
    if len(length) > 1:
        both = np.minimum(length[1:], length[:-1])
        row = np.repeat(np.arange(len(both)), both)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
        a, b = first[row] + depth, first[row + 1] + depth
        differs = np.flatnonzero((h[a] != h[b]) | (g[a] != g[b]))
        out[1:] = both
        np.minimum.at(out, row[differs] + 1, depth[differs])
    return out


def _sums(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[b] - total[a]


PIECES = (
    "block long, depth long, here boolean, open boolean, n long, conv_id long, total long, new long, leaves long, children long, "
    "before long, own long, first long, parent long, far boolean, beside boolean, ends array<string>, least long"
)


def _pieces(table: pa.Table, width: int) -> pa.Table:
    """The prefixes of one block: those that begin here (`here`), and what the block holds of those before it.

    `open` prefixes go on in the next block. `parent` is the smallest member of the prefix around; `far` says that it
    is open or from a block before, so that its smallest member isn't known here; `beside` tells that it begins here.
    """
    table = table.combine_chunks().sort_by("idx")
    block = table.column("block")[0].as_py()
    idx = table.column("idx").to_numpy()
    own = np.flatnonzero(idx // width == block)
    if not len(own):
        return pa.Table.from_pylist([], _arrow_schema())
    a, n = own[0], len(own)
    lists = {c: table.column(c).combine_chunks() for c in ("h", "g", "words")}
    first = np.concatenate([[0], np.cumsum(lists["h"].value_lengths().to_numpy())]).astype(np.int64)
    h, g, w = (lists[c].flatten().to_numpy() for c in ("h", "g", "words"))
    every = _shared(first, h, g)
    lcp, after = every[a : a + n], every[a + n] if a + n < len(every) else -1
    ids = table.column("conv_id").to_numpy()[a : a + n]
    length = np.diff(first)[a : a + n]
    words = np.concatenate([[0], np.cumsum(w, dtype=np.int64)])
    begin = first[a : a + n]
    said = lambda i, d: words[begin[i] + np.maximum(d, 0)] - words[begin[i]]
    total = said(np.arange(n), length)
    new = total - said(np.arange(n), np.minimum(lcp, length))
    leaf = (np.concatenate([lcp[1:], [after]]) < length).astype(np.int64)
    # New prefixes by place, and what comes in from the block before.
    fresh = length - lcp
    at = np.repeat(np.arange(n), fresh)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + lcp[at] + 1
    coming = np.arange(lcp[0] + 1)
    here = np.concatenate([np.zeros(len(coming), bool), np.ones(len(at), bool)])
    at, depth = np.concatenate([np.zeros(len(coming), np.int64), at]), np.concatenate([coming, depth])
    ranges = _sparse(lcp)
    # A prefix from before covers place 0, where lcp >= depth; a new one is looked for behind its place.
    end = _next_below(ranges, at + here, depth)
    is_open = (end == n) & (after >= depth)
    smallest = _least(_sparse(ids), at, end)
    # Where the prefix around begins: at the same place, or at the last place with a smaller lcp.
    start = len(coming) + np.concatenate([[0], np.cumsum(fresh)])
    around = _last_below(ranges, np.arange(n), lcp)
    known = around >= 0
    parent_row = np.where(known, start[around] + lcp - lcp[around] - 1, lcp)  # of the first new prefix of each place
    parent = np.concatenate([coming - 1, np.arange(len(coming), len(at)) - 1])
    top = np.flatnonzero(fresh > 0)
    parent[start[top]] = parent_row[top]
    root = depth == 0
    children = np.bincount(parent[here & ~root], minlength=len(at))
    far = ~root & (is_open[parent] | ~here[parent])
    known = here & ~root & ~far
    ends: list[list[str]] = [[] for _ in range(len(at))]
    same = lcp == length
    heads = np.flatnonzero(~same | (np.arange(n) == 0))
    for p, q in zip(heads, [*heads[1:], n], strict=True):
        row = int(length[p]) if same[p] else int(start[p + 1]) - 1
        names = [str(x) for x in ids[p:q].tolist()]
        ends[row] = [",".join(names[k : k + ID_CHUNK]) for k in range(0, len(names), ID_CHUNK)]
    out = {
        "block": np.full(len(at), block), "depth": depth, "here": here, "open": is_open, "n": end - at, "conv_id": smallest,
        "total": _sums(total, at, end), "new": _sums(new, at + here, end), "leaves": _sums(leaf, at, end), "children": children,
        "before": np.where(here, said(at, depth - 1), 0), "own": np.where(here, total[at], 0),
        "first": pa.array(idx[a] + at, mask=~here), "parent": pa.array(smallest[parent], mask=~known), "far": here & far, "beside": here[parent], "ends": ends,
        "least": np.full(len(at), lcp.min()),
    }
    return pa.Table.from_pydict(out, schema=_arrow_schema())


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in PIECES.split(", ")])


def _searched(table: pa.Table, level: int) -> pa.Table:
    """Queries (before, depth) answered within one group of values."""
    value = table.filter(table.column("value").is_valid()).sort_by("pos")
    asked = table.filter(table.column("depth").is_valid())
    origin = table.column("group")[0].as_py() * level
    before, depth = asked.column("pos").to_numpy(), asked.column("depth").to_numpy()
    found = _last_below(_sparse(value.column("value").to_numpy()), before - origin, depth) if len(before) else before
    return pa.table({
        "before": pa.array(before, pa.int64()), "depth": pa.array(depth, pa.int64()), "start": pa.array(found + origin, pa.int64(), mask=found < 0),
    })


def _starts(values: DataFrame, asked: DataFrame, last: int, level: int) -> DataFrame:
    """(before, depth, start): the last place in front of `before` whose value is below `depth`.

    `values` is (pos, value) for 0..last, `asked` (before, depth). Places are searched by groups of `level`, and what a
    group can't answer in a table of the groups' minima, in the same way.
    """
    nothing = F.lit(None).cast("long")
    search = lambda table: _searched(table, level)
    rows = values.select("pos", "value", nothing.alias("depth"), F.expr(f"pos div {level}").alias("group")).unionByName(
        asked.select(F.col("before").alias("pos"), nothing.alias("value"), "depth", F.expr(f"(before - 1) div {level}").alias("group"))
    )
    found = durable(rows.groupBy("group").applyInArrow(search, "before long, depth long, start long"))
    if last < level:
        return found
    group = F.expr(f"(before - 1) div {level}")
    far = durable(found.where("start is null").select("before", "depth", group.alias("_group")))
    minima = durable(values.groupBy(F.expr(f"pos div {level}").alias("pos")).agg(F.min("value").alias("value")))
    up = _starts(minima, far.select(F.col("_group").alias("before"), "depth").distinct(), last // level, level)
    up = durable(up.select(F.col("before").alias("_group"), "depth", ((F.col("start") + 1) * level).alias("_end")))
    inside = up.select(F.col("_end").alias("before"), "depth").distinct()
    rows = values.select("pos", "value", nothing.alias("depth"), F.expr(f"pos div {level}").alias("group")).unionByName(
        inside.select(F.col("before").alias("pos"), nothing.alias("value"), "depth", group.alias("group"))
    )
    there = rows.groupBy("group").applyInArrow(search, "before long, depth long, start long").withColumnRenamed("before", "_end")
    answered = far.join(up, ["_group", "depth"]).join(there, ["_end", "depth"]).select("before", "depth", "start")
    return durable(found.where("start is not null").unionByName(answered))


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of every key, which come one after the other; one chunk at a time is held."""
    key, state = None, None
    out = lambda: pa.RecordBatch.from_pydict({"block": [key[0]], "depth": [key[1]], "sha": [state.hexdigest()]})
    for batch in batches:
        for block, depth, chunk in zip(*(batch.column(c).to_pylist() for c in ("block", "depth", "chunk")), strict=True):
            if (block, depth) != key:
                if key is not None:
                    yield out()
                key, state = (block, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(chunk.encode())
    if key is not None:
        yield out()


def _ordered(rows: DataFrame) -> DataFrame:
    """(idx, conv_id, turns) by turns, then conv_id; only the sizes of the partitions are added up in one place."""
    sorted_rows = durable(
        rows.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_id", 33)).withColumn("_pos", F.col("_id") - F.shiftleft("_pid", 33))
    )
    sizes = sorted_rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row for each partition.
    return sorted_rows.join(F.broadcast(starts), "_pid").select((F.col("_start") + F.col("_pos")).alias("idx"), "conv_id", "turns")


def prefix_trie(rows: DataFrame, width: int = BLOCK, level: int = LEVEL) -> Trie:
    """The trie of `rows` (conv_id, turns; see `sequences`), one conversation each.

    `nodes` has for every different sequence of first turns, from none (the root) on: conv_id, the smallest member;
    depth; parent_conv_id, the smallest member of the prefix one turn shorter (root: NULL); n_convs; n_children;
    n_leaves, the childless nodes in the subtree, itself included; saved_tokens, each node's (n_convs - 1) times the
    words of its last turn, added up over the subtree; ends_sha256, of the conv_ids of the members of just this length,
    ascending and joined by commas; first and last, the positions of its members in `order`.

    Blocks have `width` conversations, and `level` blocks are searched at once. conv_id is an integer and unique. NULL
    turns count as none. No rows give no nodes, not even a root.
    """
    rows = rows.select("conv_id", F.coalesce("turns", F.array().cast(SEQUENCE)).alias("turns"))
    ordered = durable(_ordered(durable(rows)))
    block = F.expr(f"idx div {width}")
    place = F.expr(f"idx % {width}")
    # The rows beside a block come along: lcp needs the one before, open ends the one after.
    to = F.array_compact(F.array(block, F.when((place == 0) & (block > 0), block - 1), F.when(place == width - 1, block + 1)))
    dealt = ordered.select("idx", "conv_id", *[F.col(f"turns.{c}").alias(c) for c in ("h", "g", "words")], F.explode(to).alias("block"))
    pieces = durable(dealt.groupBy("block").applyInArrow(lambda table: _pieces(table, width), PIECES))
    closed = pieces.where("here and not open")
    crossing = durable(pieces.where("open or not here").withColumnRenamed("block", "at"))
    minima = durable(pieces.groupBy(F.col("block").alias("pos")).agg(F.min("least").alias("value")))
    last = minima.agg(F.max("pos")).first()[0]
    incoming = crossing.where("not here")
    begun = _starts(minima, incoming.select(F.col("at").alias("before"), "depth"), last or 0, level)
    key = begun.select(F.col("before").alias("at"), "depth", F.col("start").alias("block"))
    parts = durable(incoming.join(key, ["at", "depth"]).unionByName(crossing.where("here").withColumn("block", F.col("at"))))
    sums = [F.sum(c).alias(c) for c in ("n", "total", "new", "leaves", "children")]
    only = [F.max(c).alias(c) for c in ("before", "own", "first")] + [F.max(F.when(F.col("here"), F.col("beside"))).alias("beside")]
    merged = parts.groupBy("block", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, *only)
    chunks = parts.select("block", "depth", "at", F.posexplode("ends").alias("k", "chunk")).repartition("block", "depth")
    chunks = chunks.sortWithinPartitions("block", "depth", "at", "k").select("block", "depth", "chunk")
    hashed = chunks.mapInArrow(_hashed_ends, "block long, depth long, sha string")
    merged = durable(merged.join(hashed, ["block", "depth"], "left"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    measures = ["block", "depth", "conv_id", "n", "total", "new", "leaves", "children", "before", "own", "first"]
    nodes = closed.select(*measures, F.sha2(F.array_join("ends", ",").cast("binary"), 256).alias("sha"), "parent", "far", "beside").unionByName(
        merged.select(*measures, F.coalesce("sha", none).alias("sha"), F.lit(None).cast("long").alias("parent"), (F.col("depth") > 0).alias("far"), "beside")
    )
    # What a block calls a prefix that isn't its own alone: its smallest member.
    above = small_side(merged.select("block", "depth", F.col("conv_id").alias("above")))
    names = durable(parts.select("at", "block", "depth", F.col("here").alias("beside")).join(above, ["block", "depth"]).drop("block"))
    names = names.select(F.col("at").alias("block"), F.col("depth").alias("_up"), "beside", "above")
    named = nodes.where("far").withColumn("_up", F.col("depth") - 1).join(names, ["block", "_up", "beside"]).withColumn("parent", F.col("above"))
    every = named.select(nodes.columns).unionByName(nodes.where("not far"))
    saved = F.col("total") - F.col("n") * F.col("before") - (F.col("own") - F.col("before")) - F.col("new")
    return Trie(
        ordered.select(F.col("idx").alias("position"), "conv_id"),
        every.select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), F.col("sha").alias("ends_sha256"),
            "first", (F.col("first") + F.col("n") - 1).alias("last"),
        ),
    )


FAMILY, HEADS = 20, 4


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % 20 (none if it is absent), then c's own after its
    first h; h = crc32(c) % 4. The remainder has the sign of c, as in SQL."""
    stored = durable(rows)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    of = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = stored.where(of == F.col("conv_id")).select(F.col("conv_id").alias("_of"), F.slice("turns", 1, HEADS - 1).alias("_head"))
    joined = stored.withColumn("_of", of).withColumn("_h", h).join(heads, "_of", "left")
    head = F.slice(F.coalesce("_head", F.array().cast(SEQUENCE)), F.lit(1), F.col("_h"))
    rest = F.when(F.size("turns") > F.col("_h"), F.slice("turns", F.col("_h") + 1, F.size("turns"))).otherwise(F.array().cast(SEQUENCE))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


OP12_SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
             md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k,
             len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split(CAST(conv_id AS VARCHAR), ''), lambda x: list_concat([CAST(ascii(x) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END),
        CAST(4294967295 AS BIGINT)) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY src, p) AS d, k, w FROM (
        SELECT c.conv_id, 0 AS src, p, k, w FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.p <= c.h
        UNION ALL SELECT c.conv_id, 1, p, k, w FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h)),
m AS (SELECT conv_id, 0 AS d, '' AS k, 0 AS w FROM c
      UNION ALL SELECT conv_id, d, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d), w FROM r),
node AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w FROM m GROUP BY d, k),
kids AS (SELECT left(k, 32 * (d - 1)) AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON kids.k = node.k),
ends AS (SELECT d, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
         FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS l FROM m) WHERE d = l GROUP BY d, k),
sub AS (SELECT m.k, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((x.n - 1) * x.w) AS saved
        FROM full_node x JOIN m ON m.conv_id = x.conv_id AND m.d <= x.d GROUP BY m.k)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children,
       CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_node x JOIN sub ON sub.k = x.k LEFT JOIN ends ON ends.k = x.k
LEFT JOIN node p ON x.d > 0 AND p.k = left(x.k, 32 * (x.d - 1)) AND p.d = x.d - 1
"""


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie(rebuilt(rows)).nodes.drop("first", "last")
