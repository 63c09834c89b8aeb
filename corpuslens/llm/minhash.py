"""MinHash near-dedup: BagMinHash signatures of shingle multisets, banded, then verified on the multisets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.components import components, joined
from corpuslens.llm.listed import parted
from corpuslens.llm.tables import documents, id_and_text, packed_rows, query
from corpuslens.llm.words import Words, mix, shingles, slices, text_buffers
from corpuslens.session import durable, small_side

SIMILARITY = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Rounds in which the rest of a band is compared with one text; what they leave is paired by rare differences.
LEADER_ROUNDS = 3
#: Weight levels 0, 1, 2, 4, ...: a process lives on each interval between neighbours.
MAX_LEVEL = 40
_UNIT = 2.0**-53
_LEVEL_SEEDS = np.random.default_rng(2018).integers(1, 2**63, MAX_LEVEL, dtype=np.uint64)


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT


def _intervals(value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """The level intervals below each weight: (element, seed, length, part of it that lies below the weight)."""
    parts = []
    for level in range(MAX_LEVEL):
        low = 0 if level == 0 else 1 << (level - 1)
        some = np.flatnonzero(weight > low)
        if not len(some):
            break
        length = 1 if level == 0 else low
        below = np.minimum(weight[some] - low, length)
        parts.append((some, mix(value[some] + _LEVEL_SEEDS[level]), np.full(len(some), length, np.int64), below))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _inside(seed: np.ndarray, length: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Whether a point of an interval falls below the weight: its interval is halved until it is on one side."""
    low, high = np.zeros(len(seed), np.int64), length.copy()
    state = np.full(len(seed), -1, np.int8)
    while True:
        state[(state < 0) & (high <= below)] = 1
        state[(state < 0) & (low >= below)] = 0
        todo = np.flatnonzero(state < 0)
        if not len(todo):
            return state == 1
        seed = seed.copy()
        seed[todo] = mix(seed[todo] + np.uint64(0xE7037ED1A0B428DB))
        upper = (seed[todo] >> np.uint64(63)).astype(bool)
        middle = (low[todo] + high[todo]) // 2
        low[todo] = np.where(upper, middle, low[todo])
        high[todo] = np.where(upper, high[todo], middle)


def signatures(value: np.ndarray, weight: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """BagMinHash: (texts, REGISTERS) of the smallest points of Poisson processes over element and weight.

    Every element has one process for each interval of weight levels, with the interval's length as its rate. Points
    arrive in increasing order and fall into one register each; those above the weight are thinned out by halving
    the interval, so an element's points at a smaller weight are a subset of those at a larger one. Registers then
    agree with exactly the weighted Jaccard similarity. Points are made only up to a bound at which all registers of
    a text are expected to be filled; the rare text with a free register goes on with a doubled bound.
    """
    out = np.full((texts, REGISTERS), np.inf)
    if not len(value):
        return out
    element, seed, length, below = _intervals(value, weight)
    owner = text[element]
    total = np.bincount(owner, weights=below, minlength=texts)
    # Registers are filled at total rate: about ln(REGISTERS) + 5 arrivals each.
    bound = np.where(total > 0, REGISTERS * (np.log(REGISTERS) + 5.0) / np.maximum(total, 1e-300), 0)
    todo = total > 0
    while todo.any():
        mine = np.flatnonzero(todo[owner])
        at, state = np.zeros(len(mine)), seed[mine]
        while len(mine):
            state = mix(state + np.uint64(0x9E3779B97F4A7C15))
            at = at - np.log(_uniform(state)) / length[mine]
            ok = at <= bound[owner[mine]]
            mine, at, state = mine[ok], at[ok], state[ok]
            if not len(mine):
                break
            point = mix(state ^ np.uint64(0xD1B54A32D192ED03))
            low = _inside(point, length[mine], below[mine])
            register = (point % np.uint64(REGISTERS)).astype(np.int64)
            np.minimum.at(out, (owner[mine][low], register[low]), at[low])
        todo &= np.isinf(out).any(axis=1)
        bound[todo] *= 2
    return out


def _multisets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(shingle, count, text) sorted by text and shingle, and all single shingles with their text."""
    value, text = shingles(Words(data, offsets))
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(value)))
    return value[head], count, text[head]


def _fingerprint(value: np.ndarray, count: np.ndarray, text: np.ndarray, texts: int) -> pa.Array:
    """16 bytes for the multiset as a whole: the same for texts with equal shingles and counts."""
    token = mix(value ^ (count.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)))
    whole = np.zeros((texts, 2), np.uint64)
    np.add.at(whole[:, 0], text, token)
    np.add.at(whole[:, 1], text, mix(token))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), texts, [None, pa.py_buffer(whole.tobytes())]).cast(pa.binary())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for i, j in slices(offsets, 1_000_000):
            piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            value, count, text = _multisets(piece, at)
            sign = signatures(value, count, text, j - i)
            bits = sign.view(np.uint64).reshape(j - i, BANDS, ROWS)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D), (j - i, BANDS)).copy()
            for r in range(ROWS):
                key = mix(key * np.uint64(3) + bits[:, :, r])
            empty = np.isinf(sign[:, 0])
            keys = pa.FixedSizeListArray.from_arrays(pa.array(key.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
            row = [batch.column(n).slice(i, j - i) for n in ("doc_id", "h1", "h2")]
            size = np.bincount(text, weights=count, minlength=j - i).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*row, _fingerprint(value, count, text, j - i), pa.array(empty), pa.array(size), keys],
                names=["doc_id", "h1", "h2", "key", "empty", "n", "bands"],
            )


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's multiset as a set: the k-th copy of a shingle is an element of its own."""
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for i, j in slices(offsets, 1_000_000):
            value, count, text = _multisets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            row = np.repeat(np.arange(len(value)), count)
            copy = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            item = mix(value[row] + copy.astype(np.uint64) * np.uint64(0x94D049BB133111EB)).view(np.int64)
            ends = np.searchsorted(text[row], np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [_fingerprint(value, count, text, j - i), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(item))],
                names=["key", "items"],
            )


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) with the sets x of `a` and y of `b`. One set after the other is joined; the join side of a
    key with many pairs can be split, as all inputs are stored."""
    half = durable(pairs).join(sets.select(F.col("key").alias("a"), F.col("items").alias("x")), "a")
    return half.join(sets.select(F.col("key").alias("b"), F.col("items").alias("y")), "b")


def _like_sizes(x: Column, y: Column, similarity: float) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return F.least(x, y) >= F.lit(similarity) * F.greatest(x, y) - F.lit(1e-6)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""
    common = F.size(F.array_intersect("x", "y"))
    enough = common >= F.lit(similarity) * (F.size("x") + F.size("y") - common)
    return durable(_with_sets(pairs, sets).where(enough).select("a", "b"))


def _rooted(members: DataFrame, groups: DataFrame) -> DataFrame:
    known = groups.withColumnRenamed("id", "key")
    return members.join(known, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _rare_difference_pairs(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of texts that share a band, lie in different groups and may still be near copies; none is lost.

    `members` (band, leader, key, root). All texts that meet a leader L in any band are seen as their differences to
    L: with m items missing and n added, weigh w = m + similarity * n. Two texts are near copies exactly if they share
    at least (w1 + w2 - (1 - similarity) * |L|) / (1 + similarity) differences, and that is above zero for texts that
    are not both linked to L. So their first common difference, in the order of rising frequency among the texts of L,
    has at least that many of each text's differences from there on: joining on it with this bound for the other's
    weight finds every pair. Copies of one text with changes of their own share only frequent differences, too late in
    the order to be joined. Differences that a single group holds join nothing and are left out first.
    """
    hubs = durable(members.where("key <> leader").select("leader", "key", "root").distinct())
    several = hubs.groupBy("leader").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("leader")
    met = _with_sets(hubs.join(durable(several), "leader").select(F.col("leader").alias("a"), F.col("key").alias("b"), "root"), sets)
    missing, added = F.array_except("x", "y"), F.array_except("y", "x")
    unlike = met.select(F.col("a").alias("leader"), F.col("b").alias("key"), "root", F.size("x").alias("size"), missing.alias("m"), added.alias("n"))
    weight = F.size("m") + F.lit(similarity) * F.size("n")
    # Hashes name the leader, the text under it and its group while differences are counted; a clash only adds pairs.
    names = [F.xxhash64("leader").alias("l"), F.xxhash64("leader", "key").alias("t"), F.xxhash64("root").alias("g")]
    unlike = durable(unlike.select(*names, "key", "size", weight.alias("w"), F.size("n").alias("added"), F.size("m").alias("lost"), F.concat("m", "n").alias("items")))
    lightest = unlike.groupBy("l").agg(F.min("w").alias("least"))
    weighed = durable(unlike.select("l", "t", "g", "key", "size", "w", (F.col("size") - F.col("lost") + F.col("added")).alias("n")).join(lightest, "l"))
    each = durable(unlike.select("l", "t", "g", F.explode("items").alias("item")))
    common = each.groupBy("l", "item").agg(F.count(F.lit(1)).alias("holders"), F.min("g").alias("lo"), F.max("g").alias("hi"))
    common = durable(common.where("lo <> hi").select("l", "item", "holders"))
    # How many of a text's common differences stand at this place of the order or later.
    late = Window.partitionBy("l", "t").orderBy(F.desc("holders"), F.desc("item"))
    placed = each.join(common, ["l", "item"]).select("l", "t", "item", F.row_number().over(late).alias("later"))
    held = placed.join(weighed, ["l", "t"])
    most = F.lit(1 + similarity) * F.col("later") + F.lit(1 - similarity) * F.col("size") - F.col("w") + F.lit(1e-6)
    held = durable(held.withColumn("most", most).where("most >= least").select("l", "item", "g", "key", "n", "w", "most"))
    x, y = held.alias("x"), held.alias("y")
    same = F.expr("x.l = y.l AND x.item = y.item AND x.key < y.key AND x.g <> y.g AND x.w <= y.most AND y.w <= x.most")
    near = _like_sizes(F.col("x.n"), F.col("y.n"), similarity)
    return x.join(y, same & near).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()


def _grouped(one: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """(id, root) for the keys of `one` (key, h1, h2, n, bands) that are linked to others. `rows` (h1, h2, text)."""
    banded = durable(one.select("key", "n", F.explode("bands").alias("band")))
    counted = banded.groupBy("band").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = durable(banded.join(durable(counted), "band"))
    # The text whose bands hold the most others is the most central one; all its bands then have one leader.
    popular = durable(shared.groupBy("key").agg(F.sum("held").alias("popular")))
    ranked = durable(shared.join(popular, "key").select("band", "key", "n", "popular"))
    leaders = ranked.groupBy("band").agg(F.max(F.struct("popular", "key", "n")).alias("l")).select("band", F.col("l.key").alias("leader"), F.col("l.n").alias("leader_n"))
    members = durable(ranked.join(durable(leaders), "band"))
    wanted = durable(popular.select("key").join(one.select("key", "h1", "h2"), "key").select("h1", "h2"))
    texts = rows.join(small_side(wanted), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min("text").alias("text"))
    sets = durable(texts.select("text").mapInArrow(_expand, "key binary, items array<long>"))
    tried = members.where("key <> leader").where(_like_sizes(F.col("n"), F.col("leader_n"), similarity))
    pairs = tried.select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    groups = components(_verified(pairs, sets, similarity))
    for _ in range(LEADER_ROUNDS - 1):
        # What the groups of a band's first leader do not hold gets a leader of its own.
        of_leader = groups.select(F.col("id").alias("leader"), F.col("root").alias("leader_root"))
        named = _rooted(members, groups).join(of_leader, "leader", "left")
        apart = durable(named.where(F.col("root") != F.coalesce("leader_root", "leader")).select("band", "key", "n", "popular", "root"))
        heads = apart.groupBy("band").agg(F.max(F.struct("popular", "key", "n", "root")).alias("h"))
        met = apart.join(durable(heads), "band").where("root <> h.root").where(_like_sizes(F.col("n"), F.col("h.n"), similarity))
        pairs = met.select(F.col("h.key").alias("a"), F.col("key").alias("b")).distinct()
        groups = joined(groups, _verified(pairs, sets, similarity))
    rest = _rare_difference_pairs(durable(_rooted(members, groups).select("band", "leader", "key", "root")), sets, similarity)
    return joined(groups, _verified(rest, sets, similarity))


def _classified(docs: DataFrame, similarity: float) -> DataFrame:
    """Rows of `docs`: (doc_id, h1, h2, empty, first).

    h1 and h2 are hashes of the text, `first` the smallest (no id, doc_id, h1, h2) of the row's group, NULL for a text
    without words. Only texts are compared, so rows without id or with repeated ids are like all others.
    """
    rows = id_and_text(docs).withColumns({"h1": F.xxhash64("text"), "h2": F.hash("text")})
    signed = durable(rows.mapInArrow(_sign, _schema(docs, "h1 long, h2 int, key binary, empty boolean, n long, bands array<long>")))
    row = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "h1", "h2", "n", "bands")
    one = signed.where("not empty").groupBy("key").agg(F.min(row).alias("row"))
    one = durable(one.select("key", F.struct("row.anonymous", "row.doc_id", "row.h1", "row.h2").alias("first"), "row.h1", "row.h2", "row.n", "row.bands"))
    groups = _grouped(one.drop("first"), rows, similarity)
    rooted = durable(_rooted(one.select("key", "first"), groups))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    classes = durable(rooted.select("key", "root").join(durable(firsts), "root").select("key", "first"))
    named = signed.select("doc_id", "h1", "h2", "empty", F.expr("if(empty, NULL, key)").alias("key"))
    return named.join(classes, "key", "left").drop("key")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id): class_id is the smallest doc_id of the group of near copies that a document belongs to.

    Two texts are linked if the weighted Jaccard similarity of their multisets of five-word shingles (words between
    ASCII white space, as written) is at least `similarity`; groups are the connected components. A text of one to
    four words is one shingle; texts without words (NULL, empty) are not linked to anything. Documents with equal
    multisets are one text from the start, however many there are. Every row gives a row: rows that repeat a doc_id
    are grouped by their own texts, rows without one belong to a group as well but never name it (class_id is NULL if
    none of its rows has an id). Other columns are ignored. An empty table gives an empty table.

    Texts that share a band are candidates, and a band may hold very many. Each text of a band is compared with the
    band's most central text, what is left in LEADER_ROUNDS - 1 more rounds with the most central one of the rest.
    All further candidates of different groups are found by `_rare_difference_pairs`, so none is left out, and copies
    just below the threshold are not paired with each other.
    """
    classified = _classified(docs, similarity)
    return classified.select("doc_id", F.expr("if(empty, doc_id, first.doc_id)").alias("class_id"))


def first_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with one row of each group of `near_duplicates`: the one with the smallest doc_id, then text hash.

    Rows of one group that agree in doc_id and text are one row as well. Texts without words all stay, and so does a
    document without id whose group has no other. All columns are kept as they are, whatever their names.
    """
    classified = _classified(docs, similarity)
    found = durable(classified.where("not empty"))
    here = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "h1", "h2")
    row = ["doc_id", "h1", "h2"]
    gone = durable(found.where(~here.eqNullSafe(F.col("first"))).select(*row).distinct())
    again = durable(found.where(here.eqNullSafe(F.col("first"))).groupBy(*row).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*row))
    rows, unpacked = packed_rows(docs)
    keyed = rows.withColumns({"doc_id": _id_of(docs), "h1": F.xxhash64("text"), "h2": F.hash("text")})

    kept = parted(keyed, gone, row)[1]
    if not again.isEmpty():
        repeated, kept = parted(kept, again, row)
        kept = kept.unionByName(repeated.groupBy(*row).agg(F.first(F.struct("_row", "text")).alias("r")).select("r.*", *row))
    return unpacked(kept)


def _id_of(docs: DataFrame) -> Column:
    """doc_id inside the packed row."""
    return F.col("_row")[f"_{docs.columns.index('doc_id')}"]


def _schema(docs: DataFrame, rest: str) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {rest}"


@query("op6_minhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
