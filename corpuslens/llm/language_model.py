"""LM scoring by a hierarchical Pitman-Yor model, its seating sampled by Gibbs, predictions averaged over samples.

Every word of the corpus has a restaurant, of what follows it, and so has the start of a text. The dishes are words;
all restaurants share one parent restaurant over words, whose own base is diffuse: what its new tables serve is an
unknown word.

The seating is kept in a grid of buckets: a (word, context) pair lies in the row of its word and the column of its
context, so neither a frequent word nor a frequent context is in one bucket. Between two sweeps the buckets of a row add
up the tables of their words (the parent's customers), and those of a column the tables of their contexts.
"""

from __future__ import annotations

import copy
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.tables import documents, id_and_text, query
from corpuslens.llm.words import Words, slices, text_buffers
from corpuslens.session import durable, scratch_path

HELD_OUT_OF = 10
CHUNK_BYTES = 12_000_000
STEP_TOKENS = 1 << 18
SAMPLES = 2
STRENGTH = 1.0
#: Customers of a pair are seated one by one up to this many, then in blocks of a quarter of those seated.
ONE_BY_ONE = 32
_END = np.uint64(0x5BD1E995C0FFEE11)
#: Contexts are known by 48 bits of their word's hash; this one is the start of a text.
_DROPPED = np.uint64(16)
_START = np.uint64((1 << 48) - 1)
_REQUEST = "bucket int, words binary, sizes binary, keys binary, contexts binary, counts binary"


def _pack(x: np.ndarray, kind: str) -> bytes:
    """Numbers by planes of their bytes, so that bytes that say little take little room."""
    planes = np.ascontiguousarray(x, kind).view(np.uint8).reshape(len(x), -1).T
    body = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True) if len(x) else b""
    return len(x).to_bytes(8, "little") + body


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_rising(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=np.uint64(0)), "<u8")


def _unpack_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, "<u8"), dtype=np.uint64)


def _grid(buckets: int) -> tuple[int, int]:
    """(rows, columns) of at most so many buckets."""
    rows = math.isqrt(buckets)
    return rows, buckets // rows


def _bucketed(df: DataFrame, by: str) -> DataFrame:
    """`df` stored by the hash of a column, so that later joins and groups by it don't shuffle it again."""
    spark, name = df.sparkSession, f"lm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, by).option("path", scratch_path(spark, name)).saveAsTable(name)
    stored = spark.table(name)
    # The name goes out of the catalog; the files stay in the shared folder.
    spark.sql(f"DROP TABLE {name}")
    return stored


def held_out(doc_id: object) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % HELD_OUT_OF == 0


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct values, for each value the number of its distinct one)."""
    distinct, at = np.unique(values, return_inverse=True)
    return distinct, at.astype(np.uint32)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """`_numbered` of all values, from that of their parts, which are used up."""
    distinct = np.unique(np.concatenate([found for found, _ in parts]))
    for k, (found, at) in enumerate(parts):
        parts[k] = (found[:0], np.searchsorted(distinct, found).astype(np.uint32)[at])
    return distinct, np.concatenate([at for _, at in parts])


def _chunk(data: np.ndarray, offsets: np.ndarray, held: np.ndarray, buckets: int) -> dict:
    """The (word, context) pairs of some texts: their training counts by bucket, and the texts as pairs."""
    # A chunk has millions of tokens: only the distinct ones of a small step are sorted together.
    rows, columns = _grid(buckets)
    counts, parts = [], []
    for i, j in slices(offsets):
        words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
        token = np.full(len(words.start) + j - i, _END, np.uint64)
        token[np.arange(len(words.start)) + words.texts()] = words.hashes()  # one end after each text before
        counts.append(words.counts() + 1)
        parts.append(_numbered(token))
        del words, token
    sizes = np.concatenate(counts)
    vocabulary, word = _merged(parts)
    keys = np.append(vocabulary >> _DROPPED, _START)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.cumsum(sizes) - sizes] = len(vocabulary)
    steps = range(0, len(word), STEP_TOKENS)
    parts = [_numbered(word[a : a + STEP_TOKENS].astype(np.int64) * len(keys) + context[a : a + STEP_TOKENS]) for a in steps]
    del word, context
    pair, seq = _merged(parts)
    del parts
    # Pairs in the order of their buckets, of words in these and of contexts.
    row = (vocabulary >> np.uint64(32)) * np.uint64(rows) >> np.uint64(32)
    column = (keys & np.uint64(0xFFFFFFFF)) * np.uint64(columns) >> np.uint64(32)
    bucket = (row[pair // len(keys)] * np.uint64(columns) + column[pair % len(keys)]).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(pair), np.uint32)
    rank[order] = np.arange(len(pair), dtype=np.uint32)
    seq = rank[seq]
    pair, bucket = pair[order], bucket[order]
    del order, rank
    seen = np.bincount(seq[np.repeat(~held, sizes)], minlength=len(pair))
    edge = np.searchsorted(bucket, np.arange(rows * columns + 1))
    requests, per_word = [], []
    for b, (p, q) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
        if q > p:
            some, n = np.unique(pair[p:q] // len(keys), return_counts=True)
            context, at = np.unique(pair[p:q] % len(keys), return_inverse=True)
            requests.append({"bucket": b, "words": _pack_rising(vocabulary[some]), "sizes": _pack(n, "<u4"), "keys": _pack_rising(keys[context]),
                             "contexts": _pack(at, "<u4"), "counts": _pack(seen[p:q], "<u4")})
            per_word.append(n)
    return {"sizes": sizes, "seq": _pack(seq, "<u4"), "per_word": _pack(np.concatenate([np.zeros(0, np.int64), *per_word]), "<u4"), "requests": requests}


def read_chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """One row for each few MB of text: its documents, their tokens as pair numbers, and the pairs by bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_request = pa.list_(pa.struct([("bucket", pa.int32()), *((c, pa.binary()) for c in ("words", "sizes", "keys", "contexts", "counts"))]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in slices(offsets, CHUNK_BYTES):
                ids = batch.column("doc_id").slice(i, j - i)
                held = np.array([held_out(x) for x in ids.to_pylist()], bool)
                c = _chunk(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], held, buckets)
                made = pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + nth]), pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), ids), pa.array([held.tolist()]),
                     pa.array([c["sizes"].tolist()], pa.list_(pa.int64())), pa.array([c["seq"]], pa.binary()), pa.array([c["per_word"]], pa.binary()),
                     pa.array([c["requests"]], arrow_request)],
                    names=["chunk", "doc_ids", "held", "sizes", "seq", "per_word", "requests"],
                )
                del c
                yield made
                del made
                pa.default_memory_pool().release_unused()
                nth += 1

    return id_and_text(docs).mapInArrow(
        read, f"chunk long, doc_ids array<{kind}>, held array<boolean>, sizes array<long>, seq binary, per_word binary, "
        f"requests array<struct<{_REQUEST.replace(' ', ':').replace(',:', ',')}>>")


#: A bucket: its words and its contexts' keys, the pairs word by word with their contexts and training counts, and the
#: pairs that each chunk asks for.
_SEATING = ("bucket int, words binary, sizes binary, keys binary, contexts binary, counts binary, singles long, doubles long, "
            "asked array<struct<chunk:bigint,words:binary,pairs:binary>>")
_MAIL = "bucket int, name string, data binary"
_SHARED = _MAIL + ", one_table long, two_tables long, known long, tables long, tokens long"
_BLOCK = "axis string, line int, bucket int, keys binary, tables binary, counts binary"


def _opened(key: tuple, requests: pd.DataFrame) -> pd.DataFrame:
    """A bucket's pairs with the training counts of all chunks."""
    requests = requests.sort_values("chunk")
    parts = [(_unpack_rising(r.words), _unpack(r.sizes, "<u4"), _unpack_rising(r.keys), _unpack(r.contexts, "<u4")) for r in requests.itertuples(index=False)]
    vocabulary, word = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    keys, context = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    words_end, keys_end = np.cumsum([len(p[0]) for p in parts]), np.cumsum([len(p[2]) for p in parts])
    named = np.split(word, words_end[:-1])
    code = np.concatenate([np.repeat(w, p[1]) * len(keys) + c[p[3]] for p, w, c in zip(parts, named, np.split(context, keys_end[:-1]), strict=True)])
    pair, at = np.unique(code, return_inverse=True)
    del code
    count = np.bincount(at, weights=np.concatenate([_unpack(r, "<u4") for r in requests["counts"]]), minlength=len(pair)).astype(np.int64)
    pairs = np.split(at, np.cumsum([len(p[3]) for p in parts])[:-1])
    asked = [{"chunk": int(k), "words": _pack(w, "<u4"), "pairs": _pack(a, "<u4")} for k, w, a in zip(requests["chunk"], named, pairs, strict=True)]
    return pd.DataFrame({
        "bucket": [key[0]], "words": [_pack_rising(vocabulary)], "sizes": [_pack(np.bincount(pair // len(keys), minlength=len(vocabulary)), "<u4")],
        "keys": [_pack_rising(keys)], "contexts": [_pack(pair % len(keys), "<u4")], "counts": [_pack(count, "<u8")],
        "singles": [int((count == 1).sum())], "doubles": [int((count == 2).sum())], "asked": [asked]})


class _Seats:
    """A bucket as arrays; one table for each pair that has customers unless `tables` are given."""

    #: Customers of each word in the parent, where other buckets have tables of the words too.
    served: np.ndarray | None = None

    def __init__(self, r, tables: bytes | None = None):
        sizes = _unpack(r.sizes, "<u4")
        self.words = np.arange(len(sizes))
        self.word = np.repeat(self.words, sizes)
        self.context = _unpack(r.contexts, "<u4").astype(np.int64)
        self.count = _unpack(r.counts, "<u8").astype(np.int64)
        self.tables = np.minimum(self.count, 1) if tables is None else _unpack(tables, "<u4").astype(np.int64)

    def parent(self) -> np.ndarray:
        """Customers of each word in the parent: the tables that serve it anywhere."""
        if self.served is not None:
            return self.served
        return np.bincount(self.word, weights=self.tables, minlength=len(self.words)).astype(np.int64)


def _letters(mail: pd.DataFrame) -> dict[str, bytes]:
    return dict(zip(mail["name"], mail["data"], strict=True))


def _told(columns: int, counted: bool):
    """What a bucket tells its row of its words and its column of its contexts: their tables, and customers if `counted`."""

    def run(key: tuple, seating: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        r = next(seating.itertuples(index=False))
        seats = _Seats(r, _letters(mail).get("tables"))
        rows = []
        for axis, line, keys, at in (("word", key[0] // columns, r.words, seats.word), ("context", key[0] % columns, r.keys, seats.context)):
            n = int.from_bytes(keys[:8], "little")
            tables, customers = (np.bincount(at, weights=x, minlength=n) for x in (seats.tables, seats.count))
            rows.append((axis, line, key[0], keys, _pack(tables, "<u8"), _pack(customers, "<u8") if counted else None))
        return pd.DataFrame(rows, columns=["axis", "line", "bucket", "keys", "tables", "counts"])

    return run


def _added_up(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
    """For every bucket of a row or column, the totals of the words or contexts it has."""
    each = [_unpack_rising(k) for k in blocks["keys"]]
    found, at = np.unique(np.concatenate(each), return_inverse=True)
    ends = np.cumsum([len(k) for k in each])[:-1]
    places, out, stats = np.split(at, ends), [], {}
    for column in ("tables", "counts"):
        if blocks[column].iloc[0] is None:
            continue
        total = np.bincount(at, weights=np.concatenate([_unpack(x, "<u8") for x in blocks[column]]), minlength=len(found)).astype(np.int64)
        out += [(b, f"{key[0]} {column}", _pack(total[p], "<u8")) for b, p in zip(blocks["bucket"], places, strict=True)]
        if key[0] == "word" and column == "tables":
            stats |= {"one_table": int((total == 1).sum()), "two_tables": int((total == 2).sum()), "known": int((total > 0).sum()), "tables": int(total.sum())}
        elif key[0] == "word":
            stats["tokens"] = int(total.sum())
    rows = pd.DataFrame(out, columns=["bucket", "name", "data"])
    for c in ("one_table", "two_tables", "known", "tables", "tokens"):
        rows[c] = [stats.get(c, 0)] + [0] * (len(rows) - 1)
    return rows


class _Totals:
    """What buckets have to know of all others: a few numbers, and by context the customers and tables of each restaurant."""

    #: Tables everywhere; None if `tables` has all contexts.
    total: float | None = None

    def __init__(self, seating: DataFrame, shared: DataFrame):
        singles, doubles = (x or 0 for x in seating.agg(F.sum("singles"), F.sum("doubles")).first())
        sums = shared.agg(*(F.sum(c) for c in ("one_table", "two_tables", "known", "tables", "tokens"))).first()
        ones, twos, self.known, self.total, self.tokens = (x or 0 for x in sums)
        # Kneser-Ney's estimate of a discount from how often things occur once and twice.
        self.discount = min(0.95, max(0.05, singles / (singles + 2 * doubles))) if singles else 0.5
        self.parent_discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5

    def here(self, tables: bytes, customers: bytes | None = None) -> _Totals:
        """These, with the totals of one bucket's contexts."""
        local = copy.copy(self)
        local.tables = _unpack(tables, "<u8").astype(np.float64)
        local.customers = None if customers is None else _unpack(customers, "<u8").astype(np.float64)
        return local

    def all_tables(self) -> float:
        return self.tables.sum() if self.total is None else self.total

    def parent_probability(self, customers: np.ndarray) -> np.ndarray:
        """Of words with so many customers in the parent; a word without any is the unknown word."""
        total = STRENGTH + self.all_tables()
        new = (STRENGTH + self.parent_discount * self.known) / total
        return np.where(customers > 0, (customers - self.parent_discount) / total, new)

    def probability(self, seats: _Seats) -> np.ndarray:
        """The predictive probability of every pair of a bucket."""
        parent = self.parent_probability(seats.parent())[seats.word]
        k = seats.context
        back = (STRENGTH + self.discount * self.tables[k]) * parent
        return (np.maximum(seats.count - self.discount * seats.tables, 0) + back) / (STRENGTH + self.customers[k])


def _reseat(seats: _Seats, totals: _Totals, rng: np.random.Generator) -> np.ndarray:
    """A Gibbs step for all pairs: the customers of a pair leave and take seats again, given all other tables.

    A customer opens a table with the weight of the context's new tables times the parent's probability of the word,
    and joins one by the customers seated less the discounts. Pairs move at once, each against the others' tables of
    the last sweep. One customer always has one table.
    """
    tables = np.minimum(seats.count, 1)
    live = np.flatnonzero(seats.count > 1)
    parent = seats.parent()[seats.word] - seats.tables
    elsewhere = totals.tables[seats.context] - seats.tables
    total = STRENGTH + totals.all_tables()
    new_word = (STRENGTH + totals.parent_discount * totals.known) / total / max(totals.known, 1)
    seated = 1
    while len(live):
        t = tables[live]
        step = np.full(len(live), 1) if seated < ONE_BY_ONE else np.minimum(max(1, seated // 4), seats.count[live] - seated)
        dish = np.where(parent[live] + t > 0, np.maximum(parent[live] + t - totals.parent_discount, 0) / total, new_word)
        fresh = (STRENGTH + totals.discount * (elsewhere[live] + t)) * dish
        stay = np.maximum(seated + (step - 1) / 2 - totals.discount * t, 1e-9)
        tables[live] = t + rng.binomial(step, fresh / (fresh + stay))
        seated += 1 if seated < ONE_BY_ONE else max(1, seated // 4)
        live = live[seats.count[live] > seated]
    return tables


def _sweep(totals: _Totals, sample: int):
    def run(key: tuple, seating: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        letters = _letters(mail)
        seats = _Seats(next(seating.itertuples(index=False)), letters.get("tables"))
        seats.served = _unpack(letters["word tables"], "<u8").astype(np.int64)
        # Seeded by bucket and sweep: a task that runs again seats everyone as before.
        moved = _reseat(seats, totals.here(letters["context tables"]), np.random.default_rng([sample, key[0]]))
        return pd.DataFrame({"bucket": [key[0]], "name": ["tables"], "data": [_pack(moved, "<u4")]})

    return run


def _answers(samples: list[_Totals]):
    """log10 of each requested pair's probability, averaged over the samples, and each word's training count."""

    def run(key: tuple, seating: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        r, letters = next(seating.itertuples(index=False)), _letters(mail)
        chance = 0.0
        for s, totals in enumerate(samples, 1):
            seats = _Seats(r, letters[f"{s} tables"])
            seats.served = _unpack(letters[f"{s} word tables"], "<u8").astype(np.int64)
            chance = chance + totals.here(letters[f"{s} context tables"], letters["context counts"]).probability(seats)
        logs, count = np.log10(chance / len(samples)).astype(np.float32), _unpack(letters["word counts"], "<u8")
        out = [(q["chunk"], key[0], _pack(logs[_unpack(q["pairs"], "<u4")], "<f4"), _pack(count[_unpack(q["words"], "<u4")], "<u8")) for q in r.asked]
        return pd.DataFrame(out, columns=["chunk", "bucket", "logs", "known"])

    return run


def _scores(tokens: int, known: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in ("held", "sizes", "seq", "per_word", "parts")}
                parts = sorted(r["parts"], key=lambda p: p["bucket"])
                logs = np.concatenate([_unpack(p["logs"], "<f4") for p in parts]).astype(np.float64)
                per_word = _unpack(r["per_word"], "<u4")
                count = np.concatenate([_unpack(p["known"], "<u8") for p in parts]).astype(np.float64)
                base = np.repeat(np.log10((count + 0.1) / (tokens + 0.1 * (known + 1))), per_word)
                seen = np.repeat(count > 0, per_word)
                seq = _unpack(r["seq"], "<u4")
                sizes = np.array(r["sizes"], np.int64)
                begin = np.cumsum(sizes) - sizes
                ids = batch.column("doc_ids")[k].values
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(r["held"], pa.bool_()), pa.array(sizes), pa.array(np.add.reduceat(seen[seq].astype(np.int64), begin)),
                     pa.array(np.full(len(sizes), tokens, np.int64)), pa.array(np.add.reduceat(base[seq], begin)), pa.array(np.add.reduceat(logs[seq], begin))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Texts are lower-cased (A-Z) and split at ASCII white space; an end follows each. The model learns from documents
    whose crc32(doc_id) mod 10 is not 0 and scores all; perplexity is 10 ** (-score / n_tokens). Words that training
    lacks are one unknown word. NULL and empty texts are one end; a NULL doc_id is hashed as the empty text; repeated
    rows are learnt and scored each. Other columns are ignored; without training documents every token is unknown;
    an empty table gives an empty table.
    """
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = _grid(buckets)[1]
    chunks = _bucketed(read_chunks(docs, buckets), "chunk")
    requests = chunks.select("chunk", F.explode("requests").alias("r")).select("chunk", "r.*")
    stored = _bucketed(requests.groupBy("bucket").applyInPandas(_opened, _SEATING), "bucket")
    seating = stored.drop("asked").groupBy("bucket")

    def shared(tables: DataFrame, counted: bool) -> DataFrame:
        told = seating.cogroup(tables.groupBy("bucket")).applyInPandas(_told(columns, counted), _BLOCK)
        return durable(told.groupBy("axis", "line").applyInPandas(_added_up, _SHARED))

    tables = spark.createDataFrame([], _MAIL)
    mail = shared(tables, True)
    totals = first = _Totals(stored, mail)
    post = mail.where(F.col("name").endswith(" counts")).select("bucket", "name", "data")
    samples = []
    for sample in range(1, SAMPLES + 1):
        letters = tables.unionByName(mail.where(F.col("name").endswith(" tables")).select("bucket", "name", "data"))
        tables = durable(seating.cogroup(letters.groupBy("bucket")).applyInPandas(_sweep(totals, sample), _MAIL))
        mail = shared(tables, False)
        totals = _Totals(stored, mail)
        samples.append(totals)
        sent = tables.unionByName(mail.select("bucket", "name", "data"))
        post = post.unionByName(sent.select("bucket", F.concat(F.lit(f"{sample} "), "name").alias("name"), "data"))
    answers = stored.groupBy("bucket").cogroup(post.groupBy("bucket")).applyInPandas(_answers(samples), "chunk long, bucket int, logs binary, known binary")
    parts = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "logs", "known")).alias("parts"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return chunks.drop("requests").join(parts.hint("merge"), "chunk").mapInArrow(
        _scores(first.tokens, first.known), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
