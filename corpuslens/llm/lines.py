"""Line dedup: levelled sorted runs of line hashes, looked up by merge joins."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.tables import documents, packed_rows, query
from corpuslens.session import durable, scratch_path

SPACES = r"\x20\x09-\x0D"
MIN_CHARS = 1
MIN_DOCS = 10
BATCHES = 2
FANOUT = 2
#: Keys with at least this share of all (document, key) pairs; by that there are at most its reciprocal of them.
HOT_SHARE = 1 / 1000


def line_key(line: Column) -> Column:
    """The line without separators at both ends, A-Z in lower case."""
    trimmed = F.trim(line, F.lit("\x20\x09\x0a\x0b\x0c\x0d"))
    return F.translate(trimmed, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(text: Column) -> Column:
    """The lines between \\n; NULL and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed(key: Column) -> Column:
    """Two hashes, 96 bits: at 10^12 different lines about one in 10^5 runs would mix up two of them."""
    return F.struct(F.xxhash64(key).alias("h"), F.hash(key).alias("g"))


@dataclass
class SortedRuns:
    """Runs of (h, g, n): key hashes with the number of documents seen, bucketed and sorted by both hashes on shared storage.

    Level 0 holds one run for each batch; FANOUT runs of a level are merged into one of the next, so a key is
    rewritten once per level and a lookup joins few runs. Buckets are merged where they are, without a shuffle: joins
    use all columns that the buckets are made by, and each task writes one file.
    """

    spark: SparkSession
    buckets: int
    levels: list[list[DataFrame]] = field(default_factory=lambda: [[]])
    tables: list[str] = field(default_factory=list)

    def _store(self, counts: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            counts.select("h", "g", "n").write.bucketBy(self.buckets, "h", "g").sortBy("h", "g")
            .option("path", scratch_path(self.spark, name)).saveAsTable(name)
        )
        self.tables.append(name)
        return self.spark.table(name)

    def add(self, counts: DataFrame) -> None:
        level = 0
        self.levels[0].append(self._store(counts.repartition(self.buckets, "h", "g")))
        while len(self.levels[level]) >= FANOUT:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(self._store(merged))

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        """The runs of one or more levels as one; a full outer merge join adds up the counts of both sides."""
        total = runs[0]
        for run in runs[1:]:
            left, right = total.withColumnRenamed("n", "a"), run.withColumnRenamed("n", "b")
            total = left.join(right.hint("merge"), ["h", "g"], "full").select(
                "h", "g", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("n")
            )
        return total

    def all(self) -> DataFrame:
        return self._merge([run for level in self.levels for run in level])

    def forget(self) -> None:
        """Take the names out of the catalog; the files go with the shared scratch folder."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def known_keys(spark: SparkSession, keyed: DataFrame, buckets: int, batches: int = BATCHES) -> SortedRuns:
    """Add the documents of `keyed` (batch, keys: distinct hashes of one document) batch by batch.

    One shuffle counts the keys of all batches; a batch is then one slice of the stored counts.
    """
    counts = durable(
        keyed.select("batch", F.explode("keys").alias("k"))
        .groupBy("batch", F.col("k.h").alias("h"), F.col("k.g").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    )
    runs = SortedRuns(spark, buckets)
    for batch in range(batches):
        runs.add(counts.where(F.col("batch") == batch).select("h", "g", "n"))
    return runs


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with a new text, n_lines (before) and n_dropped (both long).

    Lines whose key has `min_chars` code points or more and occurs in at least `min_docs` documents (rows) go from
    every document; the others stay in order, joined by \\n. NULL and empty texts are one empty line, whose key is
    too short to be dropped, and come back as the empty text. Repeated rows count as documents of their own. Other
    columns stay as they are, but for those named n_lines or n_dropped; an empty table gives an empty table. doc_id is
    not looked at and may be NULL or repeated.
    """
    spark = docs.sparkSession
    packed, unpacked = packed_rows(docs, "n_lines", "n_dropped")
    # What a document loses depends on its text alone, so equal texts may share a number.
    rows = packed.select("_row", F.coalesce("text", F.lit("")).alias("text")).withColumn("_nr", F.md5("text"))
    keys = F.transform(lines_of(F.col("text")), line_key)
    long_enough = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    keyed = durable(rows.select("_nr", F.pmod(F.xxhash64("_nr"), F.lit(BATCHES)).alias("batch"),
                                F.array_distinct(F.transform(long_enough, _hashed)).alias("keys")))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = known_keys(spark, keyed, buckets)
    frequent = durable(runs.all().where(F.col("n") >= min_docs))
    total = frequent.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(frequent.where(F.col("n") >= F.greatest(F.lit(min_docs), F.lit(total * HOT_SHARE))).select("h", "g", F.lit(True).alias("hot")))
    pairs = keyed.select("_nr", F.explode("keys").alias("k")).select("_nr", F.col("k.h").alias("h"), F.col("k.g").alias("g"))
    marked = pairs.join(hot, ["h", "g"], "left")
    rest = marked.where("hot is null").join(frequent.select("h", "g").hint("merge"), ["h", "g"], "left_semi")
    found = marked.where("hot").select("_nr", "h", "g").unionByName(rest.select("_nr", "h", "g"))
    drops = durable(found.groupBy("_nr").agg(F.collect_set(F.struct("h", "g")).alias("_gone")))
    runs.forget()
    lines = lines_of(F.col("text"))
    kept = F.filter(lines, lambda x: (F.char_length(line_key(x)) < min_chars) | ~F.array_contains(F.col("_gone"), _hashed(line_key(x))))
    touched = F.col("_gone").isNotNull()
    out = rows.join(drops, "_nr", "left").select("_row", "text", F.size(lines).cast("long").alias("n_lines"), F.when(touched, kept).alias("_kept"))
    return unpacked(out.select(
        "_row", "n_lines",
        F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias("text"),
        F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    ))


OP3_SQL = """
WITH l AS (
  SELECT doc_id, u.i, u.line,
         translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {'i': i, 'line': x})) AS u
        FROM documents)),
f AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, f.k IS NOT NULL AS gone FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
