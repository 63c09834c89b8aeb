"""Class-based TF-IDF: term weights per topic, seeds, and outlier reassignment.

W(t, c) = tf(t, c) / sum_t tf(t, c) * ln(1 + A / f(t)), with A the truncated mean number of
words per class and f(t) the frequency of t over all classes (Grootendorst 2022).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.operators.documents import document_ngrams
from corpuslens.operators.keywords import TOP_N, top_n_per_group
from corpuslens.schema import OUTLIER
from corpuslens.session import BROADCAST_ROWS, durable, shuffled, small_side

TIE_DIGITS = 9
SEED_FACTOR = 1.2
#: Words times topics in a lane of documents, and in one of the parts its terms are dealt into.
PAIRS_PER_LANE = 48_000_000
PAIRS_PER_PART = 4_000_000


def term_counts(
    docs: DataFrame,
    text: str = "abstract",
    stop_words: Sequence[str] | str | None = None,
    ngrams: tuple[int, int] = (1, 1),
) -> DataFrame:
    """(topic, term, tf): the tokens are counted on the map side before anything is shuffled."""
    words = docs.select("topic", tx.tokens(F.col(text), stop_words).alias("_words"))
    return words.select("topic", F.explode(tx.word_ngrams("_words", *ngrams)).alias("term")).groupBy("topic", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )


def ctfidf(counts: DataFrame, seeds: DataFrame | None = None, seed_factor: float = SEED_FACTOR) -> DataFrame:
    """(topic, term, tf, idf, score) from term counts; the outlier class counts as a class.

    The counts are stored first, so the texts are tokenised once and the topic totals become a
    lookup. The window over a term holds one row per topic; nothing is gathered by topic.
    `seeds` is a table of words (`term`) whose weight is raised by `seed_factor`.
    """
    counts = durable(counts)
    totals = durable(counts.groupBy("topic").agg(F.sum("tf").alias("_words")))
    average = totals.agg(F.floor(F.avg("_words")).cast("double")).first()[0]
    weighted = (
        counts.withColumn("_f", F.sum("tf").over(Window.partitionBy("term")))
        .join(small_side(totals), "topic")
        .withColumn("idf", F.log(1 + F.lit(average) / F.col("_f")))
    )
    if seeds is not None:
        marked = small_side(seeds.select("term").distinct().withColumn("_seed", F.lit(seed_factor)))
        weighted = weighted.join(marked, "term", "left").withColumn(
            "idf", F.col("idf") * F.coalesce("_seed", F.lit(1.0))
        )
    return weighted.select(
        "topic", "term", "tf", "idf", (F.col("tf") / F.col("_words") * F.col("idf")).alias("score")
    )


def ctfidf_topn(weights: DataFrame, n: int = TOP_N) -> DataFrame:
    """(topic, rank, term, score): heaviest terms of every topic, the outlier class left out."""
    order = [F.round("score", TIE_DIGITS).desc(), F.col("term")]
    top = top_n_per_group(weights.where(F.col("topic") != OUTLIER), "topic", order, n)
    return top.select("topic", "rank", "term", "score")


def heaviest_ngrams(
    docs: DataFrame,
    text: str = "abstract",
    stop_words: Sequence[str] | str | None = None,
    ngrams: tuple[int, int] = (1, 3),
    n: int = 100,
) -> DataFrame:
    """The `n` heaviest n-grams of every topic, see `heaviest_runs`; NULL and empty texts have no words."""
    return heaviest_runs(durable(stored_words(docs.select("topic", text), text, stop_words)), ngrams, n)


def stored_words(docs: DataFrame, text: str, stop_words: Sequence[str] | str | None) -> DataFrame:
    """The other columns of `docs` and `_words`, the array of its tokens."""
    tokens = F.coalesce(tx.tokens(F.col(text), stop_words), F.array().cast("array<string>"))
    return docs.withColumn("_words", tokens).drop(text)


def heaviest_runs(words: DataFrame, ngrams: tuple[int, int] = (1, 3), n: int = 100) -> DataFrame:
    """(topic, term, tf, score): the `n` heaviest n-grams of every topic, the outlier class left out.

    The same rows as the first `n` of `ctfidf(term_counts(...))` by falling score and term, but counted level by level.
    `words` is a stored table of topic and _words.
    An n-gram is never more frequent than its head and its tail, and f(t) is at least tf(t, c), so tf / words *
    ln(1 + A / tf) of a part bounds the score of all that holds it. Longer n-grams are counted only where both parts can
    still reach some topic's n-th score so far. By that bound a topic has at most ln(1 + A) / its n-th score such parts
    of a size, whatever the size of the corpus, so they are looked up where the texts are.

    A topic without words has no rows. Topics with fewer than `n` n-grams keep all, and leave out none of the parts.
    """
    smallest, largest = ngrams
    runs = sum(F.greatest(F.size("_words") - (size - 1), F.lit(0)) for size in range(smallest, largest + 1))
    totals = durable(words.groupBy("topic").agg(F.sum(runs).alias("_total")).where(F.col("_total") > 0))
    average = F.lit(totals.agg(F.floor(F.avg("_total")).cast("double")).first()[0])
    known = small_side(totals)
    order = [F.round("score", TIE_DIGITS).desc(), F.col("term")]

    def scored(counts: DataFrame, frequency: Column) -> DataFrame:
        weight = F.col("tf") / F.col("_total") * F.log(1 + average / frequency)
        return counts.join(known, "topic").withColumn("score", weight).where(F.col("topic") != OUTLIER)

    def reaching(counts: DataFrame, best: DataFrame) -> DataFrame:
        """Counts whose bound is not below the n-th score; its column `score` holds the bound."""
        least = best.where(F.col("rank") == n).select("topic", F.round("score", TIE_DIGITS).alias("_least"))
        bounded = scored(counts.select("topic", "term", "tf"), F.col("tf")).join(small_side(least), "topic", "left")
        # Scores are compared as rounded, so the bound gets the width of one rounding.
        return bounded.where(F.col("_least").isNull() | (F.col("score") + 10.0**-TIE_DIGITS >= F.col("_least"))).select("topic", "term", "tf")

    best = counts = None
    for size in range(smallest, largest + 1):
        rows = words.select("topic", F.explode(tx.word_ngrams("_words", size, size)).alias("term"))
        if best is not None:
            live = small_side(durable(reaching(counts, best).select("term").distinct()))
            parts = {"_head": F.substring_index("term", " ", size - 1), "_tail": F.substring_index("term", " ", 1 - size)}
            for name, part in parts.items():
                rows = rows.withColumn(name, part).join(live.withColumnRenamed("term", name), name, "left_semi")
        counts = durable(rows.groupBy("topic", "term").agg(F.count(F.lit(1)).alias("tf")))
        frequency = counts.groupBy("term").agg(F.sum("tf").alias("_f"))
        candidates = counts if best is None else reaching(counts, best)
        found = scored(candidates.join(frequency, "term"), F.col("_f")).select("topic", "term", "tf", "score")
        pool = found if best is None else found.unionByName(best.drop("rank"))
        best = durable(top_n_per_group(pool, "topic", order, n))
    return best.select("topic", "term", "tf", "score")


def matched_terms(outliers: DataFrame, weights: DataFrame, text: str, stop_words: Sequence[str] | str | None, lanes: int, lookup_terms: int) -> DataFrame:
    """(doc_id, term, tf, idf, _topics): the terms of `outliers` that topics have, with their weights in these.

    Where terms are joined, a task sums up by document and topic, so it must not meet all documents: these are dealt
    into lanes, more of them the more words times topics there are, and a lane's terms into parts. A part gets the weights
    of the terms it has, so all of this grows as the words do. Texts are dealt before they are split into terms, which
    keeps the rows that a task makes of them few.
    """
    spoken = F.col("topic") == OUTLIER
    packed = durable(weights.groupBy("term").agg(
        F.first("idf").alias("idf"), F.collect_list(F.when(~spoken, F.struct("topic", "score"))).alias("_topics"), F.sum(F.when(spoken, F.col("tf"))).alias("_spoken")
    ).where(F.size("_topics") > 0))
    terms, pairs = packed.agg(F.count(F.lit(1)), F.sum(F.col("_spoken") * F.size("_topics"))).first()
    packed = packed.drop("_spoken")
    if terms <= lookup_terms:
        return document_ngrams(outliers, text, stop_words, 1, 1).join(F.broadcast(packed), "term")
    lanes = max(lanes, -(-(pairs or 0) // PAIRS_PER_LANE))
    parts = PAIRS_PER_LANE // PAIRS_PER_PART
    lane, part = (F.pmod(F.xxhash64(c), F.lit(n)) for c, n in (("doc_id", lanes), ("term", parts)))
    texts = outliers.select("doc_id", text).repartition(lanes, F.xxhash64("doc_id", text))
    dealt = document_ngrams(texts, text, stop_words, 1, 1).withColumn("_part", lane * parts + part)
    there = packed.join(shuffled(dealt.select("_part", "term").distinct()), "term")
    both = there.unionByName(dealt, allowMissingColumns=True).repartition(lanes * parts, "_part")
    # Each term's weights come first in its part; the rows after it are documents.
    first = Window.partitionBy("_part", "term").orderBy(F.col("_topics").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    given = {c: F.first(c, ignorenulls=True).over(first) for c in ("idf", "_topics")}
    return both.withColumns(given).where(F.col("tf").isNotNull() & F.col("_topics").isNotNull()).select("doc_id", "term", "tf", "idf", "_topics")


def reassign_outliers(
    docs: DataFrame,
    weights: DataFrame,
    text: str = "abstract",
    stop_words: Sequence[str] | str | None = None,
    salts: int = 1,
    lookup_terms: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, topic): outliers move to the topic with the most similar term weights.

    Similarity is the cosine between the document's and the topic's weights; a document that
    shares no term with any topic stays an outlier, and all other documents keep their topic.

    A vocabulary of at most `lookup_terms` terms is looked up where the documents are. A larger
    one is joined on the term, the documents in at least `salts` lanes; see `matched_terms`.
    """
    weights = durable(weights)
    in_topics = weights.where(F.col("topic") != OUTLIER)
    topic_norms = in_topics.groupBy("topic").agg(F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("_topic_norm"))
    matched = matched_terms(docs.where(F.col("topic") == OUTLIER), weights, text, stop_words, salts, lookup_terms)
    # The document's own norm is the same for all its topics and cannot change the choice.
    dots = (
        matched.select("doc_id", (F.col("tf") * F.col("idf")).alias("_w"), F.inline("_topics"))
        .groupBy("doc_id", "topic")
        .agg(F.sum(F.col("_w") * F.col("score")).alias("_dot"))
    )
    similarity = F.round(F.col("_dot") / F.col("_topic_norm"), TIE_DIGITS)
    best = (
        dots.join(small_side(durable(topic_norms)), "topic")
        .groupBy("doc_id")
        .agg(F.max_by("topic", F.struct(similarity, -F.col("topic"))).alias("_best"))
    )
    return docs.select("doc_id", "topic").join(best, "doc_id", "left").select(
        "doc_id", F.coalesce("_best", "topic").alias("topic")
    )
