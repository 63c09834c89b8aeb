"""Quality rules: documents whose statistics are robust multivariate outliers of their language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.tables import documents, id_and_text, query
from corpuslens.llm.words import SPACE, Words, slices, text_buffers, window_hashes
from corpuslens.session import durable

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Share of a group that the determinant is minimised over.
CORE = 0.75
STEPS = 6
#: Squared distances are counted in bins of this many per doubling.
BINS_PER_OCTAVE = 16
#: A document is rejected beyond this squared distance, scaled so that the group's median has its normal value.
TAIL = 1e-7
#: Standard deviation that every transformed statistic has at least; it also keeps constant statistics regular.
FLOOR = 0.08
#: What is believed of the spread before rows are seen, worth PRIOR_ROWS rows: a few documents are no norm.
PRIOR, PRIOR_ROWS = 0.3, 4

FEATURES = ["x_length", "x_symbol", "x_punct", "x_upper", "x_stutter"]
P = len(FEATURES)
#: The medians of the chi-square distribution with P degrees and its upper TAIL quantile (Wilson-Hilferty).
_Z_TAIL = 5.199337582  # normal quantile of 1 - 1e-7


def _chi2(z: float) -> float:
    return P * (1 - 2 / (9 * P) + z * math.sqrt(2 / (9 * P))) ** 3


STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_punct long, n_upper long, n_stutter long"


def _repeated_words(hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the words inside runs of REPEAT_WORDS words that occur twice or more in it."""
    counts, size = np.diff(first), REPEAT_WORDS
    text = np.repeat(np.arange(len(counts)), counts)
    runs = window_hashes(hashed, size)
    if not len(runs):
        return np.zeros(len(counts), np.int64)
    at = np.flatnonzero(text[: len(runs)] == text[size - 1 :])
    # A run is told apart by its text too; equal neighbours after sorting are repeats.
    keys = runs[at] ^ (text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    cover = np.zeros(len(hashed) + 1, np.int64)
    hit = at[twice]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + size, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return np.bincount(text[inside], minlength=len(counts)).astype(np.int64)


def _duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(b"\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines) - len(set(lines))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        parts = []
        for i, j in slices(offsets):
            piece, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            words = Words(piece, at)

            def per_text(mask: np.ndarray, at: np.ndarray = at) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(mask)])[at])

            head = (piece & 0xC0) != 0x80  # the first byte of each code point
            solid = ~SPACE[piece]
            raw = piece.tobytes()
            dup = [_duplicate_lines(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            hashed, texts = words.hashes(), words.texts()
            again = np.flatnonzero((hashed[1:] == hashed[:-1]) & (texts[1:] == texts[:-1]))
            parts.append([
                words.counts(), per_text(head & solid), per_text(SYMBOLS[piece]), np.array(dup, np.int64),
                _repeated_words(hashed, words.first), per_text(solid & ~ALNUM[piece]), per_text(UPPER[piece]),
                np.bincount(texts[again], minlength=j - i),
            ])
        names = [x.split()[0] for x in STATISTICS.split(", ")]
        columns = [np.concatenate([p[k] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for k in range(len(names))]
        keep = [batch.column(c) for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            keep + [pa.array(c) for c in columns], names=[c for c in batch.schema.names if c != "text"] + names
        )


def text_statistics(docs: DataFrame) -> DataFrame:
    """The counts of every whole text beside doc_id, lang and source; one pass, no shuffle."""
    part = docs.select("doc_id", "text", "lang", "source")
    kinds = {f.name: f.dataType.simpleString() for f in part.schema}
    return part.mapInArrow(
        _statistics, f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, source {kinds['source']}, {STATISTICS}"
    )


def _features(stats: DataFrame) -> DataFrame:
    """Transformed statistics, each about normal with a spread near or below one half."""
    words = F.greatest("n_words", F.lit(1))
    solid = F.greatest("word_chars", F.lit(1))
    return stats.withColumns({
        "x_length": F.log(F.greatest("word_chars", F.lit(1)) / words),
        "x_symbol": F.log1p(F.col("n_symbols") / words * 4),
        "x_punct": F.sqrt(F.col("n_punct") / solid) * 2,
        "x_upper": F.sqrt(F.col("n_upper") / solid) * 2,
        "x_stutter": F.sqrt(F.col("n_stutter") / words) * 2,
    })


def _distance(row: str = "") -> F.Column:
    """Squared Mahalanobis distance from `centre` by the inverse matrix `inv`, both arrays of the row."""
    gap = [F.col(x) - F.col("centre")[k] for k, x in enumerate(FEATURES)]
    total = F.lit(0.0)
    for a in range(P):
        total = total + F.col("inv")[a * P + a] * gap[a] * gap[a]
        for b in range(a):
            total = total + 2 * F.col("inv")[a * P + b] * gap[a] * gap[b]
    return F.greatest(total, F.lit(0.0))


_MODEL = "lang string, source string, way int, centre array<double>, inv array<double>, logdet double, scale double, size long"


def _core_of_bins(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """Mean and covariance of the closest rows that make up CORE of a group; its bins are few."""
    bins = bins.sort_values("bin")
    count = bins["n"].to_numpy()
    reach = np.cumsum(count)
    last = int(np.searchsorted(reach, CORE * reach[-1]))
    half = int(np.searchsorted(reach, 0.5 * reach[-1]))
    rows = np.stack(bins["sums"].to_numpy())[: last + 1].sum(axis=0)
    n = count[: last + 1].sum()
    mean = rows[:P] / n
    cov = np.empty((P, P))
    at = P
    for a in range(P):
        for b in range(a + 1):
            cov[a, b] = cov[b, a] = rows[at] / n - mean[a] * mean[b]
            at += 1
    cov = cov + np.eye(P) * (FLOOR**2 + PRIOR**2 * PRIOR_ROWS / (PRIOR_ROWS + reach[-1]))
    median = 2.0 ** (bins["bin"].to_numpy()[half] / BINS_PER_OCTAVE)
    return pd.DataFrame({
        "lang": [key[0]], "source": [key[1]], "way": [key[2]], "centre": [mean.tolist()],
        "inv": [np.linalg.inv(cov).ravel().tolist()], "logdet": [float(np.linalg.slogdet(cov)[1])],
        "scale": [float(median)], "size": [int(reach[-1])],
    })


def _binned(rows: DataFrame) -> DataFrame:
    """Counts and moments per group, start and bin of the distance `d2`: what a concentration step needs."""
    moments = [F.sum(x) for x in FEATURES] + [F.sum(F.col(FEATURES[a]) * F.col(FEATURES[b])) for a in range(P) for b in range(a + 1)]
    bin_of = F.floor(F.log2(F.greatest("d2", F.lit(1e-6))) * BINS_PER_OCTAVE)
    return rows.groupBy("lang", "source", "way", bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*moments).alias("sums")
    )


def _with_model(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beside their group's model. The model is a stored table of one row per group: Spark broadcasts it while
    its files are small, and otherwise splits a hot group in the merge join."""
    return rows.join(model, keys)


def fit_groups(features: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates (lang, source, centre, inv, scale, size), one row per group.

    Two starts, all rows by coordinatewise medians and by the overall mean, go through concentration steps on all
    rows at once; the smaller determinant wins. A step sends counts and moments per distance bin, so a group of any
    size arrives as a few hundred rows.
    """
    near = [F.percentile_approx(x, 0.5, 1000).alias(f"m{k}") for k, x in enumerate(FEATURES)]
    mean = [F.avg(x).alias(f"a{k}") for k, x in enumerate(FEATURES)]
    spread = [F.greatest(F.stddev_pop(x), F.lit(FLOOR)).alias(f"s{k}") for k, x in enumerate(FEATURES)]
    whole = features.groupBy("lang", "source").agg(*near, *mean, *spread)
    unit = [F.lit(0.0) if a != b else 1 / (F.col(f"s{a}") * F.col(f"s{a}")) for a in range(P) for b in range(P)]
    model = durable(whole.select(
        "lang", "source", F.explode(F.array(F.lit(0), F.lit(1))).alias("way"),
        *(F.col(f"{p}{k}") for p in "ma" for k in range(P)), F.array(*unit).alias("inv"),
    ).select(
        "lang", "source", "way", "inv",
        F.when(F.col("way") == 0, F.array(*(F.col(f"m{k}") for k in range(P)))).otherwise(F.array(*(F.col(f"a{k}") for k in range(P)))).alias("centre"),
    ))
    for _ in range(STEPS):
        rows = _with_model(features, model, ["lang", "source"]).withColumn("d2", _distance())
        model = durable(_binned(rows).groupBy("lang", "source", "way").applyInPandas(_core_of_bins, _MODEL))
    best = model.groupBy("lang", "source").agg(F.min_by("way", F.struct("logdet", "way")).alias("way"))
    chosen = model.join(best, ["lang", "source", "way"])
    # One more pass only for the median distance under the final estimate.
    rows = _with_model(features, durable(chosen), ["lang", "source"]).withColumn("d2", _distance())
    middle = _binned(rows).groupBy("lang", "source", "way").applyInPandas(_core_of_bins, _MODEL)
    return durable(chosen.drop("scale").join(middle.select("lang", "source", "scale"), ["lang", "source"]).drop("way", "logdet"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, `base_failed`, the squared distance `d2` and `kept`.

    `docs` needs doc_id, text, lang and source; other columns are ignored. NULL and empty texts have no words and
    fail the base rule. NULL lang or source form the group of the empty name. Repeated rows are judged each; a
    group too small to vary is judged by the floor and the prior on the spread. An empty table gives an empty table.
    """
    known = id_and_text(docs, "lang", "source").select("doc_id", "text", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    stats = durable(text_statistics(known))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = _features(stats).withColumn("base_failed", failed)
    model = fit_groups(rows.where(~F.col("base_failed")).select("lang", "source", *FEATURES))
    limit = _chi2(_Z_TAIL) / _chi2(0.0)
    judged = rows.join(model, ["lang", "source"], "left").withColumn("d2", _distance() / F.greatest("scale", F.lit(_chi2(0.0))) * _chi2(0.0))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= F.lit(limit * _chi2(0.0)))).alias("kept"),
        "d2", *FEATURES,
    )


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop(*FEATURES)
