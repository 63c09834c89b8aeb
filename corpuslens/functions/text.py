"""Column expressions over text: cleaning, keyword lists, tokens, word n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns, in the order they are applied.
URL = r"https?://\S+|www\.\S+"
DOI = r"\b10\.\d{4,}/\S+"
BRACKET_CITATION = r"\[\s*\d+(?:\s*[-,]\s*\d+)*\s*\]"
STANDALONE_NUMBER = r"\b\d+(?:\.\d+)?\b"
WHITESPACE = r"\s+"
# Keyword delimiter and the token pattern of a count vectoriser.
KEYWORD_DELIMITER = "; "
TOKEN = r"[\p{L}\p{N}_]{2,}"

_UNICODE = "(?U)"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only blanks."""
    return F.regexp_replace(text, _UNICODE + r"^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.when(text.rlike(_UNICODE + r"\S"), text)


def clean_text(text: Column) -> Column:
    """Lower-case text without links, DOIs, bracket citations and numbers; NULL gives ''."""
    cleaned = F.coalesce(text, F.lit(""))
    for pattern in (URL, DOI, BRACKET_CITATION, STANDALONE_NUMBER):
        cleaned = F.regexp_replace(cleaned, _UNICODE + pattern, " ")
    return F.trim(F.regexp_replace(F.lower(cleaned), _UNICODE + WHITESPACE, " "))


def keyword_array(keywords: Column, delimiter: str = KEYWORD_DELIMITER) -> Column:
    """'A; b ;; A' -> ['a', 'b', 'a']: split on the exact delimiter, strip, lower, drop empties."""
    parts = F.split(keywords, r"\Q" + delimiter + r"\E")
    return F.filter(F.transform(parts, lambda k: F.lower(strip(k))), lambda k: k != "")


def keyword_occurrences(words: str) -> Column:
    """Distinct keywords of one document as (keyword, occurrences, first position).

    `words` names a stored array column: a lambda would evaluate an expression per element.
    """
    return F.transform(
        F.array_distinct(words),
        lambda k: F.struct(
            k.alias("keyword"),
            F.size(F.filter(words, lambda w: w == k)).cast("long").alias("occurrences"),
            F.array_position(words, k).alias("pos"),
        ),
    )


def stop_word_list(stop_words: Sequence[str] | str | None) -> list[str]:
    """The words of a setting: "english" is Spark's own list, None is no word, anything else is the words themselves."""
    if stop_words is None:
        return []
    if isinstance(stop_words, str):
        if stop_words != "english":
            raise ValueError(f'stop words: "english", None or a list of words, not {stop_words!r}')
        return StopWordsRemover.loadDefaultStopWords("english")
    return list(stop_words)


def tokens(text: Column, stop_words: Sequence[str] | str | None = None) -> Column:
    """Lower-case runs of two or more word characters, stop words removed."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    words = stop_word_list(stop_words)
    if not words:
        return found
    return F.filter(found, lambda t: ~t.isin(words))


def word_ngrams(words: str, smallest: int = 1, largest: int = 3) -> Column:
    """All runs of `smallest`..`largest` consecutive words, joined by a blank.

    `words` names a stored array column, see `keyword_occurrences`.
    """
    size = F.size(words)

    def of_length(n: int) -> Column:
        if n == 1:
            return F.col(words)
        starts = F.when(size >= n, F.sequence(F.lit(1), size - (n - 1)))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.coalesce(grams, F.array().cast("array<string>"))

    return F.concat(*[of_length(n) for n in range(smallest, largest + 1)])
