from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.operators import documents as d


@pytest.mark.parametrize("dirty, clean", [
    ("AAA http://x", "aaa"),
    (None, ""),
    ("B [1] 5", "b"),
    ("see 10.1234/ab.c-9 end", "see end"),
    ("a [3-5] b [1, 2] c", "a b c"),
    ("up 42% and 7.5 of x2", "up % and of x2"),
    ("  wide  space \n", "wide space"),
    ("www.x.org Über 5é", "über 5é"),
])
def test_clean_text(spark, dirty, clean):
    row = spark.createDataFrame([(dirty,)], "t string").select(tx.clean_text(F.col("t")).alias("c")).first()
    assert row.c == clean


def test_keyword_array(spark):
    df = spark.createDataFrame([("A; b ;; A; a;b;  C",), (None,), ("",)], "k string")
    got = [r.a for r in df.select(tx.keyword_array(F.col("k")).alias("a")).collect()]
    assert got == [["a", "b ;", "a", "a;b", "c"], None, []]


def test_keyword_occurrences(spark):
    df = spark.createDataFrame([(["x", "y", "x"],)], "w array<string>")
    got = df.select(F.inline(tx.keyword_occurrences("w"))).collect()
    assert [tuple(r) for r in got] == [("x", 2, 1), ("y", 1, 2)]


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("The A4 état-unis of x and_b",), ("one",), ("",)], "t string")
    words = df.select(tx.tokens(F.col("t"), ["of", "the"]).alias("w"))
    assert [r.w for r in words.collect()] == [["a4", "état", "unis", "and_b"], ["one"], []]
    grams = [r.g for r in words.select(tx.word_ngrams("w", 1, 3).alias("g")).collect()]
    assert grams[0] == ["a4", "état", "unis", "and_b", "a4 état", "état unis", "unis and_b", "a4 état unis", "état unis and_b"]
    assert grams[1:] == [["one"], []]


def test_valid_years(spark):
    df = spark.createDataFrame([("2001",), ("n.d.",), (None,), ("0",), ("1999.0",), ("-3",), ("NaN",), ("1e99",)], "year string")
    assert sorted(r.year for r in d.valid_years(df).collect()) == [1999, 2001]
    with pytest.raises(ValueError, match="year"):
        d.valid_years(df.where("year = '0'"))


def test_drop_blank_and_pick_text(spark):
    df = spark.createDataFrame([(1, "a"), (2, "  \n"), (3, None)], "doc_id long, abstract string")
    assert [r.doc_id for r in d.drop_blank(df).collect()] == [1]
    assert d.pick_text(d.clean_documents(df.withColumn("abstract", F.upper("abstract")))).first().text == "a"
    with pytest.raises(ValueError, match="no column"):
        d.clean_documents(df.drop("abstract"))


def test_keywords_joined_late(spark):
    docs = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, topic int")
    keywords = spark.createDataFrame([(1, "a; b")], "doc_id long, author_keywords string")
    assert d.with_author_keywords(docs, None) is None
    joined = d.with_author_keywords(docs, keywords)
    assert {r.doc_id: r.author_keywords for r in joined.collect()} == {1: "a; b", 2: None}
    assert d.with_author_keywords(joined, None) is joined


def test_stop_word_settings(spark):
    df = spark.createDataFrame([("The tide and the moon",)], "text string")
    words = lambda stop: df.select(tx.tokens(F.col("text"), stop)).first()[0]
    assert words("english") == ["tide", "moon"]
    assert words(None) == ["the", "tide", "and", "the", "moon"]
    assert words(["moon"]) == ["the", "tide", "and", "the"]
    with pytest.raises(ValueError, match="german"):
        words("german")


def test_ngrams_are_counted_in_their_row_unless_ids_are_shared(spark):
    texts = [(4, "oak elm oak elm oak"), (9, "fig"), (2, "elm oak"), (4, "oak elm"), (None, "fig fig"), (None, "fig"), (7, None), (8, "x")]
    found = d.document_ngrams(spark.createDataFrame(texts, "doc_id long, abstract string"), smallest=1, largest=2).collect()
    wanted = Counter()
    for doc_id, text in texts:
        words = [w for w in (text or "").split() if len(w) > 1]
        wanted.update((doc_id, w) for w in words)
        wanted.update((doc_id, " ".join(p)) for p in zip(words, words[1:], strict=False))
    assert {(r.doc_id, r.term): r.tf for r in found} == wanted and len(found) == len(wanted)
    # Without shared ids nothing is aggregated, so nothing is spilled.
    alone = d.document_ngrams(spark.createDataFrame(texts[:3], "doc_id long, abstract string"))
    assert "Aggregate" not in alone._jdf.queryExecution().executedPlan().toString()
