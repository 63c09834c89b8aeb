from pyspark.sql import functions as F

from corpuslens.operators import weights as w
from corpuslens.operators.documents import document_ngrams


def test_a_task_of_the_reassignment_meets_few_documents(spark, monkeypatch):
    """Tasks of the join on terms sum up by document and topic; four times the documents are four times the tasks."""
    monkeypatch.setattr(w, "PAIRS_PER_LANE", 2_000)
    monkeypatch.setattr(w, "PAIRS_PER_PART", 500)

    def corpus(n):
        rows = [(i, -1 if i % 2 else i % 3, " ".join(f"w{(i * k) % 37}" for k in range(1, 9)) + " common") for i in range(n)]
        return spark.createDataFrame(rows, "doc_id long, topic int, abstract string")

    def most(n):
        docs = corpus(n)
        weights = w.ctfidf(w.term_counts(docs))
        terms = document_ngrams(docs.where("topic = -1"), "abstract", None, 1, 1)
        matched = w.matched_terms(docs.where("topic = -1"), weights, "abstract", None, 1, 0)
        assert matched.count() == terms.count()
        return matched.groupBy(F.spark_partition_id()).agg(F.countDistinct("doc_id").alias("n")).agg(F.max("n")).first()[0]

    assert most(2000) < 1.5 * most(500)
    docs = corpus(500)
    weights = w.ctfidf(w.term_counts(docs))
    rows = [sorted(map(tuple, w.reassign_outliers(docs, weights, lookup_terms=k).collect())) for k in (0, 100)]
    assert rows[0] == rows[1] and len(rows[0]) == 500


def test_null_and_repeated_ids_are_reassigned_as_when_terms_are_looked_up(spark):
    rows = [(1, 0, "fish river"), (2, 1, "star moon"), (None, -1, "star fish fish"), (None, -1, "moon"), (5, -1, "moon star"), (5, -1, "fish"), (6, -1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, topic int, abstract string")
    weights = w.ctfidf(w.term_counts(docs))
    key = lambda k: sorted(map(str, w.reassign_outliers(docs, weights, lookup_terms=k).collect()))
    assert key(0) == key(100)
