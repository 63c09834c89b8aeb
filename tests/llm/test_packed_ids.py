"""The pipeline's last table holds the ids themselves, also of repeated and missing doc_ids."""

import numpy as np
import pytest

import corpus_pipeline
from corpuslens.llm.encoding import encoder
from corpuslens.llm.packing import END_ID
from corpuslens.session import ship_package

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_pipeline_keeps_the_ids(spark):
    ship_package(spark)
    rows = [(1, "one text"), (1, "another text"), (None, "no id"), (None, "no id either"), (2, None), (3, "many words " * 3000)]
    packed = corpus_pipeline.packing(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    sequences = {}
    for r in packed.orderBy("sequence_id", "offset").collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and r["offset"] == len(sequences.get(r["sequence_id"], []))
        sequences.setdefault(r["sequence_id"], []).extend(ids.tolist())
    got = sum(sequences.values(), [])
    ids, _ = encoder(public_tokenizers.path("word_bpe_49k.json"), keep_space=False).encode([text or "" for _, text in rows])
    assert sorted(got) == sorted([*ids.tolist(), *[END_ID] * len(rows)])
    assert max(map(len, sequences.values())) <= 2048
