import pytest
from pyspark.sql import functions as F

from corpuslens import sources
from corpuslens.sources.order import sequential_index


def ingest(df, columns=None):
    return sources.assign_doc_id(sources.map_columns(sources.with_row_idx(df), columns)).orderBy("row_idx")


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def ids(df):
    return [r.doc_id for r in df.collect()]


def test_csv_mapping_keeps_unique_ids(spark, tmp_path):
    path = write(tmp_path / "c.csv", 'nr,story,printed,themes\n310,"salt\nand ""brine""",1987,sea;trade\n45,wool,1991,cloth\n')
    out = ingest(sources.read_csv(spark, path), {"text": "story", "doc_id": "nr", "year": "printed", "keywords": "themes"})
    rows = out.collect()
    assert [r.doc_id for r in rows] == [310, 45]
    assert rows[0].abstract == 'salt\nand "brine"'
    assert [r.author_keywords for r in rows] == ["sea;trade", "cloth"]
    assert [r.mesh_terms for r in rows] == [None, None]
    assert out.columns == ["doc_id", "row_idx", "year", "title", "abstract", "author_keywords", "mesh_terms"]


@pytest.mark.parametrize("body, columns", [
    ("id,abstract\n62,fig\n71,oak\n62,elm\n", {"doc_id": "id"}),
    ("id,abstract\n12d,fig\n7f,oak\n3,elm\n", {"doc_id": "id"}),
    ("abstract\nfig\noak\nelm\n", None),
])
def test_ids_are_replaced_if_any_is_unusable(spark, tmp_path, body, columns):
    out = ingest(sources.read_csv(spark, write(tmp_path / "c.csv", body)), columns)
    assert ids(out) == [1, 2, 3]


def test_decimal_ids_are_truncated(spark, tmp_path):
    out = ingest(sources.read_csv(spark, write(tmp_path / "c.csv", "pmid,text\n5.0,a\n 7 ,b\n")))
    assert ids(out) == [5, 7]


def test_missing_text_column_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="text"):
        sources.map_columns(sources.read_csv(spark, write(tmp_path / "c.csv", "foo\n1\n")))


def test_na_values(spark, tmp_path):
    path = write(tmp_path / "c.csv", "text,year\nNA,2001\nb,null\n")
    rows = sources.read_csv(spark, path, na_values=["NA", "null"]).orderBy("src_row").collect()
    assert [(r.text, r.year) for r in rows] == [(None, "2001"), ("b", None)]


def test_jsonl(spark, tmp_path):
    path = write(tmp_path / "c.jsonl", '{"id": 902, "text": "a barge", "year": 1876}\n{"id": 17, "text": "a lock", "year": 1903}\n')
    out = ingest(sources.read_jsonl(spark, path, "id LONG, text STRING, year INT"), {"doc_id": "id"})
    assert [(r.doc_id, r.abstract, r.year) for r in out.collect()] == [(902, "a barge", "1876"), (17, "a lock", "1903")]


def test_text_folder(spark, tmp_path):
    (tmp_path / "weir.txt").write_text("slow\nwater")
    (tmp_path / "canal.txt").write_bytes(b"grey \xff mud")
    (tmp_path / "other.md").write_text("no")
    rows = ingest(sources.read_text_folder(spark, str(tmp_path))).collect()
    assert [(r.doc_id, r.title, r.abstract) for r in rows] == [(1, "canal", "grey � mud"), (2, "weir", "slow\nwater")]
    with pytest.raises(ValueError, match="no file"):
        sources.read_text_folder(spark, str(tmp_path), "*.rst")


def test_citation_ids(spark, tmp_path):
    path = write(tmp_path / "i.csv", "pmid,x\n3,a\n,b\n5.0,c\n")
    assert ids(sources.read_citation_ids(spark, path)) == [3, 5]
    with pytest.raises(ValueError, match="pmid"):
        sources.read_citation_ids(spark, write(tmp_path / "j.csv", "id\n3\n"))


CITATIONS = """<?xml version="1.0"?>
<PubmedArticleSet>
<PubmedArticle><MedlineCitation Owner="x"><PMID Version="1">11</PMID><Article><Journal><JournalIssue><PubDate><Year>2019</Year></PubDate></JournalIssue></Journal>
<ArticleTitle>On <i>A</i> &amp; b</ArticleTitle><Abstract><AbstractText Label="BG">x <sub>2</sub> y &lt; 3</AbstractText><AbstractText>tail</AbstractText></Abstract></Article>
<KeywordList><Keyword MajorTopicYN="N"/><Keyword MajorTopicYN="N"> k<b>1</b> </Keyword><Keyword>k2</Keyword></KeywordList>
<MeshHeadingList><MeshHeading><DescriptorName>Humans</DescriptorName><QualifierName>q</QualifierName></MeshHeading><MeshHeading><DescriptorName>Mice</DescriptorName></MeshHeading></MeshHeadingList>
</MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>12</PMID><Article><Journal><JournalIssue><PubDate><MedlineDate>1998 Nov-Dec</MedlineDate></PubDate></JournalIssue></Journal><ArticleTitle>T</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><Article><ArticleTitle>no id</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>13</PMID></MedlineCitation></PubmedArticle>
<PubmedArticle><PMID>14</PMID></PubmedArticle>
</PubmedArticleSet>
"""


def test_citations(spark, tmp_path):
    rows = sources.read_citations(spark, write(tmp_path / "c.xml", CITATIONS)).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [11, 12]
    first, second = rows
    assert (first.year, first.title, first.abstract) == (2019, "On A & b", "BG: x 2 y < 3 tail")
    assert (first.author_keywords, first.mesh_terms) == ("k1; k2", "Humans; Mice")
    assert (second.year, second.title, second.abstract, second.author_keywords) == (1998, "T", None, None)


def test_a_bad_record_is_rejected_alone(spark, tmp_path):
    bad = """<PubmedArticle><MedlineCitation><PMID>21</PMID><Article><ArticleTitle>a &nbsp; b</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>22</PMID><Article><ArticleTitle>open <i>tag</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>x23</PMID><Article><ArticleTitle>t</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>24</PMID><Article><ArticleTitle>with <mml:math>x</mml:math></ArticleTitle></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>"""
    path = write(tmp_path / "bad.xml", CITATIONS.replace("</PubmedArticleSet>", bad))
    rows, rejected = sources.load_citations(spark, path)
    assert sorted((r.doc_id, r.title) for r in rows.collect()) == [(11, "On A & b"), (12, "T"), (24, "with x")]
    assert sorted(r.doc_id for r in sources.read_citations(spark, path).collect()) == [11, 12, 24]
    found = {r.record[r.record.index("<PMID>") + 6 :][:3].strip("<"): r.error for r in rejected.collect()}
    assert set(found) == {"21", "22", "x23"}
    assert "entity" in found["21"] and "mismatched tag" in found["22"] and "no number" in found["x23"]
    feed = write(tmp_path / "bad_feed.xml", ATOM.replace("Bell tuning", "Bell & tuning"))
    entries, refused = sources.load_atom_feed(spark, feed)
    assert [r.title for r in entries.collect()] == ["Lichens of slate roofs"]
    assert refused.count() == 1


ATOM = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>
  <entry><title> Lichens of slate roofs </title><summary>Counts from
 twelve villages.</summary><published>2009-11-30T08:15:00Z</published><category term="bot"/><category term=""/><category term="geo"/></entry>
  <entry><title>Bell tuning</title><summary>Five partials.</summary><published>2013-02-14T00:00:00Z</published><category term="snd"/></entry>
</feed>"""


def test_atom_feed(spark, tmp_path):
    rows = ingest(sources.read_atom_feed(spark, write(tmp_path / "f.xml", ATOM))).collect()
    assert [(r.doc_id, r.title, r.abstract, r.year, r.author_keywords) for r in rows] == [
        (1, "Lichens of slate roofs", "Counts from\n twelve villages.", "2009", "bot; geo"),
        (2, "Bell tuning", "Five partials.", "2013", "snd"),
    ]


def test_row_idx_over_many_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").selectExpr("id", "repeat('x', 50) AS text").write.json(path)
    conf = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        df = sources.with_row_idx(sources.read_jsonl(spark, path, "id LONG, text STRING"))
        assert df.where("id <> row_idx").count() == 0
        assert df.count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", conf)


def test_sequential_index(spark):
    df = spark.range(500).withColumn("k", F.xxhash64("id"))
    got = [r.i for r in sequential_index(df.repartition(5), ["k"], "i").orderBy("k").collect()]
    assert got == list(range(500))


def test_embeddings_of_mixed_dimension_fail(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "doc_id long, embedding array<float>")
    with pytest.raises(ValueError, match="dimension"):
        sources.load_embeddings(df)


def test_records_are_parsed_in_portions_of_their_bytes(monkeypatch):
    import pyarrow as pa

    from corpuslens.sources import xml

    monkeypatch.setattr(xml, "PORTION_BYTES", 100)
    texts = ["<e/>" * 20, None, "<e/>", "<e/>" * 90, "<e/>", "", "<e/>" * 24, "<e/>"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(8)), "value": pa.array(texts)})
    parts = list(xml._portions(batch, "value"))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    sizes = [[len(t or "") for t in p.column("value").to_pylist()] for p in parts]
    assert len(parts) > 2 and all(sum(s) - max(s) <= 100 for s in sizes)
    assert [p.num_rows for p in xml._portions(batch.slice(0, 0), "value")] == [0]
