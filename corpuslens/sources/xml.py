"""Bibliographic XML: citation records and Atom feeds.

Every record is parsed once, by itself: one that is no well-formed XML becomes a row of the rejected records and
doesn't touch the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from xml.etree.ElementTree import Element, TreeBuilder
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.text import strip
from corpuslens.session import durable
from corpuslens.sources.files import ORIGIN, origin_columns

_CITATION = "pmid string, year string, medline string, title string, labels array<string>, bodies array<string>, keywords array<string>, mesh array<string>"
_ENTRY = "title string, abstract string, year string, terms array<string>"
PORTION_BYTES = 2_000_000


def _root(xml: str) -> Element:
    """The record's element. Prefixes are part of names, as their declarations may stand outside the record."""
    builder = TreeBuilder()
    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = builder.start, builder.end, builder.data
    parser.Parse(xml.encode(), True)
    return builder.close()


def _text(element: Element | None) -> str:
    """All text inside an element, that of nested markup included."""
    return "" if element is None else "".join(element.itertext())


def _citation(record: Element) -> dict | None:
    article = record.find("MedlineCitation/Article")
    pmid = _text(record.find("MedlineCitation/PMID"))
    if article is None or not pmid:
        return None
    date = "Journal/JournalIssue/PubDate"
    parts = article.findall("Abstract/AbstractText")
    return {
        "pmid": pmid, "year": _text(article.find(f"{date}/Year")), "medline": _text(article.find(f"{date}/MedlineDate")),
        "title": _text(article.find("ArticleTitle")), "labels": [p.get("Label", "") for p in parts], "bodies": [_text(p) for p in parts],
        "keywords": [_text(k) for k in record.iter("Keyword")], "mesh": [_text(m.find("DescriptorName")) for m in record.iter("MeshHeading")],
    }


def _entry(record: Element) -> dict:
    return {
        "title": _text(record.find("title")), "abstract": _text(record.find("summary")), "year": _text(record.find("published"))[:4],
        "terms": [c.get("term", "") for c in record.findall("category")],
    }


def _portions(batch: pa.RecordBatch, xml: str) -> Iterator[pa.RecordBatch]:
    """Slices of some PORTION_BYTES of XML. A batch has a number of rows, so it grows with the length of the records."""
    sizes = pc.fill_null(pc.binary_length(batch.column(xml)), 0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PORTION_BYTES)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(a, b - a)


def _parsed(records: DataFrame, xml: str, read: Callable[[Element], dict | None], fields: str) -> DataFrame:
    """`records` with the struct `_found` of what `read` takes from a record (NULL: skipped) and `_error`, why it has no tree."""

    arrow = pa.struct([(f.split(" ")[0], pa.list_(pa.string()) if "array" in f else pa.string()) for f in fields.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in (p for batch in batches for p in _portions(batch, xml)):
            found, errors = [], []
            for text in portion.column(xml):
                try:
                    found.append(read(_root(text.as_py())) if text.is_valid else None)
                    errors.append(None)
                except expat.ExpatError as error:
                    found.append(None)
                    errors.append(str(error))
            columns = [*portion.columns, pa.array(found, arrow), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*portion.schema.names, "_found", "_error"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)
    struct = ",".join(f.replace(" ", ":", 1) for f in fields.split(", "))
    return records.mapInArrow(run, f"{kinds}, _found struct<{struct}>, _error string")


def _join_nonempty(texts: Column) -> Column:
    return F.array_join(F.filter(texts, lambda t: t != ""), "; ")


def _empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def parse_citations(records: DataFrame, xml: str = "value") -> DataFrame:
    """Citation fragments (one `<PubmedArticle>` element per row) with `_found` and `_error`.

    An id that is no number is an error. Records without citation, id or article have neither and count as skipped.
    """
    parsed = _parsed(records, xml, _citation, _CITATION)
    wrong = F.col("_found.pmid").isNotNull() & F.col("_found.pmid").try_cast("long").isNull()
    return parsed.withColumn("_error", F.when(wrong, F.concat(F.lit("id is no number: "), F.col("_found.pmid"))).otherwise(F.col("_error")))


def citation_rows(records: DataFrame, xml: str = "value") -> DataFrame:
    """Citation fragments as corpus rows; rejected and skipped records are left out. Nested markup counts as its text."""
    return _citation_rows(parse_citations(records, xml), [c for c in records.columns if c != xml])


def _citation_rows(parsed: DataFrame, kept: list[str]) -> DataFrame:
    f = lambda name: F.col(f"_found.{name}")
    parts = F.zip_with(f("labels"), f("bodies"), lambda label, body: F.when(label != "", F.concat(label, F.lit(": "), body)).otherwise(body))
    year = F.coalesce(_empty_to_null(f("year")), _empty_to_null(F.substring(f("medline"), 1, 4)))
    return parsed.where("_found is not null and _error is null").select(
        f("pmid").cast("long").alias("doc_id"),
        *kept,
        year.try_cast("int").alias("year"),
        _empty_to_null(strip(f("title"))).alias("title"),
        _empty_to_null(F.array_join(parts, " ")).alias("abstract"),
        _empty_to_null(_join_nonempty(F.transform(f("keywords"), strip))).alias("author_keywords"),
        _empty_to_null(_join_nonempty(f("mesh"))).alias("mesh_terms"),
    )


def _rejected(parsed: DataFrame, xml: str = "value") -> DataFrame:
    """(record, error and where it was) of what could not be read."""
    return parsed.where("_error is not null").select(F.col(xml).alias("record"), F.col("_error").alias("error"), *ORIGIN)


def _records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """One `<tag>...</tag>` fragment per row. Files are split at the end tag, so that a file of
    any size is shared by tasks; text before the first start tag is cut off."""
    pieces = spark.read.text(path, lineSep=f"</{tag}>").select("value", *origin_columns())
    # The tag must end here: `<PubmedArticleSet>` opens a file and shares the prefix.
    fragment = F.regexp_extract("value", rf"(?s)(<{tag}(?:\s[^>]*)?>.*)$", 1)
    cut = pieces.withColumn("value", fragment).where(F.col("value") != "")
    return cut.withColumn("value", F.concat("value", F.lit(f"</{tag}>")))


def read_citations(spark: SparkSession, path: str) -> DataFrame:
    """Citation XML files as corpus rows, see `citation_rows`."""
    return citation_rows(_records(spark, path, "PubmedArticle"))


def load_citations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of citation XML files, parsed once and stored: corpus rows, and the records that could not be
    read with the error and their place."""
    parsed = durable(parse_citations(_records(spark, path, "PubmedArticle")))
    return _citation_rows(parsed, [c for c in parsed.columns if c not in ("value", "_found", "_error")]), _rejected(parsed)


def _atom_rows(parsed: DataFrame) -> DataFrame:
    found = parsed.where("_found is not null")
    return found.select(
        strip(F.col("_found.title")).alias("title"), strip(F.col("_found.abstract")).alias("abstract"), F.col("_found.year").alias("year"),
        _join_nonempty(F.col("_found.terms")).alias("keywords"), *ORIGIN,
    )


def read_atom_feed(spark: SparkSession, path: str) -> DataFrame:
    """Atom entries: title, abstract, year and category terms (joined by '; '). Entries that can't be read are left out."""
    return _atom_rows(_parsed(_records(spark, path, "entry"), "value", _entry, _ENTRY))


def load_atom_feed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of Atom feeds, parsed once and stored."""
    parsed = durable(_parsed(_records(spark, path, "entry"), "value", _entry, _ENTRY))
    return _atom_rows(parsed), _rejected(parsed)
