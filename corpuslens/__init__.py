"""Topic analytics over document corpora, written as Spark DataFrame operators."""

from corpuslens.schema import CORPUS_SCHEMA, OUTLIER
from corpuslens.session import build_session, durable

__all__ = ["CORPUS_SCHEMA", "OUTLIER", "build_session", "durable"]
