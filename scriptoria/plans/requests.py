"""Whole requests: a vocabulary list and a paged search, composed of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.operators.frequency import coverage
from scriptoria.operators.index import Index, matches
from scriptoria.operators.search import paged_by_document
from scriptoria.sources.tables import tokens


def vocabulary_list(docs: DataFrame, share: float = 0.5, by: str = "lang") -> DataFrame:
    """The words that cover share of each language's running words, the most frequent first."""
    counts = tokens(docs).groupBy(by, "word").agg(F.count("*").alias("n"))
    return coverage(counts, share, [by], "n", "word").select(by, "word", "n", "place")


def corpus_search(index: Index, required=(), allowed=(), excluded=(), phrase=(), page: int = 1, size: int = 10, sources: list[str] | None = None) -> DataFrame:
    """Lines that match, a page of documents at a time, in document order, from a stored index."""
    hits = matches(index, ["source", "doc_id", "line"], list(required), list(allowed), list(excluded), [list(phrase)] if phrase else [])
    hits = (hits if sources is None else hits.where(F.col("source").isin(sources))).select("doc_id", "line").distinct()
    return paged_by_document(hits, page, size, ["line"])
