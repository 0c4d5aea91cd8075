"""The register of named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """All queries outside the training-data subpackage, and their SQL."""
    from scriptoria import archive, catalogue, files, forms, lexicon, markup_queries  # noqa: F401  they register themselves

    return QUERIES, ORACLES
