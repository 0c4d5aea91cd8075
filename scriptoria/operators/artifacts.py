"""Artifacts, their images, keywords and facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The facets that each kind of artifact may be browsed by, and names that stand for a facet.
FACETS = {
    "Building": ["Architect", "Building Type", "Context", "Period", "Region"],
    "Coin": ["Collection", "Context", "Denomination", "Issuing Authority", "Material", "Period", "Region", "Keyword"],
    "Gem": ["Collection", "Material", "Sculpture Type", "Style"],
    "Sculpture": ["Associated Building", "Category", "Collection", "Context", "Material", "Object Function", "Period", "Region", "Scale", "Sculptor", "Sculpture Type", "Keyword"],
    "Site": ["Region", "Site Type"],
    "Vase": ["Collection", "Context", "Painter", "Period", "Potter", "Region", "Shape", "Ware", "Keyword"],
}
ALIASES = {"function": "Object Function", "gem type": "Sculpture Type", "mint": "Context", "site": "Context"}


def facet_name(field: Column, kind: Column) -> Column:
    """The facet that a field stands for: underscores are spaces, Type and Class are of the artifact's kind; a Site has no Period."""
    name = F.replace(field, F.lit("_"), F.lit(" "))
    low = F.lower(name)
    alias = F.try_element_at(F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair)), low)
    out = F.coalesce(alias, F.when(low.isin("type", "class"), F.concat(kind, F.lit(" Type"))), name)
    return F.when(~((F.lower(kind) == "site") & low.isin("period", "periods")), out)


def is_facet(name: Column, kind: Column) -> Column:
    """Whether artifacts of a kind may be browsed by a facet; false of unknown kinds and null names."""
    allowed = F.try_element_at(F.create_map(*(x for k, v in FACETS.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), kind)
    return F.coalesce(F.array_contains(allowed, name), F.lit(False))


def filled(rows: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """How many rows have each column neither null nor empty, by group: columns named n_<column>."""
    there = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return rows.groupBy(*by).agg(*(F.count_if(there(c)).alias(f"n_{c}") for c in columns))


def named_images(artifacts: DataFrame, images: DataFrame, name: str, columns: list[str], key: str) -> DataFrame:
    """(name, key): images of which any of the name columns is an artifact's name; one row however many columns agree."""
    names = images.unpivot(key, [F.col(c).cast("string").alias(c) for c in columns], "_column", name).where(F.col(name).isNotNull())
    return artifacts.select(name).distinct().join(names.select(name, key).distinct(), name)


def first_images(occurrences: DataFrame, artifact: str, order: list[str], most: int) -> DataFrame:
    """The first most images of each artifact in an order that tells them apart, with nth."""
    w = Window.partitionBy(artifact).orderBy(*order)
    return occurrences.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most)


def keyworded(artifacts: DataFrame, keywords: DataFrame, on: list[str]) -> DataFrame:
    """keywords with the artifact that they name; those that name none are left out."""
    return keywords.join(artifacts, on)


def index(rows: DataFrame, key: str, columns: dict[str, list[str]], kind: str) -> DataFrame:
    """(key, kind, contents): what a search of artifacts reads, the columns of the row's kind line by line; other kinds have all columns."""
    every = sorted({c for cs in columns.values() for c in cs})
    lines = lambda cs: F.concat_ws("\n", *(F.col(c).cast("string") for c in cs))
    contents = lines(every)
    for k, cs in columns.items():
        contents = F.when(F.col(kind) == k, lines(cs)).otherwise(contents)
    return rows.select(key, kind, F.lower(contents).alias("contents"))


def found(contents: DataFrame, words: list[str]) -> DataFrame:
    """Rows of index() that hold every word."""
    out = contents
    for w in words:
        out = out.where(F.col("contents").contains(w.lower()))
    return out


def image_page(ids: DataFrame, key: str, page: int, size: int = 20) -> DataFrame:
    """(key, pages): a page (from 1) of the images in the order of their ids, and how many pages there are."""
    pages = -(-ids.count() // size)
    return ids.select(key).orderBy(key).offset((page - 1) * size).limit(size).withColumn("pages", F.lit(pages).cast("long"))
