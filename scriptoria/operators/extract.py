"""Extraction from markup and text: links as citations, headers, entities, their graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions.text import without_tags, xml_unescaped

# Kinds of citation link and their codes.
LINK_TYPES = {"unknown": 0, "index": 1, "specific lexicon": 2, "lexicon": 3, "commentary": 4, "text": 5, "translation": 6}


def links(pages: DataFrame) -> DataFrame:
    """(page_id, n, target, caption): anchors in order."""
    tag = r'<a href="([^"]*)">([^<]*)</a>'
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(tag), F.lit(1)).alias("target"), F.regexp_extract_all("html", F.lit(tag), F.lit(2)).alias("caption"))
    return pages.select("page_id", F.posexplode(both).alias("k", "l")).select("page_id", (F.col("k") + 1).alias("n"), "l.target", xml_unescaped(F.col("l.caption")).alias("caption"))


def header(pages: DataFrame) -> DataFrame:
    """Language, title and plain text length of each page."""
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    body = F.regexp_replace(F.regexp_replace("html", r"(?s)<script>.*?</script>", ""), r"(?s)<style>.*?</style>", "")
    return pages.select("page_id", F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"), xml_unescaped(title).alias("title"), F.length(without_tags(body)).alias("text_length"))


def resolved(edges: DataFrame, works: DataFrame) -> DataFrame:
    """Edges (source, target) with the document a target stands for; unresolved targets stay as they are."""
    return edges.join(works.select(F.col("name").alias("target"), F.col("id").alias("_id")), "target", "left").withColumn("destination", F.coalesce("_id", "target")).drop("_id")


def degrees(edges: DataFrame) -> DataFrame:
    """Incoming and outgoing distinct edges of each node."""
    e = edges.select("source", "destination").distinct()
    out = e.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("n_out"), F.lit(0).cast("long").alias("n_in"))
    into = e.groupBy(F.col("destination").alias("node")).agg(F.lit(0).cast("long").alias("n_out"), F.count("*").alias("n_in"))
    return out.unionByName(into).groupBy("node").agg(F.sum("n_out").alias("n_out"), F.sum("n_in").alias("n_in"))


def link_type(kind) -> "F.Column":
    pairs = [F.lit(x) for kv in LINK_TYPES.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), kind), F.lit(0))


def entity_counts(tokens: DataFrame, unit: list[str]) -> DataFrame:
    """Capitalised words inside a line as names: count, first position and up to three mentions."""
    names = tokens.where(F.rlike("form", F.lit("^[A-Z][a-z]{3,}$")) & (F.col("i") > 1))
    return names.groupBy(*unit, F.col("form").alias("entity")).agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def citations(edges: DataFrame, source: list | None = None, target: list | None = None, kind: str | None = None) -> DataFrame:
    """Distinct edges(source, target, kind) that agree with what is given; nothing given is all of them."""
    out = edges.select("source", "target", "kind").distinct()
    for c, wanted in (("source", source), ("target", target), ("kind", None if kind is None else [kind])):
        if wanted is not None:
            out = out.where(F.col(c).isin(wanted))
    return out


def ordered_citations(edges: DataFrame) -> DataFrame:
    """edges with place: the order of each source's destinations."""
    return edges.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy("target", "kind")))
