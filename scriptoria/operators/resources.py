"""Works and what belongs to them: editions, translations, commentaries, summaries, and passages by reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def editions(works: DataFrame, asked: DataFrame) -> DataFrame:
    """(work, subquery, citation): each asked(work, subquery) in every document of the work; works(doc_id, work)."""
    rows = asked.join(works.select("doc_id", "work"), "work")
    return rows.select("work", "subquery", F.concat_ws(":", "doc_id", F.nullif("subquery", F.lit(""))).alias("citation"))


def siblings(works: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, other): the other documents of the work of each asked(doc_id, work). The asked set is stated, so not all pairs are made."""
    rows = asked.select("doc_id", "work").join(works.select("work", F.col("doc_id").alias("other")), "work")
    return rows.where("doc_id != other").select("doc_id", "other")


def same_passages(passages: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, path, other): for each asked(doc_id, work, path) the citation of the same passage in the work's other documents, of those that have it.

    Rows grow with the documents of a work. Repeated rows of passages or asked repeat their results; null works and paths match nothing.
    """
    rows = asked.select("doc_id", "work", "path").join(passages.select("work", "path", F.col("doc_id").alias("_other")), ["work", "path"])
    return rows.where("doc_id != _other").select("doc_id", "path", F.concat_ws(":", "_other", "path").alias("other"))


def commentary_path(steps: Column, scheme: Column) -> Column:
    """Where a commentary of a scheme such as a:b=c:d speaks of a text's steps (type, value).

    The text's value of each type on the right, as long as there are such, under the types on the
    left. A text that has no card is asked for its line, and the other way round.
    """
    sides = F.split(scheme, "=")
    here, there = F.split(F.get(sides, F.lit(0)), ":"), F.split(F.get(sides, F.lit(1)), ":")
    value = lambda t: F.get(F.filter(steps, lambda s: s["type"] == t), F.lit(0))["value"]
    told = F.transform(there, lambda t: F.coalesce(value(t), F.when(t == "card", value(F.lit("line"))).when(t == "line", value(F.lit("card")))))
    n = F.least(F.size(here), F.coalesce(F.array_position(F.transform(told, lambda v: v.isNull()), True) - 1, F.size(told)))
    n = F.when(F.exists(told, lambda v: v.isNull()), n).otherwise(F.least(F.size(here), F.size(told))).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.when(n > 0, F.concat_ws("=", F.get(here, k - 1), F.get(told, k - 1))).otherwise("")), ":")


def ancestors(path: Column) -> Column:
    """A path and all it lies in, the longest first; the last is empty."""
    steps = F.split(path, ":")
    return F.transform(F.sequence(F.size(steps), F.lit(0)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), ":"))


def nearest(asked: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """asked(*key, path) with found: the longest ancestor of path that known(*key, path) has; null without any.

    asked is read once: what is repeated in it is counted and given as often again.
    """
    tried = asked.select(*key, "path", F.posexplode_outer(ancestors(F.col("path"))).alias("_k", "_tried")).withColumn("_k", F.coalesce("_k", F.lit(0)))
    held = known.select(*key, F.col("path").alias("_tried")).distinct().withColumn("_held", F.lit(True))
    hits = tried.join(held, [*key, "_tried"], "left").where("_held or _k = 0")
    found = hits.groupBy(*key, "path").agg(F.min(F.when(F.col("_held"), F.struct("_k", "_tried")))["_tried"].alias("found"), F.count_if(F.col("_k") == 0).cast("int").alias("_n"))
    return found.select(*key, "path", F.explode(F.array_repeat("found", F.col("_n"))).alias("found"))


def references(chunks: DataFrame, kind: str) -> DataFrame:
    """(doc_id, path, nth, previous, next, first, n_references, start_offset, end_offset) of a text's sections of one type."""
    whole = Window.partitionBy("doc_id")
    w = whole.orderBy("start_offset", "n")
    rows = chunks.where(F.col("type") == kind).withColumn("nth", F.row_number().over(w)).withColumn("previous", F.lag("path").over(w)).withColumn("next", F.lead("path").over(w))
    rows = rows.withColumn("first", F.first("path").over(w)).withColumn("n_references", F.count("*").over(whole))
    return rows.select("doc_id", "path", "nth", "previous", "next", "first", "n_references", "start_offset", "end_offset")


def passages(refs: DataFrame, docs: DataFrame) -> DataFrame:
    """refs with passage: the text between a reference's offsets. A text meets its references once, and is not copied to each of them."""
    rest = [c for c in refs.columns if c != "doc_id"]
    of_text = refs.groupBy("doc_id").agg(F.collect_list(F.struct(*rest)).alias("refs"))
    part = lambda r: F.substring(F.col("text"), r["start_offset"] + 1, r["end_offset"] - r["start_offset"])
    told = F.transform("refs", lambda r: F.struct(*(r[c].alias(c) for c in rest), part(r).alias("passage")))
    return of_text.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", F.inline(told))


def references_within(sections: Column, kind: str) -> Column:
    """references() of a text's sections, an array in the order of their starts, in the same order."""
    refs = F.filter(sections, lambda s: s["type"] == kind)
    path = lambda k: F.get(refs, k)["path"]
    return F.transform(refs, lambda r, k: F.struct(r["path"].alias("path"), (k + 1).alias("nth"), path(k - 1).alias("previous"), path(k + 1).alias("next"), path(F.lit(0)).alias("first"), F.size(refs).cast("long").alias("n_references"), r["start_offset"].alias("start_offset"), r["end_offset"].alias("end_offset")))


def passages_within(texts: DataFrame) -> DataFrame:
    """passages() of texts(doc_id, text, refs), one row for each text with its references."""
    part = lambda r: F.substring(F.col("text"), (r["start_offset"] + 1).cast("int"), (r["end_offset"] - r["start_offset"]).cast("int"))
    # exploded, so that each reference is made once and not again for each of its fields
    rows = texts.select("doc_id", "text", F.inline(F.array(F.struct("refs"))))
    return rows.select("doc_id", F.inline(F.transform("refs", lambda r: F.struct(r.alias("ref"), part(r).alias("passage"))))).select("doc_id", "ref.*", "passage")
