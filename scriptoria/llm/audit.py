"""Audit of document filters: what each one removes, alone and in every order of all of them.

Documents become cells (part, mask of the filters that they fail) with counts. Each cell is
unpivoted against the steps of every order; a running bit-or over the steps before tells whether
an earlier filter has removed the cell's documents. Conditional sums give each step's figures and
a window over a filter's steps the sum of what it removes. Column functions only.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.llm.common import dropped, saved

#: Bounds of the five filters of text_failures.
WORDS, DISTINCT, CAPITALS = 200, 50, 2


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides: A few words, B few distinct ones, C many capitals, D odd symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < WORDS,
        "B": 100 * distinct < DISTINCT * n,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > CAPITALS * F.length(text),
        "D": F.rlike(text, F.lit(r"[#$%&*|]")),
    }


def failed_cells(docs: DataFrame, labels: DataFrame, part: str = "source", copies: str = "E") -> tuple[DataFrame, str]:
    """(part, mask, n, good, toxic) of docs(doc_id, text, part), and the filters' letters; bit k of mask is letter k.

    The last filter, named copies, fails what is identical to the text of any smaller doc_id. Copies
    are found by the SHA-256 digests of texts: the smallest id of each is found by a partial
    aggregation, then joined on (digest, id), so that no group of copies meets in one task. Rows that
    repeat an id and a text, and those with a null id, fail it only through smaller ids. A null text
    is an empty one, a null part an empty string; labels that repeat an id count as good or
    toxic if any does.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    tests = text_failures(F.col("text"))
    mask = F.lit(0)
    for k, test in enumerate(tests.values()):
        mask = mask.bitwiseOR(F.when(test, 1 << k).otherwise(0))
    each = rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    each = saved(each.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")), "masks")
    first = each.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    found = each.join(first, ["digest", "doc_id"], "left")
    again = F.col("first").isNull() & F.col("doc_id").isNotNull()
    found = found.withColumn("mask", F.col("mask").bitwiseOR(F.when(again, 1 << len(tests)).otherwise(0))).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null")
    told = told.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    count = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c)
    cells = found.join(told, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), count("good"), count("toxic"))
    cells = saved(cells, "cells")
    dropped(each)
    return cells, "".join(tests) + copies


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of cells(part, mask, n, good, toxic).

    One row for each part, order of the filters and step (from 1), zeros included. A part has at most
    2 ** len(letters) cells, whatever its documents, so that a hot part is no large group.
    removed and redundant are what fails the step's filter and is still there or already gone, unique_fails what fails
    only that one, shapley the filter's removed summed over all orders and steps. No cells, no rows.
    """
    if len(set(letters)) != len(letters):
        raise ValueError(f"filters need a letter each: {letters}")
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(letters))), ",")
    steps = cells.select("*", F.explode(orders).alias("filter_order")).select("*", F.posexplode(F.split("filter_order", "")).alias("at", "filter")).where("filter != ''")
    steps = steps.withColumn("step", F.col("at") + 1).withColumn("bit", F.expr(f"shiftleft(1, instr('{letters}', filter) - 1)"))
    before = Window.partitionBy("part", "filter_order", "mask").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("gone", F.coalesce(F.bit_or("bit").over(before), F.lit(0)).bitwiseAND(F.col("mask")) != 0).withColumn("fails", F.col("mask").bitwiseAND(F.col("bit")) != 0)
    lost = F.col("fails") & ~F.col("gone")

    def total(condition: Column, of: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(of))), F.lit(0)).cast("long")

    figures = steps.groupBy("part", "filter_order", "step", "filter").agg(
        total(~F.col("fails") & ~F.col("gone")).alias("kept"),
        total(lost).alias("removed"),
        total(F.col("fails") & F.col("gone")).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(lost, "good").alias("good_lost"),
        total(lost, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley")
    return figures.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley)


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interactions() of the five text filters over the whole table of documents, by source."""
    return interactions(*failed_cells(docs, labels))
