"""Nested text sections: containment, overlap, adjacency, tables of contents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from scriptoria.operators.ranks import placed

#: Characters of a bucket in range joins.
BUCKET = 2048


def bucketed_range_join(outer: DataFrame, inner: DataFrame, key: str, condition: Column, bucket: int = BUCKET) -> DataFrame:
    """Pairs o, i of equal key whose spans meet and that meet condition.

    Both have start_offset and end_offset. Spans are dealt to buckets, so the join is an equi-join on
    (key, bucket) whatever the length of a document; a pair is kept in the bucket where the
    later of its two starts lies, hence once.
    """

    def dealt(rows: DataFrame, alias: str) -> DataFrame:
        spans = F.sequence(F.floor(F.col("start_offset") / bucket), F.floor(F.greatest("start_offset", "end_offset") / bucket))
        return rows.withColumn("_bucket", F.explode(spans)).withColumn("_key", F.col(key)).alias(alias)

    both = dealt(outer, "o").join(dealt(inner, "i"), ["_key", "_bucket"])
    first = F.col("_bucket") == F.floor(F.greatest("o.start_offset", "i.start_offset") / bucket)
    return both.where(first & condition)


def contains() -> Column:
    """The inner span starts within the outer one."""
    return F.col("i.start_offset").between(F.col("o.start_offset"), F.col("o.end_offset"))


def _dealt(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of lists, the row of each and where each row begins; null lists are empty."""
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])


def _meeting(begins: pa.Array, ends: pa.Array, starts: pa.Array) -> tuple[np.ndarray, ...]:
    """For each span the first of its row's starts within it and their number; with where rows begin among spans and among starts."""
    (low, row, outer), (high, _, _), (at, of, inner) = _dealt(begins), _dealt(ends), _dealt(starts)
    width = max((int(x.max()) for x in (low, high, at) if len(x)), default=0) + 1
    places = of * width + at
    first = np.searchsorted(places, row * width + low, "left")
    return first, np.maximum(np.searchsorted(places, row * width + high, "right") - first, 0), row, outer, inner


@F.arrow_udf(ArrayType(StructType([StructField("first", IntegerType()), StructField("n", IntegerType())])))
def starts_within(begins: pa.Array, ends: pa.Array, starts: pa.Array) -> pa.Array:
    """contains() within a row: for each span, in the order of begins and ends, the index of the first of starts within it, and how many they are. starts ascend; all are arrays of longs without nulls."""
    first, n, row, outer, inner = _meeting(begins, ends, starts)
    runs = [pa.array(first - inner[row], pa.int32()), pa.array(n, pa.int32())]
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pa.StructArray.from_arrays(runs, ["first", "n"]))


@F.arrow_udf(ArrayType(ArrayType(IntegerType())))
def spans_around(begins: pa.Array, ends: pa.Array, starts: pa.Array) -> pa.Array:
    """contains() within a row, the other way round: for each of starts the indices of the spans that it is within, which grows with the pairs."""
    first, n, row, outer, inner = _meeting(begins, ends, starts)
    span, start = np.repeat(np.arange(len(n)), n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    order = np.argsort(start, kind="stable")
    each = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=inner[-1]))])
    held = pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.array((span - outer[row[span]])[order], pa.int32()))
    return pa.ListArray.from_arrays(pa.array(inner, pa.int32()), held)


def strictly_contains() -> Column:
    same = (F.col("o.start_offset") == F.col("i.start_offset")) & (F.col("o.end_offset") == F.col("i.end_offset"))
    return (F.col("o.start_offset") <= F.col("i.start_offset")) & (F.col("o.end_offset") >= F.col("i.end_offset")) & ~same


def overlaps() -> Column:
    return (F.col("o.start_offset") < F.col("i.end_offset")) & (F.col("o.end_offset") > F.col("i.start_offset"))


def nearest_container(outer: DataFrame, inner: DataFrame, key: str, ids: tuple[str, str]) -> DataFrame:
    """For each inner section the containing outer one that starts last; ids are their id columns."""
    hit = (F.col("o.start_offset") <= F.col("i.start_offset")) & (F.col("o.end_offset") >= F.col("i.end_offset"))
    pairs = bucketed_range_join(outer, inner, key, hit).select(F.col(f"i.{key}").alias(key), F.col(f"i.{ids[1]}").alias(ids[1]), F.col(f"o.{ids[0]}").alias(ids[0]), F.col("o.start_offset").alias("_s"))
    return pairs.groupBy(key, ids[1]).agg(F.max_by(ids[0], F.struct("_s", ids[0])).alias(ids[0]))


def predecessor(values: DataFrame, lookups: DataFrame, key: str, value: str, lookup: str) -> DataFrame:
    """For each lookup the largest value not above it, else the smallest value of its key.

    As of: both sides are one sorted stream for each key, so no pairs are made.
    """
    both = values.select(key, F.col(value).alias("_v"), F.lit(None).cast("long").alias(lookup)).unionByName(lookups.select(key, F.col(lookup).alias("_v"), F.col(lookup).cast("long").alias(lookup)))
    w = Window.partitionBy(key)
    last = F.last(F.when(F.col(lookup).isNull(), F.col("_v")), ignorenulls=True).over(w.orderBy("_v", F.col(lookup).isNotNull()).rowsBetween(Window.unboundedPreceding, 0))
    least = F.min(F.when(F.col(lookup).isNull(), F.col("_v"))).over(w)
    return both.withColumn("found", F.coalesce(last, least)).where(F.col(lookup).isNotNull()).select(key, lookup, "found")


def numeric_order(value: Column) -> list[Column]:
    """Sort keys that put whole numbers in numeric order before other values."""
    number = value.try_cast("int")
    return [number.isNull(), number, value]


def neighbours(chunks: DataFrame, by: list[str], order: str, key: str) -> DataFrame:
    """Next and previous section of the same kind."""
    w = Window.partitionBy(*by).orderBy(order)
    return chunks.withColumn("previous", F.lag(key).over(w)).withColumn("next", F.lead(key).over(w)).withColumn("nth", F.row_number().over(w))


def first_in(chunks: DataFrame, parent: list[str], order: str, key: str) -> DataFrame:
    return chunks.groupBy(*parent).agg(F.min_by(key, order).alias("first"), F.count("*").alias("n_children"))


def document_order(chunks: DataFrame) -> DataFrame:
    """Position of sections with parents before children: start ascending, end descending."""
    return chunks.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("start_offset", F.desc("end_offset"), "chunk_type", "value")))


def contents(levels: list[DataFrame], key: str) -> DataFrame:
    """Edges (key, parent, child, depth) of adjacent levels: each child under the first parent that ends at or after its start."""
    edges = None
    for depth, (outer, inner) in enumerate(zip(levels, levels[1:])):
        hit = (F.col("o.end_offset") >= F.col("i.start_offset")) & (F.col("o.start_offset") <= F.col("i.start_offset"))
        pairs = bucketed_range_join(outer, inner, key, hit).select(F.col(f"i.{key}").alias(key), F.col("i.id").alias("child"), F.col("o.id").alias("parent"), F.col("o.start_offset").alias("_s"))
        part = pairs.groupBy(key, "child").agg(F.min_by("parent", F.struct("_s", "parent")).alias("parent")).withColumn("depth", F.lit(depth))
        edges = part if edges is None else edges.unionByName(part)
    return edges


def grouped_entries(entries: DataFrame, by: str, head: str, size: int = 50) -> DataFrame:
    """Entries in groups of size for each letter, headed first - last; a letter of any size is spread over tasks."""
    rows = placed(entries, [by], [F.col(head)], "_place").withColumn("group_no", F.floor((F.col("_place") - 1) / size))
    return rows.groupBy(by, "group_no").agg(F.concat_ws(" - ", F.min(head), F.max(head)).alias("heading"), F.count("*").alias("n_entries"))


def accepted_notes(notes: DataFrame, key: str) -> DataFrame:
    """Notes of (start, end) that no earlier accepted note overlaps; a fold over each document's sorted notes."""
    sorted_notes = F.array_sort(F.collect_list(F.struct("start", "end")))
    zero = F.struct(F.lit(-1).alias("last"), F.array().cast("array<struct<start:int,end:int>>").alias("kept"))
    fold = F.aggregate(
        sorted_notes,
        zero,
        lambda acc, n: F.when(n["start"] > acc["last"], F.struct(n["end"].cast("int").alias("last"), F.concat(acc["kept"], F.array(F.struct(n["start"].cast("int").alias("start"), n["end"].cast("int").alias("end")))).alias("kept"))).otherwise(acc),
    )
    return notes.groupBy(key).agg(fold["kept"].alias("kept")).select(key, F.explode("kept").alias("n")).select(key, "n.start", "n.end")
