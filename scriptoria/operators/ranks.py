"""Places and runs in an order within groups of any size.

Rows are dealt by ranges of the order, so a group that holds a third of all rows is spread over
many tasks; what leaves a range is one row for each group in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.sources.tables import kept, small


def ranged(rows: DataFrame, by: list[str], order: list[Column], ranges: int | None = None) -> DataFrame:
    """rows with _range: the number of the range of (by, order) that each is in, written, so that a lost task finds the same ranges again."""
    keys = [*map(F.col, by), *order]
    dealt = rows.repartitionByRange(ranges, *keys) if ranges else rows.repartitionByRange(*keys)
    return kept(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def _same(columns: list[str], prefix: str) -> Column:
    """Each of the columns is equal to the one of its number under a prefix; nulls are equal."""
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{prefix}{k}")) for k, c in enumerate(columns)))


def _joined(rows: DataFrame, heads: DataFrame, by: list[str]) -> DataFrame:
    """rows with the columns of heads, one row a range and group; null groups are groups."""
    fields = ["_range", *by]
    heads = heads.withColumnsRenamed({c: f"_g{k}" for k, c in enumerate(fields)})
    return rows.join(heads, _same(fields, "_g")).drop("_range", *(f"_g{k}" for k in range(len(fields))))


def _earlier(by: list[str], *columns: Column) -> Column:
    """The sum over the ranges before of the same group."""
    w = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(sum(columns[1:], columns[0])).over(w), F.lit(0))


def placed(rows: DataFrame, by: list[str], order: list[Column], name: str = "place", ranges: int | None = None) -> DataFrame:
    """rows with name: the place of each, from 1, in an order within its group.

    Rows that the order does not tell apart have neighbouring places in any order. Null groups are
    groups, null keys stand where the order puts them; without rows there are none.
    """
    dealt = ranged(rows, by, order, ranges)
    sizes = dealt.groupBy("_range", *by).agg(F.count("*").alias("_n")).withColumn("_before", _earlier(by, F.col("_n"))).drop("_n")
    inner = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("_range", *by).orderBy(*order)))
    return _joined(inner, sizes, by).withColumn(name, F.col("_before") + F.col("_k")).drop("_before", "_k")


def runs(rows: DataFrame, by: list[str], order: list[Column], key: str, ranges: int | None = None) -> DataFrame:
    """rows with run: the number, from 1, of the run of equal keys that each is in, in an order within its group; a null key is a run of its own."""
    dealt = ranged(rows, by, order, ranges)
    inner = Window.partitionBy("_range", *by).orderBy(*order)
    change = F.coalesce(F.lag(key).over(inner) != F.col(key), F.lit(True)).cast("long")
    marked = dealt.withColumn("_k", F.row_number().over(inner)).withColumn("_c", F.when(F.col("_k") > 1, change).otherwise(0))
    heads = marked.groupBy("_range", *by).agg(F.sum("_c").alias("_n"), F.min_by(key, "_k").alias("_first"), F.max_by(key, "_k").alias("_last"))
    last = F.lag("_last").over(Window.partitionBy(*by).orderBy("_range"))
    heads = heads.withColumn("_new", F.coalesce(last != F.col("_first"), F.lit(True)).cast("long"))
    heads = heads.withColumn("_before", _earlier(by, F.col("_n"), F.col("_new")) + F.col("_new")).drop("_n", "_first", "_last", "_new")
    so_far = F.sum("_c").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return _joined(marked.withColumn("_s", so_far), heads, by).withColumn("run", F.col("_before") + F.col("_s")).drop("_k", "_c", "_s", "_before")


def heads_of_orders(rows: DataFrame, by: list[str], orders: dict[str, list[Column]], key: str, most: int) -> DataFrame:
    """(*by, key, one place for each order): the rows among the first most of their group in any order; key tells a group's rows apart.

    All places are those in the whole group. The heads come from limited windows, of which each task ships most rows
    a group; only they, most for each group and order, meet the places.
    """
    rows, fields = kept(rows, "ordered"), [*by, key]
    firsts = []
    for order in orders.values():
        k = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        firsts.append(rows.withColumn("_k", k).where(F.col("_k") <= most).select(*fields))
    heads = kept(reduce(DataFrame.unionByName, firsts).distinct(), "heads")
    wanted = small(heads.select(*(F.col(c).alias(f"_h{k}") for k, c in enumerate(fields))))
    out = heads
    for name, order in orders.items():
        places = placed(rows, by, order, name).join(wanted, _same(fields, "_h"), "left_semi")
        out = out.join(places.select(name, *(F.col(c).alias(f"_j{k}") for k, c in enumerate(fields))), _same(fields, "_j")).drop(*(f"_j{k}" for k in range(len(fields))))
    return out
