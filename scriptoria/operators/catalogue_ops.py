"""Attribute-value metadata, predicates, facets and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_example(row: dict, ignore_case: bool = True) -> Column:
    """Equality on every value that is not None, ignoring case of strings."""
    out = F.lit(True)
    for c, v in row.items():
        if v is not None:
            out &= (F.lower(F.col(c)) == str(v).lower()) if ignore_case and isinstance(v, str) else F.col(c) == v
    return out


def matches(column: Column, text: str, mode: str, match_case: bool = False) -> Column:
    c, t = (column, text) if match_case else (F.lower(column), text.lower())
    return {"exact": c == t, "start": F.startswith(c, F.lit(t)), "end": F.endswith(c, F.lit(t)), "anywhere": c.contains(t)}[mode]


def attribute_rows(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, key_name, value): the columns as attribute-value rows, nulls left out."""
    return rows.unpivot(key, [F.col(c).cast("string").alias(c) for c in columns], "key_name", "value").where("value is not null")


def documents_with(attributes: DataFrame, key: str, name: str, values: list[str]) -> DataFrame:
    return attributes.where((F.col("key_name") == name) & F.col("value").isin(values)).select(key).distinct()


def folded_attributes(attributes: DataFrame, key: str) -> DataFrame:
    """One map of key_name to its sorted values a document."""
    each = attributes.groupBy(key, "key_name").agg(F.array_sort(F.collect_set("value")).alias("values"))
    return each.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key_name", "values")))).alias("metadata"))


def merged(a: Column, b: Column) -> Column:
    """Maps of value lists united key by key; keys that begin with internal: are left out."""
    both = F.map_zip_with(a, b, lambda k, x, y: F.array_union(F.coalesce(x, F.array().cast("array<string>")), F.coalesce(y, F.array().cast("array<string>"))))
    return F.map_filter(both, lambda k, _: ~F.startswith(k, F.lit("internal:")))


def share_value(a: Column, b: Column, name: str) -> Column:
    return F.coalesce(F.arrays_overlap(F.try_element_at(a, F.lit(name)), F.try_element_at(b, F.lit(name))), F.lit(False))


def creators_of_members(attributes: DataFrame, key: str, member: tuple[str, str], creator: str) -> DataFrame:
    """Creators of each member of a collection, joined by commas: a self-join of the attributes."""
    members = attributes.where((F.col("key_name") == member[0]) & (F.col("value") == member[1])).select(key).distinct()
    made = attributes.where(F.col("key_name") == creator).select(key, "value")
    return members.join(made, key).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("value")), ", ").alias("creators"))


def facet_counts(rows: DataFrame, facet: str) -> DataFrame:
    return rows.where(F.col(facet).isNotNull()).groupBy(F.col(facet).alias("value")).agg(F.count("*").alias("n"))


def facet_page(counts: DataFrame, page: int, size: int) -> DataFrame:
    """Page (from 1) of facet values in their order."""
    return counts.orderBy("value").offset((page - 1) * size).limit(size)


def one_of_each(rows: DataFrame, kind: str, key: str, seed: int = 0) -> DataFrame:
    """A row of each kind, drawn by a seeded hash of its key."""
    return rows.groupBy(kind).agg(F.min_by(key, F.struct(F.xxhash64(key, F.lit(seed)), key)).alias(key))


def bar_chart(counts: DataFrame, value: str) -> DataFrame:
    """Whole percentages of the largest value."""
    top = counts.agg(F.max(value).alias("_top"))
    return counts.crossJoin(F.broadcast(top)).withColumn("percent", F.floor(100 * F.col(value) / F.col("_top"))).drop("_top")


def upserted(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """What each key needs: update, insert or delete, with the value to keep."""
    both = old.select(*key, F.col(value).alias("_old")).join(new.select(*key, F.col(value).alias("_new")), key, "full")
    action = F.when(F.col("_new").isNull(), "delete").when(F.col("_old").isNull(), "insert").when(F.col("_old") != F.col("_new"), "update").otherwise("keep")
    return both.select(*key, action.alias("action"), F.col("_new").alias(value))


def added(old: DataFrame, delta: DataFrame, key: list[str], value: str) -> DataFrame:
    return old.select(*key, value).unionByName(delta.select(*key, value)).groupBy(*key).agg(F.sum(value).alias(value))


def last_of_each(rows: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last row of each key; a struct maximum, so it needs no window."""
    return rows.groupBy(*key).agg(F.max(F.struct(*order, *columns)).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in columns))


def missing_names(known: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Names found that are not yet known."""
    return found.select(name).distinct().join(known.select(name), name, "left_anti")


def equal_in_any(rows: DataFrame, key: str, columns: list[str], names: DataFrame, name: str) -> DataFrame:
    """(key, name): rows of which any of the columns equals a name; equi-joined on unpivoted columns."""
    values = rows.unpivot(key, [F.col(c).cast("string").alias(c) for c in columns], "_column", name).where(F.col(name).isNotNull())
    return values.select(key, name).distinct().join(names.select(name).distinct(), name)


def without_match(forms: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct forms that the known table lacks."""
    return forms.select(key).distinct().join(known.select(key), key, "left_anti")


def matching_metadata(attributes: DataFrame, key: str, names: list[str], words: list[str]) -> DataFrame:
    """(key, key_name, value): the first of names, in their order, of which a value has one of the words; case does not count."""
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("key_name"))
    tokens = F.split(F.lower("value"), "[^a-z0-9]+")
    hits = attributes.where((rank > 0) & F.arrays_overlap(tokens, F.array(*(F.lit(w.lower()) for w in words))))
    return hits.groupBy(key).agg(F.min_by(F.struct("key_name", "value"), F.struct(rank, "value")).alias("_m")).select(key, "_m.key_name", "_m.value")


def fits_template(metadata: Column, template: dict[str, str]) -> Column:
    """Whether every key of a template has its value in a map of value lists."""
    out = F.lit(True)
    for k, v in template.items():
        out &= F.coalesce(F.array_contains(F.try_element_at(metadata, F.lit(k)), v), F.lit(False))
    return out


def bags(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, bag, size, n_distinct): how often each key has each value, as sorted (value, n); nulls are left out."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("value")).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("bag"), F.sum("n").alias("size"), F.count("*").alias("n_distinct"))
