"""Places, persons and dates marked in texts: occurrences, frequencies, search and snippets."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from scriptoria.functions import dates as D
from scriptoria.functions.text import bound, join_present, without_tags
from scriptoria.operators.structure import spans_around
from scriptoria.sources.tables import small

#: Entries of a gazetteer that is sent to all tasks, at most; with more, places are shuffled to meet theirs.
FEW = 200_000
#: A marked name or date with all that it holds, any other tag, or what only begins like one.
_MENTION = re.compile(r"<(?:(placeName|persName|dateStruct|date|name)\b[^>]*>.*?</\1>|[^>]*>|)", re.ASCII | re.DOTALL)
_NAME = re.compile(r"<([A-Za-z][\w.:-]*)", re.ASCII)
_TAGS = re.compile(r"<[^>]+>")
#: What is read of each element: attributes, and the parts of a dateStruct.
_READ = {"placeName": ["key", "n", "reg"], "name": ["key", "n", "reg"], "persName": ["reg"], "date": ["value"], "dateStruct": ["value", "year", "month", "day"], "dateRange": ["from", "to"]}
_ATTRIBUTES = {name: re.compile(rf'<[^>]*?\s{name}="([^"]*)"', re.ASCII) for name in ("type", "key", "n", "reg", "value", "from", "to")}
_PARTS = {name: re.compile(rf"<{name}[^>]*>\s*(\d+)\s*</{name}>", re.ASCII) for name in ("year", "month", "day")}
_FIELDS = ["key", "n", "reg", "value", "from", "to", "year", "month", "day"]


def _said(raw: str, field: str) -> str | None:
    found = _PARTS[field].search(raw) if field in _PARTS else f'{field}="' in raw and _ATTRIBUTES[field].match(raw)
    return found[1] or None if found else None


@F.arrow_udf(ArrayType(StructType([StructField("k", IntegerType()), *(StructField(c, LongType()) for c in ("start_offset", "end_offset")), *(StructField(c, StringType()) for c in ("name", "display_text", *_FIELDS))])))
def _marked(texts: pa.Array) -> pa.Array:
    """The mentions of each text, as mentions() describes, by one walk along it."""
    rows, offsets = [], [0]
    for text in texts:
        k = 0
        for m in _MENTION.finditer(text.as_py()):
            raw = m[0]
            named = _NAME.match(raw)
            name = named and named[1]
            if name in _READ and (name != "name" or _said(raw, "type") == "place"):
                k, read = k + 1, _READ[name]
                rows.append((k, m.start(), m.end(), name, _TAGS.sub("", raw), *(_said(raw, c) if c in read else None for c in _FIELDS)))
        offsets.append(len(rows))
    columns = zip(*rows) if rows else [()] * (5 + len(_FIELDS))
    told = [pa.array(c, pa.int32() if k == 0 else pa.int64() if k < 3 else pa.string()) for k, c in enumerate(columns)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(told, ["k", "start_offset", "end_offset", "name", "display_text", *_FIELDS]))


def mentions(docs: DataFrame, spans: str | None = None) -> DataFrame:
    """(doc_id, k, start_offset, end_offset, name, display_text, ...): marked names and dates of docs(doc_id, text), k from 1, with the attributes and parts in _FIELDS that are read of them.

    A mention within another belongs to it. Offsets are of the whole element. With spans, a column of docs that holds an array of spans
    (start_offset, end_offset and more), within is the array of those in which a mention starts. No shuffle.
    """
    keep = ["doc_id"] if spans is None else ["doc_id", F.col(spans).alias("_spans")]
    # exploded, so that what follows reads the mentions found and does not find them again
    rows = docs.where("text is not null").select(*keep, F.posexplode(F.array(_marked("text"))).alias("_once", "marks"))
    if spans is None:
        return rows.select("doc_id", F.inline("marks"))
    long = lambda c: F.col(c).cast("array<bigint>")
    rows = rows.withColumn("around", spans_around(long("_spans.start_offset"), long("_spans.end_offset"), long("marks.start_offset")))
    held = F.transform("around", lambda ks: F.transform(ks, lambda k: F.get("_spans", k)))
    return rows.select("doc_id", F.inline(F.arrays_zip(F.col("marks").alias("mark"), held.alias("within")))).select("doc_id", "mark.*", "within")


def _asked(text: Column) -> Column:
    """What a place may be known by, the first that is known counts: its key, else n, reg or text."""
    tries = [("auth", F.split_part("key", F.lit(";"), F.lit(1))), ("display", F.col("n")), ("display", F.col("reg")), ("display", F.nullif(text, F.lit("")))]
    return F.filter(F.array(*(F.struct(F.lit(k).alias("step"), F.lit(kind).alias("kind"), v.alias("asked")) for k, (kind, v) in enumerate(tries))), lambda t: t["asked"].isNotNull())


def _names(reg: Column) -> Column:
    """Surname, then forenames, of a registered form kind:surname,forename,...; null without one. nomatch and empty forenames are left out."""
    names = F.split(F.regexp_extract(reg, r"^.*?:([^:]*)(?::.*)?$", 1), ",")
    return F.when(reg.contains(":"), bound(names, lambda n: F.concat(F.slice(n, F.lit(1), F.lit(1)), F.filter(F.transform(F.slice(n, F.lit(2), F.size(n)), lambda x: F.trim(x)), lambda x: (x != "") & (x != "nomatch")))))


def _gazetteer(gazetteer: DataFrame) -> DataFrame:
    """(kind, asked, place_auth, place_display); of entries with one display name the least counts."""
    known = gazetteer.select(F.lit("auth").alias("kind"), F.col("auth_name").alias("asked"), F.col("auth_name").alias("place_auth"), F.col("display_name").alias("place_display"))
    return known.unionByName(gazetteer.groupBy("display_name").agg(F.min("auth_name").alias("place_auth")).select(F.lit("display").alias("kind"), F.col("display_name").alias("asked"), "place_auth", F.col("display_name").alias("place_display")))


def occurrences(docs: DataFrame, gazetteer: DataFrame, spans: str | None = None) -> DataFrame:
    """All entity occurrences of docs(doc_id, text), by gazetteer(auth_name, display_name); each text is read once for all classes. With spans they have within, as mentions() describes.

    A place of which the gazetteer knows nothing is no entity; it is ambiguous unless its text has a bracket
    or comma. A person without a registered form is none; it is ambiguous if its text has no more words than
    the person has names. Dates are by value, else text or parts, ranges by their ends; unreadable ones
    are left out and none is ambiguous.
    """
    text, name = F.col("display_text"), F.col("name")
    place, person, dated, span = name.isin("placeName", "name"), name == "persName", name.isin("date", "dateStruct", "dateRange"), name == "dateRange"
    value = F.coalesce("value", F.when(name == "date", text))
    parts = F.when(name == "dateStruct", F.struct(*(F.col(c).try_cast("int").alias(c) for c in ("year", "month", "day"))))
    single = F.coalesce(D.free_date(value), F.when(F.coalesce(*(F.col(c).try_cast("int") for c in ("year", "month", "day"))).isNotNull(), parts))
    date = F.when(span, F.concat(bound(D.free_date(F.col("from")), D.authority_date), F.lit("/"), bound(D.free_date(F.col("to")), D.authority_date))).otherwise(bound(single, D.authority_date))

    def named(names: Column) -> Column:
        surname = F.get(names, F.lit(0))
        return bound(F.array_join(F.slice(names, F.lit(2), F.size(names)), " "), lambda forename: F.struct(F.lower(join_present(",", surname, F.replace(forename, F.lit(" "), F.lit(",")))).alias("auth"), join_present(" ", forename, surname).alias("display"), F.size(names).alias("n")))

    of = F.when(person, bound(_names(F.col("reg")), lambda n: F.when(n.isNotNull(), named(n)))).when(dated, bound(date, lambda d: F.when(d.isNotNull(), F.struct(d.alias("auth"), d.alias("display"), F.lit(0).alias("n")))))
    read = F.struct(of.alias("_of"), F.when(place, _asked(text)).alias("_asked"))
    beside = [] if spans is None else ["within"]
    # exploded, so that what follows reads the parsed values and does not parse again for each of their parts
    rows = mentions(docs, spans).select("doc_id", "k", "start_offset", "end_offset", *beside, "name", "display_text", F.inline(F.array(read)))
    rows = rows.where(F.col("_asked").isNotNull() | F.col("_of").isNotNull())
    ambiguous = F.when(place, ~(text.contains("(") | text.contains(","))).when(person, F.col("_of.n") >= F.size(F.split(F.trim(text), r"\s+"))).otherwise(F.lit(False))
    kind = F.when(place, "place").when(person, "person").when(span, "range").otherwise("date")
    rows = rows.select("doc_id", "k", "start_offset", "end_offset", *beside, kind.alias("class"), F.col("_of.auth").alias("auth_name"), F.col("_of.display").alias("display_name"), "display_text", ambiguous.alias("ambiguous"), "_asked")

    told = ["doc_id", "k", "start_offset", "end_offset", *beside, "class", "auth_name", "display_name", "display_text", "ambiguous"]
    if gazetteer.limit(FEW + 1).count() <= FEW:  # each step of a place is looked up where the row is
        known, found = _gazetteer(gazetteer).groupBy("kind", "asked").agg(F.min(F.struct("place_auth", "place_display")).alias("e")), rows
        for k in range(4):
            step = F.broadcast(known.select(F.col("kind").alias("_kind"), F.col("asked").alias("_name"), F.col("e").alias(f"_e{k}")))
            of = lambda field: F.get("_asked", F.lit(k))[field]  # noqa: B023, E731
            found = found.join(step, (of("kind") == F.col("_kind")) & (of("asked") == F.col("_name")), "left").drop("_kind", "_name")
        found = found.select(*told, F.coalesce(*(f"_e{k}" for k in range(4))).alias("e")).where("class != 'place' or e is not null")
        return _resolved(found, beside)
    tried = rows.select(*told, F.explode_outer("_asked").alias("t")).select(*told, "t.*")
    found = tried.join(small(_gazetteer(gazetteer)), ["kind", "asked"], "left")
    step = F.when(F.col("place_auth").isNotNull(), F.col("step"))
    found = found.groupBy(*told).agg(F.min_by(F.struct("place_auth", "place_display"), step).alias("e")).where("class != 'place' or e is not null")
    return _resolved(found, beside)


def _resolved(found: DataFrame, beside: list[str]) -> DataFrame:
    return found.select("doc_id", "k", "start_offset", "end_offset", *beside, "class", F.coalesce("e.place_auth", "auth_name").alias("auth_name"), F.coalesce("e.place_display", "display_name").alias("display_name"), "display_text", "ambiguous")


def frequencies(found: DataFrame, *unit: str) -> DataFrame:
    """Occurrences of each entity of a unit (max), those that are not ambiguous (min), and its first position."""
    return found.groupBy(*unit, "class", "auth_name").agg(F.count("*").alias("max_freq"), F.sum((~F.col("ambiguous")).cast("long")).alias("min_freq"), F.min("start_offset").alias("first_position"))


def within_window(found: DataFrame, start: int, end: int) -> DataFrame:
    """Counts and first positions of the entities that begin between two offsets of each text."""
    return frequencies(found.where(F.col("start_offset").between(start, end)), "doc_id")


def search(entities: DataFrame, keyword: str) -> DataFrame:
    """Entities(class, auth_name, display_name, max_occ) that hold a keyword in either name, whatever its case, and occur."""
    word = keyword.lower()
    return entities.where(F.col("max_occ").isNotNull() & (F.lower("display_name").contains(word) | F.lower("auth_name").contains(word)))


#: Orders of an entity list: the columns and whether the larger comes first.
ORDERS = {"display": [("display_name", False)], "authority": [("auth_name", False)], "position": [("first_position", False)], "count": [("max_freq", True)], "frequency": [("max_freq", True), ("min_freq", True)]}


def ordered(rows: DataFrame, by: list[str], method: str) -> DataFrame:
    """rows with place, in one of the ORDERS within each by; ties in the order of authority names."""
    keys = [F.desc(c) if down else F.asc(c) for c, down in ORDERS[method]]
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*keys, "class", "auth_name")))


def snippets(docs: DataFrame, found: DataFrame, most: int = 10, length: int = 1000) -> DataFrame:
    """(doc_id, class, auth_name, snippet): the first mentions of each entity in its text without tags.

    Up to most mentions share length characters; each is put in asterisks, gaps are [...], and
    [n more...] tells how many are left out. Contexts do not overlap: each begins where the one before ended.
    """
    rank = Window.partitionBy("doc_id", "class", "auth_name").orderBy("start_offset")
    rows = found.withColumn("_k", F.row_number().over(rank)).groupBy("doc_id", "class", "auth_name").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_k") <= most, F.struct("start_offset", "end_offset")))).alias("at"))
    text = docs.select("doc_id", "text")
    plain = lambda a, b: without_tags(F.substring(F.col("text"), a + 1, b - a))
    share = F.floor(F.lit(length) / F.size("at")).cast("int")
    start = F.struct(F.lit(0).alias("last"), F.lit("").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        room = F.greatest(F.floor((share - (m["end_offset"] - m["start_offset"])) / 2), F.lit(0)).cast("int")
        left = F.greatest(m["start_offset"] - room, acc["last"])
        right = F.least(m["end_offset"] + room, F.length("text"))
        gap = F.when(left > acc["last"], "[...]").otherwise("")
        out = F.concat(acc["out"], gap, plain(left, m["start_offset"]), F.lit("*"), plain(m["start_offset"], m["end_offset"]), F.lit("*"), plain(m["end_offset"], F.greatest(right, m["end_offset"])))
        return F.struct(F.greatest(right, m["end_offset"]).cast("int").alias("last"), out.alias("out"))

    made = rows.join(text, "doc_id").withColumn("s", F.aggregate("at", start, step))
    more = F.when(F.col("n") > most, F.format_string("[%d more...]", F.col("n") - most)).otherwise("")
    return made.select("doc_id", "class", "auth_name", F.concat("s.out", F.when(F.col("s.last") < F.length("text"), "[...]").otherwise(""), more).alias("snippet"))
