"""Markup as rows: tags with offsets, citable sections, headers, and tokens.

Texts are rows (doc_id, text), an id for each text. Null texts have no rows; text that is no
well-formed markup is read as far as its tags go.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from scriptoria.functions.text import running_starts, words
from scriptoria.operators.structure import bucketed_range_join, contains
from scriptoria.sources.tables import dealt

# Elements that hold citable sections, and those that begin one without holding it.
DIVISIONS = ["div", "div0", "div1", "div2", "div3", "div4"]
CONTAINERS = [*DIVISIONS, "titlePage", "text", "entry", "entryFree", "l"]
MILESTONES = ["milestone", "pb", "lb"]
# Elements of web pages that have no end, and codes, names and abbreviations of languages.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
LANGUAGES = {"ang": "ang", "ar": "ar", "ara": "ar", "arabic": "ar", "de": "de", "deu": "de", "ger": "de", "german": "de", "en": "en", "eng": "en", "english": "en", "es": "es", "spa": "es", "spanish": "es", "fr": "fr", "fre": "fr", "french": "fr", "gr": "greek", "grc": "greek", "greek": "greek", "it": "it", "ita": "it", "italian": "it", "la": "la", "lat": "la", "latin": "la", "non": "non", "oldenglish": "ang", "oldnorse": "non"}


def parts(docs: DataFrame, pattern: str = "<[^>]*>|[^<]+|<", carry: tuple[str, ...] = (), keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc_id, n, raw, start, size): the pieces of each text in order, the offset of each and the length of the text, with columns of docs to carry.

    pattern must match everything, so that the pieces are the whole text. n counts from 0 the pieces that
    keep, if given, is true of; others are left out. No shuffle.
    """
    rows = docs.where("text is not null").select("doc_id", *carry, F.length("text").alias("size"), F.regexp_extract_all("text", F.lit("(?s)" + pattern), F.lit(0)).alias("raw"))
    rows = running_starts(rows.withColumn("sizes", F.transform("raw", lambda p: F.length(p))), "sizes", "starts")
    pieces = F.arrays_zip("raw", F.col("starts").alias("start"))
    if keep:
        pieces = F.filter(pieces, lambda p: keep(p["raw"]))
    each = rows.select("doc_id", "size", *carry, F.posexplode(pieces).alias("n", "p"))
    return each.select("doc_id", "n", F.col("p.raw").alias("raw"), F.col("p.start").alias("start"), "size", *carry)


def element(raw: Column) -> Column:
    """The name of a tag; empty for text and comments."""
    return F.regexp_extract(raw, r"^</?([A-Za-z][\w.:-]*)", 1)


def attribute(raw: Column, name: str) -> Column:
    """An attribute of a tag; null if it is missing or empty."""
    value = F.regexp_extract(raw, rf'^<[^>]*?\s{name}="([^"]*)"', 1)
    return F.when(F.contains(raw, F.lit(f'{name}="')), F.when(value != "", value))


#: A tag of an element that holds or begins sections, or any other, which has no name here; what only begins like a tag is none.
_NAMED = re.compile(rf"<(?:/?({'|'.join(CONTAINERS + MILESTONES)})(?![\w.:-]))?[^>]*>", re.ASCII)
_ATTRIBUTES = {name: re.compile(rf'<[^>]*?\s{name}="([^"]*)"', re.ASCII) for name in ("ed", "type", "unit", "key", "id", "n")}


@lru_cache(4096)
def _tag(raw: str, name: str) -> tuple[int, str | None, str | None, str | None, str | None]:
    """(step, type, line, declared, id) of a tag of _NAMED.

    step is 1 for an opening tag, -1 for a closing one, 0 for others. type is that of the section that the tag begins, null if it begins none, line its
    edition, declared the value that it gives; id is empty for entries that name none.
    """

    def said(attribute: str) -> str | None:
        found = f'{attribute}="' in raw and _ATTRIBUTES[attribute].match(raw)
        return found[1] or None if found else None

    shut, milestone, division, entry = raw.startswith("</"), name in MILESTONES, name in DIVISIONS, name in ("entry", "entryFree")
    step = 0 if milestone or raw.endswith("/>") else -1 if shut else 1
    number = said("n")
    if shut or name == "text" and not number:
        return step, None, None, None, None
    kind, edition = said("type"), (said("ed") or "").lower()
    base = "line" if name in ("l", "lb") else kind or name if division else said("unit") if name == "milestone" else "page" if name == "pb" else "entry" if entry else name
    line = edition if edition not in ("", "p") and (milestone or division and kind) else None
    own = " ".join(x for x in (line, base) if x).lower() or None
    declared = said("key") if entry else said("id") or number if division and (kind or name).lower() == "entry" else number if name != "titlePage" else None
    return step, own, line, declared, said("id") or ("" if entry else None)


def _orders(tags: list) -> list[tuple[str, int, str]]:
    """Which types of section hold which, learned from the order in which a text's types first appear: (line, k, type).

    A type holds those of the same line with a larger k. Divisions and milestones of a unit count, those of each edition
    are a line; lines, pages and entries hold nothing and are held by elements only.
    """
    types = dict.fromkeys((line or "", kind) for _, _, name, (_, kind, line, _, _) in tags if kind and (name == "milestone" or name in DIVISIONS))
    return [(line, k, kind) for k, (line, kind) in enumerate(types)]


def _held(orders: list[tuple[str, int, str]]) -> dict[str, list[str]]:
    """The types that each type holds by orders; types that hold none are left out."""
    first: dict[str, dict[str, int]] = {}
    for line, k, kind in orders:
        of = first.setdefault(kind, {})
        of[line] = min(k, of.get(line, k))
    below = {kind: list(dict.fromkeys(t for line, k, t in orders if t != kind and k > of.get(line, k))) for kind, of in first.items()}
    return {kind: types for kind, types in below.items() if types}


def scheme_orders(schemes: DataFrame) -> DataFrame:
    """(doc_id, orders) of schemes(doc_id, scheme), orders as _orders() gives: types from the outermost down, divided by : or *."""
    steps = F.filter(F.split(F.lower("scheme"), r"[:*]+"), lambda t: t != "")
    lines = F.transform(steps, lambda t, k: F.struct(F.lower("scheme").alias("line"), k.alias("k"), t.alias("type")))
    return schemes.groupBy("doc_id").agg(F.flatten(F.collect_list(lines)).alias("orders"))


def _sections_of(text: str, told: list[tuple[str, int, str]] | None = None) -> list[tuple]:
    """(n, parent_n, type, value, section_id, position, start, end) of the sections of a text, as sections() describes, by one walk along its tags.

    told are orders as _orders() gives; without them they are learned. Work and memory grow with the tags, and with the types that sections hold.
    """
    tags = []
    for m in _NAMED.finditer(text, 0, text.rfind(">") + 1):
        name = m[1]
        if name:
            tags.append((m.start(), m.end(), name, _tag(m[0], name)))
    # An element that is opened encloses the level below it until a closing tag comes back to its own. One that holds no other encloses nothing.
    found, begun, depth, last, closing = [], {}, 0, 0, len(tags) - 1
    levels = []
    for n, (_, _, _, (step, kind, _, _, _)) in enumerate(tags):
        depth += step
        leaf = step == 1 and n < closing and tags[n + 1][3][0] == -1
        level = depth if step == 1 else depth + 1
        levels.append(None if step == -1 and last == 1 else level)
        if kind:
            found.append((n, level, leaf, begun.get(level)))
        if step == 1 and not leaf:
            begun[depth + 1] = (n, len(found) if kind else None)
        last = step
    if not found:
        return []
    closes, ends, upto, bounds = {}, {}, closing, [None] * len(found)
    for k in range(len(found) - 1, -1, -1):
        n, level, leaf, _ = found[k]
        while upto > n:
            start, _, _, (step, _, _, _, _) = tags[upto]
            if step == -1 and levels[upto] is not None:
                closes[levels[upto]], ends[levels[upto] + 1] = upto, start
            upto -= 1
        bounds[k] = (n + 1 if leaf else closes.get(level), ends.get(level, len(text)))
    holds = _held(_orders(tags) if told is None else told)
    # Where a section begins or ends of a type that holds others, each of those types has a turn.
    turns: dict[str, list] = {}
    for k, (n, _, _, _) in enumerate(found):
        start, _, name, (_, kind, _, _, _) = tags[n]
        milestone = name in MILESTONES
        turns.setdefault(kind, []).append((n, 0, start if milestone else None, None, k))
        turn = n if milestone else bounds[k][0]
        if turn is not None:
            for t in holds.get(kind, ()):
                turns.setdefault(t, []).append((turn, -1, tags[turn][0], (n, k + 1) if milestone else None, None))
    state: list = [None] * len(found)
    for kind, events in turns.items():
        if holds:
            events.sort(key=lambda e: e[:2])
        later = [None] * len(events)
        for j in range(len(events) - 2, -1, -1):
            later[j] = later[j + 1] if events[j + 1][2] is None else events[j + 1][2]
        scope, position, held = 0, 0, None
        for (_, turn, _, begins, k), at in zip(events, later):
            if turn:
                scope, held = scope + 1, begins or held
            else:
                position += 1
                state[k] = (scope, position, held, at)
    out, counts = [], {}
    for k, (n, level, leaf, around) in enumerate(found):
        start, after, name, (step, kind, _, declared, own) = tags[n]
        scope, position, held, later = state[k]
        close, ended = bounds[k]
        if step:
            end = ended if close is None else tags[close][1 if tags[close][2] == name else 0]
        elif name in MILESTONES:
            end = ended if later is None else min(later, ended)
        else:
            end = after
        key = kind if kind == "entry" else (kind, around and around[0], scope)
        counts[key] = counts.get(key, 0) + 1
        value = declared or str(counts[key])
        parent = around and around[1]
        if held and held[0] > (around[0] if around else -1) and out[held[1] - 1][7] > start:
            parent = held[1]
        out.append((k + 1, parent, kind, value, value if own == "" else own, position, start, end))
    return out


_SECTION = StructType([StructField("n", IntegerType()), StructField("parent_n", IntegerType()), *(StructField(c, StringType()) for c in ("type", "value", "section_id")), StructField("position", IntegerType()), StructField("abs_position", IntegerType()), *(StructField(c, LongType()) for c in ("start_offset", "end_offset"))])


def _finder(depth: int):
    """A function of texts, and of the orders told of each if there are such, that gives arrays of their sections; with path, at most depth steps of it, if there is a depth."""
    of = StructType([*_SECTION.fields, *([StructField("path", StringType())] if depth else [])])
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def found(texts: pa.Array, told=None) -> pa.Array:
        rows, offsets, paths = [], [0], []
        for i, text in enumerate(texts):
            orders = told[i].as_py() if told is not None else None
            each = _sections_of(text.as_py(), None if orders is None else [(o["line"], o["k"], o["type"]) for o in orders])
            rows += each
            offsets.append(len(rows))
            if depth:
                steps = [f"{s[2]}={s[3]}" for s in each]
                for s in each:
                    path, up = steps[s[0] - 1], s[1]
                    for _ in range(depth - 1):
                        if up is None:
                            break
                        path, up = f"{steps[up - 1]}:{path}", each[up - 1][1]
                    paths.append(path)
        n, parent, kind, value, own, position, start, end = zip(*rows) if rows else ((),) * 8
        columns = [n, parent, kind, value, own, position, n, start, end, *([paths] if depth else [])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], of.names))

    @F.arrow_udf(ArrayType(of))
    def of_texts(texts: pa.Array) -> pa.Array:
        return found(texts)

    @F.arrow_udf(ArrayType(of))
    def of_told(texts: pa.Array, told: pa.Array) -> pa.Array:
        return found(texts, told)

    return of_texts, of_told


def nested(docs: DataFrame, schemes: DataFrame | None = None, tasks: int | None = None, depth: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, sections): the sections of each text with one, as sections() describes, in one array in the order of their n, with columns of docs to carry.

    With a depth they have path, as cited() describes. Texts are dealt by doc_id once, to that many tasks or as many as shuffles have; sections are found within the text's row, and no tag is shuffled or written.
    """
    told = None if schemes is None else scheme_orders(schemes)
    kept = list(dict.fromkeys(["doc_id", "text", *carry]))
    docs = docs.where("text is not null").select(*kept)
    docs = docs if told is None else docs.join(told, "doc_id", "left")
    of_texts, of_told = _finder(depth)
    found = of_texts("text") if told is None else of_told("text", "orders")
    # exploded, so that what follows reads the sections found and does not find them again
    texts = dealt(docs, "doc_id", tasks).select("doc_id", *carry, F.posexplode(F.array(found)).alias("_once", "sections"))
    return texts.where(F.size("sections") > 0).select("doc_id", *carry, "sections")


def sections(docs: DataFrame, schemes: DataFrame | None = None) -> DataFrame:
    """Citable sections (doc_id, n, parent_n, type, value, section_id, position, abs_position, start_offset, end_offset).

    Divisions are of their type, milestones of their unit, pages and lines of those names; an
    edition other than p stands before the type. Types hold each other as schemes(doc_id, scheme), such as
    book:chapter, say, or where a text has none as _orders() learns. A division ends after its closing tag.
    A milestone ends where the next of its type begins, where a section ends of a type that holds its own, or where
    the element ends that encloses it. An element that is never closed ends with what encloses it, or with the text. value is the
    declared one, else the running number of the type since a section of a type that holds it ended, within the
    enclosing element (of entries: within the text). position counts the type, abs_position all
    sections, in the order of their starts. n names a section within its text, counted from 1; parent_n is that of the innermost
    element or open milestone that holds it, null if that is no section.
    """
    return nested(docs, schemes).select("doc_id", F.inline("sections"))


#: A tag, or what begins like one; its name is missing in comments and declarations.
_TAG = re.compile(r"<(?:(/?)([A-Za-z][\w.:-]*))?[^>]*>", re.ASCII)


def _in_force(text: str, offsets: list[int]) -> list[tuple[str, str]]:
    """The tags open at each of offsets and those that close them: one walk along the text with a stack."""
    tags = (m for m in _TAG.finditer(text) if m[2] and not m[0].endswith("/>"))
    tag, stack, found = next(tags, None), [], {}
    for at in sorted(set(offsets)):
        while tag and (tag.start() < at if tag[1] else tag.end() <= at):
            if not tag[1]:
                stack.append((tag[0], tag[2]))
            elif stack:
                stack.pop()
            tag = next(tags, None)
        found[at] = "".join(raw for raw, _ in stack), "".join(f"</{name}>" for _, name in reversed(stack))
    return [found[at] for at in offsets]


@F.arrow_udf(ArrayType(StructType([StructField("open", StringType()), StructField("close", StringType())])))
def tags_in_force(texts: pa.Array, offsets: pa.Array) -> pa.Array:
    """For each of offsets, an array without nulls, the opening tags in force there and the closing tags they need, as open_tags() describes."""
    rows = ([{"open": o, "close": c} for o, c in _in_force(t.as_py(), at.as_py())] for t, at in zip(texts, offsets))
    return pa.array(rows, pa.list_(pa.struct([("open", pa.string()), ("close", pa.string())])))


def open_tags(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, offset, open, close): the opening tags in force at each of places(doc_id, offset), outermost first, and the closing tags they need.

    An opening tag is in force from its end to the beginning of its closing tag, which closes the last open one whatever its name; a place within a tag is before what it opens and after what it closes. Comments, declarations and empty
    elements open nothing, a closing tag where nothing is open closes nothing. A text's places are brought to it once and found along it. Repeated places count once; places in texts that
    are missing or null give no row, null places neither.
    """
    asked = places.where("offset is not null").groupBy("doc_id").agg(F.collect_set(F.col("offset").cast("long")).alias("offset"))
    found = docs.where("text is not null").select("doc_id", "text").join(asked, "doc_id").withColumn("tags", tags_in_force("text", "offset"))
    return found.select("doc_id", F.inline(F.arrays_zip("offset", F.col("tags.open").alias("open"), F.col("tags.close").alias("close"))))


def slices(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, from_offset, to_offset, markup): spans(doc_id, from_offset, to_offset) of texts as well-formed markup.

    The tags in force at the beginning stand before a span, the closing tags that its end needs after it.
    Spans that begin or end within a tag, or are empty, give what their bounds say and may not parse; null ones and those of missing or null texts give no row.
    """
    asked = spans.where("from_offset is not null and to_offset is not null").groupBy("doc_id").agg(F.collect_set(F.struct("from_offset", "to_offset")).alias("spans"))
    return _sliced(docs, asked).select("doc_id", "from_offset", "to_offset", "markup")


def _sliced(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """slices() of asked(doc_id, spans), one row for each text, with all that spans hold."""
    return _sliced_rows(docs.where("text is not null").select("doc_id", "text").join(asked, "doc_id"))


def _sliced_rows(rows: DataFrame) -> DataFrame:
    bounds = F.concat("spans.from_offset", "spans.to_offset").cast("array<bigint>")
    rows = rows.withColumn("tags", tags_in_force("text", bounds))
    text = lambda s: F.substring("text", s["from_offset"].cast("int") + 1, F.greatest(s["to_offset"] - s["from_offset"], F.lit(0)).cast("int"))
    n = F.size("spans")
    tags = F.arrays_zip(F.col("spans").alias("span"), F.col("tags.open").alias("open"), F.slice("tags.close", n + 1, n).alias("close"))
    tags = F.slice(tags, F.lit(1), n)
    markup = F.transform(tags, lambda t: F.struct(t["span"].alias("span"), F.concat(t["open"], text(t["span"]), t["close"]).alias("markup")))
    return rows.select("doc_id", F.inline(markup)).select("doc_id", "span.*", "markup")


def passages(docs: DataFrame, chunks: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc_id, first, last, markup) of ranges(doc_id, first, last): from the beginning of one cited section to the end of another.

    first and last are paths of cited(); an ambiguous path is its earliest section. Ranges with an unknown bound, or that hold nothing, give no row.
    """
    held = chunks.groupBy("doc_id").agg(F.collect_list(F.struct("path", "start_offset", "end_offset")).alias("sections"))
    asked = ranges.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    return passages_within(docs, held.join(asked, "doc_id"))


def passages_within(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """passages() of texts(doc_id, sections, ranges), one row for each text with its sections and the distinct ranges asked of it.

    Where docs and texts are dealt by doc_id alike, nothing is shuffled.
    """
    place = F.transform("sections", lambda s: F.struct(s["path"].alias("path"), F.struct(*(s[c].cast("long").alias(c) for c in ("start_offset", "end_offset"))).alias("at"), F.lit(None).cast("struct<first:string,last:string>").alias("range"), F.lit(False).alias("begins")))
    bound = lambda end: F.transform("ranges", lambda r: F.struct(r[end].alias("path"), F.lit(None).cast("struct<start_offset:bigint,end_offset:bigint>").alias("at"), r.alias("range"), F.lit(end == "first").alias("begins")))
    rows = texts.select("doc_id", F.inline(F.concat(place, bound("first"), bound("last"))))
    rows = rows.withColumn("at", F.min("at").over(Window.partitionBy("doc_id", "path"))).where("range is not null")
    spans = rows.groupBy("doc_id", "range").agg(F.min(F.when(F.col("begins"), F.col("at.start_offset"))).alias("from_offset"), F.min(F.when(~F.col("begins"), F.col("at.end_offset"))).alias("to_offset"))
    asked = spans.where("from_offset < to_offset").groupBy("doc_id").agg(F.collect_list(F.struct("range.first", "range.last", "from_offset", "to_offset")).alias("spans"))
    return _sliced(docs, asked).select("doc_id", "first", "last", "markup")


@F.arrow_udf(ArrayType(StructType([StructField("from_offset", LongType()), StructField("to_offset", LongType())])))
def _bounds(paths: pa.Array, starts: pa.Array, ends: pa.Array, firsts: pa.Array, lasts: pa.Array) -> pa.Array:
    """Where each range from a first to a last path begins and ends, by the earliest section of a path; null for unknown ones."""
    rows = []
    for path, start, end, first, last in zip(*(x.to_pylist() for x in (paths, starts, ends, firsts, lasts))):
        at: dict = {}
        for p, span in zip(path, zip(start, end)):
            if p is not None and (p not in at or span < at[p]):
                at[p] = span
        rows.append([{"from_offset": at[a][0] if a in at else None, "to_offset": at[b][1] if b in at else None} for a, b in zip(first, last)])
    return pa.array(rows, pa.list_(pa.struct([("from_offset", pa.int64()), ("to_offset", pa.int64())])))


def passages_of(texts: DataFrame) -> DataFrame:
    """passages() of texts(doc_id, text, sections, ranges), each with its text in its row, so that nothing is joined or shuffled."""
    at = _bounds(F.col("sections.path"), F.col("sections.start_offset"), F.col("sections.end_offset"), F.col("ranges.first"), F.col("ranges.last"))
    spans = F.transform(F.arrays_zip(F.col("ranges").alias("range"), at.alias("at")), lambda s: F.struct(s["range"]["first"].alias("first"), s["range"]["last"].alias("last"), s["at"]["from_offset"].alias("from_offset"), s["at"]["to_offset"].alias("to_offset")))
    return _sliced_rows(texts.select("doc_id", "text", F.filter(spans, lambda s: s["from_offset"] < s["to_offset"]).alias("spans")).where("size(spans) > 0")).select("doc_id", "first", "last", "markup")


def cited(chunks: DataFrame, depth: int = 3) -> DataFrame:
    """sections() with path: type=value steps from the outermost section down, at most depth of them.

    chunks are all sections of their texts, as each finds those that hold it by their n.
    """
    rest = [c for c in chunks.columns if c != "doc_id"]
    texts = chunks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", *(c for c in rest if c != "n")))).alias("sections"))
    return _with_paths(texts, rest, depth).select("doc_id", F.inline("sections"))


def cited_sections(docs: DataFrame, depth: int = 3, schemes: DataFrame | None = None, tasks: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """cited() of the sections of docs, with columns of docs to carry; a text's sections are not brought together a second time."""
    return cited_texts(docs, depth, schemes, tasks, carry).select("doc_id", *carry, F.inline("sections"))


def cited_texts(docs: DataFrame, depth: int = 3, schemes: DataFrame | None = None, tasks: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, sections): cited_sections() of each text with one, in one array in their order, dealt by doc_id as nested() says, with columns of docs to carry."""
    return nested(docs, schemes, tasks, depth, carry)


def _with_paths(texts: DataFrame, columns: list[str], depth: int) -> DataFrame:
    def path(s: Column) -> Column:
        line = [s]
        for _ in range(depth - 1):
            line.append(F.get("sections", line[-1]["parent_n"] - 1))
        return F.concat_ws(":", *(F.concat_ws("=", x["type"], x["value"]) if x is s else F.when(x.isNotNull(), F.concat_ws("=", x["type"], x["value"])) for x in reversed(line)))

    each = F.transform("sections", lambda s: F.struct(*(s[c].alias(c) for c in columns), path(s).alias("path")))
    return texts.select("doc_id", each.alias("sections"))


def headers(docs: DataFrame) -> DataFrame:
    """(doc_id, key_name, value): title, author and language that a text's header declares."""
    header = F.regexp_extract("text", r"(?s)<teiHeader.*?</teiHeader>", 0)
    rows = docs.select("doc_id", header.alias("h")).where("h != ''")
    keys = {"title": "//titleStmt/title/text()", "creator": "//titleStmt/author/text()", "language": "//language/@id"}
    each = F.array(*(F.struct(F.lit(k).alias("key_name"), F.xpath("h", F.lit(p)).alias("values")) for k, p in keys.items()))
    return rows.select("doc_id", F.inline(each)).select("doc_id", "key_name", F.explode("values").alias("value"))


def scoped(docs: DataFrame) -> DataFrame:
    """(doc_id, n, raw, start, lang): parts() of docs(doc_id, text, lang) with the language in force at each, lang of the text outside of all.

    An element's language is that of its lang attribute (unknown, if LANGUAGES has no such code), else English in a teiHeader, else
    the first of its classes that names a language, else that of the element around it; a tag has the language of what it encloses. Ends are matched
    to beginnings of the same name, so that elements that are never closed, or out of order, disturb no others; an element with a language that is
    never closed reaches to the end of the text.
    """
    codes = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    raw = F.col("raw")
    rows = parts(docs, carry=("lang",)).withColumnRenamed("lang", "_default").withColumn("name", F.lower(element(raw)))
    said = attribute(raw, "lang")
    classes = F.get(F.filter(F.transform(F.split(F.lower(attribute(raw, "class")), r"\s+"), lambda c: F.try_element_at(codes, c)), lambda c: c.isNotNull()), F.lit(0))
    shut = F.startswith(raw, F.lit("</"))
    alone = (F.col("name") == "") | F.endswith(raw, F.lit("/>")) | F.col("name").isin(VOID)
    own = F.when(~alone & ~shut, F.when(said.isNotNull(), F.coalesce(F.try_element_at(codes, F.lower(said)), F.lit("unknown"))).when(F.col("name") == "teiheader", "en").otherwise(classes))
    rows = rows.withColumn("own", own).withColumn("step", F.when(alone, 0).when(shut, -1).otherwise(1))
    until = lambda w: w.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    tags = rows.where("step != 0").withColumn("depth", F.sum("step").over(until(Window.partitionBy("doc_id", "name"))))
    tags = tags.withColumn("level", F.when(F.col("step") == 1, F.col("depth")).otherwise(F.col("depth") + 1))
    begun = F.last(F.when(F.col("step") == 1, F.col("own").isNotNull()), ignorenulls=True).over(until(Window.partitionBy("doc_id", "name", "level")))
    turns = tags.withColumn("turn", F.when(begun, F.col("step")).otherwise(0)).drop("depth", "level")
    every = turns.unionByName(rows.where("step = 0").withColumn("turn", F.lit(0)))
    within = F.sum("turn").over(until(Window.partitionBy("doc_id")))
    every = every.withColumn("within", within + F.when(F.col("turn") == -1, 1).otherwise(0))
    lang = F.last(F.when(F.col("turn") == 1, F.col("own")), ignorenulls=True).over(until(Window.partitionBy("doc_id", "within")))
    return every.select("doc_id", "n", "raw", "start", F.when(F.col("within") > 0, lang).otherwise(F.col("_default")).alias("lang"))


def _tokens(pieces: DataFrame, *keep: str) -> DataFrame:
    raw = F.col("raw")
    tag = F.when(element(raw).isin("a", "ref", "xref", "bibl"), "link").otherwise("tag")
    entities = F.transform(F.regexp_extract_all(raw, F.lit("[&_][A-Za-z]+;"), F.lit(0)), lambda t: F.struct(F.lit("entity").alias("kind"), t.alias("token")))
    found = F.concat(entities, F.transform(words(raw), lambda t: F.struct(F.lit("word").alias("kind"), t.alias("token"))))
    each = F.when(F.startswith(raw, F.lit("<")) & (F.length(raw) > 1), F.array(F.struct(tag.alias("kind"), raw.alias("token")))).otherwise(found)
    return pieces.select("doc_id", "n", *keep, F.posexplode(each).alias("i", "t")).select("doc_id", "n", "i", *keep, "t.kind", "t.token")


def tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, n, i, kind, token): tags, links, character entities and words of each text, in order.

    A link is a tag named a, ref, xref or bibl. i counts within the piece n between two tags.
    """
    return _tokens(parts(docs))


def scoped_tokens(docs: DataFrame) -> DataFrame:
    """tokens() with lang, the language in force at each by scoped()."""
    return _tokens(scoped(docs), "lang")


#: What a link is by the innermost element around it that tells, or by its document: first what wins.
LINK_PLACES = ["index", "specific lexicon", "lexicon", "commentary"]


def placed_links(docs: DataFrame) -> DataFrame:
    """(doc_id, n, start, target, caption, kind, around) of the links of docs(doc_id, text, kind): a, ref, xref and bibl with a target.

    A link within an element whose type, n or class is index, or that is a nav element, is of kind index; else it is of its document's
    kind (specific lexicon, lexicon, commentary), or of kind text if that is none of these. around is the path by cited() of the
    innermost section that holds it, which the link cites from; null outside of all. caption is the text up to the next tag. Null texts have no link.
    """
    raw = F.col("raw")
    rows = parts(docs).withColumn("name", F.lower(element(raw)))
    shut = F.startswith(raw, F.lit("</"))
    alone = (F.col("name") == "") | F.endswith(raw, F.lit("/>")) | F.col("name").isin(VOID)
    index = (F.col("name") == "nav") | F.lower(F.concat_ws(" ", attribute(raw, "type"), attribute(raw, "n"), attribute(raw, "class"))).rlike(r"(^| )index( |$)")
    rows = rows.withColumn("step", F.when(alone, 0).when(shut, -1).otherwise(1)).withColumn("index", index & ~alone & ~shut)
    until = lambda w: w.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    tags = rows.where("step != 0").withColumn("depth", F.sum("step").over(until(Window.partitionBy("doc_id", "name"))))
    tags = tags.withColumn("level", F.when(F.col("step") == 1, F.col("depth")).otherwise(F.col("depth") + 1))
    begun = F.last(F.when(F.col("step") == 1, F.col("index")), ignorenulls=True).over(until(Window.partitionBy("doc_id", "name", "level")))
    turns = tags.withColumn("turn", F.when(begun, F.col("step")).otherwise(0)).drop("depth", "level")
    every = turns.unionByName(rows.where("step = 0").withColumn("turn", F.lit(0)))
    every = every.withColumn("inside", F.sum("turn").over(until(Window.partitionBy("doc_id"))) > 0)
    every = every.withColumn("caption", F.lead(F.when(~F.startswith(raw, F.lit("<")), raw)).over(Window.partitionBy("doc_id").orderBy("n")))
    target = F.when(F.col("name") == "a", attribute(raw, "href")).when(F.col("name") == "bibl", attribute(raw, "n")).otherwise(attribute(raw, "target"))
    links = every.where(F.col("name").isin("a", "ref", "xref", "bibl") & ~shut).withColumn("target", target).where("target is not null")
    kinds = docs.where("text is not null").select("doc_id", F.when(F.col("kind").isin(LINK_PLACES[1:]), F.col("kind")).otherwise("text").alias("_kind"))
    links = links.join(kinds, "doc_id").withColumn("kind", F.when(F.col("inside"), "index").otherwise(F.col("_kind")))
    links = links.select("doc_id", "n", "start", "target", "caption", "kind")
    chunks = cited(sections(docs), 4)
    held = bucketed_range_join(chunks.select("doc_id", "path", "abs_position", "start_offset", "end_offset"), links.select("doc_id", "n", F.col("start").alias("start_offset"), (F.col("start") + 1).alias("end_offset")), "doc_id", contains() & (F.col("i.start_offset") < F.col("o.end_offset")))
    inner = held.groupBy(F.col("i.doc_id").alias("doc_id"), F.col("i.n").alias("n")).agg(F.max_by("o.path", "o.abs_position").alias("around"))
    return links.join(inner, ["doc_id", "n"], "left")
