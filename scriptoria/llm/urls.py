"""URL filters: explicit rules, then a path-template tree learnt from labelled pages.

For each host, paths are read segment by segment. Segments that are numbers or codes become typed
wildcards. Of the rest a segment stays literal only if the pages under it are labelled bad
significantly more or less often than all under the same parent; the others merge into one wildcard
branch. Templates whose smoothed share of bad pages is high are rejected. Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import saved

#: Labelled pages a branch needs to stand alone, and standard errors it must differ by.
SUPPORT, APART = 12, 2.5
#: Strength of the prior in labelled pages, and the share of bad pages at which a template is rejected.
PRIOR, REJECT = 8.0, 0.5
# Words of host names and paths that unwanted sites give themselves.
UNWANTED = ["ads", "adserver", "adult", "bet", "bets", "betting", "casino", "escort", "gambling", "pills", "poker", "porn", "spam", "viagra", "xxx"]
#: Runs of three equal symbols in a thousand characters of html at which a page counts as junk.
JUNK = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first :// the host up to / ? # (A-Z lower-cased), then the path up to ? #; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def page_signals(pages: DataFrame) -> DataFrame:
    """Labels (page_id, bad) of pages(page_id, url, html) from the pages themselves.

    bad is 1 where a word of the host or path is one of UNWANTED, or the html holds at least JUNK
    runs of symbols in a thousand characters; 0 for other pages with html. Pages that are empty or null
    and tell nothing by their url have no row.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    words = F.split(F.lower(F.concat(host, path)), r"[^a-z0-9]+")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    junk = F.regexp_count(html, F.lit(r"%%%|\*\*\*|###|\$\$\$|@@@|!!!|&amp;&amp;&amp;")) * 1000 >= JUNK * F.length(html)
    bad = F.when(F.arrays_overlap(words, F.array(*map(F.lit, UNWANTED))), 1).when(html != "", junk.cast("int"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), bad.alias("bad")).where("bad is not null")


def first_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest of (verdict, host/path) that fits; nulls if none does."""
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in reversed(ranked):
        name, slash, start = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _typed(segment: Column) -> Column:
    """Wildcards of segments that are variable by form, else the segment."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{2,5}$", "")
    return (
        F.when(segment.isNull(), F.lit(None))
        .when(F.rlike(stem, F.lit(r"^[0-9]+$")), "{number}")
        .when(F.rlike(stem, F.lit(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$")), "{date}")
        .when(F.rlike(stem, F.lit(r"^[0-9A-Fa-f-]{8,}$")) & F.rlike(stem, F.lit("[0-9]")), "{code}")
        .when(F.rlike(stem, F.lit(r"^.{40,}$")), "{long}")
        .otherwise(segment)
    )


def shape(path: Column) -> Column:
    """The path's segments, typed and joined."""
    return F.array_join(F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _typed), "/")


def templates(shapes: DataFrame) -> DataFrame:
    """(host, shape, template, n, b) of shapes(host, shape, n, b), with labelled and bad pages of each shape.

    The tree is learnt down to the deepest level where a segment of a host has the support to stand
    alone; below it nothing could, so that every segment there is a wildcard.
    """
    out = shapes.select("host", "shape", "n", "b", F.lit("").alias("template"))
    segments = F.split("shape", "/")
    held = shapes.where("n > 0").select("host", F.posexplode(segments).alias("level", "s"), "n").groupBy("host", "level", "s").agg(F.sum("n").alias("n"))
    deepest = held.where((F.col("n") >= SUPPORT) & ~F.startswith("s", F.lit("{"))).agg(F.max("level")).first()[0]
    levels = 0 if deepest is None else deepest + 1
    for level in range(levels):
        out = out.withColumn("s", F.nullif(F.try_element_at(F.split("shape", "/"), F.lit(level + 1)), F.lit("")))
        each = out.where("s is not null").groupBy("host", "template", "s").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
        whole = each.groupBy("host", "template").agg(F.sum("n").alias("all"), F.sum("b").alias("bad"))
        p = (F.col("bad") + 1) / (F.col("all") + 2)
        apart = F.abs(F.col("b") - F.col("n") * p) >= APART * F.sqrt(F.col("n") * p * (1 - p))
        alone = each.where(F.col("n") >= SUPPORT).join(whole, ["host", "template"]).where(apart).select("host", "template", "s", F.lit(True).alias("alone"))
        out = out.join(alone, ["host", "template", "s"], "left")
        kept = F.col("alone") | F.startswith("s", F.lit("{"))
        word = F.when(F.col("s").isNull(), "").when(kept, F.concat(F.lit("/"), F.col("s"))).otherwise("/*")
        out = saved(out.select("host", "shape", "n", "b", F.concat("template", word).alias("template")), "tree")
    below = F.filter(F.slice(segments, F.lit(levels + 1), F.greatest(F.size(segments) - levels, F.lit(0))), lambda s: s != "")
    below = F.transform(below, lambda s: F.concat(F.lit("/"), F.when(F.startswith(s, F.lit("{")), s).otherwise("*")))
    return out.withColumn("template", F.concat("template", F.array_join(below, "")))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of pages(page_id, url).

    labels(page_id, bad 0/1) marks some pages; nulls are left out and an id counts once, as bad
    if any of its rows is. rules is a short list of (allow or block, host/path prefix). Without a
    fitting rule a page is blocked if its template's smoothed share of bad pages, (bad + PRIOR * base) / (labelled +
    PRIOR), reaches REJECT. A url that is null or has no :// has empty host and path, and is one
    template of its own; its rows are never blocked by the tree. Rows that repeat count each.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    marked = labels.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("int").alias("bad")).where("page_id is not null and bad in (0, 1)")
    marked = marked.groupBy("page_id").agg(F.max("bad").alias("bad"))
    rows = rows.withColumn("shape", shape(F.col("path")))
    of = rows.join(marked, "page_id", "left").groupBy("host", "shape").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"))
    made = templates(saved(of, "shapes"))
    total = made.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    base = total["b"] / total["n"] if total["n"] else 0.0
    purity = F.round((F.sum("b") + PRIOR * base) / (F.sum("n") + PRIOR), 6)
    shares = made.groupBy("host", "template").agg(purity.alias("purity"))
    made = saved(made.join(shares, ["host", "template"]).select("host", "shape", "template", "purity"), "purity")
    rule, said = first_rule(F.col("host"), F.col("path"), rules)
    learnt = F.when((F.col("purity") >= REJECT) & (F.col("host") != ""), "block").otherwise("allow")
    return rows.join(made, ["host", "shape"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, learnt).alias("verdict"), "template", "purity")
