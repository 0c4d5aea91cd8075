"""Named queries over markup: sections, headers, tokens, entities, works and passages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptoria.functions import text as X
from scriptoria.operators import entities as N
from scriptoria.operators import resources as R
from scriptoria.operators import structure as J
from scriptoria.registry import query
from scriptoria.sources import markup as K
from scriptoria.sources import tables as S
from scriptoria.sources.samples import LEDGER_TEXTS, ORDER_TEXTS, ledger_texts, order_texts, talk_texts, text_tasks

_SECTIONS = ORDER_TEXTS + """, line_places AS (SELECT p.c_custkey, p.o_orderkey, p.nth, l.k, CAST(p.start_offset + length(h) + coalesce(sum(length(l.t)) OVER (PARTITION BY l.l_orderkey ORDER BY l.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_offset, length(l.t) AS size FROM placed p JOIN line_texts l ON l.l_orderkey = p.o_orderkey),
found AS (SELECT c_custkey, 'order' AS type, CAST(o_orderkey AS VARCHAR) AS value, start_offset, start_offset + length(t) AS end_offset, 'order=' || o_orderkey AS path FROM placed UNION ALL SELECT c_custkey, 'line', CAST(k AS VARCHAR), start_offset, start_offset + size, 'order=' || o_orderkey || ':line=' || k FROM line_places),
sections AS (SELECT 'Shop:text:' || c_custkey AS doc_id, * EXCLUDE (c_custkey), row_number() OVER (PARTITION BY c_custkey, type ORDER BY start_offset) AS position, row_number() OVER (PARTITION BY c_custkey ORDER BY start_offset) AS abs_position FROM found)"""
_NAMES = ORDER_TEXTS + """, named AS (SELECT 'Shop:text:' || c_custkey AS doc_id, *, strftime(o_orderdate, '%Y-%m-%d') AS day FROM placed),
occurrences AS (SELECT doc_id, n_name AS collection, o_orderkey, 3 * nth - 2 AS k, 'date' AS class, day AS auth_name, day AS display_name, 'a day' AS display_text, false AS ambiguous, start_offset + strpos(h, '<date') - 1 AS start_offset FROM named
UNION ALL SELECT doc_id, n_name, o_orderkey, 3 * nth - 1, 'person', 'smith,' || lower(c_name), c_name || ' Smith', c_name, 2 >= len(string_split_regex(c_name, '\\s+')), start_offset + strpos(h, '<persName') - 1 FROM named
UNION ALL SELECT doc_id, n_name, o_orderkey, 3 * nth, 'place', 'nation,' || c_nationkey, n_name, CASE o_orderkey % 5 WHEN 3 THEN n_name ELSE 'home' END, true, start_offset + strpos(h, '<placeName') - 1 FROM named WHERE o_orderkey % 5 <> 4)"""


def _texts(spark, d):
    return order_texts(spark, d)


def _kept_texts(spark, d):
    """The texts, written once for queries that read them twice."""
    return S.kept(_texts(spark, d), "texts")


def _sections(spark, d):
    return K.cited_sections(_texts(spark, d), 2, tasks=text_tasks(spark, d))


def _occurrences(spark, d, texts=None, spans=None):
    gazetteer = S.table(spark, d, "nation").select(F.concat(F.lit("nation,"), "n_nationkey").alias("auth_name"), F.col("n_name").alias("display_name"))
    return N.occurrences(_texts(spark, d) if texts is None else texts, gazetteer, spans)


def _occurrences_by_order(spark, d):
    """Occurrences with order, the order in which each starts: one row for each pair, found in the text's row."""
    texts = K.cited_texts(_texts(spark, d), 2, tasks=text_tasks(spark, d), carry=("text",))
    orders = F.transform(F.filter("sections", lambda s: s["type"] == "order"), lambda s: F.struct(*(s[c].alias(c) for c in ("path", "value", "start_offset", "end_offset"))))
    found = _occurrences(spark, d, texts.select("doc_id", "text", orders.alias("orders")), "orders")
    return found.withColumn("order", F.explode("within")).drop("within")


@query(f"WITH {_SECTIONS} SELECT doc_id, type, value, path, position, abs_position, start_offset, end_offset FROM sections")
def markup_sections(spark, d):
    return _sections(spark, d).select("doc_id", "type", "value", "path", "position", "abs_position", "start_offset", "end_offset")


@query("SELECT 'Shop:text:' || c_custkey AS doc_id, unnest(['title', 'creator', 'language']) AS key_name, unnest([c_name, n_name, 'en']) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def markup_headers(spark, d):
    return K.headers(_texts(spark, d))


@query(f"WITH {ORDER_TEXTS} SELECT doc_id, CAST(len(regexp_extract_all(text, '<[^>]*>')) AS BIGINT) AS n_tags, CAST(len(regexp_extract_all(regexp_replace(text, '<[^>]*>', ' ', 'g'), '[A-Za-z][A-Za-z\\[\\]]*')) AS BIGINT) AS n_words FROM texts")
def markup_tokens(spark, d):
    t = K.tokens(_texts(spark, d))
    return t.groupBy("doc_id").agg(F.count_if(F.col("kind") == "tag").alias("n_tags"), F.count_if(F.col("kind") == "word").alias("n_words"))


@query(f"WITH {ORDER_TEXTS}, w AS (SELECT unnest(regexp_extract_all(regexp_replace(text, '<[^>]*>', ' ', 'g'), '[A-Za-z][A-Za-z\\[\\]]*')) AS token FROM texts) SELECT token, count(*) AS n FROM w GROUP BY token")
def markup_words(spark, d):
    return K.tokens(_texts(spark, d)).where(F.col("kind") == "word").groupBy("token").agg(F.count("*").alias("n"))


@query(f"WITH {_SECTIONS} SELECT doc_id, type, count(*) AS n, min(start_offset) AS first_offset, max(end_offset) AS last_offset FROM sections GROUP BY ALL")
def sections_by_type(spark, d):
    return _sections(spark, d).groupBy("doc_id", "type").agg(F.count("*").alias("n"), F.min("start_offset").alias("first_offset"), F.max("end_offset").alias("last_offset"))


@query(f"WITH {_SECTIONS} SELECT s.doc_id, s.path, arg_min(c.path, c.start_offset) AS first_child, count(*) AS n_children FROM sections s JOIN sections c ON s.doc_id = c.doc_id AND s.type = 'order' AND c.type = 'line' AND c.start_offset BETWEEN s.start_offset AND s.end_offset GROUP BY ALL")
def markup_contents(spark, d):
    of = lambda kind: F.filter("sections", lambda s: s["type"] == kind)
    texts = K.cited_texts(_texts(spark, d), 2, tasks=text_tasks(spark, d)).select("doc_id", of("order").alias("orders"), of("line").alias("lines"))
    held = texts.withColumn("runs", J.starts_within("orders.start_offset", "orders.end_offset", "lines.start_offset"))
    child = lambda k: F.get("lines", k)
    each = F.transform(F.arrays_zip(F.col("orders.path").alias("path"), "runs"), lambda o: F.struct(o["path"].alias("path"), child(o["runs"]["first"])["path"].alias("child"), child(o["runs"]["first"])["start_offset"].alias("at"), o["runs"]["n"].alias("n")))
    held = held.select("doc_id", F.inline(each)).where("n > 0")
    return held.groupBy("doc_id", "path").agg(F.min_by("child", "at").alias("first_child"), F.sum("n").alias("n_children"))


@query(f"WITH {LEDGER_TEXTS} SELECT * FROM ledger_sections")
def milestone_sections(spark, d):
    """Books and chapters that are milestones: they nest by their types, and number and end with what holds them."""
    return K.cited_sections(ledger_texts(spark, d), 3, tasks=text_tasks(spark, d)).select("doc_id", "type", "value", "path", "position", "abs_position", "start_offset", "end_offset")


@query(f"WITH {LEDGER_TEXTS} SELECT doc_id, path, '<TEI.2><text><body>' || CASE type WHEN 'part' THEN '' ELSE '<div1 type=\"part\" n=\"' || c || '\"><p>' END AS open, CASE type WHEN 'part' THEN '' ELSE '</p></div1>' END || '</body></text></TEI.2>' AS close FROM ledger_sections JOIN ledgers ON doc_id = 'Shop:ledger:' || c")
def section_contexts(spark, d):
    """The tags in force where each section begins."""
    texts = K.cited_texts(ledger_texts(spark, d), 3, tasks=text_tasks(spark, d), carry=("text",))
    found = texts.select("doc_id", F.col("sections.path").alias("path"), K.tags_in_force("text", F.col("sections.start_offset")).alias("tags"))
    return found.select("doc_id", F.inline(F.arrays_zip("path", F.col("tags.open").alias("open"), F.col("tags.close").alias("close"))))


@query(f"WITH {LEDGER_TEXTS}, b AS (SELECT *, min(nth) OVER (PARTITION BY c, value) AS seen, lead(value) OVER (PARTITION BY c ORDER BY o) AS next_value FROM books), r AS (SELECT DISTINCT c, 'part=' || c || ':book=' || value AS first, 'part=' || c || ':book=' || next_value AS last FROM b WHERE next_value IS NOT NULL), bounds AS (SELECT c, 'part=' || c || ':book=' || value AS path, min(book_at) AS s, arg_min(book_ends, book_at) AS e FROM books GROUP BY ALL) SELECT 'Shop:ledger:' || r.c AS doc_id, first, last, '<TEI.2><text><body><div1 type=\"part\" n=\"' || r.c || '\"><p>' || substr(text, CAST(x.s + 1 AS BIGINT), CAST(y.e - x.s AS BIGINT)) || CASE WHEN y.e = l.ended THEN '' ELSE '</p>' END || CASE WHEN r.c % 3 = 0 AND y.e = l.ended THEN '</body></text></TEI.2>' ELSE '</div1></body></text></TEI.2>' END AS markup FROM r JOIN bounds x ON x.c = r.c AND x.path = first JOIN bounds y ON y.c = r.c AND y.path = last JOIN ledgers l ON l.c = r.c WHERE x.s < y.e")
def passage_ranges(spark, d):
    """From each book to the end of the one after it, with the tags that make it well-formed."""
    texts = K.cited_texts(ledger_texts(spark, d), 3, tasks=text_tasks(spark, d), carry=("text",)).withColumn("books", F.transform(F.filter("sections", lambda s: s["type"] == "book"), lambda s: s["path"]))
    ranges = F.filter(F.arrays_zip(F.col("books").alias("first"), F.slice("books", F.lit(2), F.size("books")).alias("last")), lambda r: r["last"].isNotNull())
    return K.passages_of(texts.select("doc_id", "text", "sections", F.array_distinct(ranges).alias("ranges")))


@query("WITH t AS (SELECT 'talk:' || conv_id AS doc_id, turn, len(regexp_extract_all(regexp_replace(coalesce(text, ''), '[<>&_]', ' ', 'g'), '[A-Za-z][A-Za-z\\[\\]]*')) AS w FROM conversations), e AS (SELECT doc_id, unnest(CASE turn % 4 WHEN 0 THEN ['la'] WHEN 1 THEN ['greek', 'en'] WHEN 2 THEN ['de'] ELSE ['unknown'] END) AS lang, unnest(CASE turn % 4 WHEN 0 THEN [w] WHEN 1 THEN [w + 1, 2] WHEN 2 THEN [w] ELSE [w + 1] END) AS n FROM t UNION ALL SELECT DISTINCT doc_id, 'en', 2 FROM t) SELECT doc_id, lang, CAST(sum(n) AS BIGINT) AS n FROM e GROUP BY ALL HAVING sum(n) > 0")
def words_by_scope(spark, d):
    """Words of each text by the language in force where they stand."""
    return K.scoped_tokens(talk_texts(spark, d)).where("kind = 'word'").groupBy("doc_id", "lang").agg(F.count("*").alias("n"))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, len(regexp_extract_all(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[&_][A-Za-z]+;', ' ', 'g'), '[A-Za-z][A-Za-z\[\]]*')) AS n FROM pages) SELECT lang, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_pages FROM p WHERE n > 0 GROUP BY lang""")
def page_words_by_language(spark, d):
    """Words of web pages, scripts and styles too, by the language that their tags declare."""
    pages = S.table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"), F.lit(None).cast("string").alias("lang"))
    by_page = K.scoped_tokens(pages).where("kind = 'word'").groupBy("doc_id", "lang").agg(F.count("*").alias("n"))
    return by_page.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("n_pages"))


@query("SELECT 'talk:' || conv_id AS doc_id, CASE turn % 4 WHEN 2 THEN 'work:' || turn ELSE 't:' || turn END AS target, CASE WHEN turn % 4 = 3 THEN 'index' ELSE ['lexicon', 'commentary', 'text'][conv_id % 3 + 1] END AS kind, CASE turn % 4 WHEN 2 THEN 'turn=' || turn ELSE 'index=' || turn END AS around, CASE turn % 4 WHEN 3 THEN 'see' END AS caption FROM conversations WHERE turn % 4 >= 2")
def links_in_place(spark, d):
    """Links with the kind that their surroundings give them and the section that they stand in."""
    return K.placed_links(talk_texts(spark, d)).select("doc_id", "target", "kind", "around", "caption")


@query(r"""WITH parts AS (SELECT page_id, string_split(html, '</nav>') AS ps FROM pages), each AS (SELECT page_id, generate_subscripts(ps, 1) < len(ps) AS nav, unnest(ps) AS part FROM parts), l AS (SELECT page_id, nav, unnest(regexp_extract_all(part, '<a href="([^"]+)"', 1)) AS target FROM each) SELECT page_id, CASE WHEN nav THEN 'index' ELSE 'text' END AS kind, count(*) AS n, count(DISTINCT target) AS n_targets FROM l GROUP BY ALL""")
def page_link_kinds(spark, d):
    """Links of web pages: those in navigation index, those of the text."""
    pages = S.table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.lit(None).cast("string").alias("kind"), F.col("html").alias("text"))
    return K.placed_links(pages).groupBy(F.col("doc_id").alias("page_id"), "kind").agg(F.count("*").alias("n"), F.countDistinct("target").alias("n_targets"))


# Entities


@query(f"WITH {_NAMES} SELECT doc_id, k, class, auth_name, display_name, display_text, ambiguous, start_offset FROM occurrences")
def entity_occurrences(spark, d):
    return _occurrences(spark, d).select("doc_id", "k", "class", "auth_name", "display_name", "display_text", "ambiguous", "start_offset")


@query(f"WITH {_NAMES} SELECT doc_id, class, auth_name, count(*) AS max_freq, CAST(sum(CASE WHEN ambiguous THEN 0 ELSE 1 END) AS BIGINT) AS min_freq, min(start_offset) AS first_position FROM occurrences GROUP BY ALL")
def entity_frequencies(spark, d):
    return N.frequencies(_occurrences(spark, d), "doc_id")


@query(f"WITH {_NAMES} SELECT doc_id, class, auth_name, count(*) AS max_freq, CAST(sum(CASE WHEN ambiguous THEN 0 ELSE 1 END) AS BIGINT) AS min_freq, min(start_offset) AS first_position FROM occurrences WHERE start_offset BETWEEN 500 AND 2500 GROUP BY ALL")
def entities_in_window(spark, d):
    return N.within_window(_occurrences(spark, d), 500, 2500)


@query(f"WITH {_NAMES} SELECT doc_id, 'order=' || o_orderkey AS path, class, auth_name, count(*) AS n, min(start_offset) AS first_position FROM occurrences GROUP BY ALL")
def entities_by_section(spark, d):
    return _occurrences_by_order(spark, d).groupBy("doc_id", F.col("order.path").alias("path"), "class", "auth_name").agg(F.count("*").alias("n"), F.min("start_offset").alias("first_position"))


@query(f"WITH {_NAMES} SELECT collection, class, auth_name, count(*) AS max_freq, CAST(sum(CASE WHEN ambiguous THEN 0 ELSE 1 END) AS BIGINT) AS min_freq, count(DISTINCT doc_id) AS n_docs FROM occurrences GROUP BY ALL")
def entities_of_collections(spark, d):
    texts = _kept_texts(spark, d)
    members = K.headers(texts).where("key_name = 'creator'").select("doc_id", F.col("value").alias("collection"))
    by_doc = N.frequencies(_occurrences(spark, d, texts), "doc_id").join(members, "doc_id")
    return by_doc.groupBy("collection", "class", "auth_name").agg(F.sum("max_freq").alias("max_freq"), F.sum("min_freq").alias("min_freq"), F.count("*").alias("n_docs"))


_TOTALS = _NAMES + ", totals AS (SELECT class, auth_name, any_value(display_name) AS display_name, count(*) AS max_occ FROM occurrences GROUP BY ALL)"


def _totals(spark, d):
    return _occurrences(spark, d).groupBy("class", "auth_name").agg(F.min("display_name").alias("display_name"), F.count("*").alias("max_occ"))


@query(f"WITH {_TOTALS} SELECT class, count(*) AS n_entities, CAST(sum(max_occ) AS BIGINT) AS n_occurrences, min(auth_name) AS least FROM totals WHERE contains(lower(display_name), '_1') OR contains(lower(auth_name), '00012') OR contains(auth_name, '-02-') GROUP BY class")
def entity_search(spark, d):
    e = _totals(spark, d)
    hits = N.search(e, "_1").union(N.search(e, "00012")).union(N.search(e, "-02-")).distinct()
    return hits.groupBy("class").agg(F.count("*").alias("n_entities"), F.sum("max_occ").alias("n_occurrences"), F.min("auth_name").alias("least"))


@query(f"WITH {_NAMES}, f AS (SELECT doc_id, class, auth_name, count(*) AS max_freq, min(start_offset) AS first_position, CAST(sum(CASE WHEN ambiguous THEN 0 ELSE 1 END) AS BIGINT) AS min_freq FROM occurrences GROUP BY ALL) SELECT doc_id, class, auth_name, row_number() OVER (PARTITION BY doc_id ORDER BY max_freq DESC, class, auth_name) AS by_count, row_number() OVER (PARTITION BY doc_id ORDER BY first_position, class, auth_name) AS by_position, row_number() OVER (PARTITION BY doc_id ORDER BY max_freq DESC, min_freq DESC, class, auth_name) AS by_frequency FROM f")
def entity_orders(spark, d):
    rows = N.frequencies(_occurrences(spark, d), "doc_id")
    for method in ("count", "position", "frequency"):
        rows = N.ordered(rows, ["doc_id"], method).withColumnRenamed("place", f"by_{method}")
    return rows.select("doc_id", "class", "auth_name", "by_count", "by_position", "by_frequency")


@query(f"WITH {_TOTALS} SELECT class, max(max_occ) AS max_occ, min(auth_name) FILTER (max_occ = top) AS auth_name FROM (SELECT *, max(max_occ) OVER (PARTITION BY class) AS top FROM totals) GROUP BY class")
def most_frequent_entities(spark, d):
    best = F.struct(-F.col("max_occ"), "auth_name")
    return _totals(spark, d).groupBy("class").agg(F.max("max_occ").alias("max_occ"), F.min_by("auth_name", best).alias("auth_name"))


@query(f"WITH {_NAMES} SELECT o_orderkey, p.auth_name AS place, n.n_regionkey FROM (SELECT o_orderkey, doc_id FROM named) o LEFT JOIN occurrences p USING (o_orderkey, doc_id) LEFT JOIN nation n ON p.auth_name = 'nation,' || n.n_nationkey AND n.n_regionkey < 3 WHERE p.class = 'place' OR p.class IS NULL")
def places_with_their_entries(spark, d):
    """Every place mention with its entry in a partial gazetteer; mentions of others stay, with a null region."""
    pairs = _occurrences_by_order(spark, d).where(F.col("class") == "place").select(F.col("order.value").cast("long").alias("o_orderkey"), F.col("auth_name").alias("place"))
    entries = S.table(spark, d, "nation").where("n_regionkey < 3").select(F.concat(F.lit("nation,"), "n_nationkey").alias("place"), "n_regionkey")
    return pairs.join(S.small(entries), "place", "left").select("o_orderkey", "place", "n_regionkey")


@query(f"WITH {_NAMES} SELECT doc_id, class, auth_name, 'order=' || o_orderkey AS root, row_number() OVER (PARTITION BY doc_id ORDER BY o_orderkey, k) AS place FROM occurrences")
def entities_under_their_division(spark, d):
    """Occurrences re-rooted at their outermost section, in the order of section and position."""
    pairs = _occurrences_by_order(spark, d).select("doc_id", "class", "auth_name", F.split_part("order.path", F.lit(":"), F.lit(1)).alias("root"), "start_offset")
    order = X.path_steps(F.col("root"))[0]["value"].cast("long")
    return pairs.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(order, "start_offset"))).select("doc_id", "class", "auth_name", "root", "place")


@query()
def entity_snippets(spark, d):
    return N.snippets(_texts(spark, d), _occurrences(spark, d).where(F.col("class") != "date"))


_CUSTOMER = "c_custkey, 'Smith' AS surname, c_name AS forename, c_mktsegment"


@query("SELECT c_custkey FROM customer WHERE substring(lower(c_mktsegment), 1, 1) = 'b' OR lower(c_name) = 'customer#000000007' OR contains(lower(c_name || ' ' || c_mktsegment), '00013')")
def person_predicate(spark, d):
    """Persons by surname (one letter: its initial), forename or any part of the full name; one of them is enough."""
    from scriptoria.operators.predicates import person

    return S.table(spark, d, "customer").where(person(F.col("c_name"), F.col("c_mktsegment"), forename="Customer#000000007", surname="B", full="00013")).select("c_custkey")


@query("SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE lower(n_name) = 'nation_7' UNION ALL SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = (SELECT min(r_name) FROM region)")
def place_predicate(spark, d):
    """Places by chosen fields, all of which must be equal; a bare keyword is the place's own name."""
    from scriptoria.operators.predicates import place

    region = S.table(spark, d, "region")
    rows = S.table(spark, d, "nation").join(S.small(region), F.col("n_regionkey") == F.col("r_regionkey"))
    least = region.agg(F.min("r_name")).first()[0]
    return rows.where(place({"site": "n_name"}, "NATION_7")).select("n_nationkey").unionAll(rows.where(place({"nation": "r_name"}, nation=least)).select("n_nationkey"))


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 7 OR month(o_orderdate) = 7 OR day(o_orderdate) = 7")
def date_search(spark, d):
    """Dates whose display or authority form is the keyword, or of which one part is that number."""
    from scriptoria.functions.dates import partial_date
    from scriptoria.operators.predicates import dated

    day = partial_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return S.table(spark, d, "orders").where(dated(day, "7")).select("o_orderkey")


# Works and their documents

_WORKS = "works AS (SELECT DISTINCT 'Shop:text:' || c_custkey AS doc_id, c_custkey, 'Shop:abo:nation,' || c_nationkey AS work, ['text', 'text', 'commentary', 'summary'][c_custkey % 4 + 1] AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))"


def _works(spark, d):
    return _texts(spark, d).select("doc_id", "work", "kind")


@query(f"WITH {_WORKS} SELECT work, 'order=' || (length(work) % 7) AS subquery, doc_id || ':order=' || (length(work) % 7) AS citation FROM works WHERE kind = 'text'")
def work_editions(spark, d):
    works = _works(spark, d)
    asked = works.select("work").distinct().withColumn("subquery", F.concat(F.lit("order="), F.length("work") % 7))
    return R.editions(works.where("kind = 'text'"), asked)


@query(f"WITH {_WORKS} SELECT a.doc_id, b.doc_id AS other FROM works a JOIN works b ON a.work = b.work AND a.doc_id <> b.doc_id AND b.kind = 'text' WHERE a.c_custkey % 100 = 0")
def work_translations(spark, d):
    works = _works(spark, d)
    asked = works.where(F.split_part("doc_id", F.lit(":"), F.lit(3)).cast("long") % 100 == 0)
    return R.siblings(works.where("kind = 'text'"), asked)


@query(f"WITH {_SECTIONS}, {_WORKS}, lines AS (SELECT s.doc_id, work, split_part(split_part(path, ':', 1), '=', 2) AS book, value FROM sections s JOIN works USING (doc_id) WHERE type = 'line' AND kind = 'text'), comments AS (SELECT s.doc_id AS commentary, work, value FROM sections s JOIN works USING (doc_id) WHERE type = 'order' AND kind = 'commentary') SELECT DISTINCT lines.doc_id, book, lines.value AS line, commentary FROM lines JOIN comments ON comments.work = lines.work AND comments.value = lines.value")
def commentaries_on_lines(spark, d):
    """Orders of a work's commentaries that are numbered as lines of its texts, by the scheme order=card."""
    texts = _texts(spark, d)
    of = lambda kind: K.cited_sections(texts.where(F.col("kind") == kind), 2, tasks=text_tasks(spark, d), carry=("work",))
    lines = of("text").where("type = 'line'").withColumn("steps", X.path_steps(F.concat(F.lit("d:"), "path")))
    lines = lines.select("work", "doc_id", F.col("steps")[0]["value"].alias("book"), F.col("value").alias("line"), R.commentary_path(F.col("steps"), F.lit("order=card")).alias("path"))
    comments = of("commentary").where("type = 'order'").select("work", "path", F.col("doc_id").alias("commentary"))
    return lines.join(comments, ["work", "path"]).select("doc_id", "book", "line", "commentary").distinct()


@query(f"WITH {_SECTIONS}, {_WORKS}, asked AS (SELECT work, CAST(o_orderkey AS VARCHAR) AS v, 'order=' || o_orderkey || ':line=99' AS path FROM placed JOIN works USING (c_custkey)), k AS (SELECT DISTINCT work, value FROM sections JOIN works USING (doc_id) WHERE type = 'order' AND kind = 'summary') SELECT asked.work, path, CASE WHEN k.value IS NOT NULL THEN 'order=' || v END AS found FROM asked LEFT JOIN k ON k.work = asked.work AND k.value = v")
def summaries_found_by_climbing(spark, d):
    """For each order, asked for a line that it lacks, the longest part of the citation that a summary of the work has."""
    texts = _texts(spark, d)
    of = lambda rows: K.cited_sections(rows, 2, tasks=text_tasks(spark, d), carry=("work",))
    asked = of(texts).where("type = 'order'").select("work", F.concat("path", F.lit(":line=99")).alias("path"))
    return R.nearest(asked, of(texts.where("kind = 'summary'")).select("work", "path"), ["work"])


@query(f"WITH {_WORKS} SELECT work, count(*) FILTER (kind = 'text') AS n_texts, count(*) FILTER (kind = 'commentary') AS n_commentaries, min(doc_id) FILTER (kind = 'text') AS first_text, min(doc_id) FILTER (kind = 'commentary') AS first_commentary FROM works GROUP BY work")
def texts_and_commentaries(spark, d):
    rows = _works(spark, d)
    of = lambda k: F.when(F.col("kind") == k, F.col("doc_id"))
    return rows.groupBy("work").agg(F.count(of("text")).alias("n_texts"), F.count(of("commentary")).alias("n_commentaries"), F.min(of("text")).alias("first_text"), F.min(of("commentary")).alias("first_commentary"))


@query(f"WITH {_WORKS} SELECT work, CASE WHEN kind = 'text' THEN 'primary' ELSE 'secondary' END AS arity, count(*) AS n FROM works GROUP BY ALL")
def primary_and_secondary(spark, d):
    return _works(spark, d).groupBy("work", F.when(F.col("kind") == "text", "primary").otherwise("secondary").alias("arity")).agg(F.count("*").alias("n"))


@query(f"WITH {_WORKS} SELECT DISTINCT value FROM (SELECT work AS value FROM works UNION ALL SELECT doc_id FROM works) WHERE contains(value, ':abo:')")
def abstract_works(spark, d):
    rows = _works(spark, d)
    return rows.select(F.explode(F.array("work", "doc_id")).alias("value")).where(F.col("value").contains(":abo:")).distinct()


@query(f"WITH {_SECTIONS}, w AS (SELECT *, row_number() OVER o AS nth, lag(path) OVER o AS previous, lead(path) OVER o AS next, first_value(path) OVER o AS first, count(*) OVER (PARTITION BY doc_id) AS n_references FROM sections WHERE type = 'order' WINDOW o AS (PARTITION BY doc_id ORDER BY start_offset)) SELECT doc_id, path, nth, previous, next, first, n_references, md5(substring(text, CAST(start_offset + 1 AS BIGINT), CAST(end_offset - start_offset AS BIGINT))) AS passage FROM w JOIN texts USING (doc_id)")
def passages_by_reference(spark, d):
    texts = K.cited_texts(_texts(spark, d), 2, tasks=text_tasks(spark, d), carry=("text",))
    return R.passages_within(texts.select("doc_id", "text", R.references_within(F.col("sections"), "order").alias("refs"))).select("doc_id", "path", "nth", "previous", "next", "first", "n_references", F.md5("passage").alias("passage"))


@query(f"WITH {_WORKS} SELECT work, max(doc_id) FILTER (kind = 'text') AS edition, count(*) FILTER (kind = 'text') AS n_editions FROM works GROUP BY work HAVING count(*) FILTER (kind = 'text') > 0")
def chosen_editions(spark, d):
    """The edition of each work that a reader is given: the last of its texts."""
    return _works(spark, d).where("kind = 'text'").groupBy("work").agg(F.max("doc_id").alias("edition"), F.count("*").alias("n_editions"))
