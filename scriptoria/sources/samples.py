"""Marked-up texts made from the driver's order tables, one document a customer, for queries over markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.sources.tables import dealt, small, spread, table, tasks_for

#: Items of orders in one task, so that what their tags unfold into is sorted in its memory however large the tables are.
ITEMS = 100_000


def text_tasks(spark: SparkSession, d: str) -> int:
    """The tasks that order_texts and ledger_texts, and what is found in them, are dealt to."""
    return tasks_for(table(spark, d, "lineitem"), ITEMS)


def order_texts(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, work, kind, text): each customer's orders as divisions and their items as lines.

    Customers of a nation are documents of one work; by their number they are texts, a commentary or a summary.
    Odd lines declare their number, even ones do not. A place is told by its key, its name in one
    of two attributes, or its text; every fifth is unknown.
    """
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_quantity").cast("long").alias("qty")))).alias("items"))
    line = lambda x, k: F.concat(F.when(k % 2 == 0, F.concat(F.lit('<l n="'), (k + 1).cast("string"), F.lit('">'))).otherwise("<l>"), F.lit("part "), x["l_partkey"].cast("string"), F.lit(" x "), x["qty"].cast("string"), F.lit("</l>"))
    items = items.select("l_orderkey", F.array_join(F.transform("items", line), "").alias("lines"))
    nation = small(table(spark, d, "nation"))
    people = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "c_nationkey", "n_name")
    # Orders meet their items first and their customer where the text is put together, so that neither names nor heads are shuffled.
    rows = table(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.concat(F.lit("Shop:text:"), "o_custkey").alias("doc_id"), "o_orderkey", "o_orderdate", "lines")
    rows = dealt(rows, "doc_id", text_tasks(spark, d)).join(people.withColumn("doc_id", F.concat(F.lit("Shop:text:"), "c_custkey")), "doc_id")
    k = F.col("o_orderkey") % 5
    place = F.when(k == 0, F.concat(F.lit('<placeName key="nation,'), "c_nationkey", F.lit(';x">home</placeName>'))).when(k == 1, F.concat(F.lit('<placeName n="'), "n_name", F.lit('">home</placeName>')))
    place = place.when(k == 2, F.concat(F.lit('<placeName reg="'), "n_name", F.lit('">home</placeName>'))).when(k == 3, F.concat(F.lit("<placeName>"), "n_name", F.lit("</placeName>"))).otherwise("<placeName>Nowhere, far</placeName>")
    head = F.concat(
        F.lit('<div1 type="order" n="'), "o_orderkey", F.lit('"><head>Order '), "o_orderkey", F.lit('</head><p>On <date value="'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('">a day</date> for <persName reg="p:Smith,'), "c_name", F.lit('">'), "c_name", F.lit("</persName> of "), place, F.lit(".</p>")
    )
    rows = rows.select("doc_id", "c_custkey", "c_name", "n_name", "c_nationkey", "o_orderkey", F.concat(head, F.coalesce("lines", F.lit("")), F.lit("</div1>")).alias("division"))
    texts = rows.groupBy("doc_id", "c_custkey", "c_name", "n_name", "c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "division"))), lambda x: x["division"]), "").alias("body"))
    header = F.concat(F.lit("<TEI.2><teiHeader><fileDesc><titleStmt><title>"), "c_name", F.lit("</title><author>"), "n_name", F.lit('</author></titleStmt></fileDesc><profileDesc><langUsage><language id="en">English</language></langUsage></profileDesc></teiHeader><text><body>'))
    kind = F.element_at(F.array(F.lit("text"), F.lit("text"), F.lit("commentary"), F.lit("summary")), (F.col("c_custkey") % 4 + 1).cast("int"))
    return texts.select(
        "doc_id",
        F.concat(F.lit("Shop:abo:nation,"), "c_nationkey").alias("work"),
        kind.alias("kind"),
        F.concat(header, "body", F.lit("</body></text></TEI.2>")).alias("text"),
    )


#: The same texts in SQL: items, order heads and divisions with their offsets, and whole documents.
ORDER_TEXTS = """items AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_quantity AS BIGINT)) AS k, l_partkey, CAST(l_quantity AS BIGINT) AS qty FROM lineitem),
line_texts AS (SELECT l_orderkey, k, CASE WHEN k % 2 = 1 THEN '<l n="' || k || '">' ELSE '<l>' END || 'part ' || l_partkey || ' x ' || qty || '</l>' AS t FROM items),
heads AS (SELECT o_orderkey, c_custkey, c_name, c_nationkey, n_name, o_orderdate, '<div1 type="order" n="' || o_orderkey || '"><head>Order ' || o_orderkey || '</head><p>On <date value="' || strftime(o_orderdate, '%Y-%m-%d') || '">a day</date> for <persName reg="p:Smith,' || c_name || '">' || c_name || '</persName> of ' || CASE o_orderkey % 5 WHEN 0 THEN '<placeName key="nation,' || c_nationkey || ';x">home</placeName>' WHEN 1 THEN '<placeName n="' || n_name || '">home</placeName>' WHEN 2 THEN '<placeName reg="' || n_name || '">home</placeName>' WHEN 3 THEN '<placeName>' || n_name || '</placeName>' ELSE '<placeName>Nowhere, far</placeName>' END || '.</p>' AS h FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
line_sums AS (SELECT l_orderkey, string_agg(t, '' ORDER BY k) AS t FROM line_texts GROUP BY 1),
divisions AS (SELECT heads.*, h || coalesce(t, '') || '</div1>' AS t, '<TEI.2><teiHeader><fileDesc><titleStmt><title>' || c_name || '</title><author>' || n_name || '</author></titleStmt></fileDesc><profileDesc><langUsage><language id="en">English</language></langUsage></profileDesc></teiHeader><text><body>' AS header FROM heads LEFT JOIN line_sums ON l_orderkey = o_orderkey),
placed AS (SELECT *, CAST(length(header) + coalesce(sum(length(t)) OVER (PARTITION BY c_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_offset, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS nth FROM divisions),
texts AS (SELECT 'Shop:text:' || c_custkey AS doc_id, 'Shop:abo:nation,' || c_nationkey AS work, ['text', 'text', 'commentary', 'summary'][c_custkey % 4 + 1] AS kind, c_custkey, c_name, n_name, any_value(header) || string_agg(t, '' ORDER BY o_orderkey) || '</body></text></TEI.2>' AS text FROM placed GROUP BY ALL)"""


def ledger_texts(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text): each customer's orders as milestones, books that hold chapters, in one division.

    Odd orders declare their number; items are chapters that never do. A page begins before each order. Every third customer's division is never closed, every fifth's chapters are of the edition q.
    """
    edition = F.when(F.col("c_custkey") % 5 == 0, ' ed="q"').otherwise("")
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).alias("items"))
    known = table(spark, d, "customer").select(F.concat(F.lit("Shop:ledger:"), "c_custkey").alias("doc_id"), "c_custkey")
    parts = F.transform("items", lambda x: x["l_partkey"]).alias("parts")
    rows = table(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.concat(F.lit("Shop:ledger:"), "o_custkey").alias("doc_id"), "o_orderkey", parts)
    rows = dealt(rows, "doc_id", text_tasks(spark, d)).join(known, "doc_id")
    chapters = F.array_join(F.transform("parts", lambda x: F.concat(F.lit('<milestone unit="chapter"'), edition, F.lit("/>part "), x.cast("string"), F.lit(" "))), "")
    number = F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit(' n="'), F.col("o_orderkey").cast("string"), F.lit('"'))).otherwise("")
    rows = rows.select("doc_id", "c_custkey", "o_orderkey", F.concat(F.lit('<p><pb n="'), F.col("o_orderkey").cast("string"), F.lit('"/><milestone unit="book"'), number, F.lit("/>order "), F.coalesce(chapters, F.lit("")), F.lit("</p>")).alias("book"))
    texts = rows.groupBy("doc_id", "c_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "book"))), lambda x: x["book"]), "").alias("body"))
    close = F.when(F.col("c_custkey") % 3 == 0, "").otherwise("</div1>")
    return texts.select("doc_id", F.concat(F.lit('<TEI.2><text><body><div1 type="part" n="'), F.col("c_custkey").cast("string"), F.lit('">'), "body", close, F.lit("</body></text></TEI.2>")).alias("text"))


#: The same texts in SQL: chapters and books with their offsets, whole documents, and their sections.
LEDGER_TEXTS = """chapter_texts AS (SELECT o_custkey AS c, o_orderkey AS o, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, '<milestone unit="chapter"' || CASE o_custkey % 5 WHEN 0 THEN ' ed="q"' ELSE '' END || '/>part ' || l_partkey || ' ' AS t FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey),
chapter_sums AS (SELECT o, string_agg(t, '' ORDER BY k) AS chapters FROM chapter_texts GROUP BY o),
book_texts AS (SELECT o_custkey AS c, o_orderkey AS o, '<pb n="' || o_orderkey || '"/>' AS page, '<milestone unit="book"' || CASE o_orderkey % 2 WHEN 1 THEN ' n="' || o_orderkey || '"' ELSE '' END || '/>order ' AS book, coalesce(chapters, '') AS chapters FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN chapter_sums ON o = o_orderkey),
heads AS (SELECT *, '<TEI.2><text><body><div1 type="part" n="' || c || '">' AS head, '<p>' || page || book || chapters || '</p>' AS whole FROM book_texts),
book_places AS (SELECT *, row_number() OVER w AS nth, length(head) + coalesce(sum(length(whole)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 3 AS place FROM heads WINDOW w AS (PARTITION BY c ORDER BY o)),
ledgers AS (SELECT c, any_value(head) || string_agg(whole, '' ORDER BY o) AS opened, opened || CASE c % 3 WHEN 0 THEN '' ELSE '</div1>' END || '</body></text></TEI.2>' AS text, length(opened) + CASE c % 3 WHEN 0 THEN 7 ELSE 0 END AS ended FROM book_places GROUP BY c),
books AS (SELECT b.*, ended, place + length(page) AS book_at, coalesce(lead(place) OVER w, ended) AS page_ends, coalesce(lead(place + length(page)) OVER w, ended) AS book_ends, CASE o % 2 WHEN 1 THEN CAST(o AS VARCHAR) ELSE CAST(nth AS VARCHAR) END AS value FROM book_places b JOIN ledgers USING (c) WINDOW w AS (PARTITION BY c ORDER BY o)),
chapters AS (SELECT b.c, b.o, b.value AS book, x.k, b.book_ends, b.ended, b.book_at + length(b.book) + coalesce(sum(length(x.t)) OVER (PARTITION BY b.o ORDER BY x.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM books b JOIN chapter_texts x ON x.o = b.o),
placed_chapters AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY place) AS running, lead(place) OVER (PARTITION BY c ORDER BY place) AS next_at, lead(place) OVER (PARTITION BY o ORDER BY place) AS next_in_book FROM chapters),
found AS (SELECT c, 'part' AS type, CAST(c AS VARCHAR) AS value, 'part=' || c AS path, 19 AS start_offset, length(opened) + 7 AS end_offset FROM ledgers
UNION ALL SELECT c, 'page', CAST(o AS VARCHAR), 'part=' || c || ':page=' || o, place, page_ends FROM books
UNION ALL SELECT c, 'book', value, 'part=' || c || ':book=' || value, book_at, book_ends FROM books
UNION ALL SELECT c, 'chapter', CAST(k AS VARCHAR), 'part=' || c || ':book=' || book || ':chapter=' || k, place, coalesce(next_in_book, book_ends) FROM placed_chapters WHERE c % 5 <> 0
UNION ALL SELECT c, 'q chapter', CAST(running AS VARCHAR), 'part=' || c || ':q chapter=' || running, place, coalesce(next_at, ended) FROM placed_chapters WHERE c % 5 = 0),
ledger_sections AS (SELECT 'Shop:ledger:' || c AS doc_id, type, value, path, CAST(start_offset AS BIGINT) AS start_offset, CAST(end_offset AS BIGINT) AS end_offset, row_number() OVER (PARTITION BY c, type ORDER BY start_offset) AS position, row_number() OVER (PARTITION BY c ORDER BY start_offset) AS abs_position FROM found)"""


def talk_texts(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, kind, lang, text): each conversation as a text, a division a turn, with languages on texts, paragraphs and words.

    Every fourth turn names its language, holds words of another or names it as a class; the last of four is an index of an unknown language. Links are in the third and fourth of them.
    """
    said, k, n = F.regexp_replace(F.coalesce("text", F.lit("")), "[<>&_]", " "), F.col("turn") % 4, F.col("turn").cast("string")
    head = F.concat(F.lit('<div1 type="'), F.when(k == 3, "index").otherwise("turn"), F.lit('" n="'), n, F.lit('">'))
    body = F.when(k == 0, F.concat(F.lit("<p>"), said)).when(k == 1, F.concat(F.lit('<p lang="grc">'), said, F.lit(' <foreign lang="en">as said</foreign> so')))
    body = body.when(k == 2, F.concat(F.lit('<p class="note german">'), said, F.lit('<bibl n="work:'), n, F.lit('"/>'))).otherwise(F.concat(F.lit('<p lang="zz">'), said, F.lit('<xref target="t:'), n, F.lit('">see</xref>')))
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.concat(head, body, F.lit("</p></div1>")).alias("t"))
    texts = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]), "").alias("body"))
    kind = F.when(F.col("conv_id") % 3 == 0, "lexicon").when(F.col("conv_id") % 3 == 1, "commentary")
    return texts.select(F.concat(F.lit("talk:"), "conv_id").alias("doc_id"), kind.alias("kind"), F.lit("fr").alias("lang"), F.concat(F.lit('<TEI.2><teiHeader><title>one conversation</title></teiHeader><text lang="la"><body>'), "body", F.lit("</body></text></TEI.2>")).alias("text"))


# Catalogue files, written from the driver's tables and read again by sources/loads.py.


def spoken_words(spark: SparkSession, d: str) -> DataFrame:
    """(w, size): the distinct words of three letters and more of all conversations."""
    words = table(spark, d, "conversations").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("w")).distinct()
    return words.withColumn("size", F.length("w"))


def lexicon_file(spark: SparkSession, d: str) -> DataFrame:
    """Entries of two lexica: every spoken word in the large one, every fourth length with a homograph; every fifth length in the small one too, with a long mark."""
    rows = spoken_words(spark, d)
    entry = lambda document, key, told: rows.select(F.lit(document).alias("_document"), F.concat(F.lit("n"), (F.crc32("w") % 1_000_000_000).cast("string")).alias("_id"), key.alias("_key"), F.when(told[0], F.array(F.concat(F.lit(told[1]), "w"))).alias("sense"), "size")
    plain, known = F.when(F.col("size") % 2 == 0, F.concat("w", F.lit("1"))).otherwise(F.col("w")), F.col("size") % 3 != 0
    large = entry("large", plain, (known, "of "))
    second = entry("large", F.concat("w", F.lit("#2")), (known, "other ")).where("size % 4 = 0")
    small = entry("small", F.concat("w", F.lit("_")), (F.col("size") % 2 == 0, "short ")).where("size % 5 = 0")
    return large.unionByName(second).unionByName(small).drop("size")


def analysis_file(spark: SparkSession, d: str) -> DataFrame:
    """Analyses of each spoken word: itself, a plural (of the homograph, where there is one), a participle under a hyphened lemma, and a form of no lemma."""
    rows = spoken_words(spark, d)
    none = F.lit(None).cast("string")
    one = lambda form, lemma, pos, number, mood: F.struct(form.alias("form"), F.lit(lemma).alias("lemma") if isinstance(lemma, str) else lemma.alias("lemma"), F.lit(pos).alias("pos"), (F.lit(number) if number else none).alias("number"), (F.lit(mood) if mood else none).alias("mood"))
    w = F.col("w")
    plural = F.when(F.col("size") % 4 == 0, F.concat(w, F.lit("#2"))).otherwise(w)
    each = F.array(one(w, w, "noun", "sg", None), one(F.concat(w, F.lit("s")), plural, "noun", "pl", None), one(F.concat(w, F.lit("ing")), F.concat(F.lit("re-"), w), "verb", None, "part"), one(F.concat(w, F.lit("zzz")), F.concat(w, F.lit("zzz")), "noun", "sg", None))
    return rows.select(F.inline(each))


#: The lemmas and parses of these files in SQL.
LOADED = """spoken AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM conversations),
loaded AS (SELECT w AS headword, 1 AS sequence, CASE WHEN length(w) % 10 = 0 THEN 'short ' || w WHEN length(w) % 3 <> 0 THEN 'of ' || w END AS definition FROM spoken UNION ALL SELECT w, 2, CASE WHEN length(w) % 3 <> 0 THEN 'other ' || w END FROM spoken WHERE length(w) % 4 = 0),
asked AS (SELECT w AS form, w AS headword, NULL AS number, 'noun' AS pos, 'sg' AS n, NULL AS mood FROM spoken UNION ALL SELECT w || 's', w, CASE WHEN length(w) % 4 = 0 THEN 2 END, 'noun', 'pl', NULL FROM spoken UNION ALL SELECT w || 'ing', w, NULL, 'verb', NULL, 'part' FROM spoken UNION ALL SELECT w || 'zzz', w || 'zzz', NULL, 'noun', 'sg', NULL FROM spoken),
loaded_parses AS (SELECT DISTINCT form, headword, sequence, pos, n, mood FROM asked JOIN loaded USING (headword) WHERE number IS NULL OR number = sequence)"""


def artifact_file(spark: SparkSession, d: str) -> DataFrame:
    """Parts as artifacts of seven kinds, one of which is unknown; some lack a field, a version or a place among finished ones."""
    from scriptoria.sources.loads import FIELDS

    kinds = [*FIELDS, "Other"]
    kind = F.get(F.array(*map(F.lit, kinds)), (F.col("p_partkey") % 7).cast("int"))
    rest = F.get(F.array(*(F.lit(FIELDS.get(k, 20) - 5) for k in kinds)), (F.col("p_partkey") % 7).cast("int")) - (F.col("p_partkey") % 13 == 0).cast("int")
    version = F.when(F.col("p_partkey") % 11 == 0, "").otherwise((F.col("p_size") % 8 - 1).cast("string"))
    return spread(table(spark, d, "part")).select(
        F.concat("p_brand", F.lit(" & "), F.col("p_partkey").cast("string")).alias("name"), kind.alias("type"), F.col("p_type").alias("location"), F.col("p_name").alias("summary"), version.alias("perseus_version"), F.array_repeat(F.lit("told"), rest).alias("other_notes")
    )


def keyword_file(spark: SparkSession, d: str) -> DataFrame:
    """A keyword for each large part, every fourth under another type than the artifact's."""
    rows = artifact_file(spark, d).select("name", "type", "location", F.split_part("name", F.lit(" & "), F.lit(2)).cast("long").alias("k"))
    kept = rows.join(table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("k")), "k")
    return kept.select(F.col("name").alias("artifactName"), F.when(F.col("k") % 4 == 0, "Other").otherwise(F.col("type")).alias("artifactType"), F.lit("subject").alias("keyclass"), F.col("location").alias("keyword"))


def image_file(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as images, every fifth without a caption."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(F.concat(F.lit("img."), k.cast("string")).alias("archive_number"), F.when(k % 5 != 0, F.col("s_name")).alias("caption"), F.lit("").alias("credits"), (k % 3).cast("string").alias("status"), F.lit("1").alias("source_id"))


def image_name_file(spark: SparkSession, d: str) -> DataFrame:
    """The images of each part by its suppliers, named in one of three fields, in two of them for even parts."""
    names = table(spark, d, "part").select(F.concat("p_brand", F.lit(" & "), F.col("p_partkey").cast("string")).alias("n"), "p_partkey")
    rows = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct().join(names, F.col("l_partkey") == F.col("p_partkey"))
    place, even = (F.col("l_partkey") + F.col("l_suppkey")) % 3, F.col("l_partkey") % 2 == 0
    at = lambda k: F.when((place == k) | (even & ((place + 1) % 3 == k)), F.col("n")).otherwise("")
    return rows.select(F.concat(F.lit("img."), F.col("l_suppkey").cast("string")).alias("archive_number"), at(0).alias("name"), at(1).alias("secondary_name"), at(2).alias("tertiary_name"), F.lit("parts").alias("image_schema"))


def gazetteer_file(spark: SparkSession, d: str) -> DataFrame:
    """Customers as places: some with a common name, some without nation or state; those of one nation lie on the equator."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").join(small(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.concat(F.lit("tgn,"), k.cast("string")).alias("id"), F.col("c_name").alias("name"), F.when(k % 3 == 0, F.concat(F.lit("C "), "c_name")).alias("cname"),
        F.when(k % 5 != 0, F.col("n_name")).alias("nation"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("state"), (k % 360 - 179.5).cast("string").alias("lon"), (F.col("c_nationkey") * 2.0 - 20).cast("string").alias("lat"),
    )
