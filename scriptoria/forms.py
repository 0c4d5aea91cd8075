"""Named queries over forms, filters, orders and bags that the other modules do not cover."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptoria.catalogue import _PARSED, _TOKENS, _attributes, _parsed, _tokens
from scriptoria.functions import dates as D
from scriptoria.functions import text as X
from scriptoria.markup_queries import _NAMES, _occurrences
from scriptoria.operators import catalogue_ops as C
from scriptoria.operators import predicates as W
from scriptoria.operators import ranks as O
from scriptoria.operators import structure as J
from scriptoria.registry import query
from scriptoria.sources import markup as K
from scriptoria.sources import tables as S
from scriptoria.sources.samples import order_texts


@query("SELECT p_partkey FROM part WHERE p_brand = 'Brand#3' AND p_size = 37 UNION ALL SELECT p_partkey FROM part WHERE p_type = 'SMALL'")
def equality_filters(spark, d):
    part = S.table(spark, d, "part")
    asked = [{"p_brand": "Brand#3", "p_type": None, "p_size": 37}, {"p_brand": None, "p_type": "SMALL", "p_size": None}]
    one, two = (part.where(W.equal_where_given(**a)).select("p_partkey") for a in asked)
    return one.unionAll(two)


@query("WITH a AS (SELECT doc_id, 'lang' AS key_name, lang AS value, 2 AS rank FROM documents WHERE lang IS NOT NULL UNION ALL SELECT doc_id, 'source', source, 1 FROM documents WHERE source IS NOT NULL UNION ALL SELECT doc_id, 'size', CAST(n_chars // 1000 AS VARCHAR), 3 FROM documents WHERE n_chars IS NOT NULL), h AS (SELECT * FROM a WHERE list_has_any(string_split_regex(lower(value), '[^a-z0-9]+'), ['src1', 'en', '2'])) SELECT doc_id, arg_min(key_name, rank) AS key_name, arg_min(value, rank) AS value FROM h GROUP BY doc_id")
def metadata_matches(spark, d):
    """Documents of which a metadata value has one of some words, each under the first key that does."""
    return C.matching_metadata(_attributes(spark, d), "doc_id", ["source", "lang", "size"], ["src1", "en", "2"])


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND source = 'src2'")
def metadata_template(spark, d):
    m = C.folded_attributes(_attributes(spark, d), "doc_id")
    return m.where(C.fits_template(F.col("metadata"), {"lang": "en", "source": "src2"})).select("doc_id")


@query(f"WITH {_TOKENS}, own(word, own) AS (VALUES ('the', 'en'), ('of', 'en'), ('und', 'de'), ('der', 'de'), ('les', 'fr'), ('que', 'es')) SELECT doc_id, count(*) AS n FROM tokens JOIN own USING (word) WHERE own.own = tokens.lang GROUP BY doc_id")
def words_of_the_texts_language(spark, d):
    own = spark.createDataFrame([("the", "en"), ("of", "en"), ("und", "de"), ("der", "de"), ("les", "fr"), ("que", "es")], "word string, own string")
    return _tokens(spark, d).join(F.broadcast(own), "word").where("own = lang").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, count(*) AS n_left FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey")
def rows_left_after_a_delete(spark, d):
    gone = S.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return S.table(spark, d, "lineitem").join(gone, "l_orderkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n_left"))


@query(f"WITH {_PARSED} SELECT source, round(sum(1.0 / k), 4) AS weight, round(sum(1.0 / k) FILTER (line <= 2), 4) AS weight_of_first_lines FROM parsed GROUP BY source")
def weights_of_collections(spark, d):
    w = 1.0 / F.col("k")
    return _parsed(spark, d).groupBy("source").agg(F.round(F.sum(w), 4).alias("weight"), F.round(F.sum(F.when(F.col("line") <= 2, w)), 4).alias("weight_of_first_lines"))


@query(f"WITH {_PARSED}, v AS (SELECT lang, lemma, count(*) AS max_freq, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS min_freq, round(sum(1.0 / k), 6) AS weighted FROM parsed GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY max_freq DESC, lemma) AS by_max, row_number() OVER (PARTITION BY lang ORDER BY min_freq DESC, lemma) AS by_min, row_number() OVER (PARTITION BY lang ORDER BY weighted DESC, lemma) AS by_weight, row_number() OVER (PARTITION BY lang ORDER BY lemma) AS by_name FROM v) SELECT lang, lemma, by_max, by_min, by_weight, by_name FROM r WHERE least(by_max, by_min, by_weight, by_name) <= 50")
def frequency_orders(spark, d):
    """The heads of a language's vocabulary in each of its orders, fifty lemmas each."""
    v = _parsed(spark, d).groupBy("lang", "lemma").agg(F.count("*").alias("max_freq"), F.count_if(F.col("k") == 1).alias("min_freq"), F.round(F.sum(1.0 / F.col("k")), 6).alias("weighted"))
    name = F.col("lemma")
    orders = {"by_max": [F.desc("max_freq"), name], "by_min": [F.desc("min_freq"), name], "by_weight": [F.desc("weighted"), name], "by_name": [name]}
    return O.heads_of_orders(v, ["lang"], orders, "lemma", 50)


@query("WITH c AS (SELECT p_brand AS key, count(*) AS n FROM part GROUP BY p_brand) SELECT key, n, row_number() OVER (ORDER BY n DESC, key) AS from_most, row_number() OVER (ORDER BY n, key) AS from_least FROM c")
def counter_views(spark, d):
    """A counter of brands, few by nature, sorted both ways."""
    c = S.table(spark, d, "part").groupBy(F.col("p_brand").alias("key")).agg(F.count("*").alias("n"))
    return c.withColumn("from_most", F.row_number().over(Window.orderBy(F.desc("n"), "key"))).withColumn("from_least", F.row_number().over(Window.orderBy("n", "key")))


@query("WITH a AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_orderkey, string_agg(l_returnflag || n, ' ' ORDER BY l_returnflag) AS bag, CAST(sum(n) AS BIGINT) AS size, count(*) AS n_distinct FROM a GROUP BY l_orderkey")
def bags(spark, d):
    return C.bags(S.table(spark, d, "lineitem"), "l_orderkey", "l_returnflag").select("l_orderkey", F.array_join(F.transform("bag", lambda x: F.concat(x["value"], x["n"].cast("string"))), " ").alias("bag"), "size", "n_distinct")


@query("WITH n AS (SELECT l_orderkey, list(DISTINCT [[CAST(l_partkey % 97 AS BIGINT), CAST(l_partkey % 97 + l_quantity AS BIGINT)]]) AS ns FROM lineitem GROUP BY l_orderkey), k AS (SELECT l_orderkey, list_reduce(list_sort(ns), lambda acc, x: CASE WHEN x[1][1] > acc[-1][2] THEN list_concat(acc, x) ELSE acc END, [[CAST(-1 AS BIGINT), CAST(-1 AS BIGINT)]]) AS kept FROM n) SELECT l_orderkey, unnest(kept[2:])[1] AS start, unnest(kept[2:])[2] AS end_ FROM k")
def accepted_annotations(spark, d):
    """Notes of a text, of which each accepted one keeps out those that begin before its end."""
    start = F.col("l_partkey") % 97
    notes = S.table(spark, d, "lineitem").select("l_orderkey", start.cast("int").alias("start"), (start + F.col("l_quantity")).cast("int").alias("end")).distinct()
    return J.accepted_notes(notes, "l_orderkey").select("l_orderkey", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end_"))


@query(f"WITH {_NAMES} SELECT collection, doc_id, auth_name, count(*) AS n FROM occurrences WHERE class = 'place' GROUP BY GROUPING SETS ((collection, doc_id, auth_name), (collection, auth_name), (auth_name))")
def places_at_three_grains(spark, d):
    members = K.headers(order_texts(spark, d)).where("key_name = 'creator'").select("doc_id", F.col("value").alias("collection"))
    found = _occurrences(spark, d).where(F.col("class") == "place").join(members, "doc_id")
    return found.select("auth_name", F.explode(F.array(F.struct("collection", "doc_id"), F.struct("collection", F.lit(None).cast("string").alias("doc_id")), F.struct(F.lit(None).cast("string").alias("collection"), F.lit(None).cast("string").alias("doc_id")))).alias("g")).groupBy("g.collection", "g.doc_id", "auth_name").agg(F.count("*").alias("n"))


_ODD = "['mh=nin\\a/eide/', 'lo/gos]', 'a)/nqrwpos*', 'e)n[ne/pe'][p_partkey % 4 + 1]"


@query(f"WITH f AS (SELECT p_partkey, {_ODD} AS form FROM part) SELECT p_partkey, regexp_replace(form, '[()\\\\/*=|+'']', '', 'g') AS bare, regexp_replace(form, '[/\\\\=]', '', 'g') AS unaccented, regexp_replace(regexp_replace(translate(form, '\\', '/'), '[\\[\\]]', '', 'g'), '^([^/=]*[/=][^/=]*)[/=](.*)$', '\\1\\2') AS lookup FROM f")
def greek_forms(spark, d):
    form = F.get(F.array(*map(F.lit, ["mh=nin\\a/eide/", "lo/gos]", "a)/nqrwpos*", "e)n[ne/pe"])), (F.col("p_partkey") % 4).cast("int"))
    return S.table(spark, d, "part").select("p_partkey", X.bare_form(form).alias("bare"), X.greek_unaccented(form).alias("unaccented"), X.greek_lookup(form).alias("lookup"))


@query("WITH f AS (SELECT p_partkey, ['kitAbN', 'qalamu~', 'bayot', NULL][p_partkey % 4 + 1] AS form FROM part) SELECT p_partkey, regexp_replace(form, '[aiuoFKN~`]', '', 'g') AS bare, coalesce(form, '') AS filled FROM f")
def arabic_forms(spark, d):
    form = F.get(F.array(*map(F.lit, ["kitAbN", "qalamu~", "bayot", None])), (F.col("p_partkey") % 4).cast("int"))
    return S.table(spark, d, "part").select("p_partkey", X.arabic_bare(form).alias("bare"), X.no_null(form).alias("filled"))


def _pattern_sql(language: str) -> str:
    return f"CAST(len(regexp_extract_all(t, '{X.WORDS[language]}')) AS BIGINT)".replace("'`", "''`") if language == "ar" else f"CAST(len(regexp_extract_all(t, '{X.WORDS[language]}')) AS BIGINT)"


@query(f"WITH l AS (SELECT doc_id, regexp_replace(text, '[&_][A-Za-z]+;', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL) SELECT doc_id, {_pattern_sql('default')} AS n_default, {_pattern_sql('la')} AS n_latin, {_pattern_sql('ang')} AS n_english, {_pattern_sql('non')} AS n_norse FROM l")
def words_by_pattern(spark, d):
    n = lambda language: F.size(X.words(F.col("text"), language)).cast("long")
    return S.table(spark, d, "documents").where("text is not null").select("doc_id", n("default").alias("n_default"), n("la").alias("n_latin"), n("ang").alias("n_english"), n("non").alias("n_norse"))


@query("SELECT p_partkey, p_size % 14 BETWEEN 1 AND 12 AND p_partkey % 33 BETWEEN 1 AND 31 AS valid FROM part")
def valid_dates(spark, d):
    date = F.struct(F.lit(1900).alias("year"), (F.col("p_size") % 14).cast("int").alias("month"), (F.col("p_partkey") % 33).cast("int").alias("day"))
    return S.table(spark, d, "part").select("p_partkey", D.is_valid(date).alias("valid"))


@query("SELECT doc_id, count(DISTINCT lang || source) FILTER (true) AS n, string_agg(DISTINCT v, '|' ORDER BY v) AS sources FROM (SELECT doc_id, lang, source, unnest([source, CASE WHEN doc_id % 2 = 0 THEN source || 'b' END]) AS v FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL) WHERE v IS NOT NULL GROUP BY doc_id")
def merged_stores(spark, d):
    """Two stores of metadata put together key by key."""
    one = _attributes(spark, d).where("key_name = 'source'")
    two = one.where("doc_id % 2 = 0").withColumn("value", F.concat("value", F.lit("b")))
    whole = S.table(spark, d, "documents").where("source is not null and lang is not null").select("doc_id")
    m = C.folded_attributes(one.unionByName(two).join(whole, "doc_id", "left_semi"), "doc_id")
    return m.select("doc_id", F.lit(1).cast("long").alias("n"), F.array_join(F.try_element_at("metadata", F.lit("source")), "|").alias("sources"))
