"""Named queries over catalogue files, which are written from the driver's tables and read again, and over Arabic forms and codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptoria.catalogue import _PARSED, _TOKENS, _parses, _tokens
from scriptoria.functions import arabic as R
from scriptoria.functions import dates as D
from scriptoria.functions import morphology as M
from scriptoria.operators import frequency as A
from scriptoria.operators import resources as W
from scriptoria.registry import query
from scriptoria.sources import loads as L
from scriptoria.sources import markup as K
from scriptoria.sources import samples as B
from scriptoria.sources import tables as S


def _file(rows, root: str, row: str) -> str:
    return L.write_xml(rows, S.shared_folder(rows.sparkSession, root), root, row)


# Lexica and parses


def _lemmas(spark, d):
    path = _file(B.lexicon_file(spark, d), "entries", "entryFree")
    return S.kept(L.lemmas(L.lexicon_entries(spark, path), better="small"), "lemmas")


def _loaded_parses(spark, d):
    return L.parses_of(S.analyses(spark, _file(B.analysis_file(spark, d), "analyses", "analysis")), _lemmas(spark, d))


@query(f"WITH {B.LOADED} SELECT headword, CAST(sequence AS BIGINT) AS sequence, definition, headword || sequence AS authority_name, headword AS display_name, headword || sequence AS sort_name FROM loaded")
def lexicon_lemmas(spark, d):
    """Lemmas of two lexica read from files, the small one's definitions before the large one's."""
    return _lemmas(spark, d).withColumn("sequence", F.col("sequence").cast("long"))


@query(f"WITH {B.LOADED} SELECT form, headword, CAST(sequence AS BIGINT) AS sequence, concat_ws(';', 'pos=' || pos, 'number=' || n, 'mood=' || mood) AS features FROM loaded_parses")
def parses_from_files(spark, d):
    """Parses read from analysis files, one for each lemma that they name."""
    rows = _loaded_parses(spark, d)
    told = F.concat_ws(";", *(F.concat(F.lit(k + "="), F.try_element_at("features", F.lit(k))) for k in ("pos", "number", "mood")))
    return rows.select("form", "headword", F.col("sequence").cast("long").alias("sequence"), told.alias("features"))


@query(f"WITH {_TOKENS}, {B.LOADED}, byform AS (SELECT form, list(DISTINCT headword || sequence) AS ls FROM loaded_parses GROUP BY form), told AS (SELECT doc_id, coalesce(ls, [word]) AS ls FROM tokens LEFT JOIN byform ON byform.form = word), each AS (SELECT doc_id, len(ls) AS k, unnest(ls) AS lemma FROM told) SELECT lemma, count(*) AS max_freq, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS min_freq, round(sum(1.0 / k), 4) AS weighted_freq, count(DISTINCT doc_id) AS n_docs FROM each GROUP BY lemma")
def lemmas_of_loaded_parses(spark, d):
    """Frequencies of lemmas over all texts, by parses and a lexicon read from files; a form of no parse is its own lemma."""
    parses = _loaded_parses(spark, d).select("form", F.concat("headword", F.col("sequence").cast("string")).alias("lemma"))
    rows = A.corpus_lemmas(S.table(spark, d, "documents"), parses)
    return rows.withColumn("weighted_freq", F.round("weighted_freq", 4))


# Artifacts, images and places

_KIND = "['Building', 'Coin', 'Gem', 'Sculpture', 'Site', 'Vase', 'Other'][p_partkey % 7 + 1]"
_ARTIFACTS = f"all_artifacts AS (SELECT p_partkey, p_brand || ' &amp; ' || p_partkey AS name, {_KIND} AS type, p_type AS location, p_name AS summary, CAST(p_size % 8 - 1 AS DOUBLE) AS version FROM part), artifacts AS (SELECT * FROM all_artifacts WHERE type <> 'Other' AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND version >= 0 AND version < 5)"


def _artifacts(spark, d):
    return L.artifacts(spark, _file(B.artifact_file(spark, d), "artifacts", "artifact"))


@query(f"WITH {_ARTIFACTS} SELECT name, type, location, summary, version FROM artifacts")
def artifacts_from_files(spark, d):
    """Finished artifacts of files: those of a known type with all its fields and a version from 0 up to 5."""
    return _artifacts(spark, d)


@query(f"WITH {_ARTIFACTS} SELECT name, type, 'subject' AS keyclass, p_type AS keyword FROM artifacts JOIN part USING (p_partkey) WHERE p_size > 25 AND p_partkey % 4 <> 0")
def keywords_from_files(spark, d):
    """Keywords of a file that name an artifact by its name and type."""
    from scriptoria.operators.artifacts import keyworded

    words = L.artifact_keywords(spark, _file(B.keyword_file(spark, d), "Keywords", "artifactKeyword"))
    return keyworded(_artifacts(spark, d).select("name", "type"), words, ["name", "type"]).select("name", "type", "keyclass", "keyword")


@query(f"WITH {_ARTIFACTS} SELECT DISTINCT name, 'img.' || l_suppkey AS archive_number, CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS caption FROM artifacts JOIN lineitem ON l_partkey = p_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey")
def captioned_occurrences(spark, d):
    """Each artifact's images by any of their names, with captions; artifacts, names and images are read from files."""
    names = L.image_names(spark, _file(B.image_name_file(spark, d), "ImageNames", "image"))
    captions = L.images(spark, _file(B.image_file(spark, d), "Image", "img"))
    return L.occurrences(_artifacts(spark, d), names, captions)


_PLACES = "places AS (SELECT c_custkey, 'tgn,' || c_custkey AS authority_name, CASE WHEN c_custkey % 3 = 0 THEN 'C ' || c_name ELSE c_name END AS site, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS state, CASE WHEN c_custkey % 5 <> 0 THEN n_name END AS nation, c_nationkey * 2.0 - 20 AS lat, c_custkey % 360 - 179.5 AS lon FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def _places(spark, d):
    return L.gazetteer(spark, _file(B.gazetteer_file(spark, d), "TGN", "row"))


@query(f"WITH {_PLACES} SELECT authority_name, concat_ws(', ', site, state, nation) AS display_name, site, state, nation, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM places")
def gazetteer_places(spark, d):
    """Places of gazetteer files, with the names that they are shown by."""
    return _places(spark, d)


@query(f"WITH {_PLACES}, counted AS (SELECT site, lat, lon, count(*) AS n FROM orders JOIN places ON c_custkey = o_custkey GROUP BY ALL), top AS (SELECT * FROM counted ORDER BY n DESC, site, lat, lon LIMIT 200) SELECT site, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM top WHERE lat <> 0 AND lon <> 0")
def place_markers(spark, d):
    """The 200 most frequent places of a gazetteer as a file of markers, read again; those on the equator have no known place."""
    counts = S.table(spark, d, "orders").groupBy(F.concat(F.lit("tgn,"), F.col("o_custkey").cast("string")).alias("authority_name")).agg(F.count("*").alias("n"))
    path = L.write_markers(counts.join(_places(spark, d), "authority_name"), S.shared_folder(spark, "markers"))
    return S.places(spark, path)


@query("SELECT '<http://a/annotations/' || o_orderkey || '> a oac:Annotation ; oac:hasBody <http://a/places/nation,' || c_nationkey || '> ; oac:hasTarget <http://a/texts/Shop:text:' || c_custkey || ':order=' || o_orderkey || '> .' AS value FROM orders JOIN customer ON c_custkey = o_custkey")
def place_annotations(spark, d):
    """Mentions of places as annotations of passages, written to text files and read again."""
    people = S.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = S.table(spark, d, "orders").select("o_orderkey", "o_custkey").join(people, "o_custkey")
    rows = rows.select(F.col("o_orderkey").alias("n"), F.concat(F.lit("Shop:text:"), "o_custkey", F.lit(":order="), "o_orderkey").alias("citation"), F.concat(F.lit("nation,"), "c_nationkey").alias("place"))
    path = S.shared_folder(spark, "annotations")
    S.annotation_rdf(rows, "http://a").write.text(path)
    return spark.read.text(path)


@query("SELECT lower(o_orderstatus) AS lang, lower(regexp_extract(o_orderpriority, '[A-Z].*')) AS word, CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n FROM orders GROUP BY ALL")
def timeplot_files(spark, d):
    """Orders by year as lines of a file for each status and priority, read again."""
    rows = S.table(spark, d, "orders").groupBy(F.lower("o_orderstatus").alias("lang"), F.lower(F.regexp_extract("o_orderpriority", "[A-Z].*", 0)).alias("word"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("count"))
    path = S.shared_folder(spark, "timeplot")
    S.write_timeplot(rows, path)
    part = lambda k: F.split_part("value", F.lit(","), F.lit(k)).cast("long")
    return spark.read.schema("value string, lang string, word string").text(path).select("lang", "word", part(1).alias("year"), part(2).alias("n"))


# Orders, passages, times


_SORTED = {"total": "total DESC, doc_id", "max": "n DESC, doc_id", "max10k": "n / total * 10000 DESC, doc_id", "min": "least DESC, doc_id", "min10k": "least / total * 10000 DESC, doc_id", "name": "CAST(doc_id AS VARCHAR)"}
_PAGES = " UNION ALL ".join(f"(SELECT '{k}' AS sorted_by, row_number() OVER (ORDER BY {o}) AS place, doc_id, n, least, total FROM c QUALIFY place <= 20)" for k, o in _SORTED.items())


@query(f"WITH {_PARSED}, totals AS (SELECT doc_id, count(*) AS total FROM tokens GROUP BY ALL), c AS (SELECT doc_id, count(*) AS n, count(*) FILTER (k = 1) AS least, any_value(total) AS total FROM parsed JOIN totals USING (doc_id) WHERE lemma = 'the' GROUP BY doc_id) SELECT * FROM ({_PAGES})")
def word_frequency_pages(spark, d):
    """The first page of the documents that hold a lemma, by each of the six orders that a reader may choose."""
    lemma = "the"
    forms = _parses(spark, d).groupBy(F.col("form").alias("word")).agg(F.collect_set("lemma").alias("lemmas"))
    lemmas = F.coalesce("lemmas", F.array("word"))
    found = F.array_contains(lemmas, lemma)
    words = _tokens(spark, d).groupBy("doc_id", "word").agg(F.count("*").alias("m")).join(S.small(forms.where(F.array_contains("lemmas", lemma))), "word", "left")
    rows = words.groupBy("doc_id").agg(F.sum(F.when(found, F.col("m"))).alias("n"), F.coalesce(F.sum(F.when(found & (F.size(lemmas) == 1), F.col("m"))), F.lit(0)).alias("least"), F.sum("m").alias("total")).where("n is not null")
    rate = lambda n: A.per_ten_thousand(F.col(n), F.col("total"))
    rows = S.kept(rows.withColumns({"rate": rate("n"), "least_rate": rate("least"), "name": F.col("doc_id").cast("string")}), "frequencies")
    orders = {"total": [F.desc("total"), "doc_id"], "max": [F.desc("n"), "doc_id"], "max10k": [F.desc("rate"), "doc_id"], "min": [F.desc("least"), "doc_id"], "min10k": [F.desc("least_rate"), "doc_id"], "name": ["name"]}
    return A.first_pages(rows, orders, 20).select("sorted_by", "place", "doc_id", "n", "least", "total")


_TALKS = "talks AS (SELECT DISTINCT conv_id, conv_id // 5 AS work, CASE turn % 4 WHEN 3 THEN 'index' ELSE 'turn' END || '=' || turn AS path FROM conversations)"


@query(f"WITH {_TALKS} SELECT 'talk:' || a.conv_id AS doc_id, a.path, 'talk:' || b.conv_id || ':' || b.path AS other FROM talks a JOIN talks b ON a.work = b.work AND a.path = b.path AND a.conv_id <> b.conv_id")
def translated_passages(spark, d):
    """The same passage in the other texts of a work; five conversations are one work."""
    chunks = K.cited(K.sections(B.talk_texts(spark, d)), 1)
    number = F.split_part("doc_id", F.lit(":"), F.lit(2)).cast("long")
    rows = chunks.select("doc_id", F.floor(number / 5).alias("work"), "path").distinct()
    return W.same_passages(rows, rows)


@query("SELECT event_id, hour(ts) + event_id % 4 <= 24 AND minute(ts) + event_id % 5 <= 60 AND second(ts) - event_id % 3 >= -1 AND (event_id % 6) / 4 <= 1 AS valid FROM events")
def valid_times(spark, d):
    """Whether the parts of a time are within their bounds."""
    k = F.col("event_id")
    return S.table(spark, d, "events").select("event_id", D.is_valid_time(F.hour("ts") + k % 4, F.minute("ts") + k % 5, F.second("ts") - k % 3, (k % 6) / 4).alias("valid"))


# Arabic

_SPELT = "spelt AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM conversations)"
_LETTERS = R.BUCKWALTER.replace("'", "''")


@query(f"WITH {_SPELT}, b AS (SELECT word, translate(word, 'WIO', '&<>') AS buckwalter FROM spelt) SELECT word, translate(buckwalter, '{_LETTERS}', '{R.ARABIC}') AS arabic, replace(replace(replace(replace(buckwalter, '<i', 'A_'), '>', 'A^'), '&', 'w^'), '|', 'A=') AS dictionary, translate(word, '~FNKauio', '') AS unvowelled, TRUE AS whole FROM b")
def arabic_letters(spark, d):
    """Words read as transliterated Arabic: in Arabic letters, in the dictionary's spelling, without vowels, and whether both ways lead back."""
    rows = S.table(spark, d, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("word")).distinct()
    word = F.col("word")
    rows = rows.select("word", R.to_arabic(word).alias("arabic"), R.to_dictionary(R.unfriendly(word)).alias("dictionary"), R.unvowelled(word).alias("unvowelled"))
    return rows.withColumn("whole", (R.from_arabic(F.col("arabic")) == word) & (R.lookup(F.col("dictionary")) == word) & (R.to_arabic(F.col("dictionary")) == F.col("arabic")))


_OWNERS = "['" + "', '".join(M._AFFIXED) + "']"


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'v3s' || 'pi'[p_size % 2 + 1] || 'ia' || 'mf'[p_size % 2 + 1] || '----' || 'abcdefghijkl'[p_size % 12 + 1] || 'cer'[p_size % 3 + 1] ELSE 'n-s---' || 'mf'[p_size % 2 + 1] || 'nga'[p_size % 3 + 1] || '-' || 'abcdefghijkm'[p_size % 12 + 1] || 'd-' || CASE WHEN p_size % 5 = 0 THEN '-' ELSE 'p' END END AS code, CASE WHEN p_partkey % 2 = 0 THEN '+obj(' ELSE 'poss(' END || {_OWNERS}[p_size % 12 + 1] || ')' AS owner FROM part")
def arabic_codes(spark, d):
    """Codes of words from the features of what is written before them, of their stems and of what is joined to their ends; and the owner or object that a code tells."""
    size, verb = F.col("p_size"), F.col("p_partkey") % 2 == 0
    of = lambda values: F.get(F.array(*map(F.lit, values)), (size % len(values)).cast("int"))
    affix = lambda kind: of([*M.CODES["ar"][kind].values()][-12:])
    before = F.when(verb, F.create_map(F.lit("prefix"), of(["conj+", "emphatic+", "resultative+"]))).when(size % 5 != 0, F.create_map(F.lit("prefix"), F.lit("prep+")))
    stem = M.code_features(F.when(verb, F.concat(F.lit("v3s"), of("pi"), F.lit("ia"), of("mf"), F.lit("------"))).otherwise(F.concat(F.lit("n-s---"), of("mf"), of("nga"), F.lit("--d--"))), "ar")
    after = F.when(verb, F.create_map(F.lit("object"), affix("object"))).otherwise(F.create_map(F.lit("possessive"), affix("possessive")))
    rows = S.table(spark, d, "part").select("p_partkey", F.inline(F.array(F.struct(M.compound_features(before, stem, after).alias("parts")))))
    rows = rows.select("p_partkey", F.inline(F.array(F.struct(M.features_code(F.col("parts"), "ar").alias("code"))))).select("p_partkey", "code", F.inline(F.array(F.struct(M.code_features(F.col("code"), "ar").alias("f")))))
    return rows.select("p_partkey", "code", F.coalesce(F.try_element_at("f", F.lit("object")), F.try_element_at("f", F.lit("possessive"))).alias("owner"))
