"""Named queries over the tables of a scale-factor folder, each beside the SQL of the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.functions import dates as D
from scriptoria.functions import morphology as M
from scriptoria.functions import text as X
from scriptoria.operators import catalogue_ops as C
from scriptoria.operators import extract as E
from scriptoria.operators import frequency as A
from scriptoria.operators import index as B
from scriptoria.operators import ranks as O
from scriptoria.operators import search as Q
from scriptoria.operators import structure as J
from scriptoria.operators import votes as V
from scriptoria.plans import requests as P
from scriptoria.registry import query
from scriptoria.sources import tables as S
from scriptoria.streaming import incremental as I

#: Stop words of the default language.
STOP = ["a", "an", "and", "are", "as", "be", "by", "for", "he", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with", "you"]
_STOP = ", ".join(f"'{w}'" for w in STOP)

_LINES = "lines AS (SELECT doc_id, lang, source, generate_subscripts(ls, 1) AS line, unnest(ls) AS line_text FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))"
_TOKENS = _LINES + r""", toks AS (SELECT doc_id, lang, source, line, generate_subscripts(ws, 1) AS i, unnest(ws) AS form FROM (SELECT *, regexp_extract_all(regexp_replace(line_text, '[&_][A-Za-z]+;', ' ', 'g'), '[A-Za-z][A-Za-z\[\]]*') AS ws FROM lines)),
tokens AS (SELECT *, lower(form) AS word FROM toks)"""
_POS = _TOKENS + ", numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line, i) AS pos FROM tokens)"
_LEXICON = "lexicon AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS lemma FROM benchmark), parses AS (SELECT DISTINCT lemma || ending AS form, lemma, code FROM lexicon, (VALUES " + ", ".join(f"('{e}', '{c}')" for e, c in S.ENDINGS) + ") v(ending, code)), byform AS (SELECT form, list(DISTINCT lemma) AS ls FROM parses GROUP BY form)"
_PARSED = _TOKENS + ", " + _LEXICON + ", parsed AS (SELECT *, len(ls) AS k, unnest(ls) AS lemma FROM (SELECT t.*, coalesce(b.ls, [t.word]) AS ls FROM tokens t LEFT JOIN byform b ON b.form = t.word))"
_CHUNKS = _LINES + ", chunks AS (SELECT doc_id, lang, line, line_text, CAST(coalesce(sum(length(line_text) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_offset, CAST(sum(length(line_text) + 1) OVER (PARTITION BY doc_id ORDER BY line) - 1 AS BIGINT) AS end_offset FROM lines)"
_SECTIONS = _CHUNKS + ", sections AS (SELECT doc_id, CAST((line - 1) // 3 AS BIGINT) AS section, min(start_offset) AS start_offset, max(end_offset) AS end_offset FROM chunks GROUP BY ALL)"
_ATTRS = "attrs AS (SELECT doc_id, 'lang' AS key_name, lang AS value FROM documents WHERE lang IS NOT NULL UNION ALL SELECT doc_id, 'source', source FROM documents WHERE source IS NOT NULL UNION ALL SELECT doc_id, 'size', CAST(n_chars // 1000 AS VARCHAR) FROM documents WHERE n_chars IS NOT NULL)"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return S.spread(S.table(spark, d, "documents"))


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return S.tokens(_docs(spark, d))


def _index(spark: SparkSession, d: str) -> B.Index:
    return B.index_of(_docs(spark, d))


def _parses(spark: SparkSession, d: str) -> DataFrame:
    """A parse table: the benchmark's words as headwords, with their regular endings."""
    lexicon = S.table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("lemma")).distinct()
    return S.inflected(lexicon)


def _with_words(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold a word."""
    return _docs(spark, d).where(X.holds_word(F.col("text"))).select("doc_id", "lang")


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return S.parsed(_tokens(spark, d), _parses(spark, d))


def _parsed_by_document(spark: SparkSession, d: str) -> DataFrame:
    """_parsed() of texts dealt by doc_id, so that what is counted within a document is not shuffled by the token."""
    return S.parsed(S.tokens(S.dealt(S.table(spark, d, "documents"), "doc_id")), _parses(spark, d))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return S.line_chunks(_docs(spark, d))


def _sections(chunks: DataFrame) -> DataFrame:
    """Every three lines of a document as one section."""
    return chunks.groupBy("doc_id", F.floor((F.col("line") - 1) / 3).alias("section")).agg(F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"))


def _attributes(spark: SparkSession, d: str) -> DataFrame:
    return C.attribute_rows(_docs(spark, d).withColumn("size", F.floor(F.col("n_chars") / 1000)), "doc_id", ["lang", "source", "size"])


def _r(c, digits: int = 6):
    return F.round(c, digits)


# Vocabulary and frequencies


@query(f"WITH {_TOKENS}, n AS (SELECT lang, word, count(*) AS n FROM tokens GROUP BY ALL), w AS (SELECT *, sum(n) OVER (PARTITION BY lang ORDER BY n DESC, word ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before, sum(n) OVER (PARTITION BY lang) AS total FROM n) SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM w WHERE before < total * 0.5")
def vocab_coverage(spark, d):
    return P.vocabulary_list(_docs(spark, d), 0.5)


@query(f"WITH {_TOKENS} SELECT doc_id, lang, count(*) AS word_count FROM tokens GROUP BY ALL")
def word_counts(spark, d):
    return _tokens(spark, d).groupBy("doc_id", "lang").agg(F.count("*").alias("word_count"))


@query(f"WITH {_TOKENS}, c AS (SELECT source, lang, count(*) AS word_count FROM tokens GROUP BY ALL) SELECT *, max(word_count) OVER (PARTITION BY lang) AS max_of_collections, CAST(sum(word_count) OVER (PARTITION BY source) AS BIGINT) AS source_total FROM c")
def collection_word_counts(spark, d):
    c = _tokens(spark, d).groupBy("source", "lang").agg(F.count("*").alias("word_count"))
    return c.withColumn("max_of_collections", F.max("word_count").over(Window.partitionBy("lang"))).withColumn("source_total", F.sum("word_count").over(Window.partitionBy("source")))


@query(f"WITH {_PARSED}, f AS (SELECT doc_id, line, lemma, count(*) AS max_freq, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS min_freq, sum(1.0 / k) AS w FROM parsed GROUP BY ALL) SELECT doc_id, line, lemma, max_freq, min_freq, round(w, 6) AS weighted_freq, round(max_freq / count(*) OVER (PARTITION BY doc_id, line), 6) AS tf FROM f")
def chunk_frequencies(spark, d):
    out = A.term_frequency(A.ambiguity_counts(_parsed_by_document(spark, d), "doc_id", "line"), "doc_id", "line")
    return out.select("doc_id", "line", "lemma", "max_freq", "min_freq", _r(F.col("weighted_freq")).alias("weighted_freq"), _r(F.col("tf")).alias("tf"))


_DOCFREQ = _PARSED + ", f AS (SELECT doc_id, lang, lemma, count(*) AS max_freq, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS min_freq, sum(1.0 / k) AS w FROM parsed GROUP BY ALL)"


@query(f"WITH {_DOCFREQ} SELECT doc_id, lang, lemma, max_freq, min_freq, round(w, 6) AS weighted_freq, round(max_freq / count(*) OVER (PARTITION BY doc_id, lang), 6) AS tf FROM f")
def document_frequencies(spark, d):
    out = A.term_frequency(A.ambiguity_counts(_parsed_by_document(spark, d), "doc_id", "lang"), "doc_id", "lang")
    return out.select("doc_id", "lang", "lemma", "max_freq", "min_freq", _r(F.col("weighted_freq")).alias("weighted_freq"), _r(F.col("tf")).alias("tf"))


@query(f"WITH {_DOCFREQ} SELECT lang, lemma, CAST(sum(max_freq) AS BIGINT) AS max_freq, CAST(sum(min_freq) AS BIGINT) AS min_freq, round(sum(w), 4) AS weighted_freq FROM f GROUP BY ALL")
def corpus_frequencies(spark, d):
    out = A.ambiguity_counts(_parsed(spark, d), "lang")
    return out.withColumn("weighted_freq", _r(F.col("weighted_freq"), 4))


@query(f"WITH {_DOCFREQ}, n AS (SELECT lang, count(DISTINCT doc_id) AS n FROM f GROUP BY lang) SELECT lang, lemma, count(DISTINCT doc_id) AS doc_count, CAST(sum(max_freq) AS BIGINT) AS max_occ, CAST(sum(min_freq) AS BIGINT) AS min_occ, round(log2(any_value(n.n) / count(DISTINCT doc_id)), 6) AS idf FROM f JOIN n USING (lang) GROUP BY lang, lemma")
def lemma_idf(spark, d):
    out = A.inverse_document_frequency(A.ambiguity_counts(_parsed_by_document(spark, d), "doc_id", "lang"), _with_words(spark, d), "lang")
    return out.withColumn("idf", _r(F.col("idf")))


@query(f"WITH {_DOCFREQ}, t AS (SELECT *, max_freq / count(*) OVER (PARTITION BY doc_id, lang) AS tf FROM f), n AS (SELECT lang, count(DISTINCT doc_id) AS n FROM f GROUP BY lang), i AS (SELECT lang, lemma, log2(any_value(n.n) / count(DISTINCT doc_id)) AS idf FROM f JOIN n USING (lang) GROUP BY lang, lemma) SELECT doc_id, lang, lemma, round(tf * idf, 6) AS tf_idf FROM t JOIN i USING (lang, lemma)")
def tf_idf(spark, d):
    counts = S.kept(A.ambiguity_counts(_parsed_by_document(spark, d), "doc_id", "lang"), "counts")
    out = A.tf_idf(A.term_frequency(counts, "doc_id", "lang"), A.inverse_document_frequency(counts, _with_words(spark, d), "lang"), "lang")
    return out.select("doc_id", "lang", "lemma", _r(F.col("tf_idf")).alias("tf_idf"))


@query(f"WITH {_TOKENS}, w AS (SELECT source, word, count(*) AS n FROM tokens GROUP BY ALL) SELECT source, CAST(sum(n) AS BIGINT) AS total, count(*) AS unique_words, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS once, round(sum(n) / count(*), 6) AS density FROM w GROUP BY source")
def vocabulary_density(spark, d):
    counts = _tokens(spark, d).groupBy("source", "word").agg(F.count("*").alias("n"))
    return A.vocabulary(counts, "source").withColumn("density", _r(F.col("density")))


@query(f"WITH {_TOKENS}, t AS (SELECT lang, count(*) AS total FROM tokens GROUP BY lang) SELECT lang, word, count(*) AS n, round(count(*) / any_value(total) * 10000, 6) AS per_10k FROM tokens JOIN t USING (lang) GROUP BY lang, word")
def rates_per_10k(spark, d):
    counts = _tokens(spark, d).groupBy("lang", "word").agg(F.count("*").alias("n"))
    return A.rates(counts, "lang").withColumn("per_10k", _r(F.col("per_10k")))


@query(f"WITH {_TOKENS}, h AS (SELECT lang, word FROM tokens GROUP BY ALL HAVING count(*) = 1) SELECT lang, count(*) AS n_once FROM h GROUP BY lang")
def hapax_counts(spark, d):
    return _tokens(spark, d).groupBy("lang", "word").agg(F.count("*").alias("n")).where("n = 1").groupBy("lang").agg(F.count("*").alias("n_once"))


@query(f"WITH {_PARSED} SELECT lemma, count(DISTINCT doc_id) AS doc_count FROM parsed WHERE source IN ('src1', 'src2', 'src3') GROUP BY lemma")
def lemma_doc_counts_in_set(spark, d):
    return _parsed(spark, d).where(F.col("source").isin("src1", "src2", "src3")).groupBy("lemma").agg(F.countDistinct("doc_id").alias("doc_count"))


@query(f"WITH {_TOKENS} SELECT form, count(DISTINCT doc_id) AS doc_count FROM tokens GROUP BY form")
def form_doc_counts(spark, d):
    return _tokens(spark, d).groupBy("form").agg(F.countDistinct("doc_id").alias("doc_count"))


@query(f"WITH {_TOKENS} SELECT doc_id, form, line, i, row_number() OVER (PARTITION BY doc_id, form ORDER BY line, i) AS occurrence FROM tokens")
def token_occurrences(spark, d):
    return A.nth_occurrence(_tokens(spark, d)).select("doc_id", "form", "line", "i", "occurrence")


@query(f"WITH {_TOKENS} SELECT lang, word IN ({_STOP}) AS is_stop, count(*) AS n FROM tokens GROUP BY ALL")
def stopword_shares(spark, d):
    return _tokens(spark, d).withColumn("is_stop", F.col("word").isin(STOP)).groupBy("lang", "is_stop").agg(F.count("*").alias("n"))


@query(f"WITH {_TOKENS}, p AS (SELECT *, last_value(CASE WHEN word NOT IN ({_STOP}) THEN word END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM tokens) SELECT previous, word, count(*) AS n FROM p WHERE previous IS NOT NULL GROUP BY ALL")
def content_bigrams(spark, d):
    return A.content_pairs(_docs(spark, d), STOP)


@query("WITH p AS (SELECT unnest(CASE WHEN p_size % 2 = 0 THEN ['', 'brand=' || p_brand, 'size=' || CAST(p_size // 10 AS VARCHAR), 'brand=' || p_brand || ';size=' || CAST(p_size // 10 AS VARCHAR)] ELSE ['', 'brand=' || p_brand] END) AS subset, 1.0 / (1 + p_partkey % 3) AS w FROM part) SELECT subset, round(sum(w), 4) AS weight FROM p GROUP BY subset")
def feature_cube(spark, d):
    part = S.table(spark, d, "part").select((1.0 / (1 + F.col("p_partkey") % 3)).alias("w"), F.col("p_brand").alias("brand"), F.when(F.col("p_size") % 2 == 0, F.floor(F.col("p_size") / 10)).alias("size"))
    return A.feature_subsets(part, ["brand", "size"], "w").withColumn("weight", _r(F.col("weight"), 4))


_YEARS = _TOKENS + ", y AS (SELECT DISTINCT CAST(1990 + doc_id % 20 AS BIGINT) AS year, lang, word, doc_id FROM tokens)"


@query(f"WITH {_YEARS} SELECT year, lang, word, count(*) AS n_docs FROM y GROUP BY ALL")
def words_by_year(spark, d):
    return A.words_by_year(_tokens(spark, d).withColumn("year", F.lit(1990) + F.col("doc_id") % 20))


@query(f"WITH {_YEARS} SELECT year, lang, lpad(CAST(year AS VARCHAR), 4, '0') AS label, count(DISTINCT word) AS n_words FROM y GROUP BY ALL")
def distinct_words_by_year(spark, d):
    by = A.words_by_year(_tokens(spark, d).withColumn("year", F.lit(1990) + F.col("doc_id") % 20))
    return by.groupBy("year", "lang").agg(F.count("*").alias("n_words")).withColumn("label", D.padded_year(F.col("year")))


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ROLLUP(lang, source)")
def counts_at_three_grains(spark, d):
    return _docs(spark, d).rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(f"WITH {_PARSED} SELECT k, count(*) AS n_pairs, count(DISTINCT word) AS n_words FROM parsed GROUP BY k")
def ambiguity_levels(spark, d):
    return _parsed(spark, d).groupBy(F.col("k").cast("long").alias("k")).agg(F.count("*").alias("n_pairs"), F.countDistinct("word").alias("n_words"))


@query(f"WITH {_POS}, e AS (SELECT doc_id, form AS entity, count(*) AS n, min(pos) AS first_pos FROM numbered WHERE regexp_matches(form, '^[A-Z][a-z]{{3,}}$') AND i > 1 GROUP BY ALL) SELECT * FROM e")
def entity_tuples(spark, d):
    return E.entity_counts(S.numbered(_tokens(spark, d)), ["doc_id"])


@query(f"WITH {_TOKENS}, n AS (SELECT lang, word, count(*) AS n FROM tokens GROUP BY ALL) SELECT lang, word, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM n) WHERE rank <= 200")
def top_words(spark, d):
    n = _tokens(spark, d).groupBy("lang", "word").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where("rank <= 200")


# Structure


@query(f"WITH {_CHUNKS} SELECT doc_id, line, start_offset, end_offset, md5(line_text) AS digest FROM chunks")
def chunk_spans(spark, d):
    return _chunks(spark, d).select("doc_id", "line", "start_offset", "end_offset", F.md5("line_text").alias("digest"))


@query(f"WITH {_CHUNKS} SELECT c.doc_id, line, substring(text, CAST(start_offset + 1 AS BIGINT), CAST(end_offset - start_offset AS BIGINT)) = line_text AS same FROM chunks c JOIN documents d ON c.doc_id = d.doc_id")
def span_text(spark, d):
    rows = _chunks(spark, d).join(_docs(spark, d).select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", "line", (F.substring("text", F.col("start_offset") + 1, F.col("end_offset") - F.col("start_offset")) == F.col("line_text")).alias("same"))


@query(f"WITH {_SECTIONS} SELECT s.doc_id, section, count(*) AS n_lines FROM sections s JOIN chunks c ON s.doc_id = c.doc_id AND c.start_offset BETWEEN s.start_offset AND s.end_offset GROUP BY ALL")
def contained_chunks(spark, d):
    chunks = _chunks(spark, d)
    pairs = J.bucketed_range_join(_sections(chunks), chunks, "doc_id", J.contains())
    return pairs.groupBy(F.col("o.doc_id").alias("doc_id"), "section").agg(F.count("*").alias("n_lines"))


@query(f"WITH {_CHUNKS}, w AS (SELECT doc_id, CAST(unnest(generate_series(0, CAST(length(text) // 500 AS BIGINT))) AS BIGINT) AS win FROM documents) SELECT c.doc_id, win, count(*) AS n_lines FROM chunks c JOIN w ON c.doc_id = w.doc_id AND win * 500 < c.end_offset AND win * 500 + 500 > c.start_offset GROUP BY ALL")
def overlapping_chunks(spark, d):
    windows = _docs(spark, d).where("text is not null").select("doc_id", F.explode(F.expr("sequence(0L, cast(length(text) div 500 as bigint))")).alias("win"))
    windows = windows.withColumn("start_offset", F.col("win") * 500).withColumn("end_offset", F.col("win") * 500 + 500)
    pairs = J.bucketed_range_join(windows, _chunks(spark, d), "doc_id", J.overlaps())
    return pairs.groupBy(F.col("o.doc_id").alias("doc_id"), "win").agg(F.count("*").alias("n_lines"))


@query(f"WITH {_SECTIONS} SELECT c.doc_id, c.line, arg_max(section, s.start_offset) AS section FROM chunks c JOIN sections s ON c.doc_id = s.doc_id AND s.start_offset <= c.start_offset AND s.end_offset >= c.end_offset GROUP BY c.doc_id, c.line")
def containing_section(spark, d):
    chunks = _chunks(spark, d)
    return J.nearest_container(_sections(chunks), chunks, "doc_id", ("section", "line"))


@query(f"WITH {_SECTIONS} SELECT s.doc_id, section, count(*) AS n FROM sections s JOIN chunks c ON s.doc_id = c.doc_id AND s.start_offset <= c.start_offset AND s.end_offset >= c.end_offset AND NOT (s.start_offset = c.start_offset AND s.end_offset = c.end_offset) GROUP BY ALL")
def strictly_contained(spark, d):
    chunks = _chunks(spark, d)
    pairs = J.bucketed_range_join(_sections(chunks), chunks, "doc_id", J.strictly_contains())
    return pairs.groupBy(F.col("o.doc_id").alias("doc_id"), "section").agg(F.count("*").alias("n"))


@query("WITH v AS (SELECT l_suppkey AS k, CAST(l_partkey AS BIGINT) AS v FROM lineitem WHERE l_partkey IS NOT NULL), q AS (SELECT DISTINCT l_suppkey AS k, CAST(l_quantity AS BIGINT) * 37 AS lookup FROM lineitem) SELECT q.k, lookup, coalesce(max(CASE WHEN v <= lookup THEN v END), min(v)) AS found FROM q JOIN v ON q.k = v.k GROUP BY q.k, lookup")
def preceding_value(spark, d):
    lines = S.table(spark, d, "lineitem")
    values = lines.where("l_partkey is not null").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").cast("long").alias("v"))
    lookups = lines.select(F.col("l_suppkey").alias("k"), (F.col("l_quantity").cast("long") * 37).alias("lookup")).distinct()
    return J.predecessor(values, lookups, "k", "v", "lookup")


@query(f"WITH {_CHUNKS} SELECT doc_id, line, lag(line) OVER w AS previous, lead(line) OVER w AS next, row_number() OVER w AS nth FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY start_offset)")
def neighbouring_chunks(spark, d):
    return J.neighbours(_chunks(spark, d), ["doc_id"], "start_offset", "line").select("doc_id", "line", "previous", "next", "nth")


@query(f"WITH {_CHUNKS} SELECT doc_id, CAST((line - 1) // 3 AS BIGINT) AS section, arg_min(line, start_offset) AS first, count(*) AS n_children FROM chunks GROUP BY ALL")
def first_chunks(spark, d):
    return J.first_in(_chunks(spark, d).withColumn("section", F.floor((F.col("line") - 1) / 3)), ["doc_id", "section"], "start_offset", "line")


@query(f"WITH {_SECTIONS}, a AS (SELECT doc_id, 'section' AS chunk_type, section AS value, start_offset, end_offset FROM sections UNION ALL SELECT doc_id, 'line', line, start_offset, end_offset FROM chunks) SELECT doc_id, chunk_type, value, row_number() OVER (PARTITION BY doc_id ORDER BY start_offset, end_offset DESC, chunk_type, value) AS place FROM a")
def document_order(spark, d):
    chunks = _chunks(spark, d)
    both = _sections(chunks).select("doc_id", F.lit("section").alias("chunk_type"), F.col("section").alias("value"), "start_offset", "end_offset").unionByName(chunks.select("doc_id", F.lit("line").alias("chunk_type"), F.col("line").cast("long").alias("value"), "start_offset", "end_offset"))
    return J.document_order(both).select("doc_id", "chunk_type", "value", "place")


@query(f"WITH {_SECTIONS}, b AS (SELECT doc_id, 0 AS id, min(start_offset) AS s, max(end_offset) AS e FROM chunks GROUP BY doc_id), p AS (SELECT s.doc_id, s.section AS child, b.id AS parent, 0 AS depth FROM sections s JOIN b ON s.doc_id = b.doc_id UNION ALL SELECT c.doc_id, c.line, arg_min(s.section, s.start_offset), 1 FROM chunks c JOIN sections s ON c.doc_id = s.doc_id AND s.end_offset >= c.start_offset AND s.start_offset <= c.start_offset GROUP BY c.doc_id, c.line) SELECT * FROM p")
def table_of_contents(spark, d):
    chunks = _chunks(spark, d)
    book = chunks.groupBy("doc_id").agg(F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset")).withColumn("id", F.lit(0).cast("long"))
    sections = _sections(chunks).withColumnRenamed("section", "id")
    return J.contents([book, sections, chunks.select("doc_id", F.col("line").cast("long").alias("id"), "start_offset", "end_offset")], "doc_id").select("doc_id", "child", "parent", "depth")


@query(f"WITH {_TOKENS}, v AS (SELECT DISTINCT word, substring(word, 1, 1) AS letter FROM tokens), g AS (SELECT *, CAST((row_number() OVER (PARTITION BY letter ORDER BY word) - 1) // 50 AS BIGINT) AS group_no FROM v) SELECT letter, group_no, min(word) || ' - ' || max(word) AS heading, count(*) AS n_entries FROM g GROUP BY ALL")
def entry_groups(spark, d):
    v = _tokens(spark, d).select("word").distinct().withColumn("letter", F.substring("word", 1, 1))
    return J.grouped_entries(v, "letter", "word")


@query("SELECT conv_id, turn, role, lag(role) OVER w AS previous_role, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS user_turns FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def conversation_turns(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return S.table(spark, d, "conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("previous_role"), F.sum((F.col("role") == "user").cast("long")).over(w).alias("user_turns"))


# Search


@query(f"WITH {_TOKENS} SELECT lang, word, doc_id, line, count(*) AS n FROM tokens GROUP BY ALL")
def postings(spark, d):
    return Q.postings(_tokens(spark, d))


@query(f"WITH {_TOKENS} SELECT doc_id, line FROM tokens WHERE word IN ('the', 'and', 'of') GROUP BY ALL HAVING count(DISTINCT word) = 3")
def search_all_words(spark, d):
    return B.matches(_index(spark, d), ["doc_id", "line"], required=["the", "and", "of"])


@query(f"WITH {_TOKENS} SELECT DISTINCT doc_id, line FROM tokens WHERE word IN ('pour', 'avec', 'por')")
def search_any_words(spark, d):
    return B.matches(_index(spark, d), ["doc_id", "line"], allowed=["pour", "avec", "por"])


@query(f"WITH {_TOKENS} SELECT doc_id, line FROM tokens GROUP BY ALL HAVING bool_or(word = 'the') AND bool_or(word IN ('with', 'by')) AND NOT bool_or(word = 'of')")
def search_boolean(spark, d):
    return B.matches(_index(spark, d), ["doc_id", "line"], ["the"], ["with", "by"], ["of"])


@query(f"WITH {_TOKENS} SELECT a.doc_id, a.line, a.i FROM tokens a JOIN tokens b ON a.doc_id = b.doc_id AND a.line = b.line AND b.i = a.i + 1 WHERE a.word = 'of' AND b.word = 'the'")
def search_phrase(spark, d):
    return B.phrase_starts(_index(spark, d), ["of", "the"], ["doc_id", "line"]).select("doc_id", "line", F.explode("starts").alias("i"))


@query(f"WITH {_PARSED}, forms AS (SELECT DISTINCT lemma, word FROM parsed), q AS (SELECT unnest(['anatnd', 'theaing', 'thering']) AS word), l AS (SELECT DISTINCT lemma, q.word AS asked FROM forms JOIN q USING (word)) SELECT DISTINCT asked, word FROM forms JOIN l USING (lemma)")
def search_expanded_forms(spark, d):
    forms = _parsed(spark, d).select("lemma", "word").distinct()
    return Q.expanded(forms, spark.createDataFrame([("anatnd",), ("theaing",), ("thering",)], "word string"))


@query(f"WITH {_TOKENS}, h AS (SELECT DISTINCT doc_id, line FROM tokens WHERE word = 'the'), r AS (SELECT *, dense_rank() OVER (ORDER BY doc_id) AS doc_rank FROM h) SELECT doc_rank, doc_id, line FROM r WHERE doc_rank BETWEEN 11 AND 20")
def search_page(spark, d):
    return P.corpus_search(_index(spark, d), required=["the"], page=2, size=10).withColumn("doc_rank", F.col("doc_rank").cast("long"))


@query(f"WITH {_TOKENS} SELECT doc_id, count(DISTINCT line) AS n_hits FROM tokens WHERE word = 'the' GROUP BY doc_id")
def hits_per_document(spark, d):
    return B.matches(_index(spark, d), ["doc_id", "line"], ["the"]).groupBy("doc_id").agg(F.count("*").alias("n_hits"))


@query(f"WITH {_TOKENS} SELECT DISTINCT doc_id, line FROM tokens WHERE word = 'the' AND source IN ('src1', 'src2')")
def search_in_collections(spark, d):
    return B.matches(_index(spark, d), ["source", "doc_id", "line"], ["the"]).where(F.col("source").isin("src1", "src2")).select("doc_id", "line").distinct()


@query(f"WITH {_TOKENS} SELECT word AS term, count(DISTINCT (doc_id, line)) AS n_lines, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM tokens GROUP BY 1")
def search_index(spark, d):
    """The index itself: its lists by term."""
    lists = _index(spark, d).all_postings().groupBy("term", "doc_id").agg(F.count("*").alias("lines"), F.sum(F.size("positions")).alias("n"))
    return lists.groupBy("term").agg(F.sum("lines").alias("n_lines"), F.sum("n").alias("n"), F.count("*").alias("n_docs"))


@query(f"WITH {_TOKENS} SELECT DISTINCT a.doc_id FROM tokens a JOIN tokens b ON a.doc_id = b.doc_id AND a.line = b.line AND b.i = a.i + 1 JOIN tokens c ON c.doc_id = a.doc_id AND c.line = a.line AND c.i = b.i + 1 WHERE a.word = 'is' AND b.word = 'of' AND c.word = 'the' AND a.doc_id NOT IN (SELECT doc_id FROM tokens WHERE word = 'by')")
def search_phrase_without(spark, d):
    """Documents with a phrase and without a word, from the index."""
    return B.matches(_index(spark, d), ["doc_id"], phrases=[["is", "of", "the"]], excluded=["by"])


@query(f"WITH {_TOKENS}, lines_left AS (SELECT doc_id, line FROM lines EXCEPT SELECT doc_id, line FROM tokens WHERE word IN ('the', 'de', 'die', 'of')) SELECT doc_id, count(*) AS n FROM lines_left GROUP BY doc_id")
def search_only_excluded(spark, d):
    """Lines without any of some words, counted by document."""
    return B.matches(_index(spark, d), ["doc_id", "line"], excluded=["the", "de", "die", "of"]).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(f"""WITH {_TOKENS}, asked AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM benchmark WHERE item_id % 100 = 0),
tf AS (SELECT word AS term, doc_id, count(*) AS tf FROM tokens GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
sizes AS (SELECT d.doc_id, count(t.doc_id) AS length FROM (SELECT DISTINCT doc_id FROM lines) d LEFT JOIN tokens t USING (doc_id) GROUP BY 1), every AS (SELECT count(*) AS n, avg(length) AS mean FROM sizes),
scores AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {B.K1 + 1} / (tf + {B.K1} * ({1 - B.B} + {B.B} * length / mean))), 6) AS score FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN sizes USING (doc_id), every GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS place FROM scores)
SELECT query_id, doc_id, round(score, 4) AS score, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 20""")
def relevance_ranking(spark, d):
    """The twenty best documents for each benchmark item whose id is divisible by 100, as a bag of words."""
    asked = S.table(spark, d, "benchmark").where("item_id % 100 = 0").select(F.col("item_id").alias("query_id"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("term"))
    return B.relevance(_index(spark, d), asked, 20).select("query_id", "doc_id", F.round("score", 4).alias("score"), "place")


_TYPED = _POS + """, asked AS (SELECT doc_id AS query_id, doc_id // 100 % 4 AS k, max(word) FILTER (pos = 1) AS a, max(word) FILTER (pos = 2) AS b, max(word) FILTER (pos = 3) AS c FROM numbered WHERE doc_id % 100 = 0 GROUP BY ALL HAVING c IS NOT NULL)"""


def _typed(spark, d):
    """A line as a reader types it for each document whose id is divisible by 100: two words; a phrase; a word without another; or the document's id."""
    ws = F.transform(X.words(F.col("text")), lambda w: F.lower(w))
    rows = _docs(spark, d).where("doc_id % 100 = 0").select("doc_id", ws.alias("w")).where("size(w) > 2")
    k, w = F.floor(F.col("doc_id") / 100) % 4, lambda i: F.element_at("w", i)
    line = F.when(k == 0, F.concat_ws(" ", w(1), w(3))).when(k == 1, F.concat(F.lit('"'), w(1), F.lit(" "), w(2), F.lit('"'))).when(k == 2, F.concat(w(1), F.lit(" -"), w(2))).otherwise(F.concat(F.lit("Shop:text:"), "doc_id", F.lit(":line=2")))
    return rows.select(F.col("doc_id").alias("query_id"), line.alias("line"))


@query(f"""WITH {_TYPED}, t AS (SELECT DISTINCT doc_id, line, word FROM tokens)
SELECT query_id, doc_id, line FROM asked JOIN t x ON x.word = a JOIN t y USING (doc_id, line) WHERE k = 0 AND y.word = c
UNION ALL SELECT DISTINCT query_id, x.doc_id, x.line FROM asked JOIN tokens x ON x.word = a JOIN tokens y ON y.doc_id = x.doc_id AND y.line = x.line AND y.i = x.i + 1 AND y.word = b WHERE k = 1
UNION ALL SELECT query_id, x.doc_id, x.line FROM asked JOIN t x ON x.word = a WHERE k = 2 AND a <> b AND NOT EXISTS (SELECT 1 FROM t y WHERE y.doc_id = x.doc_id AND y.line = x.line AND y.word = b)""")
def typed_searches(spark, d):
    """What typed lines find, all of them answered at once from the index."""
    return B.line_hits(_index(spark, d), S.kept(B.line_plans(_typed(spark, d)), "plans"))


@query("WITH r AS (SELECT conv_id, turn, role, CASE WHEN lag(role) OVER w IS DISTINCT FROM role THEN 1 ELSE 0 END AS c FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, role, CAST(sum(c) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS run FROM r")
def hit_runs(spark, d):
    return Q.runs(S.table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], "role").withColumn("run", F.col("run").cast("long"))


@query("SELECT doc_id, substring(text, greatest(strpos(lower(text), ' the ') - 40, 1), least(strpos(lower(text), ' the ') - 1, 40) + 45) AS kwic FROM documents WHERE strpos(lower(text), ' the ') > 0")
def keyword_in_context(spark, d):
    return _docs(spark, d).select("doc_id", Q.in_context(F.col("text"), " the ", 40).alias("kwic")).where("kwic is not null")


@query()
def highlighted_hits(spark, d):
    rows = _docs(spark, d).select("doc_id", X.words(F.col("text")).alias("words"))
    return Q.highlighted(rows, "words", ["the", "and"], 5, 3).where("snippet is not null").select("doc_id", "snippet")


@query(f"WITH {_TOKENS}, v AS (SELECT DISTINCT word FROM tokens) SELECT word, starts_with(word, 'the') AS at_start, suffix(word, 'ing') AS at_end FROM v WHERE starts_with(word, 'the') OR suffix(word, 'ing')")
def lexicon_search(spark, d):
    v = _tokens(spark, d).select("word").distinct()
    hits = Q.headword_search(v, "word", "the", "start").union(Q.headword_search(v, "word", "ing", "end")).distinct()
    return hits.select("word", F.startswith("word", F.lit("the")).alias("at_start"), F.endswith("word", F.lit("ing")).alias("at_end"))


@query("SELECT p_partkey, p_type FROM part WHERE contains(lower(concat_ws(chr(10), p_name, p_brand, p_type)), '1') AND contains(lower(concat_ws(chr(10), p_name, p_brand, p_type)), 'brand')")
def contents_search(spark, d):
    return Q.contents_search(S.table(spark, d, "part"), ["p_name", "p_brand", "p_type"], ["1", "Brand"]).select("p_partkey", "p_type")


@query("SELECT p_type, count(*) AS n_hits FROM part WHERE contains(lower(concat_ws(chr(10), p_name, p_brand)), '2') GROUP BY p_type")
def hits_by_type(spark, d):
    return Q.contents_search(S.table(spark, d, "part"), ["p_name", "p_brand"], ["2"]).groupBy("p_type").agg(F.count("*").alias("n_hits"))


@query("WITH q AS (SELECT item_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS phrase FROM benchmark), t AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') || ' ' AS words FROM documents) SELECT DISTINCT item_id, doc_id FROM q JOIN t ON contains(words, ' ' || phrase || ' ') WHERE phrase <> ''")
def benchmark_phrases(spark, d):
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))
    phrases = S.table(spark, d, "benchmark").select("item_id", words(F.col("text")).alias("phrase"))
    return Q.whole_phrases(_docs(spark, d).select("doc_id", words(F.col("text")).alias("words")), phrases, "doc_id", "item_id")


# Metadata, predicates, facets


@query(f"WITH {_ATTRS} SELECT * FROM attrs")
def metadata_rows(spark, d):
    return _attributes(spark, d)


@query(f"WITH {_ATTRS} SELECT DISTINCT doc_id FROM attrs WHERE key_name = 'source' AND value IN ('src3', 'src4')")
def documents_by_metadata(spark, d):
    return C.documents_with(_attributes(spark, d), "doc_id", "source", ["src3", "src4"])


@query(f"WITH {_ATTRS} SELECT key_name, count(DISTINCT value) AS n_values, min(value) AS least, max(value) AS greatest FROM attrs GROUP BY key_name")
def metadata_values(spark, d):
    return _attributes(spark, d).groupBy("key_name").agg(F.countDistinct("value").alias("n_values"), F.min("value").alias("least"), F.max("value").alias("greatest"))


@query(f"WITH {_ATTRS} SELECT doc_id, max(CASE WHEN key_name = 'lang' THEN value END) AS lang, max(CASE WHEN key_name = 'size' THEN value END) AS size, count(*) AS n_keys FROM attrs GROUP BY doc_id")
def folded_metadata(spark, d):
    m = C.folded_attributes(_attributes(spark, d), "doc_id")
    return m.select("doc_id", F.try_element_at("metadata", F.lit("lang"))[0].alias("lang"), F.try_element_at("metadata", F.lit("size"))[0].alias("size"), F.size("metadata").cast("long").alias("n_keys"))


@query(f"WITH {_ATTRS}, m AS (SELECT DISTINCT doc_id FROM attrs WHERE key_name = 'lang' AND value = 'de') SELECT m.doc_id, string_agg(DISTINCT value, ', ' ORDER BY value) AS creators FROM m JOIN attrs USING (doc_id) WHERE key_name = 'source' GROUP BY m.doc_id")
def creators_of_members(spark, d):
    return C.creators_of_members(_attributes(spark, d), "doc_id", ("lang", "de"), "source")


@query("WITH c AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source) SELECT source, chars, CAST(floor(100 * chars / (SELECT max(chars) FROM c)) AS BIGINT) AS percent FROM c")
def collection_bar_chart(spark, d):
    return C.bar_chart(_docs(spark, d).groupBy("source").agg(F.sum("n_chars").alias("chars")), "chars")


@query("SELECT p_brand AS value, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand")
def facet_counts(spark, d):
    return C.facet_counts(S.table(spark, d, "part"), "p_brand")


@query("SELECT p_type AS value, count(*) AS n FROM part GROUP BY p_type ORDER BY p_type LIMIT 3 OFFSET 3")
def facet_page(spark, d):
    return C.facet_page(C.facet_counts(S.table(spark, d, "part"), "p_type"), 2, 3)


@query("SELECT p_type, count(DISTINCT p_brand) AS n_brands, count(DISTINCT p_size) AS n_sizes, count(*) AS n FROM part GROUP BY p_type")
def keyword_classes(spark, d):
    return S.table(spark, d, "part").groupBy("p_type").agg(F.countDistinct("p_brand").alias("n_brands"), F.countDistinct("p_size").alias("n_sizes"), F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE lower(c_mktsegment) = 'building' AND c_nationkey = 3")
def query_by_example(spark, d):
    return S.table(spark, d, "customer").where(C.by_example({"c_mktsegment": "Building", "c_nationkey": 3, "c_name": None})).select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE starts_with(lower(c_name), 'customer') AND suffix(c_name, '7') AND contains(lower(c_name), '1')")
def name_predicates(spark, d):
    c = F.col("c_name")
    return S.table(spark, d, "customer").where(C.matches(c, "Customer", "start") & C.matches(c, "7", "end", True) & C.matches(c, "1", "anywhere")).select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) BETWEEN 3 AND 5")
def date_components(spark, d):
    day = F.struct(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"))
    part = lambda y, m: F.struct(F.lit(y).alias("year"), F.lit(m).alias("month"), F.lit(None).cast("int").alias("day"))
    return S.table(spark, d, "orders").where(D.within(day, part(1995, 3), part(1995, 5))).select("o_orderkey")


@query("SELECT a.p_brand AS brand, count(*) AS n_old, CAST(sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS BIGINT) AS n_new, CASE WHEN sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) = 0 THEN 'delete' WHEN sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) <> count(*) THEN 'update' ELSE 'keep' END AS action FROM part a GROUP BY a.p_brand")
def upsert_actions(spark, d):
    part = S.table(spark, d, "part").withColumnRenamed("p_brand", "brand")
    old, new = part.groupBy("brand").agg(F.count("*").alias("n")), part.where("p_size > 25").groupBy("brand").agg(F.count("*").alias("n"))
    return C.upserted(old, new, ["brand"], "n").join(old.withColumnRenamed("n", "n_old"), "brand").select("brand", "n_old", F.coalesce("n", F.lit(0)).alias("n_new"), "action")


@query("SELECT c_mktsegment AS k, CAST(count(*) + sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM customer GROUP BY c_mktsegment")
def added_counts(spark, d):
    c = S.table(spark, d, "customer").withColumnRenamed("c_mktsegment", "k")
    count = lambda rows: rows.groupBy("k").agg(F.count("*").alias("n"))
    return C.added(count(c), count(c.where("c_acctbal > 0")), ["k"], "n")


@query("SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id, event_type")
def last_votes(spark, d):
    return C.last_of_each(S.table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["value"])


@query("SELECT DISTINCT c_name AS name FROM customer WHERE c_acctbal > 5000 EXCEPT SELECT c_name FROM customer WHERE c_nationkey < 10")
def names_to_add(spark, d):
    c = S.table(spark, d, "customer").withColumnRenamed("c_name", "name")
    return C.missing_names(c.where("c_nationkey < 10"), c.where("c_acctbal > 5000"), "name")


@query("SELECT a.doc_id, count(*) AS n_alike FROM documents a JOIN documents b ON a.source = b.source AND a.lang = b.lang AND a.doc_id <> b.doc_id GROUP BY a.doc_id")
def translations(spark, d):
    docs = _docs(spark, d).select("doc_id", "source", "lang")
    sizes = docs.groupBy("source", "lang").agg((F.count("*") - 1).alias("n_alike"))
    return docs.join(sizes, ["source", "lang"]).where("n_alike > 0").select("doc_id", "n_alike")


@query("WITH r AS (SELECT doc_id, lang, CASE WHEN lag(lang) OVER (PARTITION BY source ORDER BY doc_id) IS DISTINCT FROM lang THEN 1 ELSE 0 END AS s, source FROM documents) SELECT doc_id, source, lang, CAST(sum(s) OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS run FROM r")
def listing_runs(spark, d):
    return O.runs(_docs(spark, d).select("doc_id", "source", "lang"), ["source"], [F.col("doc_id")], "lang")


# Votes and disambiguation


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS choice, count(*) AS votes FROM events GROUP BY ALL")
def choice_votes(spark, d):
    votes = S.table(spark, d, "events").withColumn("choice", F.get_json_object("props", "$.k").cast("long") % 5)
    return V.vote_counts(votes, "event_type", "choice")


@query("SELECT user_id, CASE WHEN value < 10 THEN NULL ELSE event_type END AS choice, count(*) AS votes FROM events GROUP BY ALL")
def entity_votes(spark, d):
    return V.vote_counts(S.table(spark, d, "events").withColumn("choice", F.when(~(F.col("value") < 10), F.col("event_type"))), "user_id", "choice")


@query("WITH s AS (SELECT DISTINCT user_id, event_type FROM events), v AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE value > 150 GROUP BY ALL) SELECT s.user_id, s.event_type, coalesce(n, 0) AS votes FROM s LEFT JOIN v ON s.user_id = v.user_id AND s.event_type = v.event_type")
def sense_votes(spark, d):
    e = S.table(spark, d, "events")
    return V.sense_votes(e.select("user_id", "event_type").distinct(), e.where("value > 150"), ["user_id", "event_type"])


_SCORES = "s AS (SELECT user_id, event_type, 'count' AS evaluator, CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY ALL UNION ALL SELECT user_id, event_type, 'high', CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS DOUBLE) FROM events GROUP BY ALL)"


@query(f"WITH {_SCORES} SELECT user_id, event_type, evaluator, round(CASE WHEN sum(x) OVER (PARTITION BY user_id, evaluator) = 0 THEN 0 ELSE x / sum(x) OVER (PARTITION BY user_id, evaluator) END, 6) AS share FROM s")
def evaluator_shares(spark, d):
    return V.shares(_scores(spark, d), ["user_id", "evaluator"], "x").select("user_id", "event_type", "evaluator", _r(F.col("share")).alias("share"))


@query(f"WITH {_SCORES}, m AS (SELECT user_id, event_type, avg(x) AS mean FROM s GROUP BY ALL) SELECT user_id, event_type, round(mean, 6) AS mean_score, round(CASE WHEN sum(mean) OVER (PARTITION BY user_id) > 0 THEN mean / sum(mean) OVER (PARTITION BY user_id) ELSE mean END, 6) AS final_score, row_number() OVER (PARTITION BY user_id ORDER BY mean DESC, event_type) = 1 AS is_best FROM m")
def selected_parse(spark, d):
    out = V.selected(_scores(spark, d), ["user_id"], "event_type", "x")
    return out.select("user_id", "event_type", _r(F.col("mean_score")).alias("mean_score"), _r(F.col("final_score")).alias("final_score"), "is_best")


def _scores(spark, d):
    e = S.table(spark, d, "events").groupBy("user_id", "event_type")
    return e.agg(F.count("*").cast("double").alias("x")).withColumn("evaluator", F.lit("count")).unionByName(e.agg(F.sum((F.col("value") > 50).cast("double")).alias("x")).withColumn("evaluator", F.lit("high")))


@query("WITH p AS (SELECT DISTINCT p_type, p_brand, p_size FROM part), n AS (SELECT p_type, count(DISTINCT p_brand) AS n FROM p GROUP BY p_type), c AS (SELECT p_type, p_size, count(DISTINCT p_brand) AS c FROM p GROUP BY ALL), m AS (SELECT p.*, c < n AS own FROM p JOIN c USING (p_type, p_size) JOIN n USING (p_type)) SELECT p_type, p_brand, p_size FROM m WHERE own OR NOT (SELECT bool_or(own) FROM m m2 WHERE m2.p_type = m.p_type)")
def distinguishing_features(spark, d):
    p = S.table(spark, d, "part").select("p_type", "p_brand", "p_size").distinct()
    return V.distinguishing(p, ["p_type"], "p_size", "p_brand").select("p_type", "p_brand", "p_size")


@query("WITH c AS (SELECT c_nationkey, c_custkey AS entity_id, c_custkey % 4 AS votes, c_mktsegment = 'BUILDING' AS is_current, c_acctbal AS max_occ FROM customer) SELECT c_nationkey, entity_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY votes DESC, is_current DESC, max_occ DESC, entity_id) AS place FROM c")
def ranked_candidates(spark, d):
    c = S.table(spark, d, "customer").select("c_nationkey", F.col("c_custkey").alias("entity_id"), (F.col("c_custkey") % 4).alias("votes"), (F.col("c_mktsegment") == "BUILDING").alias("is_current"), F.col("c_acctbal").alias("max_occ"))
    return V.ranked_candidates(c, "c_nationkey").select("c_nationkey", "entity_id", "place")


@query(f"WITH {_LINES}, c AS (SELECT doc_id, count(*) AS n_chunks, CAST(sum(CASE WHEN trim(line_text) = '' OR contains(line_text, '|') THEN 1 ELSE 0 END) AS BIGINT) AS n_failed FROM lines GROUP BY doc_id) SELECT *, CASE WHEN n_failed = 0 THEN 'SUCCESS' WHEN n_failed = n_chunks THEN 'FAILURE' ELSE 'CHILD_FAILURE' END AS status FROM c")
def corpus_verification(spark, d):
    chunks = _chunks(spark, d).withColumn("failed", (F.trim("line_text") == "") | F.col("line_text").contains("|"))
    return V.verified(chunks, "doc_id", "failed")


# Extraction and links

_LINKS = r"""links AS (SELECT page_id, generate_subscripts(ts, 1) AS n, unnest(ts) AS target FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS ts FROM pages))"""


@query(f"WITH {_LINKS} SELECT page_id, n, target FROM links")
def page_links(spark, d):
    return E.links(S.table(spark, d, "pages")).select("page_id", "n", "target")


@query(f"WITH {_LINKS}, e AS (SELECT DISTINCT CAST(page_id AS VARCHAR) AS s, target AS t FROM links) SELECT node, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) AS BIGINT) AS n_in FROM (SELECT s AS node, count(*) AS o, 0 AS i FROM e GROUP BY s UNION ALL SELECT t, 0, count(*) FROM e GROUP BY t) GROUP BY node")
def citation_degrees(spark, d):
    edges = E.links(S.table(spark, d, "pages")).select(F.col("page_id").cast("string").alias("source"), F.col("target").alias("destination"))
    return E.degrees(edges)


@query(r"""SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS title FROM pages""")
def page_headers(spark, d):
    return E.header(S.table(spark, d, "pages")).select("page_id", "lang", "title")


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n FROM pages")
def tagless_text(spark, d):
    return S.table(spark, d, "pages").select("page_id", F.length(X.without_tags(F.col("html"))).cast("long").alias("n"))


# Functions


@query(f"WITH {_LINES.replace('lines AS', 'ls0 AS')}, u AS (SELECT DISTINCT unnest(regexp_extract_all(line_text, '\\p{{L}}+')) AS word FROM ls0) SELECT word, replace(replace(replace(replace(translate(word, '{X.ACCENTED}', '{X.PLAIN}'), 'æ', 'ae'), 'œ', 'oe'), 'Æ', 'AE'), 'Œ', 'OE') AS plain, translate(word, '{X.MACRONS}', '{X.WITHOUT}') AS short FROM u")
def folded_words(spark, d):
    rows = S.tokens(_docs(spark, d), "unicode").select(F.col("form").alias("word")).distinct()
    return rows.select("word", X.deaccent(F.col("word")).alias("plain"), X.drop_macrons(F.col("word")).alias("short"))


@query("SELECT p_partkey, replace(replace(replace(p_name || '<' || p_type || '&', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped, concat_ws(' ', nullif(p_brand, ''), p_type) AS joined, CASE WHEN length(p_name) > 12 THEN substring(p_name, 1, 9) || '...' ELSE p_name END AS short FROM part")
def text_functions(spark, d):
    name = F.col("p_name")
    return S.table(spark, d, "part").select("p_partkey", X.xml_escaped(F.concat(name, F.lit("<"), "p_type", F.lit("&"))).alias("escaped"), X.join_present(" ", F.col("p_brand"), F.col("p_type")).alias("joined"), X.short_definition(name, 12).alias("short"))


@query("SELECT o_orderkey, lpad(CAST(year(o_orderdate) AS VARCHAR), 4, '0') || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') AS authority, CAST(year(o_orderdate) AS BIGINT) AS y FROM orders")
def authority_dates(spark, d):
    parsed = D.partial_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return S.table(spark, d, "orders").select("o_orderkey", D.authority_date(parsed).alias("authority"), parsed["year"].cast("long").alias("y"))


_CITED = "cited AS (SELECT l_orderkey, l_linenumber, 'Shop:order:' || l_orderkey || ':part=' || l_partkey || ':line=' || l_linenumber AS c FROM lineitem), split AS (SELECT *, string_split(c, ':') AS parts FROM cited)"


@query(f"WITH {_CITED} SELECT l_orderkey, l_linenumber, array_to_string(list_filter(parts, lambda s: NOT contains(s, '=')), ':') AS document, array_to_string(parts[1 : len(parts) - 1], ':') AS parent, CAST(len(list_filter(parts, lambda s: contains(s, '='))) AS BIGINT) AS n_steps, split_part(parts[-1], '=', 2) AS last_value, true AS rebuilt FROM split")
def citation_paths(spark, d):
    cited = F.concat(F.lit("Shop:order:"), "l_orderkey", F.lit(":part="), "l_partkey", F.lit(":line="), "l_linenumber")
    rows = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", cited.alias("c")).withColumn("steps", X.path_steps(F.col("c"))).withColumn("document", X.path_document(F.col("c")))
    return rows.select("l_orderkey", "l_linenumber", "document", X.path_parent(F.col("c")).alias("parent"), F.size("steps").cast("long").alias("n_steps"), F.element_at("steps", -1)["value"].alias("last_value"), (X.path_string(F.col("document"), F.col("steps")) == F.col("c")).alias("rebuilt"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN 'Shop:n' || s_nationkey || ':s' || s_suppkey END AS document FROM supplier")
def urn_documents(spark, d):
    urn = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).otherwise(F.concat(F.lit("urn:cts:n"), "s_nationkey", F.lit(":s"), "s_suppkey", F.lit(":1.1")))
    return S.table(spark, d, "supplier").select("s_suppkey", X.document_of_urn(urn, "Shop").alias("document"))


@query("SELECT p_partkey, ['chapter', 'line', 'card'][p_partkey % 3 + 1] AS default_type, ['book chapter section', 'book line', 'card line'][p_partkey % 3 + 1] AS types FROM part")
def scheme_types(spark, d):
    scheme = F.element_at(F.array(F.lit("book:chapter*:section"), F.lit("book:line"), F.lit("card*:line")), (F.col("p_partkey") % 3 + 1).cast("int"))
    return S.table(spark, d, "part").select("p_partkey", X.default_type(scheme).alias("default_type"), F.array_join(X.default_types(scheme), " ").alias("types"))


@query("WITH w AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS w FROM part) SELECT w, 'Mc' || upper(w[1]) || w[2:] AS mc, CASE WHEN length(w) >= 3 THEN 'Mac' || upper(w[1]) || w[2:] ELSE 'Mac' || w END AS mac, 'O' || chr(39) || upper(w[1]) || w[2:] AS o FROM w WHERE w <> ''")
def name_rules(spark, d):
    w = S.table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("w")).where("w != ''").distinct()
    return w.select("w", *(X.capitalised_name(F.concat(F.lit(p), "w")).alias(n) for n, p in (("mc", "MC"), ("mac", "mac"), ("o", "o'"))))


@query("SELECT c_custkey, 'smith ' || lower(c_name) AS by_name, lower(c_name) AS by_title, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'zzzzzzz' END AS by_key, 'smith,' || lower(c_name) AS authority, c_name || ' Smith' AS display FROM customer")
def sort_keys(spark, d):
    name, other = F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    authority, display = X.person_names(F.lit("Smith"), name)
    title = F.concat(F.element_at(F.array(F.lit("The "), F.lit("Die "), F.lit("")), (F.col("c_custkey") % 3 + 1).cast("int")), name)
    return S.table(spark, d, "customer").select("c_custkey", X.sort_name(F.concat(name, F.lit(" Smith, Jr (d. 1)"))).alias("by_name"), X.sort_title(title).alias("by_title"), X.sort_value(F.lit(None), other).alias("by_key"), authority.alias("authority"), display.alias("display"))


@query("SELECT n_nationkey, n_name AS city, CASE WHEN n_nationkey % 3 <> 1 THEN 'North' END AS state, CASE WHEN n_nationkey % 3 <> 2 THEN r_name END AS nation FROM nation JOIN region ON n_regionkey = r_regionkey")
def place_names(spark, d):
    k, n, r = F.col("n_nationkey") % 3, F.col("n_name"), F.col("r_name")
    name = F.when(k == 0, F.concat(n, F.lit(" (North, "), r, F.lit(")"))).when(k == 1, F.concat(n, F.lit(" ("), r, F.lit(")"))).otherwise(F.concat(n, F.lit(", North")))
    rows = S.table(spark, d, "nation").join(F.broadcast(S.table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    city, state, nation = X.place_parts(name)
    return rows.select("n_nationkey", city.alias("city"), state.alias("state"), nation.alias("nation"))


@query(r"SELECT DISTINCT c_name, regexp_extract(c_name, '^(\D+)', 1) AS headword, CAST(right(c_name, 3) AS BIGINT) AS number FROM customer")
def lemma_sequences(spark, d):
    head, number = X.lemma_parts(F.concat(F.regexp_extract("c_name", r"^(\D+)", 1), F.right("c_name", F.lit(3))))
    return S.table(spark, d, "customer").select("c_name", head.alias("headword"), number.cast("long").alias("number")).distinct()


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(year(o_orderdate) AS BIGINT) END AS y, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(month(o_orderdate) AS BIGINT) END AS m, CASE WHEN o_orderkey % 4 >= 2 THEN CAST(day(o_orderdate) AS BIGINT) END AS d, CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN 1 THEN monthname(o_orderdate) || ' ' || year(o_orderdate) ELSE monthname(o_orderdate) || ' ' || day(o_orderdate) || CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' WHEN day(o_orderdate) IN (2, 22) THEN 'nd' WHEN day(o_orderdate) IN (3, 23) THEN 'rd' ELSE 'th' END || CASE WHEN o_orderkey % 4 = 2 THEN ', ' || year(o_orderdate) ELSE '' END END AS display FROM orders")
def partial_dates(spark, d):
    k, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(day, "yyyy")).when(k == 1, F.date_format(day, "yyyy-MM")).when(k == 2, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "--MM-dd"))
    p = D.partial_date(text)
    return S.table(spark, d, "orders").select("o_orderkey", p["year"].cast("long").alias("y"), p["month"].cast("long").alias("m"), p["day"].cast("long").alias("d"), D.display_date(p).alias("display"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-01-01'")
def dates_in_range(spark, d):
    r = D.date_range(F.lit("1996-03/1997"))
    return S.table(spark, d, "orders").where(D.within(D.partial_date(F.date_format("o_orderdate", "yyyy-MM-dd")), r["start"], r["end"])).select("o_orderkey")


@query("WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END AS s, p_partkey % 300 + 100 AS a, p_size FROM part) SELECT p_partkey, CASE WHEN p_size <= 20 THEN CAST(trunc(s * (a + a + p_size) / 2.0) AS BIGINT) END AS y, CAST(s * a AS BIGINT) AS first_year FROM p")
def document_years(spark, d):
    a = F.col("p_partkey") % 300 + 100
    era = F.when(F.col("p_partkey") % 2 == 0, " B.C.E.").otherwise(" A.D.")
    return S.table(spark, d, "part").select("p_partkey", D.document_year(F.concat(a, F.lit("-"), a + F.col("p_size"), era)).cast("long").alias("y"), D.era_year(F.concat(a, era)).cast("long").alias("first_year"))


@query("SELECT p_partkey, ['noun', 'verb', 'adj'][p_partkey % 3 + 1] AS pos, ['sg', 'pl', 'dual', NULL][p_size % 4 + 1] AS number, ['masc', 'fem', 'neut'][p_size % 3 + 1] AS gender, ['nom', 'gen', 'dat', 'acc', 'abl', 'voc', 'loc'][p_size % 7 + 1] AS case_name, CASE WHEN p_partkey % 3 = 1 THEN 'pres' END AS tense, true AS rebuilt, (['n', 'v', 'a'][p_partkey % 3 + 1]) || '-' || (['s', 'p', '!', '-'][p_size % 4 + 1]) || CASE WHEN p_partkey % 3 = 1 THEN 'p' ELSE '-' END || '--' || (['m', 'f', 'n'][p_size % 3 + 1]) || (['n', 'g', 'd', 'a', 'b', 'v', 'l'][p_size % 7 + 1]) || '-' AS in_latin FROM part")
def morphology_codes(spark, d):
    def at(letters: str, k) -> F.Column:
        return F.substring(F.lit(letters), (k + 1).cast("int"), F.lit(1))

    code = F.concat(at("nva", F.col("p_partkey") % 3), F.lit("-"), at("spd-", F.col("p_size") % 4), at("-p-", F.col("p_partkey") % 3), F.lit("--"), at("mfn", F.col("p_size") % 3), at("ngdabvl", F.col("p_size") % 7), F.lit("-"))
    rows = S.table(spark, d, "part").select("p_partkey", code.alias("code")).withColumn("f", M.code_features(F.col("code"), "grc"))
    named = [F.try_element_at("f", F.lit(k)).alias(n) for k, n in (("pos", "pos"), ("number", "number"), ("gender", "gender"), ("case", "case_name"), ("tense", "tense"))]
    return rows.select("p_partkey", *named, (M.features_code(F.col("f"), "grc") == F.col("code")).alias("rebuilt"), M.features_code(F.col("f"), "la").alias("in_latin"))


_NEXT = _TOKENS + ", vocab AS (SELECT DISTINCT substring(word, 1, 3) AS head, word FROM tokens), a AS (SELECT head, word, lead(word) OVER (PARTITION BY head ORDER BY word) AS after FROM vocab)"


def _word_pairs(spark, d):
    v = _tokens(spark, d).select(F.substring("word", 1, 3).alias("head"), "word").distinct()
    return v.withColumn("after", F.lead("word").over(Window.partitionBy("head").orderBy("word"))).where("after is not null")


@query(f"WITH {_NEXT} SELECT word, after, CAST(len(list_filter(range(1, least(length(word), length(after)) + 1), lambda k: word[1:k] = after[1:k])) AS BIGINT) AS shared FROM a WHERE after IS NOT NULL")
def initial_similarity(spark, d):
    return _word_pairs(spark, d).select("word", "after", X.common_prefix(F.col("word"), F.col("after")).cast("long").alias("shared"))


def _aligned_sql(border: str, diagonal: str, above: str, left: str, best: str) -> str:
    cell = f"{best}({diagonal.format(d='table_row[CAST(j[1] AS BIGINT)]', same='word[CAST(j[1] AS BIGINT)] = after[n + 1]')}, {above.format(x='table_row[CAST(j[1] AS BIGINT) + 1]')}, {left.format(x='acc[-1]')})"
    row = f"list_reduce(list_transform(range(1, length(word) + 1), lambda k: [CAST(k AS DOUBLE)]), lambda acc, j: list_append(acc, {cell}), [CAST(table_row[1] + ({border}) AS DOUBLE)])"
    return f"SELECT word, after, 0 AS n, list_transform(range(0, length(word) + 1), lambda k: CAST(k * ({border}) AS DOUBLE)) AS table_row FROM a WHERE after IS NOT NULL UNION ALL SELECT word, after, n + 1, {row} FROM @ WHERE n < length(after)"


_ALIGNED = _NEXT.replace("WITH ", "") + ", s AS (" + _aligned_sql("-0.05", "{d} + CASE WHEN {same} THEN 1.0 ELSE 0.0 END", "{x} - 0.05", "{x} - 0.05", "greatest").replace("@", "s") + "), v AS (" + _aligned_sql("0.0", "{d} + CASE WHEN {same} THEN 0.0 ELSE 2.0 END", "{x} + 1.0", "{x} + 1.0", "least").replace("@", "v") + ")"


@query(f"WITH RECURSIVE {_ALIGNED} SELECT s.word, s.after, round(s.table_row[-1], 6) AS score, round(1.0 / CASE WHEN v.table_row[-1] = 0 THEN 0.0001 ELSE v.table_row[-1] END, 6) AS vocalisation FROM s JOIN v ON s.word = v.word AND s.after = v.after AND v.n = length(v.after) WHERE s.n = length(s.after)")
def aligned_similarity(spark, d):
    a, b = F.col("word"), F.col("after")
    return _word_pairs(spark, d).select("word", "after", _r(X.similarity_score(a, b)).alias("score"), _r(X.vocalisation_score(a, b)).alias("vocalisation"))


@query(f"WITH {_TOKENS}, k AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark) SELECT DISTINCT word FROM tokens ANTI JOIN k USING (word)")
def unparsed_forms(spark, d):
    known = S.table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return C.without_match(_tokens(spark, d), known, "word")


@query("WITH a AS (SELECT doc_id, lang, source FROM documents) SELECT a.doc_id, concat_ws('|', a.source, CASE WHEN b.source IS DISTINCT FROM a.source THEN b.source END) AS sources, coalesce(a.lang = b.lang, false) AS same_lang FROM a JOIN a b ON b.doc_id = a.doc_id + 1 WHERE a.source IS NOT NULL AND a.lang IS NOT NULL AND b.lang IS NOT NULL")
def merged_metadata(spark, d):
    m = C.folded_attributes(_attributes(spark, d), "doc_id").where(F.array_contains(F.map_keys("metadata"), "lang"))
    pairs = m.join(m.select((F.col("doc_id") - 1).alias("doc_id"), F.col("metadata").alias("other")), "doc_id")
    merged = C.merged(F.col("metadata"), F.col("other"))
    rows = pairs.where(F.array_contains(F.map_keys("metadata"), "source"))
    return rows.select("doc_id", F.array_join(F.try_element_at(merged, F.lit("source")), "|").alias("sources"), C.share_value(F.col("metadata"), F.col("other"), "lang").alias("same_lang"))


@query(f"WITH {_LINKS}, w AS (SELECT p_name AS name, min(p_partkey) AS id FROM (SELECT '/' || split_part(p_name, ' ', 1) AS p_name, p_partkey FROM part UNION ALL SELECT '/the', 0 UNION ALL SELECT '/and', 1) GROUP BY 1) SELECT page_id, n, target, coalesce('part ' || id, target) AS destination, id IS NOT NULL AS valid FROM links LEFT JOIN w ON w.name = target")
def resolved_links(spark, d):
    names = S.table(spark, d, "part").select(F.concat(F.lit("/"), F.split_part("p_name", F.lit(" "), F.lit(1))).alias("name"), F.col("p_partkey").cast("long").alias("id"))
    works = names.union(spark.createDataFrame([("/the", 0), ("/and", 1)], "name string, id long")).groupBy("name").agg(F.concat(F.lit("part "), F.min("id")).alias("id"))
    out = E.resolved(E.links(S.table(spark, d, "pages")), works)
    return out.select("page_id", "n", "target", "destination", (F.col("destination") != F.col("target")).alias("valid"))


@query("SELECT p_partkey, CAST([0, 1, 2, 3, 4, 5, 6, 0][p_partkey % 8 + 1] AS BIGINT) AS code FROM part")
def link_type_codes(spark, d):
    kinds = [*E.LINK_TYPES, "other"]
    return S.table(spark, d, "part").select("p_partkey", E.link_type(F.element_at(F.array(*map(F.lit, kinds)), (F.col("p_partkey") % 8 + 1).cast("int"))).cast("long").alias("code"))


@query("WITH v AS (SELECT DISTINCT p_type, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS value FROM part) SELECT p_type, value, row_number() OVER (PARTITION BY p_type ORDER BY try_cast(value AS INTEGER) IS NULL, try_cast(value AS INTEGER), value) AS place FROM v")
def numeric_value_order(spark, d):
    v = S.table(spark, d, "part").select("p_type", F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("value")).distinct()
    return v.withColumn("place", F.row_number().over(Window.partitionBy("p_type").orderBy(*J.numeric_order(F.col("value")))))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN n_name || ' first' ELSE n_name END AS target FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def expanded_abbreviations(spark, d):
    nation = S.table(spark, d, "nation")
    name = F.lower("n_name")
    known = nation.select(F.array(name).alias("tokens"), F.col("n_name").alias("target")).union(nation.select(F.array(name, F.lit("1")), F.concat("n_name", F.lit(" first"))))
    rows = S.table(spark, d, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 5
    cited = rows.select("s_suppkey", F.when(k == 0, F.concat(F.lit("Of "), "n_name")).otherwise(F.concat("n_name", F.lit(". "), k.cast("string"), F.lit(".20"))).alias("citation"))
    return Q.abbreviated(cited, "citation", known).select("s_suppkey", "target")


@query("WITH n AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT DISTINCT p_type FROM part UNION SELECT 'red bolt') SELECT n.name, count(*) AS n FROM part JOIN n ON n.name IN (p_name, p_brand, p_type) GROUP BY n.name")
def named_in_any_column(spark, d):
    part = S.table(spark, d, "part")
    names = part.select(F.col("p_brand").alias("name")).union(part.select("p_type")).union(spark.createDataFrame([("red bolt",)], "name string"))
    return C.equal_in_any(part, "p_partkey", ["p_name", "p_brand", "p_type"], names, "name").groupBy("name").agg(F.count("*").alias("n"))


@query(f"WITH {_PARSED}, p AS (SELECT DISTINCT doc_id, line, i, word, last_value(CASE WHEN word NOT IN ({_STOP}) THEN word END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM tokens) SELECT previous, lemma, round(sum(1.0 / k), 4) AS weight FROM parsed JOIN p USING (doc_id, line, i) WHERE previous IS NOT NULL GROUP BY ALL")
def bigram_weights(spark, d):
    rows = S.parsed(A.content_pairs(_docs(spark, d), STOP), _parses(spark, d))
    return A.bigram_weights(rows, "previous", "lemma", "k", "n").withColumn("weight", _r(F.col("weight"), 4))


@query(f"WITH {_PARSED}, f AS (SELECT doc_id, lemma, sum(1.0 / k) AS w FROM parsed GROUP BY ALL), c AS (SELECT DISTINCT doc_id, word, lemma FROM parsed WHERE k > 1) SELECT doc_id, word, lemma, round(w / sum(w) OVER (PARTITION BY doc_id, word), 10) AS share FROM c JOIN f USING (doc_id, lemma)")
def lemma_shares(spark, d):
    return A.lemma_shares_in_document(_parsed(spark, d)).withColumn("share", _r(F.col("share"), 10)).select("doc_id", "word", "lemma", "share")


@query()
def one_part_of_each_type(spark, d):
    return C.one_of_each(S.table(spark, d, "part"), "p_type", "p_partkey")


# Streams: windows are ours, the ledger is an incremental rerun


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def streamed_daily_counts(spark, d):
    out = I.run_to_end(I.windowed_counts(I.event_stream(spark, f"{d}/events.parquet"), "1 day"), "daily")
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", _r(F.col("total"), 4).alias("total"))


@query("WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS s FROM events), g AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM e), c AS (SELECT user_id, g, count(*) AS n FROM g GROUP BY ALL) SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM c GROUP BY user_id")
def user_sessions(spark, d):
    return I.sessions(S.table(spark, d, "events"), "6 hours").groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))


@query("SELECT doc_id FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 <> 0")
def documents_due(spark, d):
    docs = _docs(spark, d).select("doc_id", F.lit("2024-01-10").cast("timestamp").alias("modified"))
    ledger = docs.where("doc_id % 5 = 0").select("doc_id", F.lit("index").alias("task"), F.when(F.col("doc_id") % 7 == 0, F.lit("2024-01-01").cast("timestamp")).otherwise(F.lit("2024-02-01").cast("timestamp")).alias("last_run"))
    return I.due(docs, ledger, "index").select("doc_id")
