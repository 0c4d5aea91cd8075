"""Named queries over the parse table, the lexicon, votes on parses, and search by lemma."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptoria.catalogue import _LEXICON, _PARSED, _TOKENS, _parsed, _parses, _tokens
from scriptoria.functions import greek as G
from scriptoria.functions import text as X
from scriptoria.operators import parses as P
from scriptoria.operators import search as Q
from scriptoria.registry import query
from scriptoria.sources import tables as S


@query(f"WITH {_PARSED} SELECT lemma, count(*) AS n_tokens, count(DISTINCT word) AS n_forms, count(DISTINCT doc_id) AS n_docs FROM parsed GROUP BY lemma")
def lemmatised_tokens(spark, d):
    return _parsed(spark, d).groupBy("lemma").agg(F.count("*").alias("n_tokens"), F.countDistinct("word").alias("n_forms"), F.countDistinct("doc_id").alias("n_docs"))


@query(f"WITH {_TOKENS}, {_LEXICON}, vocab AS (SELECT DISTINCT word FROM tokens), stems AS (SELECT lemma FROM lexicon), hit AS (SELECT DISTINCT form FROM parses WHERE form <> lemma) SELECT word, CASE WHEN word IN (SELECT form FROM hit) THEN 'parse' WHEN word IN (SELECT lemma FROM stems) THEN 'lemma' ELSE 'form' END AS told_by FROM vocab")
def lookup_fallback(spark, d):
    """Where the lemma of each word comes from: an inflected parse, else the lexicon itself, else the bare form."""
    table = _parses(spark, d)
    return P.told_by(_tokens(spark, d).select("word").distinct(), table.where("form != lemma"), table.select("lemma").distinct())


@query(f"WITH {_LEXICON} SELECT form, lemma, string_agg(DISTINCT code, ' ' ORDER BY code) AS codes, count(DISTINCT code) AS n FROM parses GROUP BY form, lemma")
def parses_by_lemma(spark, d):
    return P.grouped(_parses(spark, d)).select("form", "lemma", F.array_join("codes", " ").alias("codes"), F.size("codes").cast("long").alias("n"))


@query(f"WITH {_TOKENS}, {_LEXICON}, asked AS (SELECT DISTINCT lemma FROM parses WHERE form IN ('thes', 'inon', 'thing')), forms AS (SELECT DISTINCT parses.form AS f FROM parses JOIN asked USING (lemma)) SELECT doc_id, count(*) AS n FROM tokens JOIN forms ON word = f GROUP BY doc_id")
def lemma_search(spark, d):
    """Documents that hold any form of a lemma of the words asked for."""
    hits = P.forms_of(_parses(spark, d), ["thes", "inon", "thing"])
    return _tokens(spark, d).join(S.small(hits.select(F.col("form").alias("word"))), "word").groupBy("doc_id").agg(F.count("*").alias("n"))


@query(f"WITH {_LEXICON} SELECT lemma, reverse(lemma) AS reversed, length(lemma) AS size, substring(lemma, 1, 1) AS head FROM lexicon WHERE starts_with(lemma, 'th') OR suffix(lemma, 'ing')")
def lexicon_index(spark, d):
    index = P.lexicon_index(_parses(spark, d).select("lemma").distinct())
    return index.where(F.startswith("lemma", F.lit("th")) | F.startswith("reversed", F.reverse(F.lit("ing"))))


@query(f"WITH {_LEXICON}, h AS (SELECT lemma, row_number() OVER (ORDER BY lemma) AS place FROM lexicon WHERE starts_with(lemma, 'th') OR suffix(lemma, 'th')) SELECT lemma, place FROM h WHERE place BETWEEN 6 AND 10")
def definition_lookup(spark, d):
    """The second page of five headwords that begin or end with what was asked."""
    hits = Q.headword_search(_parses(spark, d).select("lemma").distinct(), "lemma", "th", "substring").orderBy("lemma").offset(5).limit(5)
    return hits.withColumn("place", (F.row_number().over(Window.orderBy("lemma")) + 5).cast("long"))


# Votes: events stand for votes on the forms of parses, one form a kind of event

_VOTES = "votes AS (SELECT user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ['n-s------', 'n-p------', 'v--pp----'][event_id % 4 + 1] END AS code, event_type AS lemma, event_id % 2 AS sequence FROM events)"


def _votes(spark, d):
    e = S.table(spark, d, "events")
    code = F.get(F.array(F.lit("n-s------"), F.lit("n-p------"), F.lit("v--pp----")), (F.col("event_id") % 4).cast("int"))
    return e.select("user_id", F.when(F.col("event_id") % 3 != 0, code).alias("code"), F.col("event_type").alias("lemma"), (F.col("event_id") % 2).alias("sequence"))


@query(f"WITH {_VOTES}, p AS (SELECT DISTINCT lemma, code, sequence FROM votes WHERE user_id % 5 = 0 AND code IS NOT NULL) SELECT p.lemma, p.code, p.sequence, count(votes.user_id) AS votes FROM p LEFT JOIN votes ON votes.lemma = p.lemma AND votes.code = p.code AND votes.sequence = p.sequence GROUP BY ALL")
def votes_on_parses(spark, d):
    votes = _votes(spark, d)
    known = votes.where("user_id % 5 = 0 and code is not null").select("lemma", "code", "sequence").distinct()
    return P.votes_on(known, votes)


@query(f"WITH {_VOTES} SELECT lemma, sequence, count(*) AS votes FROM votes WHERE code IS NULL GROUP BY ALL")
def lemma_only_votes(spark, d):
    return _votes(spark, d).where("code is null").groupBy("lemma", "sequence").agg(F.count("*").alias("votes"))


@query(f"WITH {_VOTES} SELECT user_id, lemma, count(*) AS votes, count(DISTINCT code) AS n_codes FROM votes GROUP BY ALL")
def votes_by_user(spark, d):
    return _votes(spark, d).groupBy("user_id", "lemma").agg(F.count("*").alias("votes"), F.countDistinct("code").alias("n_codes"))


@query("SELECT p_type AS lemma, count(*) AS n_senses, count(DISTINCT p_brand) AS n_meanings FROM part GROUP BY p_type")
def number_of_senses(spark, d):
    return S.table(spark, d, "part").groupBy(F.col("p_type").alias("lemma")).agg(F.count("*").alias("n_senses"), F.countDistinct("p_brand").alias("n_meanings"))


# Evaluators: parses in the context of the whole corpus

_EVALUATED = _LEXICON + r""", ws AS (SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM (SELECT doc_id, list_transform(regexp_extract_all(regexp_replace(text, '[&_][A-Za-z]+;', ' ', 'g'), '[A-Za-z][A-Za-z\[\]]*'), lambda x: lower(x)) AS w FROM documents)),
placed AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY pos) AS previous FROM ws),
k AS (SELECT form, count(*) AS k, bool_or(NOT regexp_full_match(code, '.-*')) AS telling FROM parses GROUP BY form),
counts AS (SELECT word, count(*) AS n FROM ws GROUP BY word),
marked AS (SELECT form, lemma, code, k, telling, list_filter(list_transform(range(1, len(code) + 1), lambda i: i || code[i]), lambda m: NOT suffix(m, '-')) AS marks FROM parses JOIN k USING (form)),
shared AS (SELECT form, m, count(*) AS have FROM (SELECT form, unnest(marks) AS m FROM marked) GROUP BY ALL),
differ AS (SELECT form, lemma, code, string_agg(m, ';' ORDER BY nth) AS special FROM (SELECT form, lemma, code, k, unnest(marks) AS m, generate_subscripts(marks, 1) AS nth FROM marked) JOIN shared USING (form, m) WHERE have < k GROUP BY ALL),
weights AS (SELECT code, sum(n / k) AS w FROM counts JOIN marked ON form = word GROUP BY code),
taken AS (SELECT w, marks, unnest(range(0, CAST(pow(2, len(marks)) AS BIGINT))) AS mask FROM weights JOIN (SELECT DISTINCT code, marks FROM marked) USING (code)),
cube AS (SELECT array_to_string(list_filter(marks, lambda x, i: (mask >> (i - 1)) & 1 = 1), ';') AS subset, sum(w) AS weight FROM taken GROUP BY 1),
own AS (SELECT m.form, m.lemma, m.code, coalesce(weight, 0) AS weight FROM marked m JOIN counts ON word = m.form LEFT JOIN differ d ON d.form = m.form AND d.lemma = m.lemma AND d.code = m.code LEFT JOIN cube ON subset = coalesce(special, array_to_string(marks, ';'))),
by_form AS (SELECT *, CASE WHEN sum(weight) OVER w > 0 THEN weight / sum(weight) OVER w ELSE 1.0 / count(*) OVER w END AS share FROM own WINDOW w AS (PARTITION BY form)),
pairs AS (SELECT previous, word, count(*) AS n FROM placed WHERE previous IS NOT NULL GROUP BY ALL),
lattice AS (SELECT p.code AS prior_code, p.lemma AS prior_lemma, m.lemma, m.code, sum(n / (p.k * m.k)) AS w FROM pairs JOIN marked m ON m.form = word JOIN marked p ON p.form = previous GROUP BY ALL),
by_code AS (SELECT prior_code, lemma, code, sum(w) AS w FROM lattice GROUP BY ALL), by_lemma AS (SELECT prior_lemma, lemma, code, sum(w) AS w FROM lattice GROUP BY ALL), by_none AS (SELECT lemma, code, sum(w) AS w FROM lattice GROUP BY ALL),
asked AS (SELECT previous, word AS form, m.lemma, m.code, k.telling FROM pairs JOIN marked m ON m.form = word LEFT JOIN k ON k.form = previous),
after AS (SELECT a.previous, a.form, a.lemma, a.code, x.w FROM asked a JOIN (SELECT DISTINCT form, code FROM parses) p ON p.form = a.previous LEFT JOIN by_code x ON prior_code = p.code AND x.lemma = a.lemma AND x.code = a.code WHERE a.telling
UNION ALL SELECT a.previous, a.form, a.lemma, a.code, x.w FROM asked a JOIN (SELECT DISTINCT form, lemma FROM parses) p ON p.form = a.previous LEFT JOIN by_lemma x ON prior_lemma = p.lemma AND x.lemma = a.lemma AND x.code = a.code WHERE NOT a.telling
UNION ALL SELECT a.previous, a.form, a.lemma, a.code, x.w FROM asked a LEFT JOIN by_none x ON x.lemma = a.lemma AND x.code = a.code WHERE a.telling IS NULL),
sums AS (SELECT previous, form, lemma, code, coalesce(sum(w), 0) AS weight FROM after GROUP BY ALL),
by_prior AS (SELECT *, CASE WHEN sum(weight) OVER w > 0 THEN weight / sum(weight) OVER w ELSE 1.0 / count(*) OVER w END AS share FROM sums WINDOW w AS (PARTITION BY previous, form))"""


def _word_counts(spark, d):
    return _tokens(spark, d).groupBy("word").agg(F.count("*").alias("n"))


@query(f"WITH {_EVALUATED} SELECT form, lemma, code, round(weight, 4) AS weight, round(share, 4) AS share FROM by_form")
def form_frequency_evaluator(spark, d):
    """Each parse of an attested form by the corpus frequency of the features that tell it apart from the form's other parses."""
    out = P.by_form_frequency(_parses(spark, d), S.kept(_word_counts(spark, d), "counts"))
    return out.select("form", "lemma", "code", F.round("weight", 4).alias("weight"), F.round("share", 4).alias("share"))


@query(f"WITH {_EVALUATED} SELECT previous, form, lemma, code, round(weight, 4) AS weight, round(share, 4) AS share FROM by_prior")
def prior_frequency_evaluator(spark, d):
    """Each parse of a word after each word before it, by weighted counts over the lattice of both words' parses."""
    out = P.by_prior_frequency(_parses(spark, d), P.word_pairs(S.table(spark, d, "documents")))
    return out.select("previous", "form", "lemma", "code", F.round("weight", 4).alias("weight"), F.round("share", 4).alias("share"))


@query(f"WITH {_EVALUATED}, scores AS (SELECT previous, form, lemma, code, (f.share + p.share) / 2 AS score FROM by_prior p JOIN by_form f USING (form, lemma, code) UNION ALL SELECT NULL, form, lemma, code, share FROM by_form), best AS (SELECT *, row_number() OVER (PARTITION BY previous, form ORDER BY round(score, 9) DESC, lemma, code) AS place FROM scores) SELECT doc_id, CAST(pos AS INTEGER) AS pos, word, lemma, code, round(score, 4) AS score FROM placed JOIN best ON form = word AND best.previous IS NOT DISTINCT FROM placed.previous WHERE place = 1")
def parses_in_context(spark, d):
    """The best parse of every word that has one, where it stands."""
    return P.chosen_in_context(S.table(spark, d, "documents"), _parses(spark, d)).withColumn("score", F.round("score", 4))


@query(f"WITH {_EVALUATED}, {_VOTES}, v AS (SELECT code, count(*) AS score FROM votes WHERE code IS NOT NULL GROUP BY code), e AS (SELECT form, lemma, code, share AS x FROM by_form UNION ALL SELECT form, lemma, code, score FROM by_form JOIN v USING (code)), m AS (SELECT form, lemma, code, avg(x) AS mean FROM e GROUP BY ALL), r AS (SELECT *, sum(mean) OVER (PARTITION BY form) AS total, row_number() OVER (PARTITION BY form ORDER BY round(mean, 9) DESC, lemma, code) AS place FROM m) SELECT form, lemma, code, round(CASE WHEN total > 0 THEN mean / total ELSE mean END, 6) AS score FROM r WHERE place = 1")
def morphology_request(spark, d):
    """The best parse of each attested form by itself: the mean over feature frequency and readers' votes, renormalised."""
    frequency = S.kept(P.by_form_frequency(_parses(spark, d), S.kept(_word_counts(spark, d), "counts")).select("form", "lemma", "code", F.col("share").alias("x")), "shares")
    voted = _votes(spark, d).where("code is not null").groupBy("code").agg(F.count("*").cast("double").alias("x"))
    scores = frequency.unionByName(frequency.drop("x").join(S.small(voted), "code").select("form", "lemma", "code", "x"))
    return P.best(scores).select("form", "lemma", "code", F.round("score", 6).alias("score"))


@query("WITH n AS (SELECT lower(n_name) AS t, n_name FROM nation) SELECT s_suppkey, count(n_name) AS n_candidates, min(n_name) AS first FROM supplier LEFT JOIN n ON starts_with(t, 'nation_' || (s_suppkey % 3)) GROUP BY s_suppkey")
def abbreviation_candidates(spark, d):
    nation = S.table(spark, d, "nation")
    known = nation.select(F.array(F.lower("n_name")).alias("tokens"), F.col("n_name").alias("target"))
    rows = S.table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Nation_"), F.col("s_suppkey") % 3).alias("citation"))
    found = Q.possible_abbreviations(rows, "citation", known)
    return found.groupBy("s_suppkey").agg(F.count("target").alias("n_candidates"), F.min("target").alias("first"))


@query(f"WITH {_TOKENS} SELECT doc_id, line, i, '<a href=\"morph?l=' || lower(form) || '&amp;la=' || lang || '\">' || form || '</a>' AS link FROM tokens WHERE word IN ('the', 'und', 'les')")
def morphology_links(spark, d):
    rows = _tokens(spark, d).where(F.col("word").isin("the", "und", "les"))
    return rows.select("doc_id", "line", "i", X.morphology_link(F.col("form"), F.col("lang")).alias("link"))


@query(f"WITH {_TOKENS}, h AS (SELECT a.doc_id, a.line, a.i FROM tokens a JOIN tokens b ON a.doc_id = b.doc_id AND a.line = b.line AND b.i = a.i + 1 WHERE a.word = 'of' AND b.word = 'the') SELECT t.doc_id, t.line, count(*) AS n_words, string_agg(CASE WHEN h.i IS NOT NULL OR g.i IS NOT NULL THEN '*' || form || '*' ELSE form END, ' ' ORDER BY t.i) AS marked FROM tokens t LEFT JOIN h ON h.doc_id = t.doc_id AND h.line = t.line AND h.i = t.i LEFT JOIN h g ON g.doc_id = t.doc_id AND g.line = t.line AND g.i + 1 = t.i WHERE (t.doc_id, t.line) IN (SELECT doc_id, line FROM h) GROUP BY ALL")
def phrase_highlights(spark, d):
    return Q.highlighted_phrase(_tokens(spark, d), ["of", "the"], ["doc_id", "line"], "form").select("doc_id", "line", F.size("words").cast("long").alias("n_words"), F.array_join("words", " ").alias("marked"))


@query(f"WITH {_TOKENS}, {_LEXICON} SELECT 'text' AS kind, count(DISTINCT doc_id) AS n FROM tokens WHERE word = 'the' UNION ALL SELECT 'lemma', count(DISTINCT lemma) FROM parses WHERE form = 'the' UNION ALL SELECT 'lexicon', count(*) FROM lexicon WHERE starts_with(lemma, 'the') UNION ALL SELECT 'metadata', count(*) FROM documents WHERE contains(lower(source), 'the') UNION ALL SELECT 'artifact', count(*) FROM part WHERE contains(lower(concat_ws(chr(10), p_name, p_brand, p_type)), 'the')")
def search_everywhere(spark, d):
    """Hits of one word in every kind of search, as a page of results heads them."""
    word = "the"
    table = _parses(spark, d)
    count = lambda kind, rows: rows.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    out = count("text", _tokens(spark, d).where(F.col("word") == word).select("doc_id").distinct())
    out = out.unionByName(count("lemma", table.where(F.col("form") == word).select("lemma").distinct()))
    out = out.unionByName(count("lexicon", Q.headword_search(table.select("lemma").distinct(), "lemma", word, "start")))
    out = out.unionByName(count("metadata", S.table(spark, d, "documents").where(F.lower("source").contains(word))))
    return out.unionByName(count("artifact", Q.contents_search(S.table(spark, d, "part"), ["p_name", "p_brand", "p_type"], [word])))


# Encodings and forms


@query("WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark) SELECT word, regexp_replace(translate(word, 'abgdezhqiklmncoprstufxyw', 'αβγδεζηθικλμνξοπρστυφχψω'), 'σ$', 'ς') AS greek, regexp_replace(word, 'j|v', '', 'g') = word AS whole FROM w")
def greek_letters(spark, d):
    """Beta Code words in Greek letters and back; a word's last sigma has its own form, j and v stand for no letter."""
    w = S.table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    greek = G.beta_to_greek(F.col("word"))
    return w.select("word", greek.alias("greek"), (~F.rlike(F.translate(greek, G.GREEK, ""), F.lit("[jv]")) & (G.greek_to_beta(greek) == F.col("word"))).alias("whole"))


@query("SELECT p_partkey, ['sg', 'pl', 'dual'][p_size % 3 + 1] AS number, CASE WHEN p_partkey % 2 = 0 THEN ['ind', 'subj', 'imperat'][p_size % 3 + 1] END AS mood, CASE WHEN p_partkey % 2 = 0 THEN 'v-' ELSE 'n-' END || ['s', 'p', 'd'][p_size % 3 + 1] || CASE WHEN p_partkey % 2 = 0 THEN 'p' || ['i', 's', 'm'][p_size % 3 + 1] || 'a---' ELSE '---' || ['m', 'f', 'n'][p_size % 3 + 1] || 'd-' END AS in_norse FROM part")
def germanic_codes(spark, d):
    """Old English codes, the features they stand for, and the Old Norse code of those."""
    from scriptoria.functions import morphology as M

    at = lambda letters: F.substring(F.lit(letters), (F.col("p_size") % 3 + 1).cast("int"), F.lit(1))
    verb, noun = F.concat(F.lit("v-"), at("spd"), F.lit("p"), at("ism"), F.lit("a---")), F.concat(F.lit("n-"), at("spd"), F.lit("---"), at("mfn"), F.lit("d-"))
    rows = S.table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, verb).otherwise(noun).alias("code")).withColumn("f", M.code_features(F.col("code"), "ang"))
    return rows.select("p_partkey", *(F.try_element_at("f", F.lit(k)).alias(k) for k in ("number", "mood")), M.features_code(F.col("f"), "non").alias("in_norse"))


@query("WITH p AS (SELECT p_partkey, ['Late Classical', 'Classical', 'Julio-Claudian', '-500', 'Stone Age', NULL][p_partkey % 6 + 1] AS period FROM part) SELECT p_partkey, CASE period WHEN 'Late Classical' THEN 'Late Classical' WHEN 'Classical' THEN 'Classical' WHEN 'Julio-Claudian' THEN 'Julio-Claudian' WHEN '-500' THEN 'Archaic' END AS sortable FROM p")
def sortable_periods(spark, d):
    given = F.get(F.array(F.lit("Late Classical"), F.lit("Classical"), F.lit("Julio-Claudian"), F.lit("-500"), F.lit("Stone Age"), F.lit(None)), (F.col("p_partkey") % 6).cast("int"))
    return S.table(spark, d, "part").select("p_partkey", X.sortable_period(given).alias("sortable"))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 6 IN (0, 1) THEN year(o_orderdate) WHEN o_orderkey % 6 = 2 THEN -year(o_orderdate) WHEN o_orderkey % 6 = 5 THEN -44 END AS BIGINT) AS y, CAST(CASE WHEN o_orderkey % 6 IN (0, 1, 2) THEN month(o_orderdate) WHEN o_orderkey % 6 = 3 AND day(o_orderdate) > 12 THEN month(o_orderdate) WHEN o_orderkey % 6 = 3 THEN day(o_orderdate) END AS BIGINT) AS m, CAST(CASE WHEN o_orderkey % 6 IN (0, 2, 4) THEN day(o_orderdate) WHEN o_orderkey % 6 = 3 AND day(o_orderdate) > 12 THEN day(o_orderdate) END AS BIGINT) AS d, CAST(CASE WHEN o_orderkey % 6 = 3 AND day(o_orderdate) <= 12 THEN month(o_orderdate) END AS BIGINT) AS y_or_month FROM orders")
def free_dates(spark, d):
    from scriptoria.functions.dates import free_date

    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = F.when(k == 0, F.date_format(day, "yyyy-M-d")).when(k == 1, F.date_format(day, "yyyy-M-")).when(k == 2, F.concat(F.lit("-"), F.date_format(day, "yyyy-M-d"))).when(k == 3, F.date_format(day, "M-d")).when(k == 4, F.concat(F.lit("--"), F.date_format(day, "d"))).otherwise("44 B.C.")
    rows = S.table(spark, d, "orders").select("o_orderkey", k.alias("k"), F.dayofmonth(day).alias("n"), F.inline(F.array(F.struct(free_date(text).alias("p")))))
    odd = (F.col("k") == 3) & (F.col("n") <= 12)
    return rows.select("o_orderkey", F.when(~odd, F.col("p.year")).cast("long").alias("y"), F.col("p.month").cast("long").alias("m"), F.col("p.day").cast("long").alias("d"), F.when(odd, F.col("p.year")).cast("long").alias("y_or_month"))


@query("SELECT event_id, CAST(hour(ts) AS BIGINT) AS h, CAST(minute(ts) AS BIGINT) AS m, CAST(second(ts) AS BIGINT) AS s, 0.25 AS fraction, CAST(CASE WHEN CAST(ts AS DATE) < DATE '2024-01-15' THEN -1 WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN 0 ELSE 1 END AS BIGINT) AS side FROM events")
def timestamps(spark, d):
    from scriptoria.functions.dates import compared, partial_date, timestamped

    t = S.table(spark, d, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(",25")).alias("text"))
    t = t.select("event_id", F.inline(F.array(F.struct(timestamped(F.col("text")).alias("p")))))
    return t.select("event_id", *(F.col(f"p.{k}").cast("long").alias(k[0]) for k in ("hour", "minute", "second")), F.col("p.fraction").alias("fraction"), compared(F.col("p.date"), partial_date(F.lit("2024-01-15"))).cast("long").alias("side"))
