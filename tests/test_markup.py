"""Markup, entities, resources, forms and artifacts: hand-made cases, nulls, ties and empty tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from scriptoria.functions import dates as D
from scriptoria.functions import greek as G
from scriptoria.functions import morphology as M
from scriptoria.functions import text as X
from scriptoria.operators import artifacts as A
from scriptoria.operators import entities as N
from scriptoria.operators import extract as E
from scriptoria.operators import frequency as W
from scriptoria.operators import parses as P
from scriptoria.operators import resources as R
from scriptoria.operators import search as Q
from scriptoria.sources import markup as K
from scriptoria.sources import tables as S

TEXT = """<TEI.2><text><body><div1 type="Book" n="1"><milestone unit="chapter" n="a"/>one<milestone unit="chapter"/>two <l>x</l><l n="7">y</l></div1><div1 type="book" ed="q"><milestone unit="chapter"/>three<lb/>four<pb n="12"/>five</div1><entry key="arma"><orth>arma</orth></entry><entry/></body></text></TEI.2>"""


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id string, text string").withColumns({c: F.lit("clash") for c in ("n", "raw", "start", "type")})


def test_sections_of_a_text(spark):
    rows = K.cited(K.sections(texts(spark, ("d", TEXT), ("none", None), ("plain", "a < b"), ("", "")))).orderBy("n").collect()
    assert [(r.path, r.position, r.abs_position) for r in rows] == [
        ("book=1", 1, 1), ("book=1:chapter=a", 1, 2), ("book=1:chapter=2", 2, 3), ("book=1:line=1", 1, 4), ("book=1:line=7", 2, 5), ("q book=1", 1, 6),
        ("q book=1:chapter=1", 3, 7), ("q book=1:line=1", 3, 8), ("q book=1:page=12", 1, 9), ("entry=arma", 1, 10), ("entry=2", 2, 11),
    ]
    part = {r.path: TEXT[r.start_offset : r.end_offset] for r in rows}
    assert part["book=1:line=7"] == '<l n="7">y</l>' and part["book=1:chapter=a"] == '<milestone unit="chapter" n="a"/>one' and part["q book=1:page=12"] == '<pb n="12"/>five'
    assert part["book=1"].endswith("</l></div1>") and part["entry=2"] == "<entry/>" and part["book=1:chapter=2"].endswith("</l>")
    assert {r.section_id for r in rows if r.type == "entry"} == {"arma", "2"}
    assert K.sections(texts(spark).limit(0)).count() == 0


def test_parts_are_the_whole_text(spark):
    for text in (TEXT, "a < b > c", "<", "no markup", "<a><b></b></a>" * 300):
        rows = K.parts(texts(spark, ("d", text))).orderBy("n").collect()
        assert "".join(r.raw for r in rows) == text and all(text[r.start :].startswith(r.raw) for r in rows)


def test_running_starts(spark):
    rows = spark.createDataFrame([([3, 1, 4, 1, 5, 9, 2],), ([],), ([7],), (list(range(50)),)], "sizes array<int>")
    for r in X.running_starts(rows, "sizes", "starts").collect():
        assert r.starts == [sum(r.sizes[:k]) for k in range(len(r.sizes))]


def test_tokens_of_markup(spark):
    got = K.tokens(texts(spark, ("d", 'He <hi>saw</hi> it&mdash;a <a href="x">b</a>'), ("e", None))).orderBy("n", "i").collect()
    assert [(r.kind, r.token) for r in got] == [("word", "He"), ("tag", "<hi>"), ("word", "saw"), ("tag", "</hi>"), ("entity", "&mdash;"), ("word", "it"), ("word", "a"), ("link", '<a href="x">'), ("word", "b"), ("link", "</a>")]


MARKED = """<p><placeName key="tgn,1;tgn,2">Rome</placeName> <placeName n="Athens">x</placeName> <name type="place">Sparta (Greece)</name> <placeName>Nowhere</placeName> <name>Bob</name>
<persName reg="p:Lincoln,Abraham, nomatch">Lincoln</persName> <persName reg="Lincoln">no</persName> <persName reg="k:Grant:x">General U. Grant</persName>
<date value="1863-07-04">that day</date> <date>44 B.C.</date> <date>soon</date> <dateStruct><year>1863</year><month>7</month></dateStruct> <dateRange from="1861-4" to="1865"/></p>"""


def test_entities_of_a_text(spark):
    gazetteer = spark.createDataFrame([("tgn,1", "Rome"), ("tgn,9", "Athens"), ("tgn,3", "Athens"), ("tgn,4", "Sparta (Greece)")], "auth_name string, display_name string")
    found = N.occurrences(texts(spark, ("d", MARKED), ("e", None)), gazetteer)
    got = {(r["class"], r.auth_name): r.ambiguous for r in found.collect()}
    assert got == {
        ("place", "tgn,1"): True, ("place", "tgn,3"): True, ("place", "tgn,4"): False, ("person", "lincoln,abraham"): True, ("person", "grant"): False,
        ("date", "1863-07-04"): False, ("date", "-0044"): False, ("date", "1863-07"): False, ("range", "1861-04/1865"): False,
    }
    snippet = {r.auth_name: r.snippet for r in N.snippets(texts(spark, ("d", MARKED)), found, length=60).collect()}["tgn,1"]
    assert "*Rome*" in snippet and snippet.endswith("[...]")
    many = "<p>" + "<placeName>Rome</placeName> and " * 13 + "</p>"
    all_of = N.occurrences(texts(spark, ("d", many)), gazetteer)
    one = N.snippets(texts(spark, ("d", many)), all_of).first().snippet
    assert one.count("*Rome*") == 10 and one.endswith("[3 more...]") and N.frequencies(all_of, "doc_id").first().max_freq == 13
    assert N.occurrences(texts(spark).limit(0), gazetteer).count() == 0


def test_free_dates(spark):
    want = {"1995-03-04": (1995, 3, 4), "1234": (1234, None, None), "44 B.C.": (-44, None, None), "79 AD": (79, None, None), "-5": (None, 5, None), "-44": (-44, None, None), "07-30": (None, 7, 30), "1863-07": (1863, 7, None), "--5": (None, None, 5), "-234-5": (-234, 5, None), "-10-15": (None, 10, 15), "-1234-5-6": (-1234, 5, 6), "1234-5-": (1234, 5, None), "1234--": (1234, None, None), "0": None, "x": None, "": None, "1-2-3-4-5": None}
    rows = spark.createDataFrame([(k,) for k in want] + [(None,)], "t string").select("t", D.free_date(F.col("t")).alias("d")).collect()
    assert {r.t: r.d and tuple(r.d) for r in rows} == want | {None: None}


def test_climbing_and_schemes(spark):
    asked = spark.createDataFrame([("w", "a=1:b=2:c=3"), ("w", "z=1"), (None, "a=1")], "work string, path string")
    known = spark.createDataFrame([("w", "a=1"), ("w", "a=1:b=2"), ("w", "a=1:b=2"), ("v", "z=1")], "work string, path string")
    assert {(r.work, r.path): r.found for r in R.nearest(asked, known, ["work"]).collect()} == {("w", "a=1:b=2:c=3"): "a=1:b=2", ("w", "z=1"): None, (None, "a=1"): None}
    rows = spark.createDataFrame([("d:book=1:line=5", "b:l=book:line"), ("d:book=1:line=5", "b:l=book:card"), ("d:line=5", "b:l=book:line"), ("d:book=2", "b:l=book:line")], "c string, s string")
    assert [r.p for r in rows.select(R.commentary_path(X.path_steps(F.col("c")), F.col("s")).alias("p")).collect()] == ["b=1:l=5", "b=1:l=5", "", "b=2"]


def test_greek_letters_and_encodings(spark):
    rows = spark.createDataFrame([("*)/arhs",), ("mh=nin",), ("lo/gos",), (None,)], "b string").select("b", G.beta_to_greek(F.col("b")).alias("g")).withColumn("back", G.greek_to_beta(F.col("g"))).withColumn("kind", G.encoding(F.col("g"))).withColumn("was", G.encoding(F.col("b"))).collect()
    assert rows[1].g == "μῆνιν" and rows[2].g.endswith("ς") and all(r.back == r.b for r in rows) and rows[0].g.startswith("Α")
    assert [r.kind for r in rows] == ["unicode"] * 3 + [None] and [r.was for r in rows] == ["beta"] * 3 + [None]


def test_codes_of_other_languages(spark):
    rows = spark.createDataFrame([("v3spia--c",), ("?",), (None,)], "c string").select(M.code_features(F.col("c"), "ang").alias("f")).select("f", M.features_code(F.col("f"), "ang").alias("back")).collect()
    assert rows[0].back == "v3spia--c" and rows[0].f["degree"] == "comp" and rows[1].f == {} and rows[2].f is None


def test_parses(spark):
    lexicon = spark.createDataFrame([("wing",), ("w",), ("thing",)], "lemma string")
    table = S.inflected(lexicon)
    tokens = spark.createDataFrame([(1, "wing"), (1, "wing"), (1, "other"), (2, None)], "doc_id int, word string")
    got = S.parsed(tokens, table)
    assert sorted((r.word, r.lemma, r.k) for r in got.where("word is not null").collect()) == [("other", "other", 1)] + [("wing", "w", 2)] * 2 + [("wing", "wing", 2)] * 2
    assert {r.form for r in P.forms_of(table, ["wing"]).collect()} == {r.form for r in table.where("lemma in ('w', 'wing')").collect()}
    scores = spark.createDataFrame([("f", "a", "x", 1.0), ("f", "a", "x", None), ("f", "b", "x", 1.0), ("g", "a", "x", 0.0)], "form string, lemma string, code string, x double")
    assert {r.form: (r.lemma, r.score) for r in P.best(scores).collect()} == {"f": ("a", 0.5), "g": ("a", 0.0)}


def test_coverage_with_ties(spark):
    rows = [("en", w, n) for w, n in (("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1), ("f", None))] + [("de", "x", 1)]
    got = W.coverage(spark.createDataFrame(rows, "lang string, word string, n int"), 0.7, ["lang"], "n", "word").collect()
    assert sorted((r.lang, r.place, r.word) for r in got) == [("de", 1, "x"), ("en", 1, "a"), ("en", 2, "b"), ("en", 3, "c")]
    assert W.coverage(spark.createDataFrame([], "lang string, word string, n int"), 0.5, ["lang"], "n", "word").count() == 0


def test_phrases(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "c", "d"]), (2, ["a", "b"]), (3, []), (4, None), (5, ["x", "a", "b", "c", "a", "b", "c", "e"])], "doc_id int, words array<string>")
    items = spark.createDataFrame([(1, ["a", "b", "c", "d"]), (2, ["b"]), (3, []), (4, ["a", "b"]), (5, ["a", "b", "c", "e"])], "item_id int, phrase array<string>")
    got = {(r.item_id, r.doc_id) for r in Q.whole_phrases(docs, items, "doc_id", "item_id").collect()}
    assert got == {(1, 1), (2, 1), (2, 2), (2, 5), (4, 1), (4, 2), (4, 5), (5, 5)}
    known = spark.createDataFrame([(["aesch"], "A"), (["aeschin"], "B"), (["aesch", "ag"], "C")], "tokens array<string>, target string")
    cited = spark.createDataFrame([(1, "Aesc."), (2, "Aesch. A"), (3, "Verg."), (4, None), (5, "")], "id int, c string")
    rows = Q.possible_abbreviations(cited, "c", known).collect()
    assert sorted((r.id, r.target or "") for r in rows) == [(1, "A"), (1, "B"), (1, "C"), (2, "C"), (3, ""), (4, ""), (5, "")]


def test_artifacts(spark):
    rows = spark.createDataFrame([("Type", "Vase"), ("mint", "Coin"), ("Period", "Site"), ("Issuing_Authority", "Coin"), (None, "Coin"), ("Region", "Ship")], "f string, k string").withColumn("n", A.facet_name(F.col("f"), F.col("k")))
    assert [(r.n, r.ok) for r in rows.withColumn("ok", A.is_facet(F.col("n"), F.col("k"))).collect()] == [("Vase Type", False), ("Context", True), (None, False), ("Issuing Authority", True), (None, False), ("Region", False)]
    ids = spark.createDataFrame([(k,) for k in range(41)], "id int")
    assert [r.id for r in A.image_page(ids, "id", 3).collect()] == [40] and A.image_page(ids, "id", 1).first().pages == 3 and A.image_page(ids.limit(0), "id", 1).count() == 0
    edges = spark.createDataFrame([("a", "x", "text"), ("a", "x", "text"), ("b", "y", "index")], "source string, target string, kind string")
    assert E.citations(edges).count() == 2 and E.citations(edges, kind="text", source=["b"]).count() == 0


def test_file_sources(spark, tmp_path):
    (tmp_path / "marks.xml").write_text('<markers><marker lat="1.5" lng="2.5" site="A &amp; B"/><marker lat="0" lng="0" site="unknown"/></markers>')
    assert [(r.site, r.lat, r.lon) for r in S.places(spark, f"file://{tmp_path}/marks.xml").collect()] == [("A & B", 1.5, 2.5)]
    (tmp_path / "stop.txt").write_text("the\n\nand\nthe\n")
    assert {r.word for r in S.stoplist(spark, f"file://{tmp_path}/stop.txt").collect()} == {"the", "and"}
    (tmp_path / "abb.tsv").write_text("hom|il\tHom. Il.\tiliad\n")
    assert [tuple(r) for r in S.abbreviations(spark, f"file://{tmp_path}/abb.tsv").collect()] == [(["hom", "il"], "Hom. Il.", "iliad")]
    (tmp_path / "analyses.xml").write_text("<analyses><analysis><form>arm#a</form><lemma>in-arma#2</lemma><pos>noun</pos></analysis></analyses>")
    r = S.analyses(spark, f"file://{tmp_path}/analyses.xml").first()
    assert (r.form, r.headword, r.sequence, r.features) == ("arma", "arma", 2, {"pos": "noun"})


PARTED = '<TEI.2><text><body><div1 type="part"><p><milestone unit="book" n="1"/>b1 <milestone unit="chapter" n="1"/>c1 <milestone unit="chapter"/>c2</p><pb n="4"/><p> more <hi>x</hi><milestone unit="book"/>b2 <milestone unit="chapter"/>only <milestone ed="q" unit="chapter"/>of q</p></div1><div1 type="part"><milestone unit="chapter"/>c<l>v</l></body></text></TEI.2>'


def test_milestones_nest_by_their_types(spark):
    rows = K.cited(K.sections(texts(spark, ("d", PARTED))), 4).orderBy("n").collect()
    by = {r.path: r for r in rows}
    assert [r.path for r in rows] == [
        "part=1", "part=1:book=1", "part=1:book=1:chapter=1", "part=1:book=1:chapter=2", "part=1:page=4", "part=1:book=2", "part=1:book=2:chapter=1", "part=1:q chapter=1", "part=2", "part=2:chapter=1", "part=2:line=1",
    ]
    second = PARTED.index('<milestone unit="book"/>')
    assert by["part=1:book=1"].end_offset == by["part=1:book=1:chapter=2"].end_offset == second
    assert by["part=1:book=1:chapter=1"].end_offset == PARTED.index('<milestone unit="chapter"/>')
    assert by["part=1:book=2"].end_offset == by["part=1:book=2:chapter=1"].end_offset == PARTED.index("</div1>")
    assert by["part=2"].end_offset == by["part=2:chapter=1"].end_offset  # never closed: ends with what encloses it
    assert all(r.end_offset is not None and r.end_offset <= len(PARTED) for r in rows)
    told = spark.createDataFrame([("d", "part:chapter"), ("d", "chapter:line"), ("e", None)], "doc_id string, scheme string")
    flat = {r.path: r for r in K.cited(K.sections(texts(spark, ("d", PARTED)), told), 4).collect()}
    assert "part=1:book=2" in flat and "part=1:chapter=3" in flat and "part=2:chapter=1:line=1" in flat
    assert flat["part=1:chapter=2"].end_offset == PARTED.index('<milestone unit="chapter"/>only')


def plain_context(text, at):
    import re

    stack = []
    for m in re.finditer(r"<(/?)([A-Za-z][\w.:-]*)[^>]*?(/?)>", text):
        if m[1] and m.start() < at or not m[1] and m.end() <= at:
            if m[1]:
                stack.pop()
            elif not m[3]:
                stack.append((m[0], m[2]))
    return "".join(t for t, _ in stack), "".join(f"</{n}>" for _, n in reversed(stack))


def test_slices_of_markup_are_well_formed(spark):
    import random
    import re
    from xml.etree import ElementTree

    whole = PARTED.replace("</l></body>", "</l></div1></body>")
    spots = sorted({m.end() for m in re.finditer("<[^>]*>", whole)} | {m.start() for m in re.finditer("<", whole)} | {whole.index("more") + 2})
    asked = spark.createDataFrame([("d", p) for p in spots] * 2 + [("d", None), ("none", 3), ("z", 0)], "doc_id string, offset int")
    docs = texts(spark, ("d", whole), ("none", None), ("e", ""))
    got = {r.offset: (r.open, r.close) for r in K.open_tags(docs, asked).collect()}
    assert got == {p: plain_context(whole, p) for p in spots}
    rng = random.Random(2)
    inner = [p for p in spots if p > len("<TEI.2>")]
    spans = [("d", *sorted(rng.sample(inner, 2))) for _ in range(40)]
    for r in K.slices(docs, spark.createDataFrame(spans, "doc_id string, from_offset int, to_offset int")).collect():
        assert "".join(ElementTree.fromstring(r.markup).itertext()) == re.sub("<[^>]*>", "", whole[r.from_offset : r.to_offset])
    ranges = spark.createDataFrame([("d", "part=1:book=1:chapter=2", "part=1:book=2"), ("d", "part=2", "part=1"), ("d", "part=9", "part=1")], "doc_id string, first string, last string")
    (one,) = K.passages(docs, K.cited(K.sections(docs), 4), ranges).collect()
    assert "".join(ElementTree.fromstring(one.markup).itertext()) == "c2 more xb2 only of q"
    assert K.open_tags(docs, asked.limit(0)).count() == 0


def test_languages_in_scope(spark):
    text = '<TEI.2><teiHeader><p>head</p></teiHeader><text lang="LA"><p>a<br>b<hi lang="grc">c<hi>d</hi><foreign class="x Latin">e</foreign>f</hi>g<q lang="zz">h<i>i</i></q></p><p lang="en">j<p>k</p>l</p>m</text>n<b lang="it">o'
    docs = spark.createDataFrame([("d", text, "fr"), ("none", None, "fr"), ("e", "", None), ("t", "plain words</p>", None)], "doc_id string, text string, lang string").withColumn("own", F.lit("clash"))
    got = {r.token: r.lang for r in K.scoped_tokens(docs).where("doc_id = 'd' and kind = 'word'").collect()}
    assert got == {"head": "en", "a": "la", "b": "la", "c": "greek", "d": "greek", "e": "la", "f": "greek", "g": "la", "h": "unknown", "i": "unknown", "j": "en", "k": "en", "l": "en", "m": "la", "n": "fr", "o": "it"}
    tags = {r.token: r.lang for r in K.scoped_tokens(docs).where("doc_id = 'd' and kind = 'tag'").collect()}
    assert tags['<hi lang="grc">'] == "greek" and tags["</q>"] == "unknown"
    assert {(r.token, r.lang) for r in K.scoped_tokens(docs).where("doc_id = 't' and kind = 'word'").collect()} == {("plain", None), ("words", None)}
    assert K.scoped_tokens(docs.limit(0)).count() == 0


def test_links_by_their_place(spark):
    text = '<text><div1 type="chapter" n="1"><p>see <bibl n="Hom. Il. 1"/> or <ref target="x">there</ref></p><div2 type="list" n="index"><ref target="y">z</ref><bibl>none</bibl></div2></div1><a href="u">w</a></text>'
    docs = spark.createDataFrame([("d", "lexicon", text), ("e", None, text), ("n", "lexicon", None)], "doc_id string, kind string, text string")
    got = sorted((r.doc_id, r.target, r.kind, r.around, r.caption) for r in K.placed_links(docs).collect())
    rows = lambda i, kind: [(i, "Hom. Il. 1", kind, "chapter=1", " or "), (i, "u", kind, None, "w"), (i, "x", kind, "chapter=1", "there"), (i, "y", "index", "chapter=1:list=index", "z")]
    assert got == rows("d", "lexicon") + rows("e", "text")
    assert K.placed_links(docs.limit(0)).count() == 0


def test_places_are_looked_up_without_a_shuffle(spark, monkeypatch):
    from scriptoria.operators import entities

    docs = spark.createDataFrame([(1, '<placeName key="a;x">home</placeName> <placeName n="none" reg="B">b</placeName> <placeName>nowhere</placeName> <persName reg="p:Smith,Jo">Jo</persName>')], "doc_id long, text string")
    known = spark.createDataFrame([("a", "A"), ("a", "A2"), ("b", "B"), ("b2", "B")], "auth_name string, display_name string").coalesce(1)
    found = entities.occurrences(docs, known)
    assert not [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(doc_id" in x]
    rows = sorted((r.k, r.auth_name, r.display_name, r.ambiguous) for r in found.collect())
    assert rows == [(1, "a", "A", True), (2, "b", "B", True), (4, "smith,jo", "Jo Smith", True)]
    monkeypatch.setattr(entities, "FEW", 0)
    assert sorted((r.k, r.auth_name, r.ambiguous) for r in entities.occurrences(docs, known).collect()) == [(k, a, m) for k, a, _, m in rows]


def test_references_read_their_sections_once(spark):
    from scriptoria.operators import resources

    chunks = spark.createDataFrame([(1, n, "order", f"order={n}", 5 * n, 5 * n + 4) for n in (2, 0, 1)] + [(1, 9, "line", "line=9", 0, 1)], "doc_id long, n int, type string, path string, start_offset long, end_offset long")
    refs = resources.references(chunks, "order")
    assert "Join" not in refs._jdf.queryExecution().executedPlan().toString()
    docs = spark.createDataFrame([(1, "abcd efgh ijkl"), (2, "none")], "doc_id long, text string")
    got = sorted((r.nth, r.first, r.previous, r.n_references, r.passage) for r in resources.passages(refs.withColumns({c: F.col(c).cast("int") for c in ("start_offset", "end_offset")}), docs).collect())
    assert got == [(1, "order=0", None, 3, "abcd"), (2, "order=0", "order=0", 3, "efgh"), (3, "order=0", "order=1", 3, "ijkl")]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_sections_deal_texts_once(spark):
    docs = texts(spark, ("d", PARTED), ("e", TEXT))
    found = K.cited_sections(docs, 4)
    assert exchanges(found) == 1 and "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, K.cited(K.sections(docs), 4).collect()))


def test_frequencies_in_a_document_deal_texts_once(spark):
    docs = spark.createDataFrame([(1, None, "s", "a b a\nc"), (2, "en", "s", None)], "doc_id long, lang string, source string, text string")
    tokens = S.parsed(S.tokens(S.dealt(docs, "doc_id")), spark.createDataFrame([("a", "x")], "form string, lemma string"))
    found = W.term_frequency(W.ambiguity_counts(tokens, "doc_id", "lang"), "doc_id", "lang")
    assert found._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(doc_id") == 1
    assert sorted((r.lemma, r.max_freq, round(r.tf, 6)) for r in found.collect()) == [("b", 1, 0.333333), ("c", 1, 0.333333), ("x", 2, 0.666667)]


def test_closing_tags_without_an_open_one_close_nothing(spark):
    text = "</x><a>b<c>d</c></a></a>e<!-- <n> --><f/>g<h\n k='1'>i"
    asked = spark.createDataFrame([("d", text.index(c)) for c in "bdegi"], "doc_id string, offset int")
    found = K.open_tags(texts(spark, ("d", text)), asked)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    assert {text[r.offset]: (r.open, r.close) for r in found.collect()} == {"b": ("<a>", "</a>"), "d": ("<a><c>", "</c></a>"), "e": ("", ""), "g": ("", ""), "i": ("<h\n k='1'>", "</h>")}


@pytest.mark.parametrize("name", ["section_contexts", "passage_ranges", "markup_sections"])
def test_sections_are_found_once_in_tasks_by_the_size_of_the_tables(spark, monkeypatch, name):
    from scriptoria import registry
    from scriptoria.sources import samples, tables
    from tests.oracle import differences

    folder, (queries, sql) = "/root/testdata/sf0.001", registry.load()
    monkeypatch.setattr(samples, "ITEMS", 500)
    monkeypatch.setattr(tables, "kept", None)
    tasks = -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500)
    plan = queries[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"Exchange hashpartitioning\(doc_id#\d+, (\d+)\)", plan)) == {str(tasks)} and plan.count("Generate posexplode") == 1
    assert differences(spark, folder, queries[name], sql[name]) == ""


def test_passages_of_a_text_meet_in_its_row(spark):
    docs = texts(spark, ("d", "<a><b>one</b><b>two</b></a>"), ("e", None)).repartition(4, "doc_id")
    sections = [("p=1", 3, 13), ("p=1", 13, 23), ("p=2", 13, 23)]
    held = spark.createDataFrame([(i, sections, [("p=1", "p=2"), ("p=2", "p=1"), ("p=1", "p=1"), ("p=1", None), (None, "p=2"), ("p=9", "p=2")]) for i in ("d", "e")], "doc_id string, sections array<struct<path:string,start_offset:int,end_offset:int>>, ranges array<struct<first:string,last:string>>")
    found = K.passages_within(docs, held.repartition(4, "doc_id"))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 2
    assert sorted((r.first, r.last, r.markup) for r in found.collect()) == [("p=1", "p=1", "<a><b>one</b></a>"), ("p=1", "p=2", "<a><b>one</b><b>two</b></a>")]
    chunks, ranges = held.select("doc_id", F.inline("sections")), held.select("doc_id", F.inline(F.concat("ranges", "ranges")))
    assert sorted(map(tuple, K.passages(docs, chunks, ranges).collect())) == sorted(map(tuple, found.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sections_are_found_by_one_walk_along_a_text(spark):
    from scriptoria import markup_queries

    found = K.cited_sections(texts(spark, ("d", PARTED)).withColumn("own", F.lit(5)), 4, carry=("own",))
    assert "Window" not in plan(found) and {r.own for r in found.collect()} == {5}
    for name in ("markup_sections", "milestone_sections", "sections_by_type"):
        assert "Window" not in plan(getattr(markup_queries, name)(spark, "/root/testdata/sf0.001"))


def test_a_milestone_may_be_held_by_one_that_began_before_the_element(spark):
    text = '</x><milestone unit="book" n="A"/><milestone unit="chapter"/><p><milestone unit="chapter"/></p><milestone unit="book"/><milestone unit="chapter"/><div type="entry" id="k"/><div1>'
    rows = K.cited_sections(texts(spark, ("d", text), ("e", "<!-- <l> -->"), ("f", "< <l>")), 3).orderBy("doc_id", "n").collect()
    assert [(r.doc_id, r.path, r.parent_n) for r in rows] == [("d", "book=A", None), ("d", "book=A:chapter=1", 1), ("d", "book=A:chapter=2", 1), ("d", "book=2", None), ("d", "book=2:chapter=1", 4), ("d", "book=2:chapter=1:entry=k", 5), ("d", "book=2:chapter=1:div1=1", 5)]


def test_spans_that_hold_starts_are_found_in_the_row(spark):
    from scriptoria.operators import structure

    rows = [(1, [0, 3, 9], [9, 5, 8], [0, 3, 5, 9, 12]), (2, [], [], [4]), (3, [1], [2], []), (4, [7, 0], [9, 9], [7])]
    df = spark.createDataFrame(rows, "i int, b array<bigint>, e array<bigint>, s array<bigint>").coalesce(1)
    got = {r.i: ([tuple(x) for x in r.w], r.a) for r in df.select("i", structure.starts_within("b", "e", "s").alias("w"), structure.spans_around("b", "e", "s").alias("a")).collect()}
    assert {i: ([n for _, n in w], a) for i, (w, a) in got.items()} == {1: ([4, 2, 0], [[0], [0, 1], [0, 1], [0], []]), 2: ([], [[]]), 3: ([0], []), 4: ([1, 1], [[0, 1]])}
    assert got[1][0][:2] == [(0, 4), (1, 2)]


def test_contents_and_passages_are_found_in_the_row_of_a_text(spark, monkeypatch):
    from scriptoria import markup_queries
    from scriptoria.sources import tables

    monkeypatch.setattr(tables, "kept", None)
    contents = plan(markup_queries.markup_contents(spark, "/root/testdata/sf0.001"))
    assert "_bucket" not in contents and "Window" not in contents
    assert "Window" not in plan(markup_queries.passages_by_reference(spark, "/root/testdata/sf0.001"))
    docs = texts(spark, ("d", '<div1 type="order" n="é"><l>x</l></div1><div1 type="order">y</div1>'), ("e", "<l>x</l>"))
    found = R.passages_within(K.cited_texts(docs, 2, carry=("text",)).select("doc_id", "text", R.references_within(F.col("sections"), "order").alias("refs")))
    assert [(r.path, r.nth, r.previous, r.next, r.first, r.n_references, r.passage) for r in found.orderBy("nth").collect()] == [
        ("order=é", 1, None, "order=2", "order=é", 2, '<div1 type="order" n="é"><l>x</l></div1>'), ("order=2", 2, "order=é", None, "order=é", 2, '<div1 type="order">y</div1>'),
    ]


def test_what_is_asked_of_known_paths_is_read_once(spark):
    asked = spark.createDataFrame([("w", "a=1:b=2"), ("w", "a=1:b=2"), ("w", None), (None, "a=1"), ("v", "a=1")], "work string, path string")
    known = spark.createDataFrame([("w", "a=1"), ("w", "a=1"), ("w", ""), (None, "a=1")], "work string, path string")
    found = R.nearest(asked, known, ["work"])
    assert plan(found).count("Join") == 1
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, [("w", "a=1:b=2", "a=1"), ("w", "a=1:b=2", "a=1"), ("w", None, None), (None, "a=1", None), ("v", "a=1", None)]))


def test_commentaries_are_found_for_the_lines_of_all_texts(spark):
    from scriptoria import markup_queries

    folder = "/root/testdata/sf0.01"
    found = markup_queries.commentaries_on_lines(spark, folder)
    of = F.split_part("doc_id", F.lit(":"), F.lit(3)).cast("long")
    assert found.where(of % 100 != 0).count() > 0


def test_passages_are_found_with_the_text_in_their_row(spark):
    text = "<a><b>one</b><b>two</b></a>"
    docs = texts(spark, ("d", text), ("e", text))
    held = spark.createDataFrame([(i, text, [("p=1", 13, 23), ("p=1", 3, 13), ("p=2", 13, 23)], [("p=1", "p=2"), ("p=2", "p=1"), ("p=1", "p=1"), ("p=1", None), (None, "p=2"), ("p=9", "p=2")]) for i in ("d", "e")], "doc_id string, text string, sections array<struct<path:string,start_offset:int,end_offset:int>>, ranges array<struct<first:string,last:string>>")
    found = K.passages_of(held)
    assert exchanges(found) == 0
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, K.passages_within(docs, held.drop("text")).collect())) and found.count() == 4


def test_mentions_meet_the_spans_that_hold_them_in_the_row(spark):
    text = '<a><date value="1990">x</date></a><a><b><persName reg="p:Smith,Jo">Jo</persName></b></a><name type="place" n="B">b</name><name>c</name>'
    at = text.index("<a><b>")
    spans = [("one", 0, at - 1), ("two", at, text.index("<name") - 1), ("three", at + 3, at + 6)]
    docs = spark.createDataFrame([("d", text, spans), ("e", None, spans), ("f", text, [])], "doc_id string, text string, held array<struct<path:string,start_offset:int,end_offset:int>>")
    known = spark.createDataFrame([("b", "B")], "auth_name string, display_name string").coalesce(1)
    found = N.occurrences(docs, known, "held")
    assert "Exchange hashpartitioning(doc_id" not in plan(found) and "Window" not in plan(found)
    rows = {(r.doc_id, r.auth_name): [s.path for s in r.within] for r in found.collect()}
    assert rows == {("d", "1990"): ["one"], ("d", "smith,jo"): ["two", "three"], ("d", "b"): [], ("f", "1990"): [], ("f", "smith,jo"): [], ("f", "b"): []}


@pytest.mark.parametrize("name", ["entities_by_section", "entities_under_their_division", "places_with_their_entries"])
def test_entities_meet_their_orders_without_a_join_of_texts(spark, monkeypatch, name):
    from scriptoria import markup_queries
    from scriptoria.sources import tables

    monkeypatch.setattr(tables, "kept", None)
    assert "_bucket" not in plan(getattr(markup_queries, name)(spark, "/root/testdata/sf0.001"))
