"""Catalogue files, Arabic letters and codes: hand-made cases, nulls, ties, repeated rows and empty tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from scriptoria.functions import arabic as R
from scriptoria.functions import dates as D
from scriptoria.functions import morphology as M
from scriptoria.operators import frequency as A
from scriptoria.operators import resources as W
from scriptoria.sources import loads as L
from scriptoria.sources import tables as S


def test_arabic_letters_lead_back(spark):
    known = [("kitAb", "كتاب", "kitAb"), ("A_n", None, "Iin"), ("sA^l", None, "sOl"), ("mu&min", None, "muWmin"), ("", "", ""), (None, None, None), ("~", None, "")]
    rows = spark.createDataFrame([(w, a, look) for w, a, look in known], "w string, a string, look string")
    got = rows.select("w", "a", "look", R.to_arabic(F.col("w")).alias("arabic"), R.lookup(F.col("w")).alias("looked")).collect()
    assert got[0].arabic == "كِتاب" and all(r.looked == r.look for r in got)
    assert got[4].arabic == "" and got[5].arabic is None
    draw = random.Random(5)
    words = [("".join(draw.choices(R.BUCKWALTER, k=draw.randint(0, 12))),) for _ in range(200)]
    rows = spark.createDataFrame(words, "w string").select("w", R.from_arabic(R.to_arabic(F.col("w"))).alias("back"), R.unfriendly(R.friendly(F.col("w"))).alias("plain"), R.to_dictionary(F.col("w")).alias("spelt"))
    for r in rows.select("*", R.from_dictionary(F.col("spelt")).alias("told")).collect():
        assert r.plain == r.w and r.back == r.w.replace("&", "W").replace("<", "I").replace(">", "O")
        # A followed by tatweel is spelt as the long initial i is, so only such words do not come back.
        assert "A_" in r.w or r.told == r.w
    assert len(R.BUCKWALTER) == len(R.ARABIC) == len(set(R.ARABIC))


def test_longest_key_wins(spark):
    rows = spark.createDataFrame([("aab",), ("ba\na",), ("",), (None,)], "t string")
    assert [r.x for r in rows.select(R.transliterated(F.col("t"), {"a": "1", "aa": "2", ".": "x"}).alias("x")).collect()] == ["2b", "b1\n1", "", None]
    assert [r.x for r in rows.select(R.unvowelled(F.lit("kitAbu")).alias("x")).collect()][0] == "ktAb"


def test_compound_codes(spark):
    one = {"prefix": "conj+", "pos": "prep"}
    rows = spark.createDataFrame([(one, {"pos": "noun", "number": "sg"}, {"possessive": "poss(3rd/masc/sing)", "number": "pl"}), (None, None, None), (None, {"pos": "verb", "object": "?"}, None), ({}, {}, {})], "b map<string,string>, s map<string,string>, a map<string,string>")
    got = rows.select(M.compound_features(F.col("b"), F.col("s"), F.col("a")).alias("f")).select("f", M.features_code(F.col("f"), "ar").alias("code")).collect()
    assert got[0].f == {"pos": "noun", "number": "sg", "possessive": "poss(3rd/masc/sing)", "prefix": "conj+"} and got[0].code == "n-s------m--c"
    assert got[1].f is None and got[1].code is None and got[2].code == "v----------!-" and got[3].code == "-" * 13
    codes = [("".join(["-", *values][(k + i) % (len(values) + 1)] for i, values in enumerate(M.CODES["ar"].values())),) for k in range(30)]
    back = spark.createDataFrame(codes, "c string").select("c", M.code_features(F.col("c"), "ar").alias("f")).select("c", M.features_code(F.col("f"), "ar").alias("b")).collect()
    assert all(r.c == r.b for r in back)


LEXICON = """<x><entryFree document="a" id="n1" key="lu_^o"><sense>first</sense></entryFree><entryFree document="a" id="n2" key="luo2"><sense> </sense></entryFree>
<entryFree document="a" id="n3" key="mare#1"><tr>sea</tr><sense>no</sense></entryFree><entryFree document="b" id="n1" key="luo"><sense>better</sense></entryFree>
<entryFree document="b" id="n2" key="mare"></entryFree><entryFree document="c" id="n9" key="luo2"><sense>late</sense></entryFree><entryFree document="a" id="n1" key="lu_^o"><sense>first</sense></entryFree></x>"""
ANALYSES = """<x><analysis><form>lues</form><orth>lu_es</orth><lemma>luo</lemma><pos>verb</pos></analysis><analysis><form>lues</form><lemma>per-luo#2</lemma></analysis>
<analysis><form>mar#i</form><lemma>mare</lemma></analysis><analysis><form>mar#i</form><lemma>mare</lemma></analysis><analysis><form>et</form><lemma>et</lemma></analysis></x>"""


def test_lexicon_and_parses(spark, tmp_path):
    (tmp_path / "lex.xml").write_text(LEXICON)
    (tmp_path / "ana.xml").write_text(ANALYSES)
    entries = L.lexicon_entries(spark, f"file://{tmp_path}/lex.xml")
    assert {(r.document, r.headword, r.sequence) for r in entries.collect()} == {("a", "luo", 1), ("a", "luo", 2), ("a", "mare", 1), ("b", "luo", 1), ("b", "mare", 1), ("c", "luo", 2)}
    plain = {(r.headword, r.sequence): r.definition for r in L.lemmas(entries).collect()}
    assert plain == {("luo", 1): "first", ("luo", 2): "late", ("mare", 1): "sea"}
    lemmas = L.lemmas(entries, better="b")
    assert {(r.authority_name, r.definition) for r in lemmas.collect()} == {("luo1", "better"), ("luo2", "late"), ("mare1", "sea")}
    assert L.lemmas(entries.limit(0), "b").count() == 0
    rows = S.analyses(spark, f"file://{tmp_path}/ana.xml")
    got = sorted((r.form, r.headword, r.sequence, r.expanded) for r in L.parses_of(rows, lemmas).collect())
    assert got == [("lues", "luo", 1, "lu_es"), ("lues", "luo", 2, "lu_es"), ("lues", "luo", 2, "lues"), ("mari", "mare", 1, "mari")]
    assert L.parses_of(rows, lemmas.limit(0)).count() == 0


def test_artifacts_and_their_images(spark, tmp_path):
    record = lambda name, kind, version, more: f"<artifact><name>{name}</name><type>{kind}</type><perseus_version>{version}</perseus_version>{more}</artifact>"
    more = "<periods></periods>" * 14
    (tmp_path / "art.xml").write_text("<Site>" + record("A &amp; B", "Site", "1.5", more) + record("Old", "Site", "5", more) + record("New", "Site", "", more) + record("Short", "Site", "1", "") + record("Odd", "Rock", "1", more) + record("Bare", "Site", "0", more) + "</Site>")
    found = L.artifacts(spark, f"file://{tmp_path}/art.xml")
    assert sorted((r.name, r.version) for r in found.collect()) == [("A &amp; B", 1.5), ("Bare", 0.0)]
    assert L.artifacts(spark, f"file://{tmp_path}/art.xml", {"Rock": 17}).first().name == "Odd"
    name = lambda n, *names: f"<image><archive_number>{n}</archive_number>" + "".join(f"<{t}>{v}</{t}>" for t, v in zip(("name", "secondary_name", "tertiary_name"), names)) + "</image>"
    (tmp_path / "names.xml").write_text("<ImageNames>" + name(1, "A &amp; B", "A &amp; B") + name(2, "x", "", "A &amp; B") + name(3, "Old") + name(1, "A &amp; B") + "</ImageNames>")
    (tmp_path / "img.xml").write_text("<Image><img><archive_number>1</archive_number><caption>north</caption><status>7</status></img><img><archive_number>1</archive_number><caption>south</caption><status>?</status></img></Image>")
    images = L.images(spark, f"file://{tmp_path}/img.xml")
    assert sorted((r.caption, r.status) for r in images.collect()) == [("north", 7), ("south", None)]
    got = L.occurrences(found.unionByName(found), L.image_names(spark, f"file://{tmp_path}/names.xml"), images)
    assert sorted(map(tuple, got.collect())) == [("A &amp; B", "1", "north"), ("A &amp; B", "2", None)]
    (tmp_path / "words.xml").write_text("<Keywords><artifactKeyword><artifactName>A &amp; B</artifactName><artifactType>Site</artifactType><keyclass>k</keyclass><keyword>w</keyword></artifactKeyword></Keywords>")
    assert tuple(L.artifact_keywords(spark, f"file://{tmp_path}/words.xml").first()) == ("A &amp; B", "Site", "k", "w")


def test_places_and_markers(spark, tmp_path):
    (tmp_path / "tgn.xml").write_text("<TGN><row><id>1</id><name>Roma</name><cname>Rome</cname><nation>Italia</nation><lon>12.5</lon><lat>41.9</lat></row><row><id>2</id><name>Nowhere</name><state>S</state><lon>?</lon><lat></lat></row></TGN>")
    got = L.gazetteer(spark, f"file://{tmp_path}/tgn.xml").orderBy("authority_name").collect()
    assert (got[0].display_name, got[0].site, got[0].lat) == ("Rome, Italia", "Rome", 41.9) and (got[1].display_name, got[1].lat, got[1].lon) == ("Nowhere, S", None, None)
    rows = spark.createDataFrame([("a & <b>", 1.0, 2.0, 5), ("c", 3.0, 4.0, 9), ("d", 3.0, 4.0, 5), ("e", 0.0, 1.0, 8)], "site string, lat double, lon double, n int")
    path = L.write_markers(rows, f"file://{tmp_path}/marks", most=3)
    assert sorted(r.site for r in S.places(spark, path).collect()) == ["a & <b>", "c"]


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("la", "arma", 1900, 3), ("la", "arma", 1899, 1), ("en", "arms", 1900, 2)], "lang string, word string, year int, count int")
    S.write_timeplot(rows, f"file://{tmp_path}/plot")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/plot/lang=la/word=arma").collect()] == ["1899,1", "1900,3"]
    line = S.annotation_rdf(spark.createDataFrame([(4, "t:1:line=2", "tgn,9")], "n int, citation string, place string"), "http://x").first().value
    assert line == "<http://x/annotations/4> a oac:Annotation ; oac:hasBody <http://x/places/tgn,9> ; oac:hasTarget <http://x/texts/t:1:line=2> ."


def test_pages_passages_times(spark):
    rows = spark.createDataFrame([(k, k % 3) for k in range(10)], "id int, n int")
    got = A.first_pages(rows, {"n": [F.desc("n"), "id"], "id": ["id"]}, 3).orderBy("sorted_by", "place").collect()
    assert [(r.sorted_by, r.place, r.id) for r in got] == [("id", 1, 0), ("id", 2, 1), ("id", 3, 2), ("n", 1, 2), ("n", 2, 5), ("n", 3, 8)]
    assert A.first_pages(rows.limit(0), {"id": ["id"]}, 3).count() == 0
    passages = spark.createDataFrame([("a", "w", "p=1"), ("b", "w", "p=1"), ("b", "w", "p=2"), ("c", "v", "p=1"), ("d", None, "p=1"), ("e", None, "p=1")], "doc_id string, work string, path string")
    assert sorted(map(tuple, W.same_passages(passages, passages).collect())) == [("a", "p=1", "b:p=1"), ("b", "p=1", "a:p=1")]
    times = spark.createDataFrame([(24, 60, 60, 1.0), (25, 0, 0, 0.0), (-1, -1, -1, None), (None, None, None, None), (0, 61, 0, 0.0), (0, 0, -2, 0.0), (0, 0, 0, 1.1)], "h int, m int, s int, f double")
    assert [r.v for r in times.select(D.is_valid_time(*map(F.col, "hmsf")).alias("v")).collect()] == [True, False, True, True, False, False, False]


def test_lemmas_of_a_corpus_match_plain_sums(spark):
    draw = random.Random(9)
    texts = [(k, " ".join(draw.choices(["luo", "Lues", "lues", "mare", "maris", "et", "x"], k=draw.randint(0, 30)))) for k in range(20)] + [(90, None), (91, "")]
    parses = [("luo", "luo"), ("lues", "luo"), ("lues", "lues"), ("mare", "mare"), ("mare", "mas"), ("maris", "mare"), ("maris", "mare"), ("unseen", "y")]
    want = {}
    for k, t in texts:
        for w in (t or "").lower().split():
            of = sorted({lemma for f, lemma in parses if f == w}) or [w]
            for lemma in of:
                m = want.setdefault(lemma, [0, 0, 0.0, set()])
                m[0], m[1], m[2] = m[0] + 1, m[1] + (len(of) == 1), m[2] + 1 / len(of)
                m[3].add(k)
    docs, table = spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(parses, "form string, lemma string")
    got = {r.lemma: (r.max_freq, r.min_freq, round(r.weighted_freq, 6), r.n_docs) for r in A.corpus_lemmas(docs, table).collect()}
    assert got == {k: (m[0], m[1], round(m[2], 6), len(m[3])) for k, m in want.items()}
    assert A.corpus_lemmas(docs.limit(0), table).count() == 0 and A.corpus_lemmas(docs, table.limit(0)).where("lemma = 'lues'").count() == 1


def test_files_of_markup_are_bounded(spark, monkeypatch):
    import os

    monkeypatch.setattr(L, "FILE_ROWS", 100)
    path = L.write_xml(spark.range(1050).coalesce(1).selectExpr("id as n"), S.shared_folder(spark, "bounded"), "rows", "row")
    files = [f for f in os.listdir(path.removeprefix("file://")) if f.startswith("part-")]
    assert len(files) == 11 and S.xml_rows(spark, path, "row", "n long").selectExpr("sum(n)", "count(*)").first() == (1049 * 525, 1050)
