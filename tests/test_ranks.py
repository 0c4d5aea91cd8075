"""Places and runs over ranges, pairs of content words and entities against plain versions."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from scriptoria.functions.text import holds_word, words
from scriptoria.operators import entities as N
from scriptoria.operators import frequency as A
from scriptoria.operators import ranks as O

HOT = [(g, (k * 7919) % 997, k) for k in range(1200) for g in (["hot"] if k % 3 else ["hot", None, "b"])]


def test_places_of_a_hot_group_in_many_ranges(spark):
    rows = spark.createDataFrame(HOT, "g string, v long, id long").repartition(7)
    got = O.placed(rows, ["g"], [F.desc("v"), F.col("id")], ranges=5).collect()
    for group in ("hot", None, "b"):
        mine = [r["id"] for r in sorted((r for r in got if r["g"] == group), key=lambda r: r["place"])]
        assert mine == [i for g, v, i in sorted((h for h in HOT if h[0] == group), key=lambda h: (-h[1], h[2]))]
        assert sorted(r["place"] for r in got if r["g"] == group) == list(range(1, len(mine) + 1))


def test_places_with_ties_repeats_nulls_and_without_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, 2)], "g string, v long")
    got = sorted((str(r["g"]), r["place"]) for r in O.placed(rows, ["g"], [F.col("v")], ranges=3).collect())
    assert got == [("None", 1), ("a", 1), ("a", 2), ("a", 3)]
    assert O.placed(rows.where("false"), ["g"], [F.col("v")]).count() == 0
    assert sorted(r["place"] for r in O.placed(rows, [], [F.col("v")], ranges=2).collect()) == [1, 2, 3, 4]


def test_runs_that_cross_ranges(spark):
    rng = random.Random(5)
    plain = [(g, k, rng.choice(["x", "x", "x", "y", None])) for g in ("hot", None) for k in range(900 if g else 40)]
    rows = spark.createDataFrame(plain, "g string, id long, lang string").repartition(6)
    got = {(r["g"], r["id"]): r["run"] for r in O.runs(rows, ["g"], [F.col("id")], "lang", ranges=9).collect()}
    expected, run, last = {}, {}, {}
    for g, k, lang in plain:
        if g not in run or lang is None or last[g] != lang:
            run[g] = run.get(g, 0) + 1
        last[g] = lang
        expected[g, k] = run[g]
    assert got == expected


def test_runs_longer_than_a_range(spark):
    rows = spark.createDataFrame([("g", k, "same") for k in range(500)], "g string, id long, lang string")
    assert {r["run"] for r in O.runs(rows, ["g"], [F.col("id")], "lang", ranges=8).collect()} == {1}


def test_heads_keep_their_places_in_the_whole_group(spark):
    rows = spark.createDataFrame([("en", f"w{k:03d}", (k * 37) % 101) for k in range(100)] + [(None, "z", 1)], "lang string, lemma string, n long")
    got = {(r["lang"], r["lemma"]): (r["by_n"], r["by_name"]) for r in O.heads_of_orders(rows, ["lang"], {"by_n": [F.desc("n"), F.col("lemma")], "by_name": [F.col("lemma")]}, "lemma", 2).collect()}
    by_n = sorted(range(100), key=lambda k: (-((k * 37) % 101), k))
    heads = {*by_n[:2], 0, 1}
    assert got == {(None, "z"): (1, 1), **{("en", f"w{k:03d}"): (by_n.index(k) + 1, k + 1) for k in heads}}


def test_pairs_of_content_words(spark):
    stop = ["the", "of", "a"]
    texts = ["The man of the\nhouse and a dog", "the of a", "", None, "dog &amp; [x man[ing]", "the " * 3000 + "end " + "of " * 3000 + "it"]
    expected: dict = {}
    for text in texts:
        last = None
        for w in [r[0] for r in spark.createDataFrame([(text,)], "text string").select(F.explode(words(F.col("text")))).collect()]:
            w = w.lower()
            if last is not None:
                expected[last, w] = expected.get((last, w), 0) + 1
            last = last if w in stop else w
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {(r["previous"], r["word"]): r["n"] for r in A.content_pairs(rows, stop).collect()} == expected
    assert expected["end", "of"] == 3000 and expected["man", "house"] == 1
    assert A.content_pairs(rows.where("false"), stop).count() == 0


def test_texts_that_hold_words(spark):
    rows = spark.createDataFrame([("a",), ("&amp;",), ("12 _",), ("",), (None,)], "text string")
    assert [r[0] for r in rows.select(holds_word(F.col("text"))).collect()] == [True, False, False, False, None]


def test_entities_of_every_class_in_one_reading(spark):
    text = (
        '<p><placeName key="tgn,1;x">Rome</placeName> <placeName reg="Athens">there (Gr.)</placeName> <placeName>Nowhere</placeName>'
        '<persName reg="full:Smith,John,nomatch">J. Smith</persName> <persName>Nobody</persName> <persName reg="full:Doe">the old man Doe</persName>'
        '<date value="1850-02-03">then</date><date>unreadable</date><dateRange from="1850" to="1851"><name type="place">Athens</name> <name type="ship">Argo</name></p>'
    )
    gazetteer = spark.createDataFrame([("tgn,1", "Roma"), ("tgn,2", "Athens"), ("tgn,0", "Athens")], "auth_name string, display_name string")
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "<p>no names</p>")], "doc_id int, text string")
    got = sorted((r["k"], r["class"], r["auth_name"], r["display_name"], r["ambiguous"]) for r in N.occurrences(docs, gazetteer).collect())
    assert [g[:4] for g in got if g[1] in ("place", "person")] == [
        (1, "place", "tgn,1", "Roma"),
        (2, "place", "tgn,0", "Athens"),
        (4, "person", "smith,john", "John Smith"),
        (6, "person", "doe", "Doe"),
        (10, "place", "tgn,0", "Athens"),
    ]
    assert [g[4] for g in got if g[1] in ("place", "person")] == [True, False, True, False, True]
    assert [(g[0], g[1], g[4]) for g in got if g[1] in ("date", "range")] == [(7, "date", False), (9, "range", False)]
    assert all(r["end_offset"] - r["start_offset"] > 0 and text[r["start_offset"]] == "<" for r in N.occurrences(docs, gazetteer).collect())
