"""Functions and operators that SQL cannot check: plain versions, nulls, ties and empty tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from scriptoria.functions import morphology as M
from scriptoria.functions import text as X
from scriptoria.operators import catalogue_ops as C
from scriptoria.operators import frequency as A
from scriptoria.operators import search as Q


def _table(a, b, border, cell):
    t = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i and j:
                t[i][j] = cell(t[i - 1][j - 1], t[i - 1][j], t[i][j - 1], a[i - 1] == b[j - 1])
            else:
                t[i][j] = border * (i + j)
    return t[-1][-1]


def test_alignment_scores_match_a_plain_table(spark):
    draw = random.Random(3)
    pairs = [("".join(draw.choices("abc", k=draw.randint(0, 7))), "".join(draw.choices("abc", k=draw.randint(0, 7)))) for _ in range(60)]
    rows = spark.createDataFrame([*pairs, (None, "a")], "a string, b string")
    got = rows.select("a", "b", X.similarity_score(F.col("a"), F.col("b")).alias("s"), X.vocalisation_score(F.col("a"), F.col("b")).alias("v")).collect()
    for r in got:
        if r["a"] is None:
            assert r["s"] is None and r["v"] is None
            continue
        s = _table(r["a"], r["b"], -0.05, lambda d, u, w, same: max(d + same, u - 0.05, w - 0.05))
        v = _table(r["a"], r["b"], 0.0, lambda d, u, w, same: min(d if same else d + 2, u + 1, w + 1))
        assert abs(r["s"] - s) < 1e-9 and abs(r["v"] - 1 / (v or 0.0001)) < 1e-6


def test_similarity_of_known_pairs(spark):
    rows = spark.createDataFrame([("ab", "cb", 1.0), ("abc", "xyz", 0.0), ("arma", "alma", 3.0), ("", "ab", -0.1), ("", "", 0.0)], "a string, b string, want double")
    assert all(abs(r["s"] - r["want"]) < 1e-9 for r in rows.select("want", X.similarity_score(F.col("a"), F.col("b")).alias("s")).collect())


def test_codes_and_features(spark):
    rows = spark.createDataFrame([("v3sria---",), ("?--------",), ("",), (None,)], "code string")
    got = rows.select("code", M.code_features(F.col("code"), "la").alias("f")).select("f", M.features_code(F.col("f"), "la").alias("back")).collect()
    assert got[0]["f"] == {"pos": "verb", "person": "3rd", "number": "sg", "tense": "perf", "mood": "ind", "voice": "act"} and got[0]["back"] == "v3sria---"
    assert got[1]["f"] == {} and got[1]["back"] == "---------" and got[2]["f"] == {}
    assert got[3]["f"] is None and got[3]["back"] is None


def test_longest_abbreviation_wins(spark):
    known = spark.createDataFrame([(["hom"], "poet"), (["hom", "il"], "iliad"), (["x"], "x")], "tokens array<string>, target string")
    rows = spark.createDataFrame([(1, "Hom. Il. 9.1"), (2, "Hom. Od. 1"), (3, "Verg. 1"), (4, None), (5, ""), (6, "Hom. Il. 9.1")], "id int, citation string")
    assert {r["id"]: r["target"] for r in Q.abbreviated(rows, "citation", known).collect()} == {1: "iliad", 2: "poet", 3: None, 4: None, 5: None, 6: "iliad"}
    assert Q.abbreviated(rows.limit(0), "citation", known).count() == 0


def test_one_of_each_is_one_of_its_kind(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(30)] + [(None, 99)], "kind int, id int")
    got = C.one_of_each(rows, "kind", "id").collect()
    assert len(got) == 4 and all(r["kind"] == (None if r["id"] == 99 else r["id"] % 3) for r in got)


def test_names_and_forms_with_nulls(spark):
    rows = spark.createDataFrame([(1, "a", "b"), (2, "b", "b"), (3, None, "c")], "id int, x string, y string")
    names = spark.createDataFrame([("b",), ("b",), (None,)], "name string")
    assert sorted(r["id"] for r in C.equal_in_any(rows, "id", ["x", "y"], names, "name").collect()) == [1, 2]
    forms = spark.createDataFrame([("a",), ("a",), ("z",)], "word string")
    assert [r["word"] for r in C.without_match(forms, spark.createDataFrame([("a",)], "word string"), "word").collect()] == ["z"]


def test_weights_of_ambiguous_words(spark):
    rows = spark.createDataFrame([(1, "p", "a", 2, "w"), (1, "p", "b", 2, "w"), (1, None, "a", 1, "v")], "doc_id int, previous string, lemma string, k int, word string")
    assert {(r["previous"], r["lemma"]): r["weight"] for r in A.bigram_weights(rows, "previous", "lemma", "k").collect()} == {("p", "a"): 0.5, ("p", "b"): 0.5}
    assert {r["lemma"]: r["share"] for r in A.lemma_shares_in_document(rows).collect()} == {"a": 0.75, "b": 0.25}


def test_reindexed_documents_replace_their_postings(spark, tmp_path):
    from scriptoria.streaming.incremental import current_postings, replace_documents

    path = f"file://{tmp_path}/index"
    write = replace_documents(path)
    batch = lambda *rows: spark.createDataFrame([(*r, "en", "web") for r in rows], "doc_id long, text string, lang string, source string")
    write(batch((1, "old words\nold line"), (2, "kept words"), (3, "gone")), 0)
    for _ in range(2):  # a repeated batch
        write(batch((1, "new words"), (3, "")), 1)
    got = sorted((r.doc_id, r.term, len(r.positions)) for r in current_postings(spark, path).collect())
    assert got == [(1, "new", 1), (1, "words", 1), (2, "kept", 1), (2, "words", 1)]
