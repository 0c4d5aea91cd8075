"""Periodic runs, language identification and the filter audit against plain versions and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptoria.llm import audit, langid, queries, runs
from tests.llm.test_operators import EDGE, FOLDER, docs, empty


def plain_runs(w, least=2, times=2):
    """Every (start, length, smallest period), found by comparing each word with those at each distance."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j - i >= q and size >= max(least, times * q) and not any(all(w[x] == w[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = [rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(rng.randrange(0, 70))]
    for _ in range(rng.randrange(3)):
        if words:
            a, p = rng.randrange(len(words)), rng.randrange(1, 9)
            for i in range(a + p, min(len(words), a + p * rng.randrange(2, 8))):
                words[i] = words[i - p]
    return words


def test_tandem_runs_are_those_of_plain_comparison():
    rng = random.Random(5)
    for _ in range(600):
        words = random_words(rng)
        numbers = {w: k for k, w in enumerate(sorted(set(words)))}
        assert sorted(runs.tandem_runs([numbers[w] for w in words]), key=lambda r: (r[0], r[2])) == plain_runs(words)


def test_suffix_tree_holds_every_factor_where_it_stands_first():
    rng = random.Random(6)
    for _ in range(60):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        tree = runs.SuffixTree(s)
        assert sorted(tree.leaves) == list(range(len(s) + 1))
        for v in range(1, len(tree.start)):
            word = tree.text[tree.first[v] : tree.first[v] + tree.depth[v]]
            places = [i for i in range(len(tree.text) - len(word) + 1) if tree.text[i : i + len(word)] == word]
            assert sorted(tree.leaves[tree.low[v] : tree.high[v]]) == places and tree.first[v] == places[0]
        bounds = tree.blocks()
        for a, b in zip(bounds, bounds[1:]):
            earlier = lambda n: any(s[j : j + n] == s[a : a + n] for j in range(a))
            assert b == len(s) or not earlier(b - a + 1)
            assert b == a + 1 or earlier(b - a)


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (9, 3)])
def test_periodic_runs_of_texts(spark, least, times):
    rng = random.Random(times)
    texts = [(k, rng.choice(["", "\n "]).join(w + rng.choice([" ", "\t", "  "]) for w in random_words(rng))) for k in range(120)]
    texts.append((500, "Aa aa Aa aa Aa aa Aa aa " + "the quick one " * 30 + "é é " * 8))
    for r in runs.periodic_runs(docs(spark, texts), least, times).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", dict(texts)[r.doc_id])
        want = plain_runs(words, least, times)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(words)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs_edge_cases(spark):
    got = runs.periodic_runs(docs(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by[7].runs] == [(0, 4000, 1)] and by[7].collapsed == "word"
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].runs == [] and by[1].collapsed == ""
    assert runs.periodic_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs(spark), times=1)


def test_the_query_plants_periods_and_digests_runs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    seen = 0
    for r in queries.op11_periodic_runs(spark, FOLDER).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        want = plain_runs(w, 6, 4)
        gone = {i for s, size, q in want for i in range(s + q, s + size)}
        top = min(want, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        seen += len(want)
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in want)
        assert tuple(r)[1:6] == (len(want), *top, 1000 * top[1] // top[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
    assert seen


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 9, 40])
def test_codewords_differ_in_rows_and_bits(n):
    code = langid.codewords(n)
    assert {tuple(r) for r in code} == {tuple(r) for r in np.unique(code, axis=0)} and len(np.unique(code, axis=0)) == n
    assert (np.abs(code.sum(axis=0)) < n).all()
    least = min((code[a] != code[b]).sum() for a in range(n) for b in range(a))
    assert least >= (2 ** (n - 2) if n <= langid.EXHAUSTIVE else 5)


def test_decoding_mends_a_wrong_bit():
    code = langid.codewords(4)
    coder = langid.Coder(["a", "b", "c", "d"], code, np.eye(7), np.zeros(7), np.full(code.shape, 1 / 7))
    for k in range(4):
        for bit in range(7):
            x = 4 * code[k].copy()
            x[bit] *= -0.5
            best, score, unclear = coder.decoded(x[None])
            assert best[0] == k and 0.5 < score[0] <= 1 and not unclear[0]
    halfway = np.where(code[0] == code[1], code[0], 0)
    assert coder.decoded(4 * halfway[None])[2][0]


def test_languages_of_held_out_texts(spark):
    found = queries.op12_language_id(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_edge_cases(spark):
    train = spark.createDataFrame([(k, t * (k % 5 + 1), lang) for k in range(40) for t, lang in (("the cat and this dog ", "en"), ("der hund und diese katze ", "de"), ("not counted ", None))], "doc_id long, text string, lang string")
    coder = langid.train_languages(train, lambda i: F.lit(True))
    assert coder.languages == ["de", "en"]
    rows = docs(spark, [*EDGE, (20, "12 34 !!"), (21, "DIESE KATZE UND DER HUND"), (22, "this and the dog")])
    got = {r.doc_id: r for r in langid.identified(rows, coder, ("label",)).collect()}
    assert got[21].lang_pred == "de" and got[22].lang_pred == "en" and got[22].label == "clash"
    assert all(got[k].lang_pred == "und" and got[k].score == 0 and got[k].ambiguous for k in (1, 2, 3, 20))
    assert langid.identified(rows, coder).count() == len(EDGE) + 3
    one = langid.train_languages(train.where("lang = 'en'"), lambda i: F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.identified(rows.where("doc_id > 20"), one).collect()} == {("en", 1.0)}
    none = langid.train_languages(train.limit(0), lambda i: F.lit(True))
    assert {r.lang_pred for r in langid.identified(rows, none).collect()} == {"und"}
    assert langid.identified(empty(spark), coder).count() == 0


def test_language_sample_is_bounded_for_a_hot_repeated_row(spark):
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 3000, F.lit("la la")).otherwise(F.concat(F.lit("ab cd "), F.col("id"))).alias("text"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("lang"))
    assert langid.train_languages(rows, lambda i: F.lit(True), sample=100).languages == ["x", "y"]


AUDITED = [(1, None, "a"), (2, "", "a"), (3, "Few Words | here", None), (4, "w " * 250, "a"), (5, "w " * 250, "b"), (5, "w " * 250, "b"), (6, " ".join(f"w{k}" for k in range(210)), "b"), (None, "w " * 250, "a"), (7, "ABC def", ""), (2, "", "b"), (3, "x#", "a")]


def test_audit_is_that_of_plain_filtering(spark):
    rows = spark.createDataFrame(AUDITED, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in ("part", "mask", "n", "good", "toxic", "quality", "step", "digest")})
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, None, 1), (5, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audited(rows, labels).collect()}
    good, toxic = {1, 2, 5}, {2, 4, 5}
    fails = []
    for i, t, _ in AUDITED:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        low = min((j for j, u, _ in AUDITED if j is not None and (u or "") == t), default=None)
        fails.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and low < i})
    removed = {}
    for part in ("", "a", "b"):
        members = [k for k, (_, _, s) in enumerate(AUDITED) if (s or "") == part]
        for order in permutations("ABCDE"):
            there = set(members)
            for step, f in enumerate(order, 1):
                out = {k for k in there if fails[k][f]}
                want = (len(there - out), len(out), sum(fails[k][f] for k in set(members) - there), sum(fails[k][f] and sum(fails[k].values()) == 1 for k in members), sum(AUDITED[k][0] in good for k in out), sum(AUDITED[k][0] in toxic for k in out))
                there -= out
                removed[part, f] = removed.get((part, f), 0) + len(out)
                assert got[part, "".join(order), step][:6] == want
    assert len(got) == 3 * 600
    assert all(v[6] == removed[part, order[step - 1]] for (part, order, step), v in got.items())
    assert audit.audited(rows.limit(0), labels).count() == 0
    assert audit.audited(rows, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0
    with pytest.raises(ValueError):
        audit.interactions(rows, "AAB")
