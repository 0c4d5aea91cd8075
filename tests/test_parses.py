"""Evaluators of parses in context against plain sums, and hand-made cases."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from scriptoria.operators import parses as P

PARSES = [("luo", "luo", "v1spia"), ("luo", "luo", "v1spsa"), ("lues", "luo", "v2spia"), ("lues", "lues", "n-s--f"), ("et", "et", "c-----"), ("nunc", "nunc", "d-----"), ("nunc", "et", "d-----"), ("mare", "mare", "n-s--n"), ("mare", "mas", "n-s--n"), ("mare", "mare", "n-p--n")]


def features(code):
    return [f"{k}{c}" for k, c in enumerate(code, 1) if c != "-"]


def test_features_that_tell_parses_apart(spark):
    table = spark.createDataFrame([("f", "a", "v1siia"), ("f", "a", "v3piia"), ("f", "a", "v3siia"), ("g", "b", "n-s---"), ("h", "c", "n-s---"), ("h", "d", "n-s---"), ("h", "d", "n-s---"), (None, "x", "n-s---")], "form string, lemma string, code string")
    got = {(r.form, r.lemma, r.code): (r.k, r.special) for r in P.told_apart(table).collect()}
    assert got["f", "a", "v1siia"] == (3, ["21", "3s"]) and got["f", "a", "v3piia"] == (3, ["23", "3p"]) and got["f", "a", "v3siia"] == (3, ["23", "3s"])
    assert got["g", "b", "n-s---"] == (1, ["1n", "3s"]) and got["h", "c", "n-s---"] == got["h", "d", "n-s---"] == (2, ["1n", "3s"])
    assert P.told_apart(table.limit(0)).count() == 0
    rows = spark.createDataFrame([("v3s-",), ("----",), ("",), (None,)], "c string").select(P.marks(F.col("c")).alias("m")).collect()
    assert [r.m for r in rows] == [["1v", "23", "3s"], [], [], None]


def plain_scores(texts):
    of = defaultdict(list)
    for f, lemma, code in PARSES:
        of[f].append((lemma, code))
    counts, pairs = Counter(), Counter()
    for t in texts:
        w = t.lower().split()
        counts.update(w)
        pairs.update(zip(w, w[1:]))
    cube = Counter()
    for w, n in counts.items():
        for _, code in of.get(w, []):
            fs = features(code)
            for size in range(len(fs) + 1):
                for s in combinations(fs, size):
                    cube[";".join(s)] += n / len(of[w])
    shares = lambda xs: {k: (v / sum(xs.values()) if sum(xs.values()) > 0 else 1 / len(xs)) for k, v in xs.items()}
    own = {}
    for w in counts:
        if w in of:
            xs = {}
            for p in of[w]:
                special = [f for f in features(p[1]) if any(f not in features(q[1]) for q in of[w])] or features(p[1])
                xs[p] = cube[";".join(special)]
            own[w] = shares(xs)
    lattice = Counter()
    for (a, b), n in pairs.items():
        for pl, pc in of.get(a, []):
            for p in of.get(b, []):
                lattice[pl, pc, p] += n / (len(of[a]) * len(of[b]))
    after = {}
    for a, b in pairs:
        if b not in of:
            continue
        telling = any(c[1:].strip("-") for _, c in of.get(a, []))
        codes, lemmas = {c for _, c in of.get(a, [])}, {x for x, _ in of.get(a, [])}
        fits = lambda pl, pc: a not in of or (pc in codes if telling else pl in lemmas)  # noqa: E731, B023
        after[a, b] = shares({p: sum(v for (pl, pc, q), v in lattice.items() if q == p and fits(pl, pc)) for p in of[b]})
    return own, after


def test_evaluators_are_those_of_plain_sums(spark):
    rng = random.Random(8)
    vocabulary = sorted({f for f, _, _ in PARSES}) + ["unknown", "Et"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(900, None), (901, ""), (902, "zzz"), (903, "et")], "doc_id int, text string").withColumns({c: F.lit("clash") for c in ("form", "k", "word", "score", "previous")})
    table = spark.createDataFrame(PARSES + PARSES[:2], "form string, lemma string, code string")
    own, after = plain_scores([*texts, "zzz", "et"])
    counts = docs.select(F.explode(F.split(F.lower("text"), " ")).alias("word")).where("word != ''").groupBy("word").agg(F.count("*").alias("n"))
    got = P.by_form_frequency(table, counts).collect()
    assert {(r.form, r.lemma, r.code): round(r.share, 9) for r in got} == {(w, *p): round(x, 9) for w, xs in own.items() for p, x in xs.items()}
    got = P.by_prior_frequency(table, P.word_pairs(docs)).collect()
    assert {(r.previous, r.form, r.lemma, r.code): round(r.share, 9) for r in got} == {(a, b, *p): round(x, 9) for (a, b), xs in after.items() for p, x in xs.items()}
    want = {}
    for i, t in [*enumerate(texts), (903, "et")]:
        words = t.lower().split()
        for k, w in enumerate(words):
            if w in own:
                score = {p: round((own[w][p] + after[words[k - 1], w][p]) / 2 if k else own[w][p], 9) for p in own[w]}
                want[i, k + 1] = min(score, key=lambda p: (-score[p], p))
    assert {(r.doc_id, r.pos): (r.lemma, r.code) for r in P.chosen_in_context(docs, table).collect()} == want
    assert P.chosen_in_context(docs.limit(0), table).count() == 0 and P.chosen_in_context(docs, table.limit(0)).count() == 0
