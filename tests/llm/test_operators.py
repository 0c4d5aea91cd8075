"""The training-data operators against plain versions, round trips and hand-made cases."""

from __future__ import annotations

import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptoria.llm import decontaminate, licenses, lm, mpeg, near_dup, pieces, quality, toxicity, urls, warc
from scriptoria.llm.graph import components
from scriptoria.llm.queries import PIECES

FOLDER = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, "   \n"), (None, "a null id with some words in it"), (4, "same words in the same order here"), (5, "same words in the same order here"), (5, "same words in the same order here"), (6, "x" * 5000), (7, "word " * 4000), (8, "Ünïcödé ✓ 🦙 text")]


def docs(spark, rows=EDGE):
    """Rows with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in ("score", "sig", "bands", "n", "window", "label", "x", "template", "row_id", "train", "component")})


def empty(spark):
    return docs(spark, []).limit(0)


def random_texts(n: int, seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for k in range(n):
        if out and rng.random() < 0.5:
            words = rng.choice(out)[1].split()
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))]
        out.append((k * 3 + 1, " ".join(words)))
    return out


def plain_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return {i: (len(sets[i]), comp[i]) for i in ids}


@pytest.mark.parametrize("size,percent", [(4, 80), (5, 80), (2, 60)])
def test_near_duplicates_are_those_of_all_pairs(spark, size, percent):
    rows = random_texts(160, size)
    got = near_dup.near_duplicates(docs(spark, rows), size, percent).collect()
    want = plain_components(rows, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_a_large_group(spark):
    base = [f"v{k}" for k in range(60)]
    rng = random.Random(3)
    rows = [(k, " ".join(w if rng.random() > 0.02 else f"z{rng.randrange(9999)}" for w in base)) for k in range(300)]
    got = near_dup.near_duplicates(docs(spark, rows), 3, 80).collect()
    want = plain_components(rows, 3, 80)
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in want.items()}


def test_near_duplicates_edge_cases(spark):
    got = near_dup.near_duplicates(docs(spark), 4, 80).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[None].component_id is None and not by[None].kept
    assert by[5].component_id == 4 and by[4].kept and by[7].n_shingles == 1
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_link_all_texts_of_an_id(spark):
    one, two = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(9, one), (9, two), (3, one), (5, two), (7, "something else that nobody has"), (9, one)]
    for part in (1, 3):
        got = near_dup.near_duplicates(docs(spark, rows).repartition(part), 4, 80).collect()
        assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(3, 3, True), (5, 3, False), (7, 7, True), (9, 3, False), (9, 3, False), (9, 3, False)]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "src long, dst long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_lm_scores_are_those_of_plain_sums(spark):
    rows = random_texts(80, 5) + EDGE
    got = lm.score_katz(docs(spark, rows), lambda i: F.coalesce(i % 4 != 0, F.lit(True)), frequent=50).collect()
    assert len(got) == len(rows)
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None]
    counts = Counter(w for i, t in rows if i is None or i % 4 != 0 for w in split(t))
    total, types = sum(counts.values()), len(counts)
    top = {w for w, _ in counts.most_common() if w is not None}
    want = Counter()
    for i, t in rows:
        w = split(t)
        base = sum(math.log10((counts[x] + 1) / (total + types + 1)) for x in w)
        want[(i, len(w), sum(counts[x] > 0 for x in w), round(base, 6))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert top and all(r.score < 0 and math.isfinite(r.score) and r.train_tokens == total for r in got)
    assert lm.score_katz(empty(spark), lambda i: F.lit(True)).count() == 0
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in lm.score_katz(docs(spark), lambda i: F.lit(False)).collect())


def plain_katz(rows, train):
    """log10 of each text's probability by a model of all words, from plain dictionaries."""
    split = lambda t: [None, *re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None]
    pairs = Counter(p for i, t in rows if train(i) for w in [split(t)] for p in zip(w, w[1:]))
    own, after = Counter(), {}
    for (c, w), n in pairs.items():
        own[w] += n
        after.setdefault(c, {})[w] = n
    places = sum(own.values()) + 1
    f = lm.discounts(np.array([0, *(sum(n == k for n in pairs.values()) for k in range(1, lm.K + 2))]))
    less = lambda n: n * (f[n] if n <= lm.K else 1.0)
    scale, alpha = {}, {}
    for c, ws in after.items():
        total, seen = sum(ws.values()), sum(own[w] for w in ws) / places
        kept = sum(map(less, ws.values())) / total
        scale[c] = total / (total + 1) if kept > 1 - 1e-12 else 1.0
        alpha[c] = (1 - kept * scale[c]) / (1 - seen)

    def p(c, w):
        n = pairs[c, w]
        return scale[c] * less(n) / sum(after[c].values()) if n else alpha.get(c, 1.0) * max(own[w], 1) / places

    for c in after if len(own) < 1000 else ():  # every context's probabilities, with one place for words never seen, sum to one
        assert math.isclose(sum(p(c, w) for w in own) + alpha[c] / places, 1, rel_tol=1e-9)
    return {i: sum(math.log10(p(c, w)) for w in [split(t)] for c, w in zip(w, w[1:])) for i, t in rows}


@pytest.mark.parametrize("frequent,held", [(0, 10), (40, 0), (5000, 300), (60, 1 << 20)])
def test_lm_scores_have_contexts_of_all_words(spark, frequent, held):
    rows = random_texts(150, 11) + [(1000, "w1 never seen w2"), (1001, "")]
    got = lm.score_katz(docs(spark, rows), lambda i: i % 4 != 0, frequent=frequent, held=held).collect()
    want = plain_katz(rows, lambda i: i % 4 != 0)
    assert len(got) == len(rows) and all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-9) for r in got)


def test_lm_vocabulary_has_no_bound(spark):
    rows = [(k, " ".join(f"r{(k * 700 + j) % 70_000}" for j in range(701))) for k in range(100)]
    got = {r.doc_id: r.score for r in lm.score_katz(docs(spark, rows), lambda i: F.lit(True)).collect()}
    want = plain_katz(rows, lambda i: True)
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i, _ in rows)


def test_discounts():
    assert lm.discounts(np.zeros(7)).tolist() == [1] * 6
    d = lm.discounts(np.array([0, 1000, 400, 200, 120, 80, 50]))
    common = 6 * 50 / 1000
    assert math.isclose(d[1], (2 * 400 / 1000 - common) / (1 - common)) and all(0 < x <= 1 for x in d)


def plain_viterbi(coder, text):
    best = [(0.0, [])] + [(-math.inf, [])] * len(text)
    for e in range(1, len(text) + 1):
        for b in range(e):
            found = coder.score.get(text[b:e])
            s = found[1] if found else coder.worst if e - b == 1 else None
            if s is not None and best[b][0] + s > best[e][0]:
                best[e] = (best[b][0] + s, [*best[b][1], *([found[0]] if found else (coder.bytes[x] for x in text[b:e].encode()))])
    return best[-1]


def test_pieces_are_the_best_path_and_decode(spark):
    with open(PIECES, "rb") as f:
        coder = pieces.Coder(f.read())
    rng = random.Random(1)
    texts = ["▁" + "".join(rng.choice("thereouandsiné ▁🦙①") for _ in range(rng.randrange(0, 14))).replace(" ", "") for _ in range(300)]
    for t in texts:
        score, ids = coder.path(t)
        want, other = plain_viterbi(coder, t)
        assert score == want and ids == other
    for t in ["", " ", "  a  b ", "x\ty\n\nz", "\n", "a\n", "🦙" * 40, "ab🦙cd ①①x", "é" * 3000]:
        assert coder.decode(np.frombuffer(coder.encode(t), np.int32).tolist()) == t
    got = pieces.encoded(docs(spark), PIECES)
    assert got.where("not round_trip").count() == 0 and got.count() == len(EDGE)
    back = pieces.decoded(got.where("doc_id is not null"), PIECES).distinct().collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in EDGE if i is not None}
    assert pieces.encoded(empty(spark), PIECES).count() == 0


def _labelled(spark, kind):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(400):
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(80)]
        bad = k % 4 == 0
        if bad and kind == "toxic":
            for _ in range(5):
                words[rng.randrange(80)] = rng.choice(["grumbod", "grumbodel", "zarkish", "idiot"])
        if bad and kind == "quality":
            words = [w + "$$$" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad if kind == "toxic" else not bad)))
    return docs(spark, rows + EDGE), spark.createDataFrame([*labels, (3, None), (None, 1)], f"doc_id long, {kind} int"), dict(labels)


def test_quality_on_held_out_rows(spark):
    d, l, truth = _labelled(spark, "quality")
    model = quality.train_quality(d, l, lambda i: i % 3 != 0)
    got = quality.score_quality(d, model).collect()
    assert len(got) == 400 + len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in got if r.doc_id is not None and r.doc_id % 3 == 0 and r.doc_id > 8]) > 0.97
    none = quality.train_quality(d, l.limit(0), lambda i: F.lit(True))
    assert all(r.score >= 0.7 for r in quality.score_quality(d, none).collect())
    assert quality.score_quality(empty(spark), model).count() == 0


def test_toxicity_on_held_out_rows(spark):
    d, l, truth = _labelled(spark, "toxic")
    model = toxicity.train_toxicity(d, l, lambda i: i % 3 != 0)
    got = toxicity.score_toxicity(d, model).collect()
    assert len(got) == 400 + len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in got if r.doc_id is not None and r.doc_id % 3 == 0 and r.doc_id > 8]) > 0.95
    none = toxicity.train_toxicity(d, l.limit(0), lambda i: F.lit(True))
    assert {r.score for r in toxicity.score_toxicity(d, none).collect()} == {0.0}
    assert toxicity.score_toxicity(empty(spark), model).count() == 0


def test_obfuscated_insults_count():
    data, offsets = toxicity.text_bytes(toxicity.pa.array(["you 1d10t there", "YOU IDIOT", "", None]))
    x = toxicity.Lexicon([], []).features(data, offsets)
    name = {f: k for k, f in enumerate(toxicity.FEATURES)}
    assert x[0, name["obfuscated"]] > 0 and x[1, name["seed"]] == 0.5 and x[1, name["nearness"]] == 0.5 and not x[2:].any()


def test_streams_round_trip(spark):
    rng = random.Random(2)
    for n in (64, 128, 1417, 1418, 5000, 100_000):
        payload = bytes(rng.choice(b"\xff\xfb\xfa\x90ab") for _ in range(n))
        stream = mpeg.write_stream(payload)
        read = mpeg.read_stream(stream)
        assert mpeg.payload_of(read) == payload and read.skipped == read.bad_checksums == 0
        assert read.table_frames == len(read.offsets) and read.samples == 1152 * len(read.offsets) and read.trailer
        assert read.seek(read.samples - 1) == read.offsets[-1]
    # junk between frames is passed over, a damaged header is noticed
    at = read.offsets[2]
    junk = mpeg.read_stream(stream[:at] + b"\xff\xfbjunk\xff\xe0" + stream[at:])
    assert len(junk.offsets) >= len(read.offsets) - 1 and junk.skipped > 0
    broken = mpeg.read_stream(stream[: at + 4] + b"\x00\x00" + stream[at + 6 :])
    assert broken.bad_checksums >= 1 and len(broken.offsets) == len(read.offsets) - 1
    assert mpeg.read_stream(b"").offsets == [] and mpeg.read_stream(b"text").offsets == []
    got = mpeg.audio_columns(docs(spark)).collect()
    for r, t in ((r, t) for r in got for i, t in EDGE if i == r.doc_id):
        raw = (t or "").encode()
        full = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    assert len(got) == len(EDGE) and mpeg.audio_columns(empty(spark)).count() == 0


PAGES = [(1, "http://a/1", "p" * 1000), (2, None, "p" * 1000), (3, "http://a/3", "short"), (4, "u v", "short"), (5, "http://a/5", None), (5, "http://a/5", "p" * 1000), (None, "http://n", "p" * 1000), (9, "http://é", "é" * 600)]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("digest", "shard", "kind")})
    uri = warc.write_warc(pages, f"file://{tmp_path}/w", roll=600)
    got = warc.read_warc(spark, uri).collect()
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        revisit = h == "p" * 1000 and i != 5
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    files = sorted((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 1 and all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for f in files)
    again = warc.write_warc(pages.repartition(3), f"file://{tmp_path}/v", roll=600)
    assert [f.read_bytes() for f in files] == [f.read_bytes() for f in sorted((tmp_path / "v").glob("*.warc.gz"))]
    assert warc.read_warc(spark, again).count() == len(PAGES) and not list((tmp_path / "w").glob(".*.tmp"))
    assert warc.read_warc(spark, warc.write_warc(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_licenses(spark):
    mit = "Copyright (c) 2020 Someone\n\n" + licenses._MIT.upper().replace('"', "“")
    rows = [(1, mit), (2, "text\n  released under the M.I.T licence\nReleased under the MIT Licence!\nAll rights reserved."), (3, None), (4, ""), (None, "Released under the MIT License."), (5, "nothing here"), (5, "nothing here"), (6, "w " * 20000 + "\nLicensed under CC BY-NC 4.0.")]
    got = licenses.scan_licenses(docs(spark, rows)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[1].license == "MIT" and by[2].license is None and by[2].line_licenses == "MIT,Proprietary"
    assert by[3].digest == by[4].digest and by[3].license is None and by[None].license == "MIT"
    assert by[6].line_licenses == "CC-BY-NC-4.0" and by[5].line_licenses is None
    assert licenses.scan_licenses(empty(spark)).count() == 0


ITEM = "If Anna has 12 km to walk and Anna walks 3 km in one hour then how long does it take her to get home today"


def test_contamination(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "tiny item"), (3, None), (None, ITEM), (4, "")], "item_id long, text string")
    rows = [
        (1, "noise before. " + ITEM + " noise after"),
        (2, "noise before. " + ITEM.replace("Anna", "Maria").replace("12", "40").replace("3 km", "5 km").replace("km", "miles")),
        (3, "noise before. " + ITEM.replace("Anna walks", "Maria walks")),
        (4, "an unrelated text about walking home for one hour and nothing more than that"),
        (5, None),
        (6, ""),
        (None, ITEM),
        (7, "w " * 3000 + ITEM.lower().replace("anna", "Anna")),
        (8, "here is a tiny item and more"),
        (8, "here is a tiny item and more"),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert {(1, 1), (2, 1), (7, 1), (8, 2)} <= set(got) and not any(d in (4, 5, 6, None) for d, _ in got)
    assert got[3, 1].windows < got[1, 1].windows  # windows with the changed name do not count, the others do
    assert decontaminate.contaminated(empty(spark), bench).count() == 0 and decontaminate.contaminated(docs(spark), bench.limit(0)).count() == 0


def test_contamination_finds_items_full_of_values(spark):
    short, long = "What is 7 plus 5?", "add 3 4 5 6 7 to 8 9 10 11 12 or 13 14 15 16 17"
    bench = spark.createDataFrame([(1, short), (2, long), (3, "three plain words")], "item_id long, text string")
    rows = [(1, "he asked: what is 7 plus 5? and left"), (2, "he asked: what is 7 plus 6? and left"), (3, f"so {long} it is"), (4, "so " + long.replace(" 6", " 60").replace(" 10", " 1").replace("14", "40") + " it is"), (5, "three plain words")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (5, 3)}


def test_contamination_finds_what_plain_search_finds(spark):
    d, b = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: words(r.text) for r in b.collect()}
    want = set()
    for r in d.collect():
        w = words(r.text)
        windows = {tuple(w[k : k + 14]) for k in range(len(w))}
        want |= {(r.doc_id, i) for i, x in items.items() if any(tuple(x[k : k + 14]) in windows for k in range(len(x) - 13))}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()}
    assert want and want <= got and all(any(" ".join(items[i][k : k + 6]) in " ".join(words(r.text)) for k in range(len(items[i]) - 5)) for r in d.collect() for j, i in got if j == r.doc_id)


def test_url_parts_and_rules(spark):
    from scriptoria.llm.queries import RULES

    cases = {
        "http://A.Example.com/en/700?x#y": ("a.example.com", "/en/700", "example.com/en/7", "allow"),
        "x://b.com/en/1": ("b.com", "/en/1", "com/en/", "block"),
        "https://example.net/de/81#t": ("example.net", "/de/81", "example.net/de/8", "block"),
        "https://w.example.net/de/7": ("w.example.net", "/de/7", "net/de/", "allow"),
        "https://org/es/": ("org", "/es/", "org/es/", "block"),
        "https://xorg/es/": ("xorg", "/es/", None, "allow"),
        "no scheme/en/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://h?p=://q/en/": ("h", "", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)) + [(None, "http://z.de/a")], "page_id long, url string").withColumns({c: F.lit(0) for c in ("host", "bad", "shape")})
    labels = spark.createDataFrame([(0, 0), (0, None), (None, 1)], "page_id long, bad int")
    got = {r.page_id: r for r in urls.filter_urls(pages, labels, RULES).collect()}
    assert len(got) == len(cases) + 1
    for k, want in enumerate(cases.values()):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == want
    assert urls.filter_urls(pages.limit(0), labels.limit(0), RULES).count() == 0


def test_url_templates_are_those_of_a_plain_tree(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(1500):
        part = rng.choice(["ads", "news", "blog", "shop"])
        rows.append((k, f"http://h{k % 2}.de/{part}/{rng.randrange(999)}/{rng.choice(['a', 'b'])}.html"))
        if rng.random() < 0.5:
            labels.append((k, int(rng.random() < (0.9 if part == "ads" else 0.1))))
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), []).collect()
    marked = dict(labels)
    base = sum(marked.values()) / len(marked)
    sums = {}
    for r in got:
        n, b = sums.get((r.host, r.template), (0, 0))
        sums[r.host, r.template] = (n + (r.page_id in marked), b + marked.get(r.page_id, 0))
        assert (r.verdict == "block") == ("/ads/" in r.path)
        assert r.template.split("/")[2] == "{number}"
    for r in got:
        n, b = sums[r.host, r.template]
        assert math.isclose(r.purity, (b + urls.PRIOR * base) / (n + urls.PRIOR), abs_tol=1e-6)


def test_url_templates_reach_any_depth(spark):
    rows = [(k, f"http://h.de/a/b/c/d/e/f/g/{'ads' if k % 2 else 'news'}/x{k}/{k}") for k in range(200)]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([(k, k % 2) for k in range(100)], "page_id long, bad int"), []).collect()
    assert all((r.verdict == "block") == (r.page_id % 2 == 1) for r in got)
    assert {r.template for r in got} == {f"/*/*/*/*/*/*/*/{x}/*/{{number}}" for x in ("ads", "news")}


def test_pieces_are_the_best_path_through_runs_of_spaces(spark):
    with open(PIECES, "rb") as f:
        coder = pieces.Coder(f.read())
    assert coder.by_word
    rng = random.Random(8)
    parts = ["hello", "world", "x", "the", "def f(x):", "é", "🦙", " ", "  ", "    ", "\t", "\n", "\n    ", "return", "▁"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 9)))) for k in range(500)] + [(500, "hello    world"), (501, "        if a:\n                b")]
    got = {r.doc_id: r.ids for r in pieces.encoded(docs(spark, rows), PIECES).collect()}
    assert all(got[k] == (plain_viterbi(coder, "▁" + t.replace(" ", "▁"))[1] if t else []) for k, t in rows)


def test_variable_bitrate_table_stands_at_its_place():
    mono = bytes([0xFF, 0xFB, 5 << 4 | 2 << 2, 0xC0])
    size = mpeg.header(mono).size
    frame = lambda body, at=21: (mono + bytes(at - 4) + body).ljust(size, b"\x00")
    vbri = b"VBRI" + bytes(6) + (9999).to_bytes(4) + (3).to_bytes(4)
    read = mpeg.read_stream(frame(vbri, 36) + frame(b"data") * 3)
    assert (read.table_bytes, read.table_frames, len(read.offsets), read.samples) == (9999, 3, 3, 3 * 1152)
    assert mpeg.read_stream(frame(vbri, 21) + frame(b"data")).table_frames is None
    short = mpeg.Stream()
    mpeg._table(short, b"Xing" + (7).to_bytes(4) + (5).to_bytes(4) + b"\x00")
    assert short.table_frames == 5 and short.table_bytes is None and short.toc == b""


def test_quality_cut_is_a_quantile(spark):
    d, l, truth = _labelled(spark, "quality")
    labelled = d.join(l.select("doc_id").distinct(), "doc_id", "left_semi").where("doc_id >= 10")
    for q in (None, 0.5):
        model = quality.train_quality(d, l, lambda i: i >= 10, quantile=q)
        low = labelled.count() - quality.score_quality(labelled, model).where("score >= 0.7").count()
        assert abs(low / labelled.count() - (0.25 if q is None else q)) < 0.01


def test_contamination_reads_each_text_of_an_id(spark):
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, "When John Smith met BOB in Rome he had 4 apples and gave them all away")], "item_id long, text string")
    other = "some other words that stand at the very same place of a text with Anna and Maria and 4 km to go on for long enough"
    rows = [(1, ITEM), (1, other), (1, None), (2, "when Mary met Alice Jones in Paris he had 9 apples and gave them all away"), (3, "WHEN JOHN SMITH MET BOB"), (4, other)]
    got = {(r.doc_id, r.item_id): r.windows for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 2)} and got[1, 1] == 19


def test_names_are_one_slot_wherever_they_stand(spark):
    one = spark.createDataFrame([("John Smith met ANNA-MARIE. Paris is big, Rome too.",)], "t string").select(decontaminate.slotted(F.col("t")).alias("w")).first().w
    m, j = decontaminate.MARK, decontaminate.JOIN
    assert one == [f"{m}njohn{j}smith", "met", f"{m}nanna", f"{m}nmarie", f"{m}nparis", "is", "big", f"{m}nrome", "too"]


def plain_tree(shapes):
    """Template of each (host, shape) with its labelled and bad pages, by a recursion over lists."""
    out = {}

    def grow(members, depth, prefix):
        segments = {}
        for key, parts, n, b in members:
            if depth < len(parts):
                segments.setdefault(parts[depth], []).append((key, parts, n, b))
            else:
                out[key] = prefix
        every = [m for group in segments.values() for m in group]
        p = (sum(m[3] for m in every) + 1) / (sum(m[2] for m in every) + 2)
        merged = []
        for s, group in segments.items():
            n, b = sum(m[2] for m in group), sum(m[3] for m in group)
            if s.startswith("{") or (n >= urls.SUPPORT and abs(b - n * p) >= urls.APART * math.sqrt(n * p * (1 - p))):
                grow(group, depth + 1, f"{prefix}/{s}")
            else:
                merged += group
        if merged:
            grow(merged, depth + 1, f"{prefix}/*")

    for host in {h for h, _ in shapes}:
        grow([((h, s), s.split("/") if s else [], *nb) for (h, s), nb in shapes.items() if h == host], 0, "")
    return out


def test_url_templates_are_those_of_an_independent_tree(spark):
    rng = random.Random(12)
    rows, bad = [], {}
    for k in range(3000):
        parts = [rng.choice(["ads", "news", "shop", f"w{rng.randrange(30)}"]), rng.choice(["a", "b", f"{rng.randrange(99)}"]), rng.choice(["x", "y", "z"])][: rng.randrange(0, 4)]
        rows.append((k, f"http://h{k % 3}.de/" + "/".join(parts)))
        if rng.random() < 0.7:
            bad[k] = int(rng.random() < (0.8 if parts[:1] == ["ads"] and parts[1:2] != ["b"] else 0.5 if parts[2:] == ["z"] else 0.1))
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(list(bad.items()), "page_id long, bad int"), []).collect()
    shape = lambda path: "/".join("{number}" if s.isdigit() else s for s in path.split("/") if s)
    shapes = {}
    for r in got:
        n, b = shapes.get((r.host, shape(r.path)), (0, 0))
        shapes[r.host, shape(r.path)] = (n + (r.page_id in bad), b + bad.get(r.page_id, 0))
    want = plain_tree(shapes)
    assert all(r.template == want[r.host, shape(r.path)] for r in got)
    base = sum(bad.values()) / len(bad)
    sums = Counter()
    for key, (n, b) in shapes.items():
        sums[key[0], want[key], "n"] += n
        sums[key[0], want[key], "b"] += b
    blocked = {(h, t) for h, t, _ in sums if (sums[h, t, "b"] + urls.PRIOR * base) / (sums[h, t, "n"] + urls.PRIOR) >= urls.REJECT}
    assert blocked and all((r.verdict == "block") == ((r.host, r.template) in blocked) for r in got)


def test_pages_tell_their_own_labels(spark):
    rows = [(1, "http://free-bets.de/a", None), (2, "http://a.de/x", "<p>" + "word $$$ " * 50), (3, "http://a.de/x", "<p>" + "word " * 50), (4, "http://a.de", None), (5, None, ""), (6, "http://alphabet.de/bets/9", "text"), (None, "http://a.de", "text")]
    got = {r.page_id: r.bad for r in urls.page_signals(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 6: 1, None: 0}


def test_whole_licence_texts(spark):
    folder = "/usr/share/common-licenses/"
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3"}
    rows, want = [], {}
    for k, (file, name) in enumerate(names.items()):
        if os.path.exists(folder + file):
            with open(folder + file, encoding="utf-8") as f:
                text = f.read()
            rows += [(2 * k, text.upper().replace("LICENSE", "LICENCE")), (2 * k + 1, text + "one more word")]
            want |= {2 * k: name, 2 * k + 1: None}
    rows.append((99, licenses._UNLICENSE.replace(",", "")))
    got = {r.doc_id: r.license for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    assert got == want | {99: "Unlicense"}
    own = spark.createDataFrame([(hashlib.md5(b"mine").hexdigest(), "B"), (hashlib.md5(b"mine").hexdigest(), "A"), (None, "C"), ("x", None)], "digest string, license string")
    assert [(r.license, r.line_licenses) for r in licenses.scan_licenses(docs(spark, [(1, "Mine!"), (2, "a\nmine\nMINE")]), own).orderBy("doc_id").collect()] == [("A", "A"), (None, "A")]
    assert licenses.scan_licenses(docs(spark, [(1, "Mine!")]), own.limit(0)).first().license is None


def test_warc_shards_are_of_like_bytes_and_nulls_are_spread(spark, tmp_path):
    rows = [(k, f"http://a/{k}", "x" * (20_000 if k < 20 else 100)) for k in range(400)] + [(None, None, f"null {k} " * 30) for k in range(200)] + [(2**62 + 1, "http://long", "é" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    uri = warc.write_warc(pages, f"file://{tmp_path}/w", shards=8)
    files = spark.read.parquet(f"{uri}/_manifest").collect()
    first = [f for f in files if f.first_page is not None and f.first_page < 20]
    assert len({f.shard for f in files}) > 4 and len(first) >= 3
    got = warc.read_warc(spark, uri)
    assert got.count() == len(rows) and got.where("page_id is null").count() == 200 and got.where(f"page_id = {2**62 + 1}").first().payload_bytes == 600_000


def test_contamination_keeps_windows_without_the_changed_slot(spark):
    item = "a train leaves Paris at noon and goes along the river for hours until all of its tired riders see the old bridge and the lights of Paris once more while the rain begins to fall on them"
    short = ["What is the capital of Spain?", "How many days has a leap year in Rome?", "Who wrote Hamlet?"]
    bench = spark.createDataFrame(list(enumerate([item, *short])), "item_id long, text string")
    rows = [
        (1, item),
        (2, "x " + item.replace("Paris", "Lyon")),
        (3, item.replace("Paris once", "Lyon once")),
        (4, "she asked: What is the capital of France? and how many days has a leap year in Oslo?"),
        (5, "Paris is the capital of France, and nobody knows who wrote Faust"),
        (6, "who wrote Hamlet"),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 0), (4, 1), (4, 2), (6, 3)}
    assert got[2, 0].windows == got[1, 0].windows > got[3, 0].windows
    assert got[1, 0].windows - got[3, 0].windows == got[1, 0].slots


def test_recall_of_items_with_other_values(spark):
    """Every benchmark item, put into a document whose id is divisible by 100 with other names and numbers, is found there."""
    rng = random.Random(9)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    numbered = [(i, t if k % 2 else t + f" How many of the {k + 3} km remain after {k + 5} days for Alice Moore and for Tom?") for k, (i, t) in enumerate(items)]

    def changed(text):
        names = {n: n[0] + "".join(rng.sample("aeiourstln", 5)) for n in set(re.findall(r"[^\W\d_]+", text)) if n[0].isupper() and n not in decontaminate.NO_NAMES}
        digits = {n: str(rng.randrange(10, 99)) for n in set(re.findall(r"[0-9]+", text))}
        return re.sub(r"[^\W_]+", lambda m: names.get(m[0], digits.get(m[0], m[0])), text)

    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 3 = 0").collect()]
    rows = [(100 * k, f"{texts[k % len(texts)]}\n{changed(t)}") for k, (_, t) in enumerate(numbered)]
    bench = spark.createDataFrame(numbered, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    found = sum((100 * k, i) in got for k, (i, _) in enumerate(numbered))
    print("recall", found, "of", len(numbered))
    assert found >= 0.9 * len(numbered)


def test_lm_buckets_share_a_bounded_number_of_partitions(spark, monkeypatch):
    rows = random_texts(80, 12)
    monkeypatch.setattr(lm, "BUCKET", 300)
    monkeypatch.setattr(lm, "PARTITIONS", 3)
    got = lm.score_katz(docs(spark, rows), lambda i: i % 4 != 0, frequent=40, held=10).collect()
    want = plain_katz(rows, lambda i: i % 4 != 0)
    assert len(got) == len(rows) and all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-9) for r in got)
    assert got[0].train_tokens > 300 * 10  # so that there are more buckets than partitions


def test_quality_is_learned_from_every_labelled_row(spark):
    rows = [(k, 1, [float(k % 7)] * 12) for k in range(1000)] + [(k, 0, [float(k % 5)] * 12) for k in range(1000, 1003)]
    table = spark.createDataFrame(rows, "doc_id long, label int, x array<double>")
    members = quality.blocks_of(table, {0: 3, 1: 1000}).collect()
    inside = [m.doc_id for b in members for m in b.members]
    assert set(inside) == {r[0] for r in rows} and all({m.label for m in b.members} == {0, 1} for b in members)
    strengths = spark.range(30_000).selectExpr("cast(id % 10 = 0 as int) as label", "cast(id as double) as s")
    assert quality.cut_at(strengths, (1 / 30_000, 1 / 30_000), 0.25, most=50) == 7499.5
    d, l, truth = _labelled(spark, "quality")
    d, l = d.where("doc_id >= 10"), l.where("doc_id >= 10")
    one, other = quality.train_quality(d, l, lambda i: F.lit(True)), quality.train_quality(d, l.withColumn("quality", F.when(F.col("doc_id") == 13, 1 - F.col("quality")).otherwise(F.col("quality"))), lambda i: F.lit(True))
    assert not np.array_equal(one.weight, other.weight)
    assert np.array_equal(one.weight, quality.train_quality(d.repartition(7), l, lambda i: F.lit(True)).weight)
