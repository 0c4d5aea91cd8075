"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is a short seed list plus words and word beginnings whose counts in labelled toxic
documents stand out by a likelihood ratio; features are its densities, nearness to a second
person, capitals, punctuation and obfuscation rates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from scriptoria.llm.common import mix, saved, slices, text_bytes
from scriptoria.llm.common import _P, _P_INV, _power
from scriptoria.llm.quality import labelled_sample

FEATURES = ["seed", "learned", "stems", "hits", "nearness", "second", "capitals", "bangs", "punctuation", "obfuscated", "mixed", "words"]
#: Labelled rows of each class that a fit takes at most.
SAMPLE = 3000
#: The likelihood ratio (G squared) that an entry of the learned lexicon must reach, the rows of label 1 that must
#: hold it, and how many times likelier than in rows of label 0 it must be. The sample bounds their number.
RATIO, LEAST, ODDS = 30.0, 4, 12
#: Words between a lexicon hit and a second person that still count as near.
NEAR = 4
# Everyday insults, and second-person forms of four languages.
INSULTS = ["clown", "creep", "disgusting", "dumb", "fool", "garbage", "idiot", "imbecile", "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless"]
SECOND = ["you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "euch", "tu", "te", "toi", "vous", "votre", "tú", "ti", "usted", "vosotros"]

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_LEET = _FOLD.copy()
for _a, _b in zip(b"0134578@$!|", b"oieastbasil"):
    _LEET[_a] = _b
_PLAIN = np.zeros(256, bool)
_PLAIN[0x41:0x5B] = _PLAIN[0x61:0x7B] = _PLAIN[0x80:] = True
_LOOSE = _PLAIN.copy()
_LOOSE[list(b"0134578@$")] = True


def folded(data: np.ndarray, table: np.ndarray = _FOLD) -> np.ndarray:
    """Lower case of ASCII and of Latin-1 capitals in UTF-8, bytewise."""
    out = table[data]
    if len(data) > 1:
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][wide] += 32
    return out


def _spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = kind[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (cut | ~before))
    return starts, np.flatnonzero(before & (cut | ~inside)), np.searchsorted(starts, offsets)


def _sums(lower: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lower) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * _power(_P, len(lower)), out=out[1:])
    return out


def _hash(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Lexicon:
    """Hashed words and word beginnings with quick membership tests."""

    def __init__(self, words: list[str], stems: list[str]):
        self.words, self.stems = words, stems
        self.word = self._table(words)
        self.seed, self.second = self._table(INSULTS), self._table(SECOND)
        by_size: dict[int, list[str]] = {}
        for s in stems:
            by_size.setdefault(len(s.encode()), []).append(s)
        self.stem = {k: self._table(v) for k, v in sorted(by_size.items())}

    @staticmethod
    def _table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(pa.array(words, pa.string()))
        h = np.unique(_hash(_sums(folded(data)), _power(_P_INV, len(data) + 1), offsets[:-1], offsets[1:])) if words else np.zeros(0, np.uint64)
        quick = np.zeros(1 << 16, bool)
        quick[(h & np.uint64(0xFFFF)).astype(np.int64)] = True
        return quick, h

    @staticmethod
    def has(table: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
        quick, values = table
        out = quick[(h & np.uint64(0xFFFF)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.minimum(np.searchsorted(values, h[maybe]), len(values) - 1)
            out[maybe] = values[at] == h[maybe]
        return out

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of FEATURES for each text; all zero for empty ones."""
        rows = len(offsets) - 1
        inverse = _power(_P_INV, len(data) + 1)
        sums = _sums(folded(data))
        starts, ends, first = _spans(data, offsets, _PLAIN)
        row = np.repeat(np.arange(rows), np.diff(first))
        h = _hash(sums, inverse, starts, ends)
        seed, learned, second = self.has(self.seed, h), self.has(self.word, h), self.has(self.second, h)
        stems = np.zeros(len(h), bool)
        for k, table in self.stem.items():
            long = np.flatnonzero(ends - starts > k)
            stems[long] |= self.has(table, _hash(sums, inverse, starts[long], starts[long] + k))
        hit = seed | learned | stems
        near = np.zeros(len(h), bool)
        for k in range(1, NEAR + 1):
            same = row[k:] == row[:-k]
            near[k:] |= second[:-k] & same
            near[:-k] |= second[k:] & same
        loose = _sums(folded(data, _LEET))
        a, b, _ = _spans(data, offsets, _LOOSE)
        odd = np.concatenate([[0], np.cumsum(_LOOSE[data] & ~_PLAIN[data])])
        plain = np.concatenate([[0], np.cumsum(_PLAIN[data])])
        odd, plain = (odd[b] - odd[a]) > 0, (plain[b] - plain[a]) > 0
        mixed = np.flatnonzero(odd & plain)
        g = _hash(loose, inverse, a[mixed], b[mixed])
        masked = self.has(self.seed, g) | self.has(self.word, g)
        where = np.searchsorted(offsets, a[mixed], "right") - 1

        def count(mask: np.ndarray, at: np.ndarray = row) -> np.ndarray:
            return np.bincount(at, mask, minlength=rows).astype(float)

        def total(mask: np.ndarray) -> np.ndarray:
            c = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
            return (c[offsets[1:]] - c[offsets[:-1]]).astype(float)

        words = np.diff(first).astype(float)
        n, size = np.maximum(words, 1), np.maximum(np.diff(offsets), 1)
        upper = (data >= 0x41) & (data <= 0x5A)
        out = np.stack(
            [
                count(seed) / n,
                count(learned) / n,
                count(stems) / n,
                np.log1p(count(hit) + count(masked, where)),
                count(hit & near) / n,
                count(second) / n,
                total(upper) / np.maximum(total(_PLAIN[data]), 1),
                total(data == 0x21) / n,
                total((data > 0x20) & (data < 0x7F) & ~_LOOSE[data]) / size,
                count(masked, where) / n,
                count(np.ones(len(mixed)), where) / n,
                np.log1p(words),
            ],
            axis=1,
        )
        out[np.diff(offsets) == 0] = 0
        return out


def learned_lexicon(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Words and word beginnings (4 to 10 letters of longer words) typical of label 1.

    Counted over the distinct words of each row of rows(text, label), a bounded sample; an entry
    needs a likelihood ratio of RATIO, and a beginning is left out if a shorter one has it.
    """
    words = F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")))
    each = rows.select("label", words.alias("word")).where("word != ''")
    beginnings = F.transform(F.sequence(F.lit(4), F.greatest(F.lit(4), F.least(F.lit(10), F.length("word") - 1))), lambda k: F.struct(F.lit(True).alias("stem"), F.substring(F.col("word"), F.lit(1), k).alias("entry")))
    forms = F.when(F.length("word") > 4, F.concat(F.array(F.struct(F.lit(False).alias("stem"), F.col("word").alias("entry"))), beginnings))
    forms = F.coalesce(forms, F.array(F.struct(F.lit(False).alias("stem"), F.col("word").alias("entry"))))
    tally = each.select("label", F.explode(forms).alias("f")).groupBy("f.stem", "f.entry").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where(F.col("a") >= LEAST)
    total = rows.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("p"), F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).alias("q")).first()
    if not total["p"] or not total["q"]:
        return [], []
    share = total["p"] / (total["p"] + total["q"])
    expect = (F.col("a") + F.col("b")) * share
    ratio = 2 * (F.col("a") * F.log(F.col("a") / expect) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (F.col("a") + F.col("b") - expect))).otherwise(0.0))
    top = tally.where((F.col("a") > ODDS * (F.col("b") + 0.5) * total["p"] / total["q"]) & (ratio >= RATIO)).collect()
    stems: list[str] = []
    for s in sorted((r["entry"] for r in top if r["stem"]), key=lambda s: (len(s), s)):
        if not any(s.startswith(t) for t in stems):
            stems.append(s)
    return sorted(r["entry"] for r in top if not r["stem"]), stems


@dataclass(frozen=True)
class Toxicity:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    base: float


def _features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    def measured(batches):
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(lexicon.features(data, offsets)), pa.list_(pa.float64()))], names=[*batch.schema.names, "x"])

    return docs.mapInArrow(measured, StructType([*docs.schema.fields, StructField("x", ArrayType(DoubleType()))]))


def train_toxicity(docs: DataFrame, labels: DataFrame, train, sample: int = SAMPLE) -> Toxicity:
    """Learn from labels(doc_id, toxic) of the rows that train(doc_id) accepts.

    At most sample rows of each class are used: three quarters, by a hash of the id, for the
    lexicon and the trees, the rest for calibration (all for both where a part lacks a class).
    Without labelled rows of both classes every score is the share of label 1, or 0.
    """
    rows, counts = labelled_sample(docs, labels, "toxic", train, sample)
    rows = saved(rows, "labelled")
    every = counts[0] + counts[1]
    base = counts[1] / every if every else 0.0
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4))
    parts = {(r["last"], r["label"]): r["count"] for r in rows.groupBy((fold == 3).alias("last"), "label").count().collect()}
    if not all(parts.get((False, v), 0) + parts.get((True, v), 0) for v in (0, 1)):
        return Toxicity(Lexicon([], []), None, None, base)
    split = all(parts.get((s, v), 0) >= 5 for s in (True, False) for v in (0, 1))
    first, last = (rows.where(fold != 3), rows.where(fold == 3)) if split else (rows, rows)
    lexicon = Lexicon(*learned_lexicon(first))
    size = {v: max(1, parts.get((False, v), 0) + parts.get((True, v), 0)) for v in (0, 1)}
    weight = F.when(F.col("label") == 1, counts[1] / size[1]).otherwise(counts[0] / size[0])

    def ready(part: DataFrame) -> DataFrame:
        x = _features(part.select("doc_id", "label", "text"), lexicon)
        return saved(x.select("doc_id", F.col("label").cast("double").alias("label"), weight.alias("weight"), "x"), "features").withColumn("features", array_to_vector("x"))

    grown = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=20, maxDepth=3, stepSize=0.3, seed=5, cacheNodeIds=False).fit(ready(first).orderBy("doc_id").coalesce(1))
    held = grown.transform(ready(last)).select("label", "weight", vector_to_array("probability")[1].alias("p"))
    curve = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight", predictionCol="score").fit(held)
    return Toxicity(lexicon, grown, curve, base)


def score_toxicity(docs: DataFrame, model: Toxicity, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs' columns doc_id and text, those of carry, and score double (0 to 1, higher: more likely toxic).

    Null and empty texts have zero features and are scored as such; each row is scored alone.
    Columns not named in carry are dropped, so theirs cannot clash.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    if model.trees is None:
        return rows.withColumn("score", F.lit(float(model.base)))
    x = _features(rows, model.lexicon).withColumn("features", array_to_vector("x"))
    p = model.trees.transform(x).select(*rows.columns, vector_to_array("probability")[1].alias("p"))
    return model.curve.transform(p).select(*rows.columns, F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("score"))
