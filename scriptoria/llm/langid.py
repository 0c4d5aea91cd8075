"""Language identification by error-correcting output codes over letter n-grams.

Each learned language has a codeword; a binary logistic classifier over hashed n-grams predicts each
bit. A text's language is the codeword with the least loss, each bit weighted by how well its
classifier does on held-back texts of that language; where no codeword is clearly nearest, the text is flagged.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from scriptoria.llm.common import mix, slices, text_bytes
from scriptoria.llm.toxicity import folded

#: Hashed n-grams of 1 to GRAMS bytes; rows that a fit takes at most in all, and of one language at least, should there be so many languages.
SIZE, GRAMS, SAMPLE, LEAST = 1 << 12, 3, 3000, 20
#: Up to so many languages every split of them is a bit; more have BITS bits for each doubling of their number.
EXHAUSTIVE, BITS = 5, 10
#: A score below which a text is ambiguous whatever its bits.
CLEAR = 0.6
UNKNOWN = "und"
_CHUNK = 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def gram_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of SIZE values for each text: square roots of the counts of its n-grams, of length 1; all zero without letters.

    Letters are a-z, their capitals, and all bytes from 0x80; anything between them is one space.
    """
    rows = len(offsets) - 1
    letter = _LETTER[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    row = np.repeat(np.arange(rows), np.diff(offsets))[keep]
    text = np.where(letter, folded(data), 0x20)[keep].astype(np.uint64)
    out = np.zeros(rows * SIZE)
    for at in range(0, len(text), _CHUNK):
        part, of = text[at : at + _CHUNK + GRAMS - 1], row[at : at + _CHUNK + GRAMS - 1]
        gram = np.zeros(len(part), np.uint64)
        for n in range(1, GRAMS + 1):
            gram = gram[: len(part) - n + 1] * np.uint64(256) + part[n - 1 :]
            use = np.flatnonzero(of[: len(gram)] == of[n - 1 :])
            use = use[use < _CHUNK]
            where = of[use] * SIZE + (mix(gram[use] + np.uint64(n << 32)) & np.uint64(SIZE - 1)).astype(np.int64)
            out += np.bincount(where, minlength=len(out))
    out = np.sqrt(out.reshape(rows, SIZE))
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language: all splits of few languages, else the best of many random codes by the least distance of two rows."""
    if languages < 2:
        return np.zeros((languages, 0))
    if languages <= EXHAUSTIVE:
        bits = [[1 if k == 0 or m >> (k - 1) & 1 else -1 for k in range(languages)] for m in range((1 << (languages - 1)) - 1)]
        return np.array(bits, float).T
    rng = np.random.default_rng(13)
    length = int(np.ceil(BITS * np.log2(languages)))
    best, far = None, -1.0
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (languages, length))
        code = code[:, np.abs(code.sum(axis=0)) < languages]  # a bit that is the same for all tells nothing
        near = (code.shape[1] - (code @ code.T - 2 * code.shape[1] * np.eye(languages)).max()) / 2
        if near > far:
            best, far = code, near
    return best


@dataclass(frozen=True)
class Coder:
    """Languages, their codewords, the bits' linear classifiers, and what each bit counts for each language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def decoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the nearest codeword, its score among all, ambiguous) of feature rows."""
        if self.code.shape[1] == 0:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        f = self.margins(x)
        loss = np.logaddexp(0, -f) @ (self.trust * (self.code > 0)).T + np.logaddexp(0, f) @ (self.trust * (self.code < 0)).T
        best = loss.argmin(axis=1)
        odds = np.exp(np.clip(loss.min(axis=1, keepdims=True) - loss, -700, 0) * self.code.shape[1])
        score = odds.max(axis=1) / odds.sum(axis=1)
        wrong = (np.where(f >= 0, 1, -1) != self.code[best]).sum(axis=1)
        least = min((int((a != b).sum()) for a, b in combinations(self.code, 2)), default=0)
        return best, score, (wrong > (least - 1) // 2) | (score < CLEAR)


def _bits(x: np.ndarray, y: np.ndarray, mass: np.ndarray, steps: int = 200, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of one logistic classifier for each column of y (-1 or 1), by accelerated gradient steps on the weighted mean loss."""
    mean = mass @ x
    z = x - mean
    rate = 1 / (0.25 * max(float(np.linalg.norm(z * np.sqrt(mass)[:, None])), 1e-6) ** 2 + penalty)
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    v, c = w, b
    for k in range(steps):
        p = (-y / (1 + np.exp(np.clip(y * (z @ v + c), -60, 60))) * mass[:, None]).astype(np.float32)
        new, shift = v - np.float32(rate) * (z.T @ p + np.float32(penalty) * v), c - np.float32(4) * p.sum(axis=0)
        ahead = np.float32(k / (k + 3))
        v, c, w, b = new + ahead * (new - w), shift + ahead * (shift - b), new, shift
    return w, b - mean @ w


def fitted(languages: list[str], x: np.ndarray, y: np.ndarray) -> Coder:
    """Learn from feature rows and the index of each one's language; every language weighs the same."""
    code = codewords(len(languages))
    if not code.shape[1]:
        return Coder(languages, code, np.zeros((SIZE, 0)), np.zeros(0), code)

    def of(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.bincount(y[some], minlength=len(languages))
        mass = (1 / np.maximum(counts, 1))[y[some]]
        return _bits(x[some], code[y[some]], (mass / mass.sum()).astype(np.float32))

    held = np.arange(len(y)) % 4 == 3
    trust = np.ones_like(code)
    if held.any() and not held.all():
        w, b = of(~held)
        right = np.where(x[held] @ w + b >= 0, 1, -1) == code[y[held]]
        for k in range(len(languages)):
            if (y[held] == k).any():
                trust[k] = np.maximum(right[y[held] == k].mean(axis=0) * 2 - 1, 0.01)
    trust /= trust.sum(axis=1, keepdims=True)
    return Coder(languages, code, *of(np.ones(len(y), bool)), trust)


def train_languages(docs: DataFrame, train, sample: int = SAMPLE) -> Coder:
    """Learn the languages of docs(doc_id, text, lang) from rows that train(doc_id) accepts and whose lang is not null.

    Each language has the same share of sample rows, LEAST at least: those with the least hash of id and
    text, repeated rows once. The driver holds their features only. Texts without a letter are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}")) & train(F.col("doc_id")))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Coder([], codewords(0), np.zeros((SIZE, 0)), np.zeros(0), codewords(0))
    each = max(LEAST, sample // len(counts))
    # hashes below a bound that leaves twice as many as are wanted, or somewhat more; then the least of them
    bounds = docs.sparkSession.createDataFrame([(k, min(1.0, (2.0 * each + 100) / n)) for k, n in sorted(counts.items())], "lang string, bound double")
    near = rows.join(F.broadcast(bounds), "lang").where((F.shiftrightunsigned("h", 1) / float(1 << 63)) < F.col("bound")).select("lang", "h").distinct()
    chosen = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 1), "h"))).where(F.col("k") <= each).drop("k")
    texts = rows.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "h", "text")

    def measured(batches):
        for batch in slices(batches, 256):
            x = gram_features(*text_bytes(batch.column("text")))
            cells = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array([c.astype(np.int16) for c in cells], pa.list_(pa.int16())), pa.array([r[c] for r, c in zip(x, cells)], pa.list_(pa.float32()))], names=["lang", "h", "cells", "values"])

    got = texts.mapInArrow(measured, "lang string, h long, cells array<short>, values array<float>").toArrow()
    languages = sorted(counts)
    y = np.array([languages.index(k) for k in got.column("lang").to_pylist()], int)
    x = np.zeros((len(y), SIZE), np.float32)
    for k, (c, v) in enumerate(zip(got.column("cells"), got.column("values"))):
        x[k, c.values.to_numpy()] = v.values.to_numpy()
    order = np.argsort(got.column("h").to_numpy(), kind="stable")  # the order of arrival must not matter
    return fitted(languages, x[order], y[order])


def identified(docs: DataFrame, coder: Coder, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs' columns doc_id, those of carry, lang_pred string, score double (0 to 1) and ambiguous boolean.

    Each row is judged by its text alone, without a shuffle. A null text or one without a letter is UNKNOWN with score
    0 and ambiguous, and so is every text if no language was learned; with a single one it is that. ambiguous: more bits are
    wrong for the nearest codeword than the code can correct, or its score is below CLEAR. Other columns are left out.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.when(F.rlike(text, F.lit(r"\p{L}")), text).alias("text"))
    keep = [f for f in rows.schema.fields if f.name != "text"]

    def judged(batches):
        names = np.array([*coder.languages, UNKNOWN], object)
        for batch in slices(batches, 256):
            column = batch.column("text")
            best, score, unclear = coder.decoded(gram_features(*text_bytes(column)))
            known = column.is_valid().to_numpy(zero_copy_only=False) & bool(coder.languages)
            best, score, unclear = np.where(known, best, len(coder.languages)), np.where(known, score, 0.0), unclear | ~known
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(unclear)], names=[*(f.name for f in keep), "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(judged, StructType([*keep, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]))
