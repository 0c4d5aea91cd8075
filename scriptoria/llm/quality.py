"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in dense text features. It is learned from preference pairs (a
labelled good document preferred to a labelled bad one) by logistic loss on the difference of
their features. Every labelled document takes part: they are dealt to blocks, and all pairs of a block count. The threshold is a quantile of the strengths of all labelled documents: that below which there
are as many documents as are labelled bad, unless another is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from scriptoria.llm.common import SEPARATORS, dropped, saved, slices, text_bytes, word_hashes, word_spans

FEATURES = ["words", "word_length", "symbols", "bars", "bangs", "capitals", "digits", "repeats", "distinct", "line_words", "stops", "wide"]
#: Documents of the larger class in a block of pairs, on average.
BLOCK = 64
#: Documents of the smaller class that each block has at least, on average; they are copied to several blocks for that.
OPPONENTS = 16
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*+<=>@\\^_`{}~")] = True


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; all zero for texts without words."""

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    words = np.diff(first).astype(float)
    row = np.repeat(np.arange(len(words)), np.diff(first))
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    n = np.maximum(words, 1)
    size = np.maximum(total(~SEPARATORS[data]), 1)
    upper = (data >= 0x41) & (data <= 0x5A)
    letters = upper | ((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80)
    out = np.stack(
        [
            np.log1p(words),
            np.log1p(size / n),
            total(_SYMBOLS[data]) / size,
            total(data == 0x7C) / n,
            total(data == 0x21) / n,
            total(upper) / np.maximum(total(letters), 1),
            total((data >= 0x30) & (data <= 0x39)) / size,
            np.bincount(row, again, minlength=len(words)) / n,
            np.bincount(row[order], new, minlength=len(words)) / n ** 0.8,
            np.log1p(n / (total(data == 0x0A) + 1)),
            total(data == 0x2E) / n,
            total(data >= 0x80) / size,
        ],
        axis=1,
    )
    out[words == 0] = 0
    return np.sqrt(np.maximum(out, 0))


@dataclass(frozen=True)
class Ranking:
    """Strengths and what maps them to a score: 0.7 exactly at the threshold."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float
    quantile: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold + np.log(0.7 / 0.3), -40, 40)))


def blocks_of(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(block, members) of rows(doc_id, label, x): each row in a block at least, with rows of the other label; members are in one order.

    A row of the larger class is in one block. Those of the smaller one are copied to as many blocks as are needed for OPPONENTS of them in each.
    """
    larger = int(counts[1] >= counts[0])
    n = -(-counts[larger] // BLOCK)
    copies = min(n, -(-OPPONENTS * n // counts[1 - larger]))
    last = F.when(F.col("label") == larger, 0).otherwise(copies - 1)
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("j"))
    block = F.pmod(F.xxhash64("doc_id") + F.col("j"), F.lit(n))
    return dealt.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("label", "doc_id", "x"))).alias("members"))


def _step(blocks: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, penalty: float) -> np.ndarray:
    """One Newton step on the mean logistic loss of all pairs with an L2 penalty; blocks add up where they are, the driver gets a sum from each task."""
    width = len(w)

    def sums(batches):
        total = np.zeros(1 + width + width * width)
        for batch in batches:
            for members in batch.column("members"):
                members = members.values
                z = (np.asarray(members.field("x").flatten()).reshape(-1, width) - mean) / scale
                good = np.asarray(members.field("label")) == 1
                d = (z[good][:, None, :] - z[~good][None, :, :]).reshape(-1, width)
                p = 1 / (1 + np.exp(-np.clip(d @ w, -40, 40)))
                total += np.concatenate([[len(d)], d.T @ (1 - p), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    n, *rest = np.sum([r["sums"] for r in blocks.select("members").mapInArrow(sums, "sums array<double>").collect()], axis=0)
    gradient, curve = np.array(rest[:width]), np.array(rest[width:]).reshape(width, width)
    return np.linalg.solve(curve / n + penalty * np.eye(width), gradient / n - penalty * w)


def cut_at(rows: DataFrame, masses: tuple[float, float], quantile: float, most: int = 10_000) -> float:
    """The strength below which there is a quantile of all rows(label, s), each of the mass of its label: halfway between the strengths on its two sides.

    Bins of strengths are counted over all rows, ever finer about the cut, until the bin that holds it has few rows or
    one strength; so the driver sees bins, and most strengths at last.
    """
    both = [F.count_if(F.col("label") == k).alias(f"n{k}") for k in (0, 1)]
    mass = lambda r: masses[0] * r["n0"] + masses[1] * r["n1"]
    low, high, n = rows.agg(F.min("s"), F.max("s"), F.count("*")).first()
    below = 0.0
    while n > most and low < high:
        bins = rows.where(F.col("s").between(low, high)).groupBy(F.floor((F.col("s") - low) / (high - low) * 1000).alias("bin")).agg(*both, F.min("s").alias("low"), F.max("s").alias("high")).orderBy("bin").collect()
        for r in bins:
            if r is bins[-1] or below + mass(r) >= quantile:
                break
            below += mass(r)
        low, high, n = r["low"], r["high"], r["n0"] + r["n1"]
    levels = rows.where(F.col("s").between(low, high)).groupBy("s").agg(*both).orderBy("s").collect()
    under, over = rows.agg(F.max(F.when(F.col("s") < low, F.col("s"))), F.min(F.when(F.col("s") > high, F.col("s")))).first()
    places = [levels[0]["s"] - 2 if under is None else under, *(r["s"] for r in levels), levels[-1]["s"] + 2 if over is None else over]
    cut = int(np.abs(below + np.cumsum([0.0, *map(mass, levels)]) - quantile).argmin())
    return (places[cut] + places[cut + 1]) / 2


def fitted(rows: DataFrame, counts: dict[int, int], quantile: float | None = None, penalty: float = 1e-3) -> Ranking:
    """Fit on all of rows(doc_id, label, x), labels 0 and 1; counts: of all labelled documents by label.

    quantile: the share of labelled rows to fall below the threshold; by default that of bad ones.
    The cut lies halfway between the strengths on its two sides. Without rows of both classes nothing can be preferred: all strengths are equal and every
    document passes if good rows were the only ones, or there were none.
    """
    width = len(FEATURES)
    x = [F.get("x", F.lit(k)) for k in range(width)]
    told = rows.agg(*(F.count_if(F.col("label") == k) for k in (0, 1)), *map(F.avg, x), *map(F.stddev_pop, x)).first()
    have = {0: told[0], 1: told[1]}
    if not have[0] or not have[1]:
        only_bad = have[0] > 0
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 1.0 if only_bad else -1.0, 1.0 if only_bad else 0.0)
    mean, scale = np.round(told[2 : 2 + width], 12), np.maximum(np.round(told[2 + width :], 12), 1e-6)
    blocks, w = saved(blocks_of(rows, have), "blocks"), np.zeros(width)
    for _ in range(30):
        step = _step(blocks, mean, scale, w, penalty)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    dropped(blocks)
    w = np.round(w, 6)  # sums of tasks come in any order
    ranking = Ranking(mean, scale, w, 0.0, counts[0] / (counts[0] + counts[1]))

    def strengths(batches):
        for batch in batches:
            s = ranking.strength(np.asarray(batch.column("x").flatten()).reshape(-1, width))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(s)], names=["label", "s"])

    ranked = saved(rows.select("label", "x").mapInArrow(strengths, "label int, s double"), "strengths")
    share = ranking.quantile
    quantile = share if quantile is None else quantile
    at = cut_at(ranked, (share / have[0], (1 - share) / have[1]), quantile)
    dropped(ranked)
    return Ranking(mean, scale, w, float(at), quantile)


def _measured(batches):
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        x = text_features(data, offsets)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


def known_labels(labels: DataFrame, label: str, train) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of labels(doc_id, <label>) rows that train(doc_id) accepts, each id once, and the number of either label; null ids and labels are left out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(train(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = known.groupBy("label").count().collect()
    return known, {0: 0, 1: 0} | {r["label"]: r["count"] for r in rows}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train, each: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most each rows of either class, and all classes' counts.

    labels(doc_id, <label>) rows that train(doc_id) accepts count once per id; null ids and
    labels are left out. The rows kept are those with the least hash of the id.
    """
    known, counts = known_labels(labels, label, train)
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id"), counts


def train_quality(docs: DataFrame, labels: DataFrame, train, quantile: float | None = None) -> Ranking:
    """Learn from labels(doc_id, quality) of all rows that train(doc_id) accepts; quantile is that of fitted().

    Features are measured where the texts are, so that only they are shuffled to meet their labels; they are written
    once and read by each step of the fit. The driver holds sums and bins, whatever the size of the tables.
    """
    known, counts = known_labels(labels, "quality", train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null").where(train(F.col("doc_id")))
    rows = saved(texts.mapInArrow(_measured, "doc_id long, x array<double>").join(known, "doc_id").select("doc_id", "label", "x"), "features")
    ranking = fitted(rows, counts, quantile)
    dropped(rows)
    return ranking


def score_quality(docs: DataFrame, model: Ranking, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs' columns doc_id and text, those of carry, and score double: 0 to 1, at least 0.7 above the threshold.

    Null and empty texts have zero features and are scored as such; each row is scored alone.
    Columns not named in carry are dropped, so theirs cannot clash.
    """

    def scored(batches):
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(text_features(data, offsets)))], names=[*batch.schema.names, "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    return rows.mapInArrow(scored, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
