"""Near-duplicate documents by b-bit MinHash, confirmed on whole shingle sets.

Signatures keep two low bits of each of 216 minima, packed into bit planes. Thirty-six bands of
six minima give candidates: at similarity 0.8 a pair misses every band with probability 2e-5.
Members of a shared bucket are gathered under the most connected member among them (its
canopy), so the many buckets of one group collapse into one or few canopies; canopies are
compared in blocks, a block pair to a task, first by bit counts, then on full sets. Only a
spanning forest leaves a task, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import mix, row_shingles, saved, slices, text_bytes
from scriptoria.llm.graph import components

BANDS, ROWS = 36, 6
HASHES = BANDS * ROWS
WORDS_OF_PLANE = -(-HASHES // 64)
#: Standard errors of the estimate that a candidate may fall short of the threshold.
MARGIN = 5.0
#: Members of a block, and the most blocks of one canopy; beyond that blocks grow instead.
BLOCK, BLOCKS = 128, 64
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)

SIGNATURE = "doc_id long, n_shingles long, fp_a long, fp_b long, bands array<long>, sig binary"


def _signed(batches, words: int):
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        shingles, bounds = row_shingles(data, offsets, words)
        size = np.diff(bounds)
        full = np.flatnonzero(size)
        minima = np.empty((len(full), HASHES), np.uint64)
        if len(full):
            at = bounds[full]
            for k in range(HASHES):
                minima[:, k] = np.minimum.reduceat(shingles * _A[k] + _B[k], at)
        planes = np.zeros((2, len(full), WORDS_OF_PLANE * 64), np.uint8)
        planes[0, :, :HASHES] = minima & np.uint64(1)
        planes[1, :, :HASHES] = (minima >> np.uint64(1)) & np.uint64(1)
        packed = np.concatenate([np.packbits(planes[0], axis=1), np.packbits(planes[1], axis=1)], axis=1)
        bands = np.zeros((len(full), BANDS), np.uint64)
        for r in range(ROWS):
            bands = mix(bands * np.uint64(0xD6E8FEB86659FD93) + minima[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64))
        fp = np.zeros((2, batch.num_rows), np.uint64)
        if len(full):
            fp[0, full] = np.add.reduceat(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), at)
            fp[1, full] = np.add.reduceat(mix(shingles ^ np.uint64(0x14057B7EF767814F)), at)
        ends = np.zeros(batch.num_rows + 1, np.int32)
        ends[1:] = np.cumsum(size > 0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(size),
                pa.array(fp[0].view(np.int64)),
                pa.array(fp[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends * BANDS), pa.array(bands.reshape(-1).view(np.int64))),
                pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends * packed.shape[1]), pa.py_buffer(np.ascontiguousarray(packed))]),
            ],
            names=["doc_id", "n_shingles", "fp_a", "fp_b", "bands", "sig"],
        )


def signatures(docs: DataFrame, words: int = 5) -> DataFrame:
    """Shingle count, set fingerprint, band keys and packed b-bit signature of each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _signed(batches, words), SIGNATURE)


def _match(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated similarity of all rows of left against right: agreement corrected for chance."""
    half = left.shape[1] // 2
    differ = (left[:, None, :half] ^ right[None, :, :half]) | (left[:, None, half:] ^ right[None, :, half:])
    same = 1 - np.bitwise_count(differ).sum(axis=2, dtype=np.int32) / HASHES
    return (same - 0.25) / 0.75


def _groups(batches, keys: list[str]):
    """Runs of equal keys in a sorted stream of Arrow batches, as one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(columns[:, a].tolist())
            if held and key != last:
                yield last, pa.Table.from_batches(held).combine_chunks()
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held).combine_chunks()


def _sides(table: pa.Table, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    block = table.column("block").to_numpy()
    return np.flatnonzero(block == i), np.flatnonzero(block == j)


def _estimated(batches, least: float):
    """Members with at least one partner whose estimate reaches least."""
    for (pivot, i, j), table in _groups(batches, ["pivot", "i", "j"]):
        left, right = _sides(table, i, j)
        if not len(left) or not len(right):
            continue
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint64).reshape(table.num_rows, -1)
        ids = table.column("doc_id").to_numpy()
        hit = np.zeros(table.num_rows, bool)
        for a in range(0, len(left), 512):
            for b in range(0, len(right), 512):
                x, y = left[a : a + 512], right[b : b + 512]
                good = (_match(sig[x], sig[y]) >= least) & (ids[x][:, None] != ids[y][None, :])
                hit[x] |= good.any(axis=1)
                hit[y] |= good.any(axis=0)
        kept, first = np.unique(ids[hit], return_index=True)  # an id with several texts is told once
        n = len(kept)
        if n:
            block = table.column("block").to_numpy()[hit][first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, pivot)), pa.array(np.full(n, i, np.int32)), pa.array(np.full(n, j, np.int32)), pa.array(block), pa.array(kept)],
                names=["pivot", "i", "j", "block", "doc_id"],
            )


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """Index pairs of left x right whose sets share at least percent of their union, in blocks."""
    size = np.array([len(s) for s in sets], np.int64)
    values, column = np.unique(np.concatenate(sets), return_inverse=True) if size.sum() else (np.zeros(0), np.zeros(0, np.int64))
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(column, minlength=len(values)) > 1
    rank = np.cumsum(shared) - 1
    keep = shared[column]
    row, column, width = row[keep], rank[column[keep]], int(shared.sum())
    first = np.searchsorted(row, np.arange(len(sets) + 1))

    def dense(rows: np.ndarray, low: int, high: int) -> np.ndarray:
        out = np.zeros((len(rows), high - low), np.float32)
        for k, r in enumerate(rows):
            c = column[first[r] : first[r + 1]]
            out[k, c[(c >= low) & (c < high)] - low] = 1
        return out

    for a in range(0, len(left), 512):
        for b in range(0, len(right), 512):
            x, y = left[a : a + 512], right[b : b + 512]
            both = np.zeros((len(x), len(y)), np.float32)
            for low in range(0, width, 8192):
                high = min(low + 8192, width)
                both += dense(x, low, high) @ dense(y, low, high).T
            both = both.astype(np.int64)
            union = size[x][:, None] + size[y][None, :] - both
            p, q = np.nonzero((100 * both >= percent * union) & (both > 0))
            yield x[p], y[q]


def _confirmed(batches, words: int, percent: int):
    """A spanning forest of the confirmed links of each block pair, as (src, dst)."""
    for (_, i, j), table in _groups(batches, ["pivot", "i", "j"]):
        left, right = _sides(table, i, j)
        data, offsets = text_bytes(table.column("text").combine_chunks())
        shingles, bounds = row_shingles(data, offsets, words)
        sets = [shingles[a:b] for a, b in zip(bounds, bounds[1:])]
        ids = table.column("doc_id").to_numpy()
        root = np.arange(len(ids))
        for x, y in linked(sets, left, right, percent):
            while True:  # least root of each link, until nothing moves
                low = np.minimum(root[x], root[y])
                was = root.copy()
                np.minimum.at(root, root[x], low)
                np.minimum.at(root, root[y], low)
                root = root[root]
                if (root == was).all():
                    break
        moved = np.flatnonzero(root != np.arange(len(ids)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["src", "dst"])


def _by_block_pair(rows: DataFrame) -> DataFrame:
    return rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs(doc_id, text).

    Two documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of distinct
    word shingles (A-Z lower-cased). A text shorter than a shingle is one shingle; null, empty
    and blank texts have no shingle and link with nothing. component_id is the smallest doc_id
    reachable, kept marks it. Rows that repeat a doc_id are one node, linked by any of their texts, and each returned; a null
    doc_id gives a null component and kept false. Other columns of docs are ignored. Texts count as
    copies of one set when its size and two independent 64-bit sums over it agree.
    """
    p = percent / 100
    least = p - MARGIN * ((0.25 + 0.75 * p) * (0.75 - 0.75 * p) / HASHES) ** 0.5 / 0.75
    signed = saved(signatures(docs, words), "signatures")
    known = signed.where("doc_id is not null and n_shingles > 0")
    # Grouped sides are written before they meet rows of a key again: the join then reads the rows from a shuffle of
    # its own, whose large partitions are split, so that a hot set or bucket does not land in one task.
    sets = saved(known.groupBy("n_shingles", "fp_a", "fp_b").agg(F.min("doc_id").alias("rep")), "sets")
    reps = known.join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    spread = known.groupBy("doc_id").agg(*(f(c).alias(f"{k}_{c}") for k, f in (("low", F.min), ("high", F.max)) for c in ("fp_a", "fp_b")))
    several = saved(spread.where("low_fp_a != high_fp_a or low_fp_b != high_fp_b").select("doc_id"), "several")
    same_id = known.join(several, "doc_id", "left_semi").join(sets, ["n_shingles", "fp_a", "fp_b"]).select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))

    rows = reps.select("doc_id", F.explode("bands").alias("band"))
    buckets = saved(rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    rows = saved(rows.join(buckets, "band"), "buckets")
    weight = rows.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    pivots = saved(rows.join(weight, "doc_id").groupBy("band").agg(F.max(F.struct("weight", -F.col("doc_id"))).alias("top")).select("band", (-F.col("top.col2")).alias("pivot")), "pivots")
    members = rows.join(pivots, "band").select("pivot", "doc_id").distinct()
    size = members.groupBy("pivot").agg(F.least(F.ceil(F.count("*") / BLOCK), F.lit(BLOCKS)).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").drop("n")
    laid = members.join(size, "pivot").join(reps.select("doc_id", "sig"), "doc_id")
    laid = laid.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    laid = laid.select("pivot", "doc_id", "sig", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    laid = laid.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "sig")
    likely = _by_block_pair(laid).mapInArrow(lambda b: _estimated(b, least), "pivot long, i int, j int, block int, doc_id long")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    whole = _by_block_pair(likely.join(texts, "doc_id").select("pivot", "i", "j", "block", "doc_id", "text"))
    edges = saved(whole.mapInArrow(lambda b: _confirmed(b, words, percent), "src long, dst long"), "links")

    found = components(edges.union(same_id)).withColumnRenamed("node", "rep")
    named = saved(sets.join(found, "rep", "left").select("n_shingles", "fp_a", "fp_b", F.coalesce("component", "rep").alias("component")), "named")
    out = signed.select("doc_id", "n_shingles", "fp_a", "fp_b").join(named, ["n_shingles", "fp_a", "fp_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
