"""Katz backoff bigram model over whole corpora, in partitioned tables.

Every word of the training rows is a word of the model, and every bigram is counted; words never
seen share one place. Bigram counts are Good-Turing discounted up to K; what a context loses goes to
the words not seen after it, by a backoff weight that makes the context's probabilities sum to one.

Tables hold packed arrays, some rows for each bucket. Words that are frequent are coded by
ids, and their counts and weights as contexts are small arrays; a bigram of them is put into a
bucket by its own hash, so that a frequent word spreads over all buckets. Other words meet in the
bucket of their hash. The most frequent bigrams are scored where the texts are read, from a table
whose size is bounded: so no bigram, however frequent, sends all its places to one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import dropped, mix, partitions, released, saved, slices, text_bytes, word_hashes, word_spans

#: Discounts apply to counts up to K.
K = 5
#: Most frequent words that are coded by ids and held in arrays; others are coded by their hash with the TAIL bit.
HEAD = 65_533
TAIL = np.uint64(1 << 63)
#: Hash that stands for the end of a text, and tokens that a task gathers before it hands on counts.
END = np.uint64(0xE0D0F0A0E7E7E7E7)
GATHER = 1 << 20
#: Bigrams that tasks hold at most: those that are at least this fraction of all tokens, so that there cannot be more.
HELD = 1 << 20
#: Tokens that one bucket should hold at most, on average, and partitions of a shuffle at most; more buckets share them.
BUCKET, PARTITIONS = 2_000_000, 20_000
_MIXER = np.uint64(0x9E3779B97F4A7C15)


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each text with its end, and each row's first token."""
    data, offsets = text_bytes(batch.column("text"))
    starts, ends, first = word_spans(data, offsets)
    h = np.insert(word_hashes(data, starts, ends), first[1:], END)
    return h, first + np.arange(len(first))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.add.reduceat(np.concatenate([p[1] for p in parts])[order], at) if len(at) else np.zeros(0, np.int64)
    return keys[at], counts


def _unigrams(batches):
    held, n = [], 0

    def out():
        keys, counts = _merged(held)
        for a in range(0, len(keys), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 17)].view(np.int64)), pa.array(counts[a : a + (1 << 17)])], names=["word", "n"])

    for batch in slices(batches):
        h, first = _tokens(batch)
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        keys, counts = np.unique(h[np.repeat(train, np.diff(first))], return_counts=True)
        held.append((keys, counts))
        n += len(keys)
        if n > GATHER:
            yield from out()
            held, n = [], 0
    if held:
        yield from out()


@dataclass(frozen=True)
class Unigrams:
    """The frequent words in hash order with their ids, and counts by id.

    Ids: 0 is the end of a text and, as a context, its start; 1 stands for all words that are not frequent.
    """

    words: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    texts: int
    tokens: int
    types: int

    def coded(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), np.uint16)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            out = np.where(self.words[at] == h, self.ids[at], out).astype(np.uint16)
        out[h == END] = 0
        return out


def unigrams(docs: DataFrame, frequent: int = HEAD) -> tuple[DataFrame, Unigrams]:
    """The table (word hash, n) of all training words, and the frequent ones (bounded) on the driver."""
    counted = saved(docs.select("text", "train").mapInArrow(_unigrams, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    end = int(END.view(np.int64))
    sums = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types"), F.coalesce(F.sum(F.when(F.col("word") == end, F.col("n"))), F.lit(0)).alias("texts")).first()
    top = counted.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    words, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    counts = np.concatenate([[sums["texts"], sums["tokens"] - sums["texts"] - int(n.sum())], n]).astype(np.int64)
    order = np.argsort(words)
    return counted, Unigrams(words[order], (order + 2).astype(np.uint16), counts, sums["texts"], sums["tokens"], sums["types"])


def _buckets_of(bucket: np.ndarray):
    """(bucket, its places) for each bucket that there is."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)) if len(order) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(bucket[order[a]]), order[a:b]


_PACKED = "bucket int, kind int, gather long, keys binary, counts binary, ids binary"


def _packed(bucket: int, kind: int, keys: bytes, counts: bytes = b"", ids: bytes = b"", gather: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([gather], pa.int64()), *(pa.array([x], pa.binary()) for x in (keys, counts, ids))],
        names=["bucket", "kind", "gather", "keys", "counts", "ids"],
    )


def discounts(counts_of_counts: np.ndarray, k: int = K) -> np.ndarray:
    """Good-Turing factors for counts 1..k, from n[1..k+1]; 1 where the estimate is no discount."""
    n = counts_of_counts.astype(float)
    out = np.ones(k + 1)
    if n[1] > 0 and n[k + 1] > 0:
        common = (k + 1) * n[k + 1] / n[1]
        if common < 1:
            for c in range(1, k + 1):
                if n[c] > 0:
                    d = ((c + 1) * n[c + 1] / (c * n[c]) - common) / (1 - common)
                    out[c] = d if 0 < d < 1 else 1.0
    return out


def _weights(mass: np.ndarray, seen: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale, alpha) of contexts from their discounted counts, the probability of what they have seen, and their counts."""
    kept = np.divide(mass, total, out=np.zeros(len(mass)), where=total > 0)
    full = (kept > 1 - 1e-12) & (seen < 1 - 1e-12)
    scale = np.where(full, total / (total + 1), 1.0)
    scale = np.where(seen >= 1 - 1e-12, np.divide(1.0, kept, out=np.ones(len(mass)), where=kept > 0), scale)
    return scale, np.where(seen < 1 - 1e-12, (1 - kept * scale) / np.maximum(1 - seen, 1e-300), 0.0)


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _found(keys: np.ndarray, counts: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Counts of k in a sorted table, 0 where it is not there."""
    if not len(keys):
        return np.zeros(len(k), np.int64)
    at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
    return np.where(keys[at] == k, counts[at], 0)


def _collected(batches, model: Unigrams):
    """Rows of each gathering, from batches sorted by it with kind 4 first."""
    log_total = np.log10(model.tokens + model.types + 1)

    def out(ids, flags, direct, score, rare, known):
        tokens, own, others, base, held = direct
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64(), mask=flags[0]),
                pa.array(~flags[1]),
                pa.array(tokens.astype(np.int64)),
                pa.array((own + known).astype(np.int64)),
                pa.array(base + rare - others * log_total),
                pa.array(score + held),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    state = None
    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == 4:
                if state:
                    yield out(*state)
                ids = np.frombuffer(r["rows"], np.int64)
                state = (ids, np.frombuffer(r["known"], bool).reshape(2, -1), np.frombuffer(r["sums"]).reshape(5, -1), *np.zeros((3, len(ids))))
                continue
            at, (score, base) = np.frombuffer(r["rows"], np.uint16), np.frombuffer(r["sums"]).reshape(2, -1)
            state[3][at] += score
            state[4][at] += base
            state[5][at] += np.frombuffer(r["known"], np.int64)
    if state:
        yield out(*state)


def _coded(h: np.ndarray, head: Unigrams) -> np.ndarray:
    """Id of each frequent word, 0 of the end of a text, else the word's hash with the TAIL bit."""
    ids = head.coded(h)
    return np.where(ids != 1, ids.astype(np.uint64), h | TAIL)


def _narrow(code: np.ndarray) -> bytes:
    """Codes in few bytes: how many, which have the TAIL bit, two bytes of each id, eight of each hash."""
    tail = code >= TAIL
    return np.int64(len(code)).tobytes() + np.packbits(tail).tobytes() + code[~tail].astype(np.uint16).tobytes() + code[tail].tobytes()


def _wide(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ids = 8 + (n + 7) // 8
    tail = np.unpackbits(np.frombuffer(data[8:ids], np.uint8), count=n).astype(bool)
    hashes = ids + 2 * int(n - tail.sum())
    out = np.empty(n, np.uint64)
    out[~tail] = np.frombuffer(data[ids:hashes], np.uint16)
    out[tail] = np.frombuffer(data[hashes:], np.uint64)
    return out


def _before(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The context of each token; a text's first token has context 0."""
    context = np.zeros(len(code), np.uint64)
    context[1:] = code[:-1]
    context[first[:-1]] = 0
    return context


def _pair(c: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(c * _MIXER + mix(w + np.uint64(1)))


def _route(c: np.ndarray, w: np.ndarray, by: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each pair: that of by where it is no frequent word, else by a hash of the pair."""
    return (np.where(by >= TAIL, mix(by), _pair(c, w)) % np.uint64(buckets)).astype(np.int64)


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (c, w), sorted, and the sums of their counts."""
    c, w, n = (np.concatenate([p[k] for p in parts]) for k in range(3))
    if not len(c):
        return c, w, n
    order = np.lexsort((w, c))
    c, w = c[order], w[order]
    at = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])]))
    return c[at], w[at], np.add.reduceat(n[order], at)


def _counted_pairs(batches, head: Unigrams, buckets: int):
    held, n = [], 0

    def out():
        c, w, counts = _summed(held)
        for b, at in _buckets_of(_route(c, w, w, buckets)):
            yield _packed(b, 0, _narrow(c[at]), counts[at].astype(np.int64).tobytes(), _narrow(w[at]))

    for batch in slices(batches):
        h, first = _tokens(batch)
        code = _coded(h, head)
        train = np.repeat(batch.column("train").to_numpy(zero_copy_only=False).astype(bool), np.diff(first))
        held.append(_summed([(_before(code, first)[train], code[train], np.ones(int(train.sum()), np.int64))]))
        n += len(held[-1][0])
        if n > GATHER:
            yield from out()
            held, n = [], 0
    if held:
        yield from out()


def _packed_words(batches, head: Unigrams, buckets: int):
    """Counts of all words that are not frequent, by bucket: kind 1."""
    for batch in batches:
        code, n = _coded(batch.column("word").to_numpy().view(np.uint64), head), batch.column("n").to_numpy()
        code, n = code[code >= TAIL], n[code >= TAIL]
        for b, at in _buckets_of((mix(code) % np.uint64(buckets)).astype(np.int64)):
            yield _packed(b, 1, code[at].tobytes(), n[at].astype(np.int64).tobytes())


def _buckets(batches):
    """(bucket, its rows) from batches sorted by bucket; the rows are to be read before the next."""
    rows = (r for batch in batches for r in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        bucket = row["bucket"]

        def here():
            nonlocal row
            while row is not None and row["bucket"] == bucket:
                yield row
                row = next(rows, None)

        yield bucket, here()


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """rows by bucket: a partition for each, or beyond PARTITIONS of them several in one, one after the other."""
    parts = min(buckets, PARTITIONS)
    return rows.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket", "kind")


def whole_bigrams(docs: DataFrame, counted: DataFrame, head: Unigrams, buckets: int) -> DataFrame:
    """The table of all bigrams, packed: contexts (keys), words (ids), counts, and the own counts of words that are not frequent (own)."""
    rows = docs.select("text", "train").mapInArrow(lambda b: _counted_pairs(b, head, buckets), _PACKED)
    rows = rows.union(counted.mapInArrow(lambda b: _packed_words(b, head, buckets), _PACKED))

    def summed(batches):
        for bucket, here in _buckets(batches):
            pairs, words = [], []
            for r in here:
                if r["kind"] == 1:
                    words.append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)))
                    continue
                pairs.append((_wide(r["keys"]), _wide(r["ids"]), np.frombuffer(r["counts"], np.int64)))
                if len(pairs) > 64:
                    pairs = [_summed(pairs)]
            if not pairs:
                continue
            c, w, n = _summed(pairs)
            own = _found(*_merged(words), w) if words else np.zeros(len(w), np.int64)
            for b, at in _buckets_of(_route(c, w, c, buckets)):
                yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), *(pa.array([x], pa.binary()) for x in (_narrow(c[at]), n[at].astype(np.int64).tobytes(), _narrow(w[at]), own[at][w[at] >= TAIL].astype(np.int64).tobytes()))],
                        names=["bucket", "keys", "counts", "ids", "own"],
                    )

    rows = _dealt(rows, buckets)
    return saved(rows.mapInArrow(summed, "bucket int, keys binary, counts binary, ids binary, own binary"), "bigrams")


def _unpacked(r, share: np.ndarray, places: float) -> tuple[np.ndarray, ...]:
    """(c, w, n, p(w), w's own count, 0 for frequent words) of a row of the table; share has p of the frequent words."""
    c, w, n = _wide(r["keys"]), _wide(r["ids"]), np.frombuffer(r["counts"], np.int64)
    often = w < TAIL
    p = share[np.where(often, w, np.uint64(0)).astype(np.int64)]
    own = np.zeros(len(w), np.int64)
    own[~often] = np.frombuffer(r["own"], np.int64)
    p[~often] = own[~often] / places
    return c, w, n, p, own


@dataclass(frozen=True)
class Whole:
    """What scoring by all bigrams needs beside the tables: places is the sum of all counts with that of unseen words."""

    head: Unigrams
    places: float
    share: np.ndarray
    factors: np.ndarray
    total: np.ndarray
    scale: np.ndarray
    alpha: np.ndarray

    def discounted(self, n: np.ndarray) -> np.ndarray:
        return self.factors[np.where(n <= K, n, 0)] * n


def whole_backoff(table: DataFrame, head: Unigrams) -> Whole:
    """Discounts from all bigrams, and the weights of the frequent contexts; those of others are made in their bucket."""
    size, places = len(head.counts), float(head.tokens + 1 + (head.texts == 0))
    share = np.maximum(head.counts, 1) / places
    names = ["total", "seen", "used", *(f"n{k}" for k in range(1, K + 2))]

    def sums(batches):
        held = np.zeros((len(names), size))
        of = np.zeros(K + 2)
        for batch in batches:
            for r in batch.to_pylist():
                c, _, n, p, _ = _unpacked(r, share, places)
                of += np.bincount(np.where(n <= K + 1, n, 0), minlength=K + 2)
                often = c < TAIL
                c, n, p = c[often].astype(np.int64), n[often], p[often]
                for k, x in enumerate((n, p, n * (n > K), *((n == k) for k in range(1, K + 2)))):
                    held[k] += np.bincount(c, x, minlength=size)
        some = np.flatnonzero(held[0])
        last = np.concatenate([[0.0, 0.0, 0.0], of[1:]])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1).astype(np.int32)), *(pa.array(np.append(held[k][some], last[k])) for k in range(len(names)))], names=["context", *names])

    got = table.mapInArrow(sums, "context int, " + ", ".join(f"{x} double" for x in names)).groupBy("context").agg(*(F.sum(x).alias(x) for x in names)).toArrow()
    at = got.column("context").to_numpy()
    value = np.zeros((len(names), size + 1))
    for k, x in enumerate(names):
        value[k][at] = got.column(x).to_numpy()  # at -1 the sums over all contexts
    factors = discounts(np.concatenate([[0.0], value[3:, -1]]))
    value = value[:, :-1]
    mass = value[2] + sum(factors[k] * k * value[2 + k] for k in range(1, K + 1))
    return Whole(head, places, share, factors, value[0], *_weights(mass, value[1], value[0]))


def held_bigrams(table: DataFrame, model: Whole, held: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, sorted; log10 p; the word's own count) of the bigrams of frequent contexts that are at least 1 / held of all tokens: held of them at most."""
    least = max(1, -(-model.head.tokens // held)) if held else model.head.tokens + 1

    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                c, w, n, _, own = _unpacked(r, model.share, model.places)
                some = (n >= least) & (c < TAIL)
                yield pa.RecordBatch.from_arrays([pa.array(c[some].astype(np.int32)), pa.array(w[some].view(np.int64)), pa.array(n[some]), pa.array(own[some])], names=["c", "w", "n", "own"])

    got = table.mapInArrow(rows, "c int, w long, n long, own long").toArrow()
    c, w, n = got.column("c").to_numpy().astype(np.int64), got.column("w").to_numpy().view(np.uint64), got.column("n").to_numpy()
    keys = _pair(c.astype(np.uint64), w)
    order = np.argsort(keys)
    value = np.log10(model.scale[c] * model.discounted(n) / np.maximum(model.total[c], 1))
    return keys[order], value[order], got.column("own").to_numpy()[order]


def _whole_events(batches, head: Unigrams, held: tuple[np.ndarray, np.ndarray, np.ndarray], buckets: int):
    """What is to be scored, for some thousand rows (a gathering) at a time.

    Kind 2: distinct pairs of a bucket (contexts, then words), a bit for each token that begins a pair, and the tokens' rows.
    Kind 4: the gathering's rows, with the sums that need no table.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    n = rows = seq = 0
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    log_own = np.log10(head.counts + 1.0) - np.log10(head.tokens + head.types + 1)

    def out():
        base = np.cumsum([0, *(len(x[0]) for x in parts)])
        size = int(base[-1])
        ids, empty, train, c, w = (np.concatenate([x[k] for x in parts]) for k in range(5))
        row = np.concatenate([x[5] + b for x, b in zip(parts, base)])
        often = w < TAIL
        at = np.where(often, w, np.uint64(0)).astype(np.int64)
        known, own = often & (head.counts[at] > 0), np.where(often, log_own[at], 0.0)
        direct, ready = np.zeros(size), np.zeros(len(c), bool)
        if len(held[0]):
            k = _pair(c, w)
            at = np.minimum(np.searchsorted(held[0], k), len(held[0]) - 1)
            ready = held[0][at] == k
            direct = np.bincount(row[ready], held[1][at[ready]], minlength=size)
            rare = ready & ~often
            known[rare], own[rare] = True, np.log10(held[2][at[rare]] + 1)
        sums = [np.bincount(row, minlength=size), np.bincount(row, known, minlength=size), np.bincount(row, ~often, minlength=size), np.bincount(row, own, minlength=size), direct]
        gather = part << 32 | seq
        yield _packed(gather % buckets, 4, ids.tobytes(), b"".join(x.astype(float).tobytes() for x in sums), np.stack([empty, train]).tobytes(), gather=gather)
        c, w, row = c[~ready], w[~ready], row[~ready]
        order = np.lexsort((w, c))
        c, w, row = c[order], w[order], row[order].astype(np.uint16)
        first = np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])])[: len(c)]
        for b, at in _buckets_of(_route(c, w, c, buckets)):
            new = at[first[at]]
            codes = _narrow(np.concatenate([c[new], w[new]]))
            yield _packed(b, 2, codes, np.packbits(first[at]).tobytes(), row[at].tobytes(), gather=gather)

    for batch in slices(batches):
        h, first = _tokens(batch)
        code = _coded(h, head)
        row = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(first).astype(np.int64))
        ids = batch.column("doc_id")
        parts.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column("train").to_numpy(zero_copy_only=False), _before(code, first), code, row))
        n, rows = n + len(h), rows + batch.num_rows
        if n > GATHER or rows > 40_000:
            yield from out()
            parts, n, rows, seq = [], 0, 0, seq + 1
    if parts:
        yield from out()


_STEP = "gather long, kind int, rows binary, sums binary, known binary, bucket int"


def _step(gather: int, kind: int, rows: bytes, sums: bytes = b"", known: bytes = b"", bucket: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([gather], pa.int64()), pa.array([kind], pa.int32()), *(pa.array([x], pa.binary()) for x in (rows, sums, known)), pa.array([bucket], pa.int32())],
        names=["gather", "kind", "rows", "sums", "known", "bucket"],
    )


def _scored_pairs(batches, model: Whole, buckets: int):
    """Sums of each gathering's rows over the pairs of a bucket; kind 5: words whose own count is still to be found, with gathering and row."""
    log_share, log_alpha = np.log10(model.share), np.log10(np.maximum(model.alpha, 1e-300))
    asked: list[tuple[np.ndarray, ...]] = []
    n_asked = 0

    def ask():
        w, gather, row = (np.concatenate([x[k] for x in asked]) for k in range(3))
        for b, at in _buckets_of((mix(w) % np.uint64(buckets)).astype(np.int64)):
            yield _step(0, 5, w[at].tobytes(), gather[at].tobytes(), row[at].tobytes(), b)

    for _, here in _buckets(batches):
        parts, table = [], None
        for r in here:
            if r["kind"] == 0:
                parts.append(_unpacked(r, model.share, model.places))
                continue
            if r["kind"] == 4:
                yield _step(r["gather"], 4, r["keys"], r["counts"], r["ids"])
                continue
            if table is None:
                table = _whole_table(parts, model)
                parts = []
            keys, value, own, contexts, weights = table
            c, w = _wide(r["keys"]).reshape(2, -1)
            row = np.frombuffer(r["ids"], np.uint16)
            begins = np.unpackbits(np.frombuffer(r["counts"], np.uint8), count=len(row))
            times = np.diff(np.append(np.flatnonzero(begins), len(row)))
            k = _pair(c, w)
            at = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
            seen = keys[at] == k if len(keys) else np.zeros(len(k), bool)
            log = np.where(c < TAIL, log_alpha[np.where(c < TAIL, c, np.uint64(0)).astype(np.int64)], 0.0)
            if len(contexts):
                of = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
                log = np.where(contexts[of] == c, weights[of], log)
            log = log + np.where(w < TAIL, log_share[np.where(w < TAIL, w, np.uint64(0)).astype(np.int64)], 0.0)
            if len(keys):
                log = np.where(seen, value[at], log)
            base, known = np.zeros(len(k)), seen & (w >= TAIL)
            if known.any():
                base[known] = np.log10(own[at[known]] + 1)
            rows, local = np.unique(row, return_inverse=True)
            sums = [np.bincount(local, np.repeat(x, times), minlength=len(rows)) for x in (log, base, known)]
            yield _step(r["gather"], 2, rows.tobytes(), sums[0].tobytes() + sums[1].tobytes(), sums[2].astype(np.int64).tobytes())
            rest = np.repeat(~seen & (w >= TAIL), times)
            if rest.any():
                asked.append((np.repeat(w, times)[rest], np.full(int(rest.sum()), r["gather"], np.int64), row[rest]))
                n_asked += len(asked[-1][0])
                if n_asked > GATHER:
                    yield from ask()
                    asked, n_asked = [], 0
    if asked:
        yield from ask()


def _whole_table(parts: list[tuple[np.ndarray, ...]], model: Whole) -> tuple[np.ndarray, ...]:
    """(hashes of pairs, sorted, their log10 p, their words' own counts; contexts that are not frequent, sorted, their log10 alpha) of a bucket."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    c, w, n, p, own = (np.concatenate([x[k] for x in parts]) for k in range(5))
    less = model.discounted(n)
    often = c < TAIL
    at = np.where(often, c, np.uint64(0)).astype(np.int64)
    ratio = model.scale[at] / np.maximum(model.total[at], 1)
    contexts, local = np.unique(c[~often], return_inverse=True)
    mass, seen, total = (np.bincount(local, x[~often], minlength=len(contexts)) for x in (less, p, n))
    scale, alpha = _weights(mass, seen, total)
    ratio[~often] = (scale / np.maximum(total, 1))[local]
    keys = _pair(c, w)
    order = np.argsort(keys)
    return keys[order], np.log10(ratio * less)[order], own[order], contexts, np.log10(np.maximum(alpha, 1e-300))


def _scored_words(batches, places: float):
    """Sums of each gathering's rows over words that are not frequent and were not seen after their context."""
    for _, here in _buckets(batches):
        table, asked, words, n = [], [], np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def told():
            k, gather, row = (np.concatenate([x[i] for x in asked]) for i in range(3))
            own = _found(words, n, k)
            value = [np.log10(np.maximum(own, 1)) - np.log10(places), np.log10(own + 1), own > 0]
            order = np.lexsort((row, gather))
            gather, row = gather[order], row[order]
            at = np.flatnonzero(np.concatenate([[True], (gather[1:] != gather[:-1]) | (row[1:] != row[:-1])]))
            gather, row, value = gather[at], row[at], [np.add.reduceat(x[order].astype(float), at) for x in value]
            cuts = np.flatnonzero(np.concatenate([[True], gather[1:] != gather[:-1], [True]]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield _step(int(gather[a]), 2, row[a:b].tobytes(), value[0][a:b].tobytes() + value[1][a:b].tobytes(), value[2][a:b].astype(np.int64).tobytes())

        for r in here:
            if r["kind"] == 1:
                table.append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64)))
                continue
            if table:
                words, n = _merged(table)
                table = []
            asked.append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64), np.frombuffer(r["ids"], np.uint16)))
            if sum(len(x[0]) for x in asked) > GATHER:
                yield from told()
                asked = []
        if asked:
            yield from told()


def score_katz(docs: DataFrame, train, frequent: int = HEAD, held: int = HELD) -> DataFrame:
    """Score every text of docs(doc_id, text) by a model learnt from rows that train(doc_id) accepts.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).
    Null texts are empty: one token, the end. Rows that repeat a doc_id all count in training and are
    scored each; train(null) decides on null ids. Without training rows nothing is known: base_score is
    that of a uniform guess over one type, and score is that of a word never seen.
    frequent (at most HEAD) words are coded by ids, and some of the most frequent bigrams, held at most, are
    scored without a shuffle; neither changes a result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("train", F.coalesce(train(F.col("doc_id")), F.lit(False)))
    counted, head = unigrams(rows, frequent)
    buckets = max(partitions(spark), -(-head.tokens // BUCKET))
    table = whole_bigrams(rows, counted, head, buckets)
    released(spark)
    model = whole_backoff(table, head)
    known = held_bigrams(table, model, held)
    released(spark)  # what the jobs since the first call still held
    events = rows.mapInArrow(lambda b: _whole_events(b, head, known, buckets), _PACKED).withColumn("own", F.lit(None).cast("binary"))
    pairs = table.select("bucket", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("gather"), "keys", "counts", "ids", "own").union(events)
    pairs = _dealt(pairs, buckets)
    first = saved(pairs.mapInArrow(lambda b: _scored_pairs(b, model, buckets), _STEP), "pairs")
    dropped(table)
    del pairs, events, table
    released(spark)
    asked = first.where("kind = 5").select("bucket", "kind", "gather", F.col("rows").alias("keys"), F.col("sums").alias("counts"), F.col("known").alias("ids"))
    words = counted.mapInArrow(lambda b: _packed_words(b, head, buckets), _PACKED).union(asked)
    words = _dealt(words, buckets)
    places = model.places
    sums = first.where("kind in (2, 4)").union(words.mapInArrow(lambda b: _scored_words(b, places), _STEP))
    sums = sums.repartition("gather").sortWithinPartitions("gather", F.desc("kind"))
    scored = sums.mapInArrow(lambda b: _collected(b, head), _OUT)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(head.tokens).cast("long").alias("train_tokens"), "base_score", "score")
