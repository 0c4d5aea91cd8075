"""Periodic runs of words by the linear tandem-repeat method of Gusfield and Stoye.

A text's words are first thinned to stretches in which every word comes back often enough to be
part of a run. For each stretch: a suffix tree; Lempel-Ziv blocks read off it, whose boundaries
give squares that cover the leftmost occurrence of every kind of square; their places in the tree,
completed by walks along suffix links to all rotations; and the leaves below those places, which
are all occurrences of primitively rooted squares. Occurrences side by side merge into runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from scriptoria.llm.common import mix, slices, text_bytes, word_hashes, word_spans

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4

RUN = StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])


class SuffixTree:
    """Ukkonen's suffix tree of a list of small integers, closed by an end mark that nothing equals.

    Nodes are numbers, the root 0; edges are in one table by node and first symbol. first is where
    the string of a node stands first, depth its length; leaves[low:high] are the places of all.
    """

    def __init__(self, symbols: list[int]):
        self.text = text = [*symbols, max(symbols, default=-1) + 1]
        self.width = width = text[-1] + 1
        n = len(text)
        self.go: dict[int, int] = {}
        self.start, self.end, self.link = [0], [0], [0]
        go, start, end, link = self.go, self.start, self.end, self.link
        node, edge, length, left = 0, 0, 0, 0
        for i, symbol in enumerate(text):
            left += 1
            last = -1
            while left:
                if not length:
                    edge = i
                key = node * width + text[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(start)
                    start.append(i), end.append(n), link.append(0)
                    if last >= 0:
                        link[last] = node
                        last = -1
                else:
                    size = min(end[child], i + 1) - start[child]
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    if text[start[child] + length] == symbol:
                        length += 1
                        if last >= 0 and node:
                            link[last] = node
                        break
                    cut = len(start)
                    go[key] = cut
                    start.append(start[child]), end.append(start[child] + length), link.append(0)
                    start[child] += length
                    go[cut * width + text[start[child]]] = child
                    go[cut * width + symbol] = len(start)
                    start.append(i), end.append(n), link.append(0)
                    if last >= 0:
                        link[last] = cut
                    last = cut
                left -= 1
                if not node and length:
                    length -= 1
                    edge = i - left + 1
                elif node:
                    node = link[node]
        self._measure(n)

    def _measure(self, n: int) -> None:
        count = len(self.start)
        kids: list[list[int]] = [[] for _ in range(count)]
        self.parent = parent = [0] * count
        for key, child in self.go.items():
            above = key // self.width
            parent[child] = above
            kids[above].append(child)
        self.depth, self.first, self.low, self.high = [0] * count, [0] * count, [0] * count, [0] * count
        self.leaves: list[int] = []
        todo = [0]
        while todo:
            v = todo.pop()
            if v < 0:
                self.high[~v] = len(self.leaves)
                continue
            if v:
                self.depth[v] = self.depth[parent[v]] + self.end[v] - self.start[v]
                self.first[v] = self.end[v] - self.depth[v]
            self.low[v] = len(self.leaves)
            if kids[v]:
                todo.append(~v)
                todo.extend(kids[v])
            else:
                self.leaves.append(self.first[v])
                self.high[v] = len(self.leaves)
        self.leaf = [0] * n
        for v in range(1, count):
            if not kids[v]:
                self.leaf[self.first[v]] = v

    def blocks(self) -> list[int]:
        """Starts of the Lempel-Ziv blocks and the end: each the longest that stands earlier too, or one symbol."""
        n, at, out = len(self.text) - 1, 0, [0]
        while at < n:
            node, size = 0, 0
            while True:
                node = self.go[node * self.width + self.text[at + size]]
                if self.first[node] >= at:
                    break
                size = self.depth[node]
            at += max(size, 1)
            out.append(min(at, n))
        return out


def _extensions(symbols: np.ndarray):
    """Functions of two lists of places: how far equal symbols go on from them, and how far they go back before them."""
    n = len(symbols)
    ranks, size = [np.unique(symbols, return_inverse=True)[1].astype(np.int64)], 1
    while 2 * size <= n:
        r = ranks[-1]
        ranks.append(np.unique(r[: n - 2 * size + 1] * n + r[size : n - size + 1], return_inverse=True)[1])
        size *= 2

    def ahead(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            size = 1 << k
            fits = np.flatnonzero(np.maximum(a, b) + size <= n)
            same = fits[ranks[k][a[fits]] == ranks[k][b[fits]]]
            for x in (a, b, out):
                x[same] += size
        return out

    def back(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            size = 1 << k
            fits = np.flatnonzero(np.minimum(a, b) >= size)
            same = fits[ranks[k][a[fits] - size] == ranks[k][b[fits] - size]]
            a[same] -= size
            b[same] -= size
            out[same] += size
        return out

    return ahead, back


def covering_squares(symbols: np.ndarray, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, half lengths) of squares that cover the leftmost occurrence of every kind of square.

    For each block and each half length at most one square around the next block's start, and one
    around its own; ordered by start, longest first. As many candidates as a few times the symbols.
    """
    n = len(symbols)
    ahead, back = _extensions(symbols)
    own, after = np.array(bounds[:-1], np.int64), np.array(bounds[1:], np.int64)
    beyond = np.append(after[1:], n)[: len(after)]

    def counted(most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = np.repeat(np.arange(len(most)), most)
        return block, np.arange(len(block)) - np.repeat(np.cumsum(most) - most, most) + 1

    block, half = counted(after - own)
    mark = after[block]
    other = mark - half
    more, less = ahead(other, mark), back(other, mark)
    start = np.maximum(other - less, other - half + 1)
    good = (more + less >= half) & (more > 0)
    found = [(start[good], half[good])]
    block, half = counted(beyond - own)
    mark = own[block]
    other = mark + half
    inside = np.flatnonzero(other <= n)
    block, half, mark, other = block[inside], half[inside], mark[inside], other[inside]
    more, less = ahead(mark, other), back(mark, other)
    start = np.maximum(mark - less, mark - half + 1)
    good = (more + less >= half) & (more > 0) & (less > 0) & (start + half <= after[block])
    found.append((start[good], half[good]))
    start, half = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    order = np.lexsort((-half, start))
    return start[order], half[order]


def square_places(tree: SuffixTree, starts: list[int], halves: list[int]) -> set[tuple[int, int]]:
    """(half length, node) of every kind of square: the node is the first at or below the square's end."""
    depth, first, parent, go, link, text, width = tree.depth, tree.first, tree.parent, tree.go, tree.link, tree.text, tree.width
    found: list[tuple[int, int]] = []
    at = 0
    while at < len(starts):  # from each leaf up, as long as its square is the leftmost below the node
        i, v = starts[at], tree.leaf[starts[at]]
        while at < len(starts) and starts[at] == i:
            while v and first[v] == i and depth[parent[v]] >= 2 * halves[at]:
                v = parent[v]
            if not v or first[v] != i:
                while at < len(starts) and starts[at] == i:
                    at += 1
                break
            found.append((halves[at], v))
            at += 1
    known = set(found)
    for half, v in found:  # rotations: one symbol off the front, the same symbol at the end
        size = 2 * half
        while True:
            i = first[v]
            u = parent[v]
            node = link[u] if u else 0
            while depth[node] < size - 1:
                below = go[node * width + text[i + 1 + depth[node]]]
                if depth[below] > size - 1:
                    break
                node = below
            if depth[node] == size - 1:
                v = go.get(node * width + text[i])
            else:
                v = below if text[first[below] + size - 1] == text[i] else None
            if v is None or (half, v) in known:
                break
            known.add((half, v))
    return known


def tandem_runs(symbols: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of at least two periods, by period, then start."""
    if len(symbols) < 2:
        return []
    tree = SuffixTree(symbols)
    starts, halves = covering_squares(np.array(symbols, np.int64), tree.blocks())
    places = sorted(square_places(tree, starts.tolist(), halves.tolist()))
    leaves = np.array(tree.leaves, np.int64)
    reach = np.zeros(len(symbols), np.int64)  # the furthest end of a run of a smaller period over a place
    out: list[tuple[int, int, int]] = []
    at = 0
    while at < len(places):
        half, occurrences = places[at][0], []
        while at < len(places) and places[at][0] == half:
            v = places[at][1]
            if reach[tree.first[v]] < tree.first[v] + 2 * half:  # else its root is a repetition itself
                occurrences.append(leaves[tree.low[v] : tree.high[v]])
            at += 1
        if not occurrences:
            continue
        here = np.sort(np.concatenate(occurrences))
        heads = np.flatnonzero(np.diff(here, prepend=here[0] - 2) != 1)
        for a, b in zip(here[heads].tolist(), here[np.append(heads[1:], len(here)) - 1].tolist()):
            end = b + 2 * half
            out.append((a, end - a, half))
            np.maximum(reach[a:end], end, out=reach[a:end])
    return out


def _stretches(hashes: np.ndarray, first: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(row, from, to) of stretches of words that may hold runs; all runs lie in them.

    Each word of a run stands in it at least times times: words that come back less often within
    their stretch divide it, until no stretch changes. Equal hashes of unequal words only keep more.
    """
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    live = np.arange(len(hashes))
    stretch = row
    while len(live):
        _, which, often = np.unique(mix(hashes[live] + mix(stretch.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        stay = live[often[which] >= times]
        if not len(stay):
            return []
        new = np.ones(len(stay), bool)
        new[1:] = (stay[1:] != stay[:-1] + 1) | (row[stay[1:]] != row[stay[:-1]])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(stay)))
        long = np.repeat(sizes >= least, sizes)
        stretch = (np.cumsum(new) - 1)[long]
        same = len(stay) == len(live) and long.all()
        live = stay[long]
        if same:
            return [(int(row[a]), int(a), int(a + n)) for a, n in zip(live[heads], sizes)]
    return []


def text_runs(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> dict[int, list[tuple[int, int, int]]]:
    """By row, (start, length, period) of the runs of each text that has any, by start, then period."""
    starts, ends, first = word_spans(data, offsets)
    out: dict[int, list[tuple[int, int, int]]] = {}
    for row, a, b in _stretches(word_hashes(data, starts, ends), first, least, times):
        numbers: dict[bytes, int] = {}
        symbols = [numbers.setdefault(w, len(numbers)) for w in data[starts[a] : ends[b - 1]].tobytes().split()]
        shift = a - int(first[row])
        found = [(s + shift, n, q) for s, n, q in tandem_runs(symbols) if n >= max(least, times * q)]
        if found:
            out.setdefault(row, []).extend(found)
    return {row: sorted(found, key=lambda r: (r[0], r[2])) for row, found in out.items()}


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that stand in a run after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([w for w, keep in zip(words, kept) if keep])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs array<struct<start, length, period>> and collapsed, the text without repetitions, of docs(doc_id, text).

    Words end at space and 0x09-0x0D; runs are maximal stretches of words with smallest period q
    and at least least words and times * q, in the order of start, then period. times is at least 2. Each row is
    read by itself, whatever its id, without a shuffle; null and empty texts have no word and no run. A task holds one slice
    of texts and the tree of one stretch of repeated words, some hundred bytes for each of its words. Other columns are left out.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")

    def found(batches):
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            runs = text_runs(data, offsets, least, times)
            words = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:])]
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in runs.get(k, [])] for k in range(len(words))]
            texts = [(collapsed(w, runs[k]) if k in runs else b" ".join(w)).decode() for k, w in enumerate(words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), pa.array(rows, kind), pa.array(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))
    schema = StructType([StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(found, schema)
