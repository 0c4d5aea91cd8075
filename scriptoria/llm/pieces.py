"""SentencePiece encoding and decoding with an Aho-Corasick automaton and Viterbi.

One pass over the characters: at each position the automaton's output links give every piece
that ends there, longest first, and each relaxes the best score of that position. Characters that no
piece covers cost the unknown score and fall back to byte pieces. Among equal scores
the longer last piece wins. The model file's scores decide: for a file trained by merges they are
merge ranks, so the best path by score need not be the path by merge order.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import slices

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Words whose pieces a task remembers at most.
REMEMBERED = 300_000
#: How much worse than the worst piece an unknown character is.
UNKNOWN = 10.0
_coders: dict[int, "Coder"] = {}


class Coder:
    """Encoder and decoder of one model; the model file's bytes are the argument."""

    def __init__(self, model: bytes):
        loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(loaded.get_piece_size())
        self.pieces = [loaded.id_to_piece(i) for i in ids]
        self.unknown = loaded.unk_id()
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in ids if loaded.is_byte(i)}
        self.score = {self.pieces[i]: (i, loaded.get_score(i)) for i in ids if not (loaded.is_byte(i) or loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i))}
        self.worst = min((s for _, s in self.score.values()), default=0.0) - UNKNOWN
        self.single = {p for p in self.score if len(p) == 1}
        self._build()
        self.spelled = [b"" if loaded.is_control(i) else bytes([int(self.pieces[i][3:5], 16)]) if loaded.is_byte(i) else self.pieces[i].replace(SPACE, " ").encode() for i in ids]
        self.known: dict[str, bytes] = {}
        self.by_line = not any("\n" in p for p in self.score)
        # A cut where a run of spaces begins is exact if every piece that spans such a place is worse than its parts.
        self.by_word = all(sum(self.path(part)[0] for part in self._cut(p)) > s for p, (_, s) in self.score.items() if SPACE in p.lstrip(SPACE))

    def _build(self) -> None:
        """Trie of the pieces; failure links breadth first; output links to the next piece that ends in a state."""
        step: list[dict[str, int]] = [{}]
        piece: list[tuple[int, int, float] | None] = [None]
        for p, (i, s) in self.score.items():
            at = 0
            for c in p:
                after = step[at].get(c)
                if after is None:
                    after = step[at][c] = len(step)
                    step.append({})
                    piece.append(None)
                at = after
            piece[at] = (len(p), i, s)
        fail = [0] * len(step)
        outputs: list[tuple] = [()] * len(step)
        queue = list(step[0].values())
        for at in queue:
            outputs[at] = ((piece[at],) if piece[at] else ()) + outputs[fail[at]]
            for c, after in step[at].items():
                back = fail[at]
                while back and c not in step[back]:
                    back = fail[back]
                fail[after] = step[back].get(c, 0)
                queue.append(after)
        self.step, self.fail, self.outputs = step, fail, outputs

    @staticmethod
    def _cut(text: str) -> list[str]:
        """Words, each with the run of spaces before it."""
        return _SEGMENT.findall(text)

    def path(self, text: str) -> tuple[float, list[int]]:
        """The best score and its pieces' ids."""
        step, fail, outputs, single = self.step, self.fail, self.outputs, self.single
        n, at, e = len(text), 0, 0
        best, start, piece = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        for c in text:
            while at and c not in step[at]:
                at = fail[at]
            at = step[at].get(c, 0)
            e += 1
            top = float("-inf") if c in single else best[e - 1] + self.worst
            begin, chosen = e - 1, -1
            for size, i, s in outputs[at]:
                here = best[e - size] + s
                if here > top:
                    top, begin, chosen = here, e - size, i
            best[e], start[e], piece[e] = top, begin, chosen
        return best[n], self._walk(text, start, piece)

    def _walk(self, text: str, start: list[int], piece: list[int]) -> list[int]:
        out: list[int] = []
        e = len(text)
        while e > 0:
            if piece[e] >= 0:
                out.append(piece[e])
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[start[e] : e].encode()))
            else:
                out.append(self.unknown)
            e = start[e]
        return out[::-1]

    def _word(self, word: str) -> bytes:
        if self.by_line and "\n" in word:
            first, *rest = word.split("\n")  # a character in no piece always stands alone
            line = np.array(self.path("\n")[1], np.int32).tobytes()
            return self._word(first) + b"".join(line + self._word(r) for r in rest)
        out = self.known.get(word)
        if out is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            out = self.known[word] = np.array(self.path(word)[1] if word else [], np.int32).tobytes()
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as packed 32-bit integers; none for a null or empty text."""
        if not text:
            return b""
        if not self.by_word:
            return np.array(self.path(SPACE + text.replace(" ", SPACE))[1], np.int32).tobytes()
        get, word = self.known.get, self._word
        plain = SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " "
        words = [SPACE + w for w in text.split(" ")] if plain else self._cut(SPACE + text.replace(" ", SPACE))
        return b"".join([get(w) or word(w) for w in words])

    def decode(self, ids) -> str:
        """The text of ids, without the space put before its first word."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def coder(model: bytes) -> Coder:
    key = hash(model)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(model)
    return _coders[key]


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>, n_pieces long, round_trip boolean) of docs(doc_id, text).

    round_trip: decoding the ids gives the text again (null as empty). It is false only for
    texts that hold the space mark U+2581 itself. Each row stands alone, so copies, ties and
    null ids need no rule; the model file, of a fixed size, is read once on the driver.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def coded(batches):
        own = coder(model)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            packed = [own.encode(t) for t in texts]
            size = np.array([len(p) // 4 for p in packed], np.int64)
            ids = np.frombuffer(b"".join(packed), np.int32)
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            same = [own.decode(ids[a:b].tolist()) == (t or "") for t, a, b in zip(texts, ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.array(size), pa.array(same)], names=["doc_id", "ids", "n_pieces", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(coded, "doc_id long, ids array<int>, n_pieces long, round_trip boolean")


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of rows(doc_id, ids); null ids give a null text, ids outside the model fail."""
    with open(model_path, "rb") as f:
        model = f.read()

    def texts(batches):
        own = coder(model)
        for batch in batches:
            out = [None if ids is None else own.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(texts, "doc_id long, text string")
