"""Helpers shared by the training-data operators: shared storage, splits, vectorised words."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and 0x09-0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Odd multiplier of the rolling byte hash, its inverse modulo 2**64, and splitmix64's constants.
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every node sees: spark.checkpoint.dir. Only a local master may leave it unset; it gets a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="scriptoria-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage durably."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that saved() made, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Let the executors drop shuffle files that no table needs any more, before more are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; null ids are remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            take = min(done, size - done)
            have[done : done + take] = have[:take] * step
            done += take
        _powers[base] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and each row's offsets; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row): maximal runs without separators, cut at row bounds."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~SEPARATORS[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (cut | ~before))
    ends = np.flatnonzero(before & (cut | ~inside))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased: a rolling hash by prefix sums, then mixed."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power(_P, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_P_INV, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def slices(batches, rows: int = 4096, size: int = 2 << 20, column: str = "text"):
    """Arrow batches cut so that each has few rows and few bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            end = min(max(end, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def row_shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word-shingle hashes of each row, sorted, and each row's bounds in them.

    A row with fewer words than a shingle has its whole sequence as one; one without words has none.
    """
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    count = np.diff(first)
    made = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), made)
    bounds = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], made) + np.repeat(first[:-1], made)
    left = np.minimum(words, np.repeat(count, made))
    out = np.zeros(len(at), np.uint64)
    for k in range(words):
        use = k < left
        out = np.where(use, mix(out * np.uint64(0xD6E8FEB86659FD93) + h[np.minimum(at + k, max(len(h) - 1, 0))] + np.uint64(k + 1)) if len(h) else out, out)
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
    return out[keep], np.searchsorted(row[keep], np.arange(len(count) + 1))
