"""Deterministic sharded WARC writer, and a reader of what it has committed.

Records are cut into shards by id bounds, sorted, and written as gzip members; a shard rolls to its
next file once that many compressed bytes are reached. Each file is written under a temporary
name and moved to its own when complete, so a lost or repeated task leaves the same file. The
manifest, renamed into place last, lists the files that count.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.llm.common import fresh, partitions, saved

#: Payloads of fewer bytes are never replaced by revisits.
LEAST = 1000
#: Compressed bytes at which a file is closed, payload bytes of a shard, and ids sampled for each shard's bounds.
ROLL, SHARD, SAMPLED = 64 << 20, 512 << 20, 20
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def page_record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record with regenerated headers and digests; a revisit has no payload, only its digest."""
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest.hexdigest())), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", "".join(url.split()))] if url else []
    fields += [("WARC-Payload-Digest", _base32(digest.digest())), ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())), ("Content-Type", "application/http; msgtype=response")]
    fields += [("X-Page-Id", str(page_id))] if page_id is not None else []
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest.hexdigest())), ("X-Refers-To-Page-Id", str(refers_to))]
    return _record(fields, block)


def _zipped(record: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


@dataclass
class _File:
    """One archive file in the making."""

    fs: pafs.FileSystem
    root: str
    shard: int
    seq: int
    records: int = 0
    size: int = 0
    first: int | None = None
    last: int | None = None

    def __post_init__(self):
        self.name = f"part-{self.shard:05d}-{self.seq:05d}.warc.gz"
        self.temporary = f"{self.root}/.{self.name}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.sum = hashlib.sha256()

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)

    def close(self) -> dict:
        self.out.close()
        self.fs.move(self.temporary, f"{self.root}/{self.name}")
        return {"file": self.name, "shard": self.shard, "records": self.records, "bytes": self.size, "first_page": self.first, "last_page": self.last, "sha256": self.sum.hexdigest()}


MANIFEST = "file string, shard int, records long, bytes long, first_page long, last_page long, sha256 string"
_MANIFEST = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("first_page", pa.int64()), ("last_page", pa.int64()), ("sha256", pa.string())])


def _write(batches, uri: str, roll: int, level: int):
    fs, root = pafs.FileSystem.from_uri(uri)
    fs.create_dir(root, recursive=True)
    file: _File | None = None
    mark: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["page_id"], row["digest"])
            if row["kind"] == 0:  # says of the record that follows what it revisits
                mark = {key: row["refers_to"]}
                continue
            if file is None or file.shard != row["shard"] or file.size >= roll:
                seq = file.seq + 1 if file is not None and file.shard == row["shard"] else 0
                if file is not None:
                    yield pa.RecordBatch.from_pylist([file.close()], _MANIFEST)
                file = _File(fs, root, row["shard"], seq)
                info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("info", file.name)), ("WARC-Date", DATE), ("WARC-Filename", file.name), ("Content-Type", "application/warc-fields")]
                file.add(_zipped(_record(info, b"format: WARC File Format 1.1\r\n"), level))
            file.add(_zipped(page_record(row["page_id"], row["url"], (row["html"] or "").encode(), mark.get(key), key in mark), level))
            file.records += 1
            if row["page_id"] is not None:
                file.first = row["page_id"] if file.first is None else file.first
                file.last = row["page_id"]
    if file is not None:
        yield pa.RecordBatch.from_pylist([file.close()], _MANIFEST)


def _bounds(pages: DataFrame, shards: int | None) -> list[int]:
    """Ids that cut pages(page_id, size) into shards of like bytes, by a sample chosen by hash.

    Unless given, the number of shards follows the bytes. The driver holds some SAMPLED ids for each shard.
    """
    whole = pages.agg(F.count("page_id").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    shards = shards or max(partitions(pages.sparkSession), -(-whole["bytes"] // SHARD))
    every = max(1, whole["rows"] // max(20_000, SAMPLED * shards))
    got = pages.where((F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0) & F.col("page_id").isNotNull()).groupBy("page_id").agg(F.sum(F.col("size") + 1).alias("size")).toArrow().sort_by("page_id")
    ids, sizes = got.column("page_id").to_numpy(), np.cumsum(got.column("size").to_numpy())
    if not len(ids):
        return []
    at = np.searchsorted(sizes, sizes[-1] * np.arange(1, shards) / shards)
    return sorted(set(ids[np.minimum(at, len(ids) - 1)].tolist()))


def _shard(bounds: list[int]) -> Column:
    """Number of bounds not above the id; pages without an id are spread by their digest."""
    cuts = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def of(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, page_id.to_numpy(), "right").astype(np.int32))

    spread = F.pmod(F.xxhash64("digest"), F.lit(len(bounds) + 1)).cast("int")
    return F.when(F.col("page_id").isNull(), spread).otherwise(of(F.coalesce("page_id", F.lit(0))))


def write_warc(pages: DataFrame, uri: str, shards: int | None = None, roll: int = ROLL, least: int = LEAST, level: int = 6) -> str:
    """Write pages(page_id, url, html) under uri and return it; other columns are ignored.

    Of records with equal payloads of at least least bytes, that with the largest page_id is a
    response and the others revisits of it; smaller payloads are all responses. Rows that
    repeat the largest page_id are responses each. Null html is an empty payload, a null url is left
    out; pages without an id are spread over the shards, sort first there and may revisit, but nothing refers to
    them. Shards are of like bytes, as many as those ask for unless shards is given. An empty table
    gives an empty manifest.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumn("digest", F.sha1(body))
    thin = rows.where(F.octet_length(body) >= least).select("page_id", "digest")
    # written, so that the join below reads the pages of a digest from a shuffle of its own, which is split where it is hot
    kept = saved(thin.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").select("digest", "refers_to"), "kept")
    marks = thin.join(kept, "digest").where("page_id is null or page_id < refers_to")
    bounds = _bounds(rows.select("page_id", F.octet_length(body).alias("size")), shards)
    empty = F.lit(None).cast("string")
    both = rows.select("page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "html")
    both = both.union(marks.select("page_id", "digest", F.lit(0).alias("kind"), "refers_to", empty.alias("url"), empty.alias("html")).distinct())
    laid = both.withColumn("shard", _shard(bounds)).repartitionById(len(bounds) + 1, "shard")
    laid = laid.sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    manifest = laid.mapInArrow(lambda b: _write(b, uri, roll, level), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{uri}/_manifest.tmp")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(uri).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(f"{uri}/_manifest"), True)
    if not files.rename(path(f"{uri}/_manifest.tmp"), path(f"{uri}/_manifest")):
        raise OSError(f"could not commit the manifest under {uri}")
    return uri


def records(stream, chunk: int = 1 << 20):
    """Each record of a file of gzip members, as (fields, block)."""
    data, more = b"", True
    z = zlib.decompressobj(31)
    parts: list[bytes] = []
    while more or data:
        if not data:
            data = stream.read(chunk)
            more = bool(data)
            if not more:
                break
        parts.append(z.decompress(data))
        data = b""
        if z.eof:
            data = z.unused_data
            yield parse_record(b"".join(parts))
            z, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends within a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError("a record's length is not its Content-Length")
    return fields, rest[:size]


SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string"


def _read(batches, uri: str):
    fs, root = pafs.FileSystem.from_uri(uri)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for name in batch.column("file").to_pylist():
            rows = []
            with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for fields, block in records(stream):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    said = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rsplit(b"Content-Length: ", 1)[1])
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != said):
                        raise ValueError(f"{name}: payload of {fields['WARC-Record-ID']} differs from its digest")
                    number = fields.get("X-Page-Id")
                    refers = fields.get("X-Refers-To-Page-Id")
                    rows.append((None if number is None else int(number), size, said, kind, None if refers is None else int(refers), fields.get("WARC-Target-URI"), name))
                    if len(rows) == 5000:
                        yield out(rows)
                        rows = []
            if rows:
                yield out(rows)


def read_warc(spark: SparkSession, uri: str) -> DataFrame:
    """One row for each page record of the committed files; payload digests are verified.

    A file is streamed record by record by one task; the manifest says which files there are.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{uri}/_manifest").select("file")
    return files.repartition(partitions(spark)).mapInArrow(lambda b: _read(b, uri), SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to a new folder of the shared ones and read them back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, fresh(spark, "warc")))
