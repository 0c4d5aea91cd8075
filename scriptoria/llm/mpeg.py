"""MPEG audio columns: carry bytes in Layer III frames, and read any such stream back.

A stream is an ID3v2 tag, a variable-bitrate header frame, data frames and an ID3v1 tag. Frames
are MPEG-1 Layer III, 32 kHz, one channel, with a checksum; their data follow the side
information as 8-bit units. The last frames take smaller bitrates, so little is padded.

The reader resynchronises: a header counts only if it is of the stream's kind, its checksum holds
and the next frame, tag or the end follows where its length says, so false sync words in data or
junk are passed over.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import slices

# Fixed values of the format: kbit/s by index and sample rates, MPEG-1 (3), MPEG-2 (2) and MPEG-2.5 (0).
LAYER3 = {3: [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320], 2: [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160]}
RATES = {3: [44100, 48000, 32000], 2: [22050, 24000, 16000], 0: [11025, 12000, 8000]}
RATE, SAMPLES = 32000, 1152
#: Where a VBRI table stands in its frame, whatever the side information: 32 bytes after the header.
VBRI = 36
_HEAD = 6  # header and checksum
_SIDE = 17
_UNIT = _HEAD + _SIDE


def crc16(data: bytes, value: int = 0xFFFF) -> int:
    """The frames' checksum: polynomial 0x8005, most significant bit first."""
    for b in data:
        value = ((value << 8) & 0xFFFF) ^ _CRC[(value >> 8) ^ b]
    return value


def _crc_row(b: int) -> int:
    v = b << 8
    for _ in range(8):
        v = ((v << 1) ^ 0x8005) & 0xFFFF if v & 0x8000 else v << 1
    return v


_CRC = [_crc_row(b) for b in range(256)]


@dataclass(frozen=True)
class Header:
    version: int
    protected: bool
    kbps: int
    rate: int
    mono: bool
    size: int
    samples: int

    @property
    def kind(self) -> tuple[int, bool, int, bool]:
        """What all frames of a stream share."""
        return self.version, self.protected, self.rate, self.mono

    @property
    def side(self) -> int:
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)


_parsed: dict[bytes, Header | None] = {}


def header(four: bytes) -> Header | None:
    """Meaning of a Layer III frame header; None if the four bytes are none."""
    if four not in _parsed:
        if len(_parsed) > 4096:
            _parsed.clear()
        _parsed[four] = _header(four)
    return _parsed[four]


def _header(four: bytes) -> Header | None:
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer = four[1] >> 3 & 3, four[1] >> 1 & 3
    bit, rate = four[2] >> 4, four[2] >> 2 & 3
    if version == 1 or layer != 1 or bit in (0, 15) or rate == 3:
        return None
    kbps, hz = LAYER3[3 if version == 3 else 2][bit], RATES[version][rate]
    samples = 1152 if version == 3 else 576
    return Header(version, not four[1] & 1, kbps, hz, four[3] >> 6 == 3, samples // 8 * kbps * 1000 // hz + (four[2] >> 1 & 1), samples)


def _frame_head(index: int) -> bytes:
    head = bytes([0xFF, 0xFA, index << 4 | 2 << 2, 0xC0])
    return head + struct.pack(">H", crc16(head[2:] + bytes(_SIDE))) + bytes(_SIDE)


_HEADS = {kbps: _frame_head(i) for i, kbps in enumerate(LAYER3[3]) if kbps}
_ROOM = {kbps: SAMPLES // 8 * kbps * 1000 // RATE - _UNIT for kbps in LAYER3[3] if kbps}


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def _plan(n: int) -> list[int]:
    """Bitrates of the frames that hold n bytes: the largest, then the least that takes the rest."""
    full, rest = divmod(n, _ROOM[320])
    return [320] * full + ([min(k for k, room in _ROOM.items() if room >= rest)] if rest else [])


def write_stream(payload: bytes) -> bytes:
    """An MPEG audio stream that holds payload losslessly as the 8-bit units of its frames."""
    plan = _plan(len(payload))
    text = b"\x00payload\x00" + str(len(payload)).encode()
    body = b"TXXX" + struct.pack(">IH", len(text), 0) + text
    out = [b"ID3\x04\x00\x00" + _synchsafe(len(body)) + body]
    sizes = [_ROOM[k] + _UNIT for k in plan]
    info = _ROOM[128] + _UNIT
    total = info + sum(sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)]) + info
    toc = bytes(int(256 * ends[len(plan) * k // 100] / total) for k in range(100))
    xing = b"Xing" + struct.pack(">III", 7, len(plan), total) + toc
    out.append(_HEADS[128] + xing + bytes(_ROOM[128] - len(xing)))
    at = 0
    for k in plan:
        part = payload[at : at + _ROOM[k]]
        out += (_HEADS[k], part) if len(part) == _ROOM[k] else (_HEADS[k], part, bytes(_ROOM[k] - len(part)))
        at += _ROOM[k]
    out.append(b"TAG" + b"scriptoria".ljust(124, b"\x00") + b"\xff")
    return b"".join(out)


@dataclass
class Stream:
    """What reading a stream finds. duration is exact: samples over the sample rate."""

    tags: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    kbps: list[int] = field(default_factory=list)
    parts: list[bytes] = field(default_factory=list)
    samples: int = 0
    rate: int = 0
    bad_checksums: int = 0
    skipped: int = 0
    table_frames: int | None = None
    table_bytes: int | None = None
    toc: bytes = b""
    trailer: bool = False

    @property
    def seconds(self) -> float:
        return self.samples / self.rate if self.rate else 0.0

    def seek(self, sample: int) -> int:
        """Byte offset of the frame that holds a sample (constant samples per frame)."""
        return self.offsets[sample // (self.samples // len(self.offsets))]


def _tags(data: bytes) -> tuple[int, dict[str, str]]:
    if data[:3] != b"ID3" or len(data) < 10:
        return 0, {}
    size = data[6] << 21 | data[7] << 14 | data[8] << 7 | data[9]
    end, at, out = min(10 + size, len(data)), 10, {}
    while at + 10 <= end and data[at : at + 4].strip(b"\x00"):
        name, n = data[at : at + 4].decode("latin-1"), struct.unpack(">I", data[at + 4 : at + 8])[0]
        if data[3] == 4:
            n = data[at + 4] << 21 | data[at + 5] << 14 | data[at + 6] << 7 | data[at + 7]
        value = data[at + 11 : at + 10 + n].decode("latin-1")
        if name == "TXXX":
            name, _, value = value.partition("\x00")
        out[name] = value
        at += 10 + n
    return end, out


def read_stream(data: bytes) -> Stream:
    """Parse tags, the variable-bitrate table and all frames; an empty or foreign stream has none."""
    out = Stream()
    at, out.tags = _tags(data)
    end = len(data)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        out.trailer = True
    first, kind = True, None
    while at + 4 <= end:
        h = header(data[at : at + 4])
        ok = h is not None and (kind is None or kind == h.kind) and at + h.size <= end and (at + h.size == end or header(data[at + h.size : at + h.size + 4]) is not None or end - at - h.size < 4)
        if ok and h.protected:
            body = at + 6
            ok = struct.unpack(">H", data[at + 4 : at + 6])[0] == _side_crc(data[at + 2 : at + 4], data[body : body + h.side])
            out.bad_checksums += not ok
        if not ok:
            after = data.find(b"\xff", at + 1, end)
            after = end if after < 0 else after
            out.skipped += after - at
            at = after
            continue
        begin = at + (6 if h.protected else 4) + h.side
        tag = data[begin : begin + 4]
        if first and tag in (b"Xing", b"Info"):
            _table(out, data[begin : at + h.size])
        elif first and data[at + VBRI : at + VBRI + 4] == b"VBRI" and h.size >= VBRI + 18:
            out.table_bytes, out.table_frames = struct.unpack(">II", data[at + VBRI + 10 : at + VBRI + 18])
        else:
            out.offsets.append(at)
            out.kbps.append(h.kbps)
            out.parts.append(data[begin : at + h.size])
            out.samples += h.samples
            out.rate = h.rate
        first, kind = False, h.kind
        at += h.size
    return out


_sides: dict[bytes, int] = {}


def _side_crc(head: bytes, side: bytes) -> int:
    key = head + side
    if key not in _sides:
        if len(_sides) > 4096:
            _sides.clear()
        _sides[key] = crc16(key)
    return _sides[key]


def _table(out: Stream, frame: bytes) -> None:
    """Read a Xing or Info table; one that its frame cuts short tells what it holds whole."""
    flags, at = int.from_bytes(frame[4:8]), 8
    for bit, name in ((1, "table_frames"), (2, "table_bytes")):
        if flags & bit:
            if at + 4 > len(frame):
                return
            setattr(out, name, int.from_bytes(frame[at : at + 4]))
            at += 4
    if flags & 4 and at + 100 <= len(frame):
        out.toc = frame[at : at + 100]


def payload_of(stream: Stream) -> bytes:
    """The bytes that write_stream() was given."""
    return b"".join(stream.parts)[: int(stream.tags.get("payload", 0))]


def _described(s: Stream) -> str:
    rate = f"{s.rate} Hz" if s.rate else "no"
    seeks = zlib.crc32(np.array(s.offsets, np.int64).tobytes())
    table = "agrees" if s.table_frames == len(s.offsets) else "differs"
    return f"frames={len(s.offsets)};samples={s.samples};rate={rate};seconds={s.seconds:.6f};kbps={min(s.kbps, default=0)}-{max(s.kbps, default=0)};table={table};bad_crc={s.bad_checksums};skipped={s.skipped};seeks={seeks:08x}"


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, seek_offsets array<long>, seconds double"


def audio_columns(docs: DataFrame, media: bool = False) -> DataFrame:
    """Store each text of docs(doc_id, text) as MPEG audio, read it back and describe it.

    The text's UTF-8 bytes (null: none) are padded with zero bytes to a positive multiple of 64.
    Digests of the payload are of what was read back. Equal texts give equal values, whatever
    their row; null ids are kept. With media, the stream itself is a binary column more.
    """

    def stored(batches):
        for batch in slices(batches, rows=1024):
            made = []
            for text in batch.column("text").to_pylist():
                raw = (text or "").encode()
                stream = write_stream(raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw)))
                read = read_stream(stream)
                back = payload_of(read)
                made.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(stream), hashlib.sha256(stream).hexdigest(), _described(read), read.offsets, read.seconds, stream))
            columns = list(zip(*made))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.float64(), pa.binary()]
            names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "seek_offsets", "seconds", "media"]
            keep = range(10 if media else 9)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(columns[k], types[k]) for k in keep)], names=["doc_id", *(names[k] for k in keep)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(stored, SCHEMA + (", media binary" if media else ""))
