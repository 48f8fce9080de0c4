"""Texts as MPEG transport streams in a binary column, and back.

A stream starts with a program association table and a program map table. The payload is cut into access units, each
in one packetised elementary stream (PES) packet with a presentation time stamp. The first transport packet of a unit
carries the random-access indicator and the program clock reference; the last is filled up by its adaptation field.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hivelens.llm.common import appended, texts_of

UNIT = 192
PMT_PID, DATA_PID, STREAM_TYPE, STREAM_ID = 0x1000, 0x0100, 0x06, 0xBD
#: Bytes of an access unit, and ticks of the 90 kHz clock that one lasts at 8,000 samples a second.
AU_BYTES = 64 * UNIT
AU_TICKS = AU_BYTES * 90_000 // 8_000
FIRST_PTS = 90_000


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1) ^ (0x04C11DB7 if c & 0x80000000 else 0)
        table.append(c & 0xFFFFFFFF)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for x in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ x]
    return c


def _section(pid: int, table_id: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | (len(body) + 9), number, 0xC1, 0, 0) + body
    section = head + struct.pack(">I", crc32_mpeg(head))
    packet = struct.pack(">BHB", 0x47, 0x4000 | pid, 0x10) + b"\0" + section
    return packet.ljust(188, b"\xff")


_TABLES = _section(0, 0, 1, struct.pack(">HH", 1, 0xE000 | PMT_PID)) + _section(
    PMT_PID, 2, 1, struct.pack(">HHBHH", 0xE000 | DATA_PID, 0xF000, STREAM_TYPE, 0xE000 | DATA_PID, 0xF000)
)


def padded(data: bytes) -> bytes:
    """data with spaces appended up to a positive multiple of UNIT bytes."""
    return data + b" " * (max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


def _pts(pts: int) -> bytes:
    return bytes((0x21 | (pts >> 29) & 0xE, (pts >> 22) & 0xFF, 1 | (pts >> 14) & 0xFE, (pts >> 7) & 0xFF, 1 | (pts << 1) & 0xFE))


def mux(payload: bytes) -> bytes:
    """A transport stream of a payload."""
    out, counter = [_TABLES], 0
    for k, a in enumerate(range(0, len(payload), AU_BYTES)):
        unit, pts = payload[a : a + AU_BYTES], (FIRST_PTS + k * AU_TICKS) % (1 << 33)
        pes = b"\0\0\1" + struct.pack(">BHBBB", STREAM_ID, len(unit) + 8, 0x84, 0x80, 5) + _pts(pts) + unit
        clock = (pts - FIRST_PTS // 2) % (1 << 33)
        field_ = struct.pack(">BBIH", 7, 0x50, clock >> 1, (clock & 1) << 15 | 0x7E00)
        if len(pes) < 176:
            fill = 176 - len(pes)
            field_ = bytes((7 + fill,)) + field_[1:] + b"\xff" * fill
        out.append(struct.pack(">BHB", 0x47, 0x4000 | DATA_PID, 0x30 | counter) + field_ + pes[:176])
        counter = (counter + 1) % 16
        rest = np.frombuffer(pes, dtype=np.uint8)[176:]
        n = len(rest) // 184
        if n:
            body = np.empty((n, 188), dtype=np.uint8)
            body[:, :3] = (0x47, DATA_PID >> 8, DATA_PID & 0xFF)
            body[:, 3] = 0x10 | (counter + np.arange(n)) % 16
            body[:, 4:] = rest[: n * 184].reshape(n, 184)
            out.append(body.tobytes())
            counter = (counter + n) % 16
        if tail := rest[n * 184 :].tobytes():
            fill = 184 - len(tail)
            stuffing = b"\0" if fill == 1 else bytes((fill - 1, 0)) + b"\xff" * (fill - 2)
            out.append(struct.pack(">BHB", 0x47, DATA_PID, 0x30 | counter) + stuffing + tail)
            counter = (counter + 1) % 16
    return b"".join(out)


@dataclass
class Stream:
    """What a transport stream holds for one elementary stream."""

    payload: bytes
    packets: int = 0
    units: int = 0
    pts: list[int] = field(default_factory=list)
    #: Packet numbers where decoding may start.
    random_access: list[int] = field(default_factory=list)
    counter_errors: int = 0


def _read_section(packet: bytes, table_id: int) -> bytes:
    start = 4 + (1 + packet[4] if packet[3] & 0x20 else 0)
    section = packet[start + 1 + packet[start] :]
    size = 3 + (struct.unpack(">H", section[1:3])[0] & 0xFFF)
    if section[0] != table_id or crc32_mpeg(section[:size]):
        raise ValueError("a program table is damaged")
    return section[8 : size - 4]


def demux(media: bytes) -> Stream:
    """Follows the program tables to the first elementary stream, checks its counters and reassembles it."""
    if not media or len(media) % 188:
        raise ValueError("not whole transport packets")
    p = np.frombuffer(media, dtype=np.uint8).reshape(-1, 188)
    if (p[:, 0] != 0x47).any():
        raise ValueError("lost synchronisation")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    at = np.flatnonzero(pid == 0)
    if not len(at):
        raise ValueError("no program association table")
    pat = _read_section(p[at[0]].tobytes(), 0)
    pmt_pid = struct.unpack(">H", pat[2:4])[0] & 0x1FFF
    at = np.flatnonzero(pid == pmt_pid)
    if not len(at):
        raise ValueError("no program map table")
    pmt = _read_section(p[at[0]].tobytes(), 2)
    skip = 4 + (struct.unpack(">H", pmt[2:4])[0] & 0xFFF)
    data_pid = struct.unpack(">H", pmt[skip + 1 : skip + 3])[0] & 0x1FFF
    rows = np.flatnonzero(pid == data_pid)
    q = p[rows]
    field_on, counter = (q[:, 3] & 0x20) > 0, q[:, 3].astype(np.int64) & 15
    loaded = (q[:, 3] & 0x10) > 0
    steps = np.diff(counter[loaded]) % 16
    start = np.where(field_on, 5 + q[:, 4].astype(np.int64), 4)
    access = rows[field_on & (q[:, 4] > 0) & ((q[:, 5] & 0x40) > 0)]
    opens = ((q[:, 1] & 0x40) > 0)[loaded]
    body = q[loaded]
    keep = np.arange(188) >= start[loaded][:, None]
    joined = body[keep].tobytes()
    ends = np.concatenate(([0], np.cumsum(keep.sum(1))))
    firsts = ends[:-1][opens]
    out = Stream(b"", len(p), len(firsts), random_access=access.tolist(), counter_errors=int((steps != 1).sum()))
    parts = []
    for a, b in zip(firsts, [*firsts[1:], len(joined)]):
        head = joined[a : a + 14]
        if head[:3] != b"\0\0\1":
            raise ValueError("a PES packet lacks its start code")
        size, extra = struct.unpack(">H", head[4:6])[0], head[8]
        if head[7] & 0x80:
            t = head[9:14]
            out.pts.append((t[0] >> 1 & 7) << 30 | t[1] << 22 | t[2] >> 1 << 15 | t[3] << 7 | t[4] >> 1)
        end = a + 6 + size if size else b
        if end > b:
            raise ValueError("a PES packet is cut short")
        parts.append(joined[a + 9 + extra : end])
    out.payload = b"".join(parts)
    return out


def encode_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_bytes and media: the whole text's UTF-8 bytes, padded with spaces, as a transport stream.

    A missing text is empty. Input columns of these names give way. Rows are independent: missing or repeated ids and
    ties don't matter; an empty table stays empty; memory follows the longest text.
    """

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = texts_of(batch, text)
        return {"n_bytes": pa.array(map(len, texts), pa.int64()), "media": pa.array([mux(padded(t)) for t in texts], pa.binary())}

    return appended(docs, lambda: run, [T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])


def media_features(media: DataFrame, column: str = "media") -> DataFrame:
    """media with digests and features of what its streams hold, read back from the stored bytes.

    Adds payload_bytes, payload_sha256, tail_crc32 (of the last 16 bytes), media_bytes, media_sha256, feature. A missing
    stream has missing results; a damaged one raises an error.
    """
    kinds = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = []
        for value in batch.column(column):
            if not value.is_valid:
                rows.append([None] * 6)
                continue
            data = value.as_buffer().to_pybytes()
            s = demux(data)
            feature = f"packets={s.packets};units={s.units};random_access={len(s.random_access)};first_pts={s.pts[0]};last_pts={s.pts[-1]};counter_errors={s.counter_errors}"
            rows.append([len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature])
        columns = zip(*rows) if rows else [[]] * 6
        return {n: pa.array(list(c), t) for (n, t), c in zip(kinds.items(), columns)}

    spark_types = {pa.int64(): T.LongType(), pa.string(): T.StringType()}
    return appended(media, lambda: run, [T.StructField(n, spark_types[t]) for n, t in kinds.items()])
