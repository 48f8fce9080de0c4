"""Token ids in bit-plane files.

A file holds the ids of a run of documents, cut into blocks of CHUNK_IDS ids. A block's ids, as unsigned 32-bit
integers, are transposed into bit planes (or byte planes); planes above the highest bit in use are left out, and each
of the others is compressed with zstandard on its own. At the end stand the chunk index (place, number of ids and
sizes of the planes of each block), the documents' ids and lengths, and the length of this footer.

    magic | planes of block 0 | planes of block 1 | ... | zstd(json footer) | u64 footer length | magic
"""

from __future__ import annotations

import json
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hivelens.llm.common import scratch_path, ship_package, stage_table, total_bytes, whole_text
from hivelens.llm.token_files import read_file, runs, word_encoder, write_file

MAGIC = b"HLPLANE1"
CHUNK_IDS = 65_536
SHARD_BYTES = 16 << 20
#: Files whose starts one task sums.
BUNDLE = 1024


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    width = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        return [raw[:, k].tobytes() for k in range(-(-width // 8))]
    planes = []
    for k in range(-(-width // 8)):
        bits = np.unpackbits(np.ascontiguousarray(raw[:, k])[:, None], axis=1, bitorder="little")
        planes += [np.packbits(bits[:, j], bitorder="little").tobytes() for j in range(min(8, width - 8 * k))]
    return planes


def join_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    raw = np.zeros((n, 4), dtype=np.uint8)
    for k, plane in enumerate(planes):
        part = np.frombuffer(plane, dtype=np.uint8)
        if kind == "byte":
            raw[:, k] = part
        else:
            raw[:, k // 8] |= np.unpackbits(part, count=n, bitorder="little") << np.uint8(k % 8)
    return raw.reshape(-1).view("<u4")


class Writer:
    """Writes one file to a stream; memory holds one block."""

    def __init__(self, stream, kind: str = "bit", chunk_ids: int = CHUNK_IDS):
        self.stream, self.kind, self.chunk_ids = stream, kind, chunk_ids
        self.pack = zstandard.ZstdCompressor(level=1)
        self.index: list[list] = []
        self.docs: list[tuple[int | None, int]] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.place = 0, len(MAGIC)
        stream.write(MAGIC)

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with the numbers of ids that they have of ids."""
        self.docs += zip(doc_ids, sizes.tolist())
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.chunk_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, dtype=np.uint32)
        end = len(ids) if last else len(ids) // self.chunk_ids * self.chunk_ids
        for a in range(0, end, self.chunk_ids):
            block = ids[a : min(end, a + self.chunk_ids)]
            packed = [self.pack.compress(p) for p in split_planes(block, self.kind)]
            for p in packed:
                self.stream.write(p)
            self.index.append([self.place, len(block), [len(p) for p in packed]])
            self.place += sum(map(len, packed))
        self.waiting = [ids[end:]]
        self.n_waiting = len(ids) - end

    def close(self) -> None:
        self._flush(True)
        footer = self.pack.compress(json.dumps({"kind": self.kind, "chunks": self.index, "docs": self.docs}).encode())
        self.stream.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


class Reader:
    """Random access to blocks, and documents in order."""

    def __init__(self, file):
        self.file = file
        file.seek(file.size() - 16)
        n, magic = struct.unpack("<Q8s", file.read(16))
        if magic != MAGIC:
            raise ValueError("not a bit-plane file")
        file.seek(file.size() - 16 - n)
        footer = json.loads(zstandard.ZstdDecompressor().decompress(file.read(n)))
        self.kind, self.chunks, self.docs = footer["kind"], footer["chunks"], footer["docs"]
        self.unpack = zstandard.ZstdDecompressor()

    def chunk(self, k: int) -> np.ndarray:
        place, n, sizes = self.chunks[k]
        self.file.seek(place)
        return join_planes([self.unpack.decompress(self.file.read(s)) for s in sizes], n, self.kind)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        rest, k = np.zeros(0, dtype=np.uint32), 0
        for doc_id, n in self.docs:
            parts, have = [rest], len(rest)
            while have < n:
                parts.append(self.chunk(k))
                have += len(parts[-1])
                k += 1
            ids = parts[0] if len(parts) == 1 else np.concatenate(parts)
            yield doc_id, ids[:n]
            rest = ids[n:]


def write_bitplanes(docs: DataFrame, tokenizer_path: str, end_id: int, kind: str = "bit", id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes whole texts, appends end_id to each and writes bit-plane files in ascending id order.

    Returns one row for each file: shard, path, n_docs, n_ids, and start (ids in the files before it). Documents with
    a missing id come first; equal ids are ordered by text; a missing text is empty and keeps its end_id. An empty
    table gives no files. Only the two named columns are used. Files appear when whole, so lost tasks write them anew.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shards = max(16, math.ceil(total_bytes(docs.select(whole_text(text).alias("text"))) / SHARD_BYTES))
    base = scratch_path(spark, "bitplanes")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    rows = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder, uri = word_encoder(tokenizer_path), f"{base}/{shard:06d}.hlp"
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        made = {}

        def fill(stream) -> None:
            writer, ids_written = Writer(stream, kind), 0
            for batch in _chain(first, batches):
                doc_ids = batch.column("doc_id").to_pylist()
                for i, run in runs(batch.column("text")):
                    ids, sizes = encoder.encode_ended(run, end_id)
                    writer.add(doc_ids[i : i + len(run)], sizes, ids)
                    ids_written += len(ids)
            writer.close()
            made.update(n_docs=len(writer.docs), n_ids=ids_written)

        write_file(uri, fill)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "path": [uri], "n_docs": pa.array([made["n_docs"]], pa.int64()), "n_ids": pa.array([made["n_ids"]], pa.int64())})

    listed = stage_table(rows.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"), "manifest")
    # One row for each SHARD_BYTES of text. Starts are sums in two steps, so no task sorts more than a bundle of files.
    bundle = F.floor(F.col("shard") / BUNDLE)
    before = Window.orderBy("bundle").rowsBetween(Window.unboundedPreceding, -1)
    sums = listed.groupBy(bundle.alias("bundle")).agg(F.sum("n_ids").alias("n")).select("bundle", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("bundle").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    out = listed.withColumn("bundle", bundle).join(sums, "bundle")
    out = out.select("shard", "path", "n_docs", "n_ids", (F.col("ahead") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start"))
    return out.repartition(shards, "shard")


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def read_bitplanes(manifest: DataFrame) -> DataFrame:
    """The documents of bit-plane files: doc_id, start (ids before it in all files), ids."""
    ship_package(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start in _files(batches):
            with read_file(path) as f:
                rows: list[tuple] = []
                n = 0
                for doc_id, ids in Reader(f).documents():
                    rows.append((doc_id, start, ids.astype(np.int64)))
                    start += len(ids)
                    n += len(ids)
                    if n >= 1 << 20:
                        yield _rows(rows)
                        rows, n = [], 0
                if rows:
                    yield _rows(rows)

    return manifest.select("path", "start").mapInArrow(read, "doc_id long, start long, ids array<long>")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(a, pa.int64()), "start": pa.array(b, pa.int64()), "ids": pa.array(c, pa.list_(pa.int64()))})


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    for batch in batches:
        yield from zip(batch.column("path").to_pylist(), batch.column("start").to_pylist())


def bitplane_digests(manifest: DataFrame) -> DataFrame:
    """One row for each document, computed from the files: doc_id, start, n_tokens, ids_crc32."""
    ship_package(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start in _files(batches):
            cols: list[list] = [[], [], [], []]
            with read_file(path) as f:
                for doc_id, ids in Reader(f).documents():
                    for c, v in zip(cols, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        c.append(v)
                    start += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("path", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
