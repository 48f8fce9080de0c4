"""Token counts of documents in flat files of ids that have no index: a scan for end-of-document ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hivelens.llm.common import scratch_path, ship_package, stage_table, whole_text
from hivelens.llm.token_files import read_file, runs, word_encoder, write_file

BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, tokenizer_path: str, end_id: int, id_column: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Encodes whole texts and writes flat files of unsigned 16-bit ids, end_id after each text and nowhere else.

    Returns the files (shard, path, n_ids) and which document was written where (shard, ordinal, doc_id). Missing texts
    are empty; missing ids and repeated rows are kept as they are; an empty table gives no files.
    """
    spark = docs.sparkSession
    ship_package(spark)
    base = scratch_path(spark, "flat")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder = TaskContext.get().partitionId(), word_encoder(tokenizer_path)
        uri, doc_ids, n_ids = f"{base}/{shard:06d}.u16", [], 0

        def fill(stream) -> None:
            nonlocal n_ids
            for batch in batches:
                doc_ids.extend(batch.column("doc_id").to_pylist())
                for _, run in runs(batch.column("text")):
                    ids, _ = encoder.encode_ended(run, end_id)
                    if ids.max() > 0xFFFF or (ids == end_id).sum() != len(run):
                        raise ValueError("an id is over 16 bits or the end id")
                    stream.write(ids.astype("<u2").tobytes())
                    n_ids += len(ids)

        write_file(uri, fill)
        n = len(doc_ids)
        for a in range(0, n, 10_000):
            b = min(n, a + 10_000)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard] * (b - a), pa.int64()), "ordinal": pa.array(range(a, b), pa.int64()), "doc_id": pa.array(doc_ids[a:b], pa.int64()), "path": [uri] * (b - a), "n_ids": pa.array([n_ids] * (b - a), pa.int64())})

    written = stage_table(rows.mapInArrow(write, "shard long, ordinal long, doc_id long, path string, n_ids long"), "written")
    return written.where("ordinal = 0").select("shard", "path", "n_ids"), written.select("shard", "ordinal", "doc_id")


def count_tokens(files: DataFrame, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Start and length of each document in flat files (shard, path, n_ids), found by its end id alone.

    Files are cut into blocks without regard to documents; each block lists where its end ids are. A prefix scan over
    the blocks of a file gives the number of documents and the last end id before each, which stitches documents that
    span blocks. Returns shard, ordinal (the document's place in its file), start, n_tokens (without the end id).
    Ids after the last end id belong to no document. Files without ids give no rows.
    """
    ship_package(files.sparkSession)
    size = F.lit(block_ids)
    blocks = files.where("n_ids > 0").select("shard", "path", "n_ids", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_ids") - 1) / size).cast("long"))).alias("block"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with read_file(r["path"]) as f:
                    f.seek(2 * block_ids * r["block"])
                    ids = np.frombuffer(f.read(2 * block_ids), dtype="<u2")
                ends = np.flatnonzero(ids == end_id) + block_ids * r["block"]
                yield pa.RecordBatch.from_pydict({"shard": pa.array([r["shard"]], pa.int64()), "block": pa.array([r["block"]], pa.int64()), "ends": pa.array([ends], pa.list_(pa.int64()))})

    found = stage_table(blocks.repartition("shard", "block").mapInArrow(scan, "shard long, block long, ends array<long>"), "ends")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("shard", "block", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    carry = sums.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("end_before"))
    each = found.join(carry, ["shard", "block"]).select("shard", "docs_before", F.concat(F.array("end_before"), "ends").alias("at"))
    each = each.select("shard", "docs_before", F.explode(F.arrays_zip(F.slice("at", F.lit(1), F.size("at") - 1).alias("a"), F.slice("at", F.lit(2), F.size("at") - 1).alias("b"), F.sequence(F.lit(0), F.greatest(F.size("at") - 2, F.lit(0))).alias("k"))).alias("d"))
    return each.where("d.b is not null").select("shard", (F.col("docs_before") + F.col("d.k")).alias("ordinal"), (F.col("d.a") + 1).alias("start"), (F.col("d.b") - F.col("d.a") - 1).alias("n_tokens"))
