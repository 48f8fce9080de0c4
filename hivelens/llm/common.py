"""Helpers that all operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import inspect
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a missing one as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bucket_of(id_column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; a missing id counts as bucket 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(0)) % modulus


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = jsc.get() if jsc.isDefined() else "file://" + tempfile.mkdtemp(prefix="hivelens-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/hivelens/{uuid.uuid4().hex}/{name}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df into the shared folder and reads it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers that don't get the repository by PYTHONPATH or working folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT in paths or os.getcwd() == _ROOT and sc.master.startswith("local["):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="hivelens-"), "hivelens.zip")
    with zipfile.ZipFile(target, "w") as z:
        top = os.path.join(_ROOT, "hivelens")
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), _ROOT))
    sc.addPyFile(target)
    sys.path[:] = [p for p in sys.path if p != target]


def release() -> None:
    """Gives what this process has freed back to the system: Python workers outlive their tasks and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def frugal(f: Callable) -> Callable:
    """f, a function of a task's batches or of a group's table, with release() at its end."""

    @functools.wraps(f)
    def batches_(batches):
        try:
            yield from f(batches)
        finally:
            release()

    @functools.wraps(f)
    def table_(table):
        try:
            return f(table)
        finally:
            release()

    return batches_ if inspect.isgeneratorfunction(f) else table_


def appended(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]],
    fields: list[T.StructField],
) -> DataFrame:
    """docs with columns computed batch by batch; input columns that have a result's name give way to it.

    make() runs once in each task and returns the function that maps a batch to its new columns.
    """
    ship_package(docs.sparkSession)
    names = {f.name.lower() for f in fields}
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    schema = T.StructType(base.schema.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            new = f(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(new[x.name] for x in fields)], [*batch.schema.names, *(x.name for x in fields)]
            )

    return base.mapInArrow(frugal(run), schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, empty for missing ones."""
    return [x or b"" for x in batch.column(column).cast(pa.large_binary()).to_pylist()]


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
