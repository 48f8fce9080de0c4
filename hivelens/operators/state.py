"""State that lasts over cycles: maxima, emit logs, caches, retention and runs of failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_max_state(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Highest score of each id, with the name that came with it (the newest of equals), all labels, newest time."""
    both = stored.unionByName(new)
    return both.groupBy("id").agg(
        F.max("score").alias("score"), F.max_by("name", F.struct("score", "updated_at", "name")).alias("name"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("labels")))).alias("labels"), F.max("updated_at").alias("updated_at"),
    )


def newly_active(activity: DataFrame, emitted: DataFrame) -> DataFrame:
    """Rows whose last_seen is later than what was emitted for their address."""
    last = emitted.groupBy("src_ip").agg(F.max("last_seen").alias("__emitted"))
    return activity.join(last, "src_ip", "left").where("__emitted is null or last_seen > __emitted").drop("__emitted")


def cache_hits(cache: DataFrame, now: str) -> DataFrame:
    """Answers still in force: found or known to be absent, and not expired."""
    return cache.where(F.col("status").isin("ok", "absent") & (F.col("expires_at") > F.lit(now).cast("timestamp_ntz")))


def backoff_seconds(attempts: Column, base: int = 60, most: int = 86_400) -> Column:
    """Waiting time after so many failures: base, doubled with each, at most `most`."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), F.least(attempts, F.lit(40)) - 1), F.lit(most)).cast("long")


def in_backoff(cache: DataFrame, now: str, base: int = 60, most: int = 86_400) -> DataFrame:
    """Failed look-ups that must still wait."""
    until = F.unix_timestamp("fetched_at") + backoff_seconds(F.col("attempts"), base, most)
    return cache.where((F.col("status") == "error") & (F.col("attempts") > 0) & (until > F.unix_timestamp(F.lit(now).cast("timestamp_ntz"))))


def retained(rows: DataFrame, column: str, now: str, days: int) -> DataFrame:
    """Rows not older than so many days."""
    return rows.where(F.col(column) >= F.lit(now).cast("timestamp_ntz") - F.make_interval(days=F.lit(days)))


def newest(rows: DataFrame, order: str, keep: int) -> DataFrame:
    return rows.orderBy(F.desc(order)).limit(keep)


def plan_hashes(chunks: DataFrame) -> DataFrame:
    """A hash of each chunk's sorted ids, which seals a publication plan. A chunk is bounded by how it was cut."""
    return chunks.groupBy("chunk").agg(F.count("*").alias("objects"), F.sha2(F.array_join(F.array_sort(F.collect_list("id")), "\n").cast("binary"), 256).alias("hash"))


def failure_runs(results: DataFrame) -> DataFrame:
    """Runs of consecutive equal failures in each pass: results has pass, at, signature (missing on success)."""
    w = Window.partitionBy("pass").orderBy("at")
    changed = ~F.col("signature").eqNullSafe(F.lag("signature").over(w)) | F.lag("at").over(w).isNull()
    marked = results.withColumn("__run", F.sum(changed.cast("int")).over(w))
    return marked.where("signature is not null").groupBy("pass", "__run", "signature").agg(F.count("*").alias("failures"), F.min("at").alias("since")).drop("__run")


def is_clean(chunks: DataFrame, expected: int) -> DataFrame:
    """One row: whether all expected chunks are there, done and without errors."""
    return chunks.agg((F.count_distinct("chunk").eqNullSafe(F.lit(expected)) & F.coalesce(F.bool_and((F.col("status") == "complete") & (F.col("errors") == 0)), F.lit(False))).alias("clean"))
