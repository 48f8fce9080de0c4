"""Events to attack sessions: one each, by session key, or by gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_SECONDS = 300


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a time with or without a zone."""
    return F.unix_micros(ts.cast("timestamp"))


def single_sessions(events: DataFrame, session: Column | None = None) -> DataFrame:
    """Each event is a session of its own; without a key it is sensor:address:milliseconds."""
    made = F.concat_ws(":", "sensor", "src_ip", F.floor(micros(F.col("ts")) / 1000).cast("string"))
    return events.withColumn("session_id", made if session is None else F.coalesce(session, made))


def gap_marks(events: DataFrame, seconds: int = GAP_SECONDS, keys: tuple[str, ...] = ("src_ip", "sensor"), order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """events with burst, the number of the session within its key: a new one begins after a gap of more than `seconds`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    gap = (micros(F.col("ts")) - micros(F.lag("ts").over(w))) > seconds * 1_000_000
    return events.withColumn("__new", F.coalesce(gap.cast("int"), F.lit(0))).withColumn("burst", F.sum("__new").over(w).cast("int")).drop("__new")


def gap_sessions(events: DataFrame, seconds: int = GAP_SECONDS) -> DataFrame:
    """Sessions by gaps, with first and last time, events, distinct ports and types."""
    marked = gap_marks(events, seconds)
    return marked.groupBy("src_ip", "sensor", "burst").agg(*session_sums())


def session_sums() -> list[Column]:
    return [
        F.min("ts").alias("first_seen"),
        F.max("ts").alias("last_seen"),
        F.count("*").alias("events"),
        F.count_distinct("dst_port").alias("ports"),
        F.count_distinct("type").alias("types"),
        F.count_if(F.col("type") == "signup").alias("auths"),
        F.count_if(F.col("type") == "purchase").alias("commands"),
        F.count_if((F.col("type") == "error") & (F.col("value") > 50)).alias("hashes"),
        F.count_if(F.col("type") == "click").alias("credentials"),
    ]


def _joined(order: str, text: str) -> Column:
    """Texts in order, joined by line feeds; missing ones are left out."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n")


def _transcript_parts(rows: DataFrame, keys: tuple[str, ...], order: str, text: str) -> DataFrame:
    """Transcripts of ranges of the order column within each key, so that the rows of a large key meet in many tasks."""
    ranged = rows.repartitionByRange(*keys, order).withColumn("part", F.spark_partition_id())
    return ranged.groupBy(*keys, "part").agg(F.count("*").alias("n"), F.when(F.count(text) > 0, _joined(order, text)).alias("transcript"))


def transcript_parts(rows: DataFrame, keys: tuple[str, ...], order: str, text: str) -> DataFrame:
    """Rows of a key in order, as parts numbered from 1 that follow each other: count and joined texts of each."""
    by_key = Window.partitionBy(*keys).orderBy("part")
    return _transcript_parts(rows, keys, order, text).withColumn("part", F.row_number().over(by_key))


def keyed_sessions(rows: DataFrame, keys: tuple[str, ...], order: str, text: str) -> DataFrame:
    """Rows of a key in order: count and all ordered texts joined by line feeds.

    A transcript is one value, so at most 2 GB; keys with more are for transcript_parts.
    """
    parts = _transcript_parts(rows, keys, order, text)
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), _joined("part", "transcript").alias("transcript"))


def mixed_sessions(events: DataFrame, seconds: int = GAP_SECONDS, need: str = "any") -> DataFrame:
    """session_key by session id if any (or all) events of an address and sensor have one, else by gaps."""
    w = Window.partitionBy("src_ip", "sensor")
    has = F.col("session").isNotNull()
    by_id = (F.bool_or(has) if need == "any" else F.bool_and(has)).over(w)
    marked = gap_marks(events.withColumn("__by_id", by_id), seconds)
    alone = F.concat_ws(":", "sensor", "src_ip", F.floor(micros(F.col("ts")) / 1000).cast("string"))
    return marked.withColumn("session_key", F.when(F.col("__by_id"), F.coalesce("session", alone)).otherwise(F.concat(F.lit("burst-"), F.col("burst").cast("string")))).drop("__by_id")


def fold_targets(targets: Column, urls: Column) -> Column:
    """Request targets first, then other URLs, each once."""
    return F.array_distinct(F.concat(targets, urls))
