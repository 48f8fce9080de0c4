"""Passes, chunks and outcomes of publishing objects, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Types of objects by the pass that publishes them.
FOUNDATION = ("identity", "marking-definition", "attack-pattern", "location", "autonomous-system", "malware")
ENTITIES = ("ipv4-addr", "ipv6-addr", "file", "url", "domain-name", "process", "cryptographic-key", "indicator", "note", "vulnerability", "campaign")
RELATIONSHIPS = ("relationship", "sighting")
#: Chunks of a pass at most, and objects of a chunk at least.
MOST_CHUNKS, LEAST_OBJECTS = 6, 40
#: Events of a cycle from which a share of parsed ones under LEAST_PARSED is a stall.
STALL_EVENTS, LEAST_PARSED = 10_000, 0.01


def publish_pass(kind: Column) -> Column:
    """The pass of a type; unknown types go last, with relationships."""
    return F.when(kind.isin(*FOUNDATION), "foundation").when(kind.isin(*ENTITIES), "entities").otherwise("relationships")


def unknown_types(objects: DataFrame) -> DataFrame:
    """Objects of each type that no pass knows."""
    return objects.where(F.col("type").isNull() | ~F.col("type").isin(*FOUNDATION, *ENTITIES, *RELATIONSHIPS, "bundle")).groupBy("type").agg(F.count("*").alias("n"))


def chunked(objects: DataFrame, most: int = MOST_CHUNKS, least: int = LEAST_OBJECTS) -> DataFrame:
    """objects (pass, id) with chunk: near-equal runs of a pass in order of id, fewer where a pass is small.

    Places are sums in two steps, by the first signs of the id and then within them, so no task orders a whole pass.
    """
    head = F.substring(F.substring_index("id", "--", -1), 1, 3)
    order = [head, F.substring_index("id", "--", -1), F.col("id")]
    sizes = objects.groupBy("pass", head.alias("__head")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("pass").orderBy("__head").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn("__all", F.sum("__n").over(Window.partitionBy("pass")))
    placed = objects.withColumn("__head", head).join(ahead, ["pass", "__head"])
    place = F.col("__ahead") + F.row_number().over(Window.partitionBy("pass", "__head").orderBy(*order)) - 1
    chunks = F.greatest(F.lit(1), F.least(F.lit(most), F.greatest(F.expr(f"__all div {least}"), F.lit(1))))
    size = F.floor((F.col("__all") + chunks - 1) / chunks)
    return placed.select(*[F.col(c) for c in objects.columns], F.floor(place / size).cast("int").alias("chunk"))


def chunk_outcomes(events: DataFrame) -> DataFrame:
    """State of each chunk from its events (pass, chunk, seq, status, errors, summary): that of the last, and all its quarantines.

    A quarantine keeps the errors counted before and adds its reason to the summary.
    """
    ended = F.when(F.col("status") != "quarantined", F.col("seq"))
    out = events.groupBy("pass", "chunk").agg(
        F.max_by("status", "seq").alias("status"),
        F.max_by(F.when(ended.isNotNull(), F.struct("errors", "summary")), ended).alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "quarantined", F.struct("seq", "summary")))).alias("reasons"),
    )
    said = F.transform("reasons", lambda r: F.concat(F.lit(" | QUARANTINED: "), r["summary"]))
    return out.select("pass", "chunk", "status", F.coalesce("last.errors", F.lit(0)).alias("errors"), F.concat(F.coalesce("last.summary", F.lit("")), F.array_join(said, "")).alias("summary"))


def error_signature(errors: Column) -> Column:
    """A digest of errors (array of source, message) that doesn't depend on their order or time."""
    named = F.transform(errors, lambda e: F.concat(F.regexp_extract(F.coalesce(e["source"], F.lit("")), r'"id":\s*"([a-z0-9-]+--[0-9a-fA-F-]+)"', 1), F.lit("|"), F.coalesce(e["message"], F.lit(""))))
    return F.substring(F.sha2(F.array_join(F.array_sort(named), "\n").cast("binary"), 256), 1, 32)


def throughput(passes: DataFrame) -> DataFrame:
    """Objects a second of each pass (pass, objects, seconds) over all its records; missing without any time."""
    out = passes.groupBy("pass").agg(F.sum("objects").alias("objects"), F.sum("seconds").alias("seconds"), F.count("*").alias("records"))
    return out.withColumn("rate", F.when(F.col("seconds") > 0, F.col("objects") / F.col("seconds")))


def cycle_alarms(read: Column, parsed: Column, raw: Column, filtered: Column, excluded: Column) -> Column:
    """Alarms of a cycle: stall, if hardly any of many events parse; drift, if raw less filtered isn't what was excluded."""
    stall = (read >= STALL_EVENTS) & (parsed / read < LEAST_PARSED)
    drift = F.abs(raw - filtered - excluded) > F.greatest(F.lit(50.0), raw * 0.01)
    return F.array_compact(F.array(F.when(stall, "stall"), F.when(drift, "drift")))


def ledger_counts(ledger: DataFrame, since: Column) -> DataFrame:
    """Rows of each source and status, and how many were fetched since a time, errors too."""
    return ledger.groupBy("source", "status").agg(F.count("*").alias("n"), F.count_if(F.col("fetched_at") >= since).alias("spent"))


def busiest_unparsed(events: DataFrame, known: tuple[str, ...], most: int = 30) -> DataFrame:
    """The types without a parser that have the most events, ties by name."""
    return events.where(~F.col("type").isin(*known)).groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type").limit(most)
