"""Rolling aggregates of attackers, credentials, artifacts and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 25
CAMPAIGN_MEMBERS = (2, 50)


def attacker_activity(events: DataFrame) -> DataFrame:
    """Counters and bounds for each address, type and sensor; last known value of a column by time."""
    return events.groupBy("src_ip", F.col("type").alias("parser"), "sensor").agg(
        F.count("*").alias("events"),
        F.min("ts").alias("first_seen"),
        F.max("ts").alias("last_seen"),
        F.count_distinct("dst_port").alias("ports"),
        F.max_by("dst_port", F.struct("ts", "event_id")).alias("last_port"),
    )


def merge_activity(old: DataFrame, new: DataFrame, keys: tuple[str, ...], sums: tuple[str, ...]) -> DataFrame:
    """Stored and new aggregates in one: sums added, bounds widened. The union's order doesn't matter."""
    parts = old.unionByName(new).groupBy(*keys)
    return parts.agg(*[F.sum(c).alias(c) for c in sums], F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def top_counted(rows: DataFrame, keys: tuple[str, ...], value: str, most: int = SAMPLES) -> DataFrame:
    """The values of a key seen most often, ties by value; counts are kept whole and cut only here."""
    counted = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def first_distinct(rows: DataFrame, keys: tuple[str, ...], value: str, most: int = SAMPLES) -> DataFrame:
    """The distinct values of a key seen first."""
    seen = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min("ts").alias("first_seen"))
    w = Window.partitionBy(*keys).orderBy("first_seen", value)
    return seen.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def campaign_members(rows: DataFrame, key: Column) -> DataFrame:
    """First and last time of each artifact and address."""
    return rows.select(key.alias("artifact_key"), "src_ip", "ts").where("artifact_key is not null").groupBy("artifact_key", "src_ip").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def campaigns(members: DataFrame, least: int = CAMPAIGN_MEMBERS[0], most: int = CAMPAIGN_MEMBERS[1]) -> DataFrame:
    """Artifacts shared by at least `least` and at most `most` addresses."""
    found = members.groupBy("artifact_key").agg(F.count("*").alias("members"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return found.where(F.col("members").between(least, most))


def sweep(activity: DataFrame) -> DataFrame:
    """One row for each address over its activity rows."""
    return activity.groupBy("src_ip").agg(F.count_distinct("parser").alias("surfaces"), F.count_distinct("sensor").alias("sensors"), F.sum("events").alias("events"), F.max("last_seen").alias("last_seen"))


def credential_totals(attempts: DataFrame) -> DataFrame:
    """Attempts, bounds and distinct addresses of each user, password and sensor."""
    return attempts.groupBy("username", "password", "sensor").agg(
        F.count("*").alias("attempts"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count_distinct("src_ip").alias("sources")
    )


def daily_top_credentials(attempts: DataFrame, most: int = 100) -> DataFrame:
    """The pairs of a sensor and day tried most often."""
    counted = attempts.groupBy("sensor", F.to_date("ts").alias("day"), "username", "password").agg(F.count("*").alias("attempts"), F.count_distinct("src_ip").alias("sources"))
    w = Window.partitionBy("sensor", "day").orderBy(F.desc("attempts"), "username", "password")
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def active_between(activity: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose [first_seen, last_seen] meets [start, end]."""
    return activity.where((F.col("last_seen") >= F.lit(start).cast("timestamp_ntz")) & (F.col("first_seen") <= F.lit(end).cast("timestamp_ntz")))


def samples(files: DataFrame) -> DataFrame:
    """Captures of each file content: count, first sensor and size. files: sha256, sensor, ts, size."""
    return files.groupBy("sha256").agg(F.count("*").alias("captures"), F.min_by("sensor", F.struct("ts", "sensor")).alias("first_sensor"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.max("size").alias("size"))


def ip_credentials(attempts: DataFrame, most: int = 200) -> DataFrame:
    """The pairs that an address tried: accepted ones first, then by attempts. attempts: src_ip, username, password, ok."""
    counted = attempts.groupBy("src_ip", "username", "password").agg(F.count("*").alias("attempts"), F.bool_or("ok").alias("succeeded"))
    w = Window.partitionBy("src_ip").orderBy(F.desc("succeeded"), F.desc("attempts"), "username", "password")
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
