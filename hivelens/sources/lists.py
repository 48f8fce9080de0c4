"""Published lists of addresses and networks, and how fresh they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hivelens.functions.network import canonical_ip, is_ipv4, network_table
from hivelens.functions.text import malware_family

#: Lists older than this match nothing.
STALE_HOURS = 72.0


def netset(lines: DataFrame, column: str = "value") -> DataFrame:
    """IPv4 networks of list lines as cidr, lo and hi: the first word of lines that aren't blank or comments (# or ;)."""
    text = F.trim(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"[\t\r\x0b\x0c]", " "))
    token = F.split(text, " +")[0]
    return network_table(lines.where((text != "") & ~F.substring(text, 1, 1).isin("#", ";")).select(token.alias("cidr")))


def online_hosts(documents: DataFrame, column: str = "value") -> DataFrame:
    """IPv4 hosts that JSON arrays of trackers state as online: ip and family.

    A document that is no array, or an array without any ip_address, raises an error: its schema has changed, and no
    hosts would pass for a clean result.
    """
    entries = F.from_json(F.col(column), "array<struct<ip_address string, status string, malware string>>")
    shaped = F.when(entries.isNull() | ~F.startswith(F.trim(F.col(column)), F.lit("[")), F.raise_error(F.lit("a list is no JSON array"))).when(
        (F.size(entries) > 0) & ~F.exists(entries, lambda e: e["ip_address"].isNotNull()), F.raise_error(F.lit("no entry has an ip_address"))
    ).otherwise(entries)
    each = documents.select(F.explode(shaped).alias("e")).select(F.trim("e.ip_address").alias("ip"), F.lower("e.status").alias("status"), F.nullif(F.trim("e.malware"), F.lit("")).alias("family"))
    return each.where((F.col("status") == "online") & is_ipv4(F.col("ip"))).select(canonical_ip(F.col("ip")).alias("ip"), "family")


def age_hours(fetched_at: Column, now: Column) -> Column:
    """Hours since a fetch, not under zero; missing if it lies over an hour ahead, as a clock is wrong then."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(fetched_at.cast("timestamp"))) / 3.6e9
    return F.when(age >= -1.0, F.greatest(age, F.lit(0.0)))


def usable(lists: DataFrame, now: Column) -> DataFrame:
    """Lists (fetched_at) that are fresh enough to match, with their age."""
    return lists.withColumn("age", age_hours(F.col("fetched_at"), now)).where(F.col("age") <= STALE_HOURS)


def due(lists: DataFrame, now: Column, every_seconds: float) -> DataFrame:
    """Lists (fetched_at, failed) that the next fetch covers: failed ones and those past their time; all where none is due."""
    late = F.coalesce(age_hours(F.col("fetched_at"), now), F.lit(1e9)) * 3600 >= every_seconds
    marked = lists.withColumn("__due", F.coalesce("failed", F.lit(False)) | late)
    some = marked.agg(F.coalesce(F.max("__due"), F.lit(False)).alias("__some"))  # one row
    return marked.join(F.broadcast(some)).where(F.col("__due") | ~F.col("__some")).drop("__due", "__some")


def hit_labels(hits: DataFrame, sources: DataFrame) -> DataFrame:
    """Labels of each address that lists (key) hold: ip and the sorted labels of the sources (key, label)."""
    return hits.join(sources.select("key", "label"), "key").groupBy("ip").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def hit_families(hits: DataFrame, sources: DataFrame) -> DataFrame:
    """Edges from addresses to malware families, from sources that promote families and hits that name one."""
    named = hits.join(sources.where("promotes").select("key"), "key", "left_semi").withColumn("family", malware_family(F.col("family")))
    return named.where("family is not null").select("ip", F.lit("related-to").alias("kind"), "family").distinct()


def address_candidates(activity: DataFrame, after: str, limit: int) -> DataFrame:
    """A page of the attackers' IPv4 addresses, in order, for look-ups."""
    return activity.where((F.col("src_ip") > after) & is_ipv4(F.col("src_ip"))).select("src_ip").distinct().orderBy("src_ip").limit(limit)


def hash_candidates(artifacts: DataFrame, limit: int) -> DataFrame:
    """SHA-256 digests of captured malware, the last seen first (ties by digest), for look-ups."""
    kept = artifacts.where((F.col("kind") == "malware") & (F.length("value") == 64))
    found = kept.groupBy(F.lower("value").alias("sha256")).agg(F.max("last_seen").alias("last_seen"))
    return found.orderBy(F.desc("last_seen"), "sha256").limit(limit)
