"""Range, suffix, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hivelens.functions.network import hostname_suffix, ipv4_number


def cidr_join(addresses: DataFrame, nets: DataFrame, ip: str = "src_ip", number: Column | None = None) -> DataFrame:
    """Addresses with every network (columns lo and hi, see network_table) that holds them.

    number: the addresses as numbers, where they are known; else they are worked out from the text in ip.

    Networks are filed under the first octets they reach, an equi-join key, so no address meets all networks.
    """
    filed = nets.withColumn("__octet", F.explode(F.sequence(F.expr("lo div 16777216"), F.expr("hi div 16777216"))))
    numbered = addresses.withColumn("__n", ipv4_number(F.col(ip)) if number is None else number).withColumn("__octet", F.expr("__n div 16777216"))
    return numbered.join(filed, "__octet").where("__n between lo and hi").drop("__n", "__octet")


def first_match(matches: DataFrame, keys: tuple[str, ...], order: str, value: str) -> DataFrame:
    """The value of the first rule that matched each key."""
    return matches.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def suffix_join(hosts: DataFrame, suffixes: DataFrame, host: str = "host", suffix: str = "suffix") -> DataFrame:
    """Hosts with the domains they lie under: every tail of a host's labels is an equi-join key."""
    labels = F.split(F.lower(F.col(host)), r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    out = hosts.withColumn("__tail", F.explode(tails)).join(suffixes.withColumn("__tail", F.lower(F.col(suffix))), "__tail")
    return out.where(hostname_suffix(F.lower(F.col(host)), F.lower(F.col(suffix)))).drop("__tail")


def vendor_match(events: DataFrame, rules: DataFrame) -> DataFrame:
    """events with vendor and basis: by AS number, else by a keyword in the AS name, else by the confirmed host name.

    events: event_id, asn, as_org, host; rules: vendor, kind (asn, org, rdns), value, rank. Keyword rules are few by
    nature (a hand-kept table), so they alone are compared one by one.
    """
    asn = events.join(rules.where("kind = 'asn'").select(F.col("value").cast("int").alias("asn"), "vendor", "rank"), "asn").select("event_id", "vendor", F.concat(F.lit("asn:"), "asn").alias("basis"), F.struct(F.lit(0).alias("p"), "rank").alias("order"))
    org = events.join(rules.where("kind = 'org'"), F.contains(F.lower("as_org"), F.lower("value"))).select("event_id", "vendor", F.concat(F.lit("org:"), "value").alias("basis"), F.struct(F.lit(1).alias("p"), "rank").alias("order"))
    name = suffix_join(events, rules.where("kind = 'rdns'").select(F.col("value").alias("suffix"), "vendor", "rank")).select("event_id", "vendor", F.concat(F.lit("rdns:"), "suffix").alias("basis"), F.struct(F.lit(2).alias("p"), "rank").alias("order"))
    best = asn.unionByName(org).unionByName(name).groupBy("event_id").agg(F.min_by(F.struct("vendor", "basis"), "order").alias("m"))
    return events.join(best, "event_id", "left").select(events["*"], "m.vendor", "m.basis")


def without_dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends exist."""
    known = nodes.select("id").distinct()
    return edges.join(known.withColumnRenamed("id", "src"), "src", "left_semi").join(known.withColumnRenamed("id", "dst"), "dst", "left_semi")


def not_emitted(edges: DataFrame, emitted: DataFrame, kinds: tuple[str, ...] = ("located-at", "belongs-to", "based-on")) -> DataFrame:
    """Edges of kinds that never change and were emitted before go."""
    known = emitted.select("id").distinct().withColumn("__known", F.lit(True))
    return edges.join(known, "id", "left").where(~(F.col("kind").isin(*kinds) & F.coalesce("__known", F.lit(False)))).drop("__known")
