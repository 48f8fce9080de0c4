"""Correlated sessions of all families to their nodes and edges.

All kinds of nodes are structs of one explode of the sessions, which are read once, so nodes and edges come from the same rows and an edge
never depends on which session first made a node. Repeated ones collapse in one group-by by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hivelens.functions import ids, scoring, text

_TECHNIQUE_NAMES = {i: n for i, n in scoring.TECHNIQUES.items()}


def with_evidence(sessions: DataFrame) -> DataFrame:
    """sessions (see correlate) with score, valid_days, techniques, domains, a command transcript and URLs that hold."""
    n = F.size
    signal = scoring.signal_score(F.col("auth_success"), n("commands"), n("hashes"), n("credentials"))
    out = sessions.withColumn("score", scoring.ip_score(signal, F.col("reputation"), F.coalesce("ics.write", F.lit(False))))
    out = out.withColumn("valid_days", scoring.validity_days(F.col("score")))
    shown = scoring.techniques(F.col("family"), F.col("auth_success"), n("commands"), n("hashes"), n("credentials"), n("keys"), n("ports"))
    out = out.withColumn("techniques", shown).withColumn("urls", F.filter("urls", text.valid_url))
    hosts = F.array_distinct(F.concat(F.transform("urls", text.url_host), F.array_compact(F.transform("jndi", lambda x: x["host"]))))
    out = out.withColumn("urls", F.array_distinct(F.concat("urls", F.transform("jndi", lambda x: x["url"]))))
    out = out.withColumn("domains", F.filter(hosts, text.valid_domain))
    plain = (n("commands") > 0) & ~text.recon_only(F.col("commands"))
    return out.withColumn("transcript", F.when(plain, text.process_line(F.col("commands"))))


def _node(kind: str, id_: Column, name: Column, score: Column | None = None) -> Column:
    value = F.struct(id_.alias("id"), F.lit(kind).alias("kind"), name.cast("string").alias("name"), (F.lit(None) if score is None else score).cast("int").alias("score"))
    return F.when(name.isNotNull(), value)


def _edge(src: Column, kind: str, dst: Column, where: Column | None = None) -> Column:
    value = F.struct(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("kind"))
    return value if where is None else F.when(where, value)


def _unfolded(sessions: DataFrame, single: list[Column], many: list[Column]) -> DataFrame:
    """The fields of structs and of arrays of structs of each session, missing ones left out, in one pass over the sessions."""
    lists = [F.coalesce(x, F.slice(F.array(single[0]), 1, 0)) for x in many]
    return sessions.select("first_seen", "last_seen", F.explode(F.array_compact(F.concat(F.array(*single), *lists))).alias("__x")).select("__x.*", "first_seen", "last_seen")


def observable_nodes(sessions: DataFrame) -> DataFrame:
    """id, kind, name, score and bounds of all nodes of sessions with evidence, one row for each id."""
    ip, score, sure = F.col("src_ip"), F.col("score"), F.lit(85)
    names = F.create_map(*[F.lit(v) for pair in _TECHNIQUE_NAMES.items() for v in pair])
    single = [
        _node("address", ids.address_id(ip), ip, score),
        _node("indicator", ids.ip_indicator_id(ip), ip, score),
        _node("sensor", ids.sensor_id(F.col("sensor")), F.col("sensor")),
        _node("country", ids.country_id(F.col("country")), F.col("country")),
        _node("network", ids.autonomous_system_id(F.col("asn")), F.col("asn")),
        _node("process", ids.process_id(F.col("transcript")), F.col("transcript")),
        _node("fingerprint", ids.key_id(F.col("hassh")), F.col("hassh")),
        _node("fingerprint", ids.key_id(F.col("ja3")), F.col("ja3")),
    ]
    many = [
        F.transform("hashes", lambda x: _node("file", ids.file_id(x), x, sure)),
        F.transform("hashes", lambda x: _node("file-indicator", ids.file_indicator_id(x), x, sure)),
        F.transform("urls", lambda x: _node("url", ids.url_id(x), x, score)),
        F.transform("domains", lambda x: _node("domain", ids.domain_id(x), F.lower(x), score)),
        F.transform("cves", lambda x: _node("vulnerability", ids.vulnerability_id(x), F.upper(x))),
        F.transform("techniques", lambda x: _node("technique", ids.technique_id(F.try_element_at(names, x)), x)),
        F.transform("keys", lambda x: _node("ssh-key", ids.key_id(x["fingerprint"]), x["fingerprint"], sure)),
    ]
    return _unfolded(sessions, single, many).groupBy("id").agg(
        F.min("kind").alias("kind"), F.min("name").alias("name"), F.max("score").alias("score"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def observable_edges(sessions: DataFrame) -> DataFrame:
    """id, src, dst, kind and bounds of all edges of sessions with evidence; edges onto themselves and repeats go."""
    ip, transcript = F.col("src_ip"), F.col("transcript")
    address, indicator = ids.address_id(ip), ids.ip_indicator_id(ip)
    names = F.create_map(*[F.lit(v) for pair in _TECHNIQUE_NAMES.items() for v in pair])
    there = lambda c: F.col(c).isNotNull()
    single = [
        _edge(indicator, "based-on", address),
        _edge(address, "located-at", ids.country_id(F.col("country")), there("country")),
        _edge(address, "belongs-to", ids.autonomous_system_id(F.col("asn")), there("asn")),
        _edge(ids.process_id(transcript), "related-to", address, there("transcript")),
        _edge(address, "related-to", ids.key_id(F.col("hassh")), there("hassh")),
        _edge(address, "related-to", ids.key_id(F.col("ja3")), there("ja3")),
    ]
    many = [
        F.transform("techniques", lambda x: _edge(indicator, "indicates", ids.technique_id(F.try_element_at(names, x)))),
        F.transform("cves", lambda x: _edge(indicator, "indicates", ids.vulnerability_id(x))),
        F.transform("hashes", lambda x: _edge(ids.file_indicator_id(x), "based-on", ids.file_id(x))),
        F.transform("hashes", lambda x: _edge(ids.file_id(x), "related-to", address)),
        F.transform("hashes", lambda x: _edge(ids.process_id(transcript), "related-to", ids.file_id(x), there("transcript"))),
        F.transform("urls", lambda x: _edge(ids.url_id(x), "related-to", address)),
        F.transform("keys", lambda x: _edge(address, "related-to", ids.key_id(x["fingerprint"]))),
        F.transform("keys", lambda x: _edge(indicator, "related-to", ids.key_id(x["fingerprint"]))),
    ]
    merged = _unfolded(sessions, single, many).where("src is not null and dst is not null and src <> dst")
    merged = merged.groupBy("src", "dst", "kind").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return merged.select(ids.relationship_id(F.col("src"), F.col("dst"), F.col("kind")).alias("id"), "src", "dst", "kind", "first_seen", "last_seen")


def jndi_nodes(events: DataFrame) -> DataFrame:
    """Look-up payloads of events (see jndi_events) by host, whether or not their source is an address: URLs, hosts, events."""
    each = events.select("ts", "sensor", F.explode("jndi").alias("x"))
    return each.groupBy(F.coalesce("x.host", "x.url").alias("group")).agg(
        F.count("*").alias("events"), F.array_sort(F.collect_set("x.scheme")).alias("schemes"), F.count_distinct("x.url").alias("urls"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )
