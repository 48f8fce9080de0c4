"""Normalised events of all families to sessions with what happened in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hivelens.functions.ics import summary_of
from hivelens.operators.sessions import GAP_SECONDS, micros
from hivelens.sources.families import FAMILIES, signals

_KEYS = ("family", "sensor", "src_ip")


def session_keys(events: DataFrame, seconds: int = GAP_SECONDS) -> DataFrame:
    """events with session_key, formed as the family says: an event each, by id, by gaps, or by id where any or all events have one."""
    how = lambda *kinds: F.col("family").isin([f.type for f in FAMILIES if f.how in kinds])
    part = Window.partitionBy(*_KEYS)
    order = part.orderBy("ts", "doc_hash")
    rows = events.withColumn("doc_hash", F.xxhash64(F.to_json(F.struct("doc"))))
    gap = (micros(F.col("ts")) - micros(F.lag("ts").over(order))) > seconds * 1_000_000
    rows = rows.withColumns({
        "__new": F.coalesce(gap.cast("int"), F.lit(0)),
        "__any": F.max(F.col("session").isNotNull()).over(part),
        "__all": F.min(F.col("session").isNotNull()).over(part),
    })
    burst = F.concat(F.lit("burst-"), F.sum("__new").over(order).cast("string"))
    alone = F.concat_ws(":", F.floor(micros(F.col("ts")) / 1000).cast("string"), F.hex("doc_hash"))
    by_id = F.coalesce("session", alone)
    key = F.when(how("gap"), burst).when(how("key"), by_id).when(how("any"), F.when(F.col("__any"), by_id).otherwise(burst)).when(how("all"), F.when(F.col("__all"), by_id).otherwise(burst)).otherwise(alone)
    return rows.withColumn("session_key", key).drop("__new", "__any", "__all")


def _ordered(value: Column) -> Column:
    """Values in order of time, missing ones left out."""
    kept = F.collect_list(F.when(value.isNotNull(), F.struct("ts", "doc_hash", value.alias("v"))))
    return F.transform(F.array_sort(kept), lambda x: x["v"])


#: Distinct industrial requests that a session shows.
MOST_REQUESTS = 20


def correlate(events: DataFrame, seconds: int = GAP_SECONDS) -> DataFrame:
    """Sessions: bounds, ports, protocols, credentials and commands in order, files, URLs, fingerprints, keys, and what only
    some families tell (see families.signals).

    Fingerprints are the last known, for Fatt the first. Mail and desktop log-ins are pairs, each once; credentials of
    request bodies come after the others. requests are mail verbs as sent, or the first MOST_REQUESTS distinct industrial
    requests; ics summarises the latter's findings and is missing for other families.
    """
    at = F.struct("ts", "doc_hash")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), at))
    print_ = lambda c: F.when(F.col("family") == "Fatt", first(c)).otherwise(last(c)).alias(c)
    tried = F.when(F.col("username").isNotNull() | F.col("password").isNotNull(), F.struct("username", "password"))
    flat = lambda c: F.flatten(_ordered(F.col(c)))
    industrial = F.when(F.col("finding").isNotNull(), F.col("protocol"))
    summary = summary_of(industrial, F.col("finding.tier"), F.col("finding.function"))
    out = session_keys(signals(events), seconds).groupBy(*_KEYS, "session_key").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("events"),
        F.array_sort(F.collect_set("dst_port")).alias("ports"), F.array_sort(F.collect_set("protocol")).alias("protocols"),
        F.bool_or("login_ok").alias("auth_success"), _ordered(tried).alias("credentials"), _ordered(F.col("command")).alias("commands"),
        F.array_sort(F.collect_set("sha256")).alias("hashes"), F.array_distinct(_ordered(F.col("url"))).alias("urls"), F.array_distinct(_ordered(F.col("path"))).alias("paths"),
        print_("hassh"), print_("ja3"), print_("ja3s"), print_("ssh_version"), F.max_by("payload", F.length("payload")).alias("payload"),
        F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("cves")))).alias("cves"),
        F.min_by("reputation", at).alias("reputation"), F.bool_or("international").alias("international"), last("country").alias("country"), last("asn").alias("asn"), last("as_org").alias("as_org"),
        flat("requests").alias("requests"), F.nullif(F.sum("mail_bytes"), F.lit(0)).alias("mail_bytes"), _ordered(F.col("ntlm")).alias("ntlm"),
        F.array_distinct(_ordered(F.col("request_url"))).alias("request_urls"), F.array_distinct(_ordered(F.col("request_host"))).alias("request_hosts"),
        flat("body_credentials").alias("__body"), F.array_distinct(flat("jndi")).alias("jndi"), F.struct(*summary).alias("ics"),
    )
    url = r"(?:https?|ftp|tftp)://[^\s\"'<>;|&)]+"
    inside = F.flatten(F.transform("commands", lambda c: F.regexp_extract_all(c, F.lit(url), F.lit(0))))
    pairs = F.array_distinct(F.filter("credentials", lambda c: c["username"].isNotNull() & c["password"].isNotNull()))
    own = F.when(F.col("family").isin("Mailoney", "RDPHoneypot"), pairs).otherwise(F.col("credentials"))
    industrial_only = F.col("family") == "ConPot"
    return out.withColumns({
        "urls": F.array_distinct(F.concat("urls", inside)),
        "credentials": F.concat(own, F.array_except("__body", own)),
        "requests": F.when(industrial_only, F.slice(F.array_distinct("requests"), 1, MOST_REQUESTS)).otherwise(F.col("requests")),
        "ics": F.when(industrial_only, F.col("ics")),
    }).drop("__body")


def bare_scan(sessions: DataFrame) -> Column:
    """Whether a session did nothing: no login, command, file, credential, payload, and fewer than three ports."""
    empty = [F.size(c) == 0 for c in ("commands", "hashes", "credentials", "urls")]
    out = ~F.col("auth_success") & (F.size("ports") < 3) & F.col("payload").isNull()
    for e in empty:
        out = out & e
    return out
