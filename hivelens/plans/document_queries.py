"""Queries over sensor documents: the event table written as JSON of all families, read back, normalised and correlated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hivelens.operators import correlate, observables
from hivelens.plans.registry import T, query
from hivelens.sources import families
from hivelens.sources.telemetry import events_of

_TYPES = [*(f.type for f in families.FAMILIES), "Mystery"]
_HAS = lambda f, column, path: path in f.fields.get(column, ())
_FAMILY_SQL = "f(family, how, port, protocol, has_session, has_login, has_command) AS (VALUES " + ", ".join(
    f"('{f.type}', '{f.how}', {f.port or 'NULL'}, {repr(f.protocol) if f.protocol else 'NULL'}, {_HAS(f, 'session', 'session') or _HAS(f, 'session', 'session_id')}, {_HAS(f, 'username', 'username')}, {_HAS(f, 'command', 'command')})"
    for f in families.FAMILIES
) + ", ('fallback', 'event', NULL, NULL, FALSE, FALSE, FALSE))"
_NORMAL_SQL = f"""{T}, {_FAMILY_SQL}, y AS (SELECT *, ({_TYPES!r})[CAST(event_id % {len(_TYPES)} AS INTEGER) + 1] AS said FROM t),
e AS (SELECT event_id, CASE WHEN said = 'Mystery' THEN 'fallback' ELSE said END AS family, date_trunc('millisecond', ts) AS ts, CASE WHEN type <> 'error' OR value <= 90 THEN src_ip END AS src_ip, sensor,
 CASE WHEN dst_port % 3 > 0 THEN dst_port END AS said_port, 'N' || chr(CAST(65 + user_id % 26 AS INTEGER)) AS country, CAST(64500 + user_id % 7 AS INTEGER) AS asn, CASE WHEN event_id % 5 > 0 THEN 's' || user_id || '-' || (event_id % 4) END AS said_session,
 CASE WHEN type = 'signup' THEN 'user' || (dst_port % 9) END AS said_user, CASE WHEN type = 'purchase' THEN 'run ' || (dst_port % 11) END AS said_command, CASE WHEN user_id % 2 = 0 THEN 'CVE-2021-' || (10000 + dst_port) END AS said_cve FROM y),
n AS (SELECT event_id, family, how, ts, src_ip, sensor, coalesce(said_port, port) AS dst_port, CASE WHEN family = 'Cowrie' THEN CASE WHEN coalesce(said_port, 22) IN (22, 2222) THEN 'ssh' ELSE 'telnet' END ELSE coalesce(protocol, 'tcp') END AS protocol, country, asn,
 CASE WHEN has_session THEN said_session END AS session, CASE WHEN has_login THEN said_user END AS username, CASE WHEN has_login THEN 'p' || said_user END AS password, CASE WHEN has_command THEN said_command END AS command, CASE WHEN family = 'Suricata' THEN said_cve END AS cve
 FROM e JOIN f USING (family) WHERE (src_ip IS NOT NULL OR family = 'fallback') AND (family <> 'Suricata' OR said_cve IS NOT NULL))"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON document of each event, by turns of all families and of an unknown type, as VARIANT."""
    even = F.col("user_id") % 2 == 0
    user = F.when(F.col("type") == "signup", F.concat(F.lit("user"), (F.col("dst_port") % 9).cast("string")))
    session = F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("s"), "user_id", F.lit("-"), (F.col("event_id") % 4).cast("string")))
    fields = {
        "event_id": F.col("event_id"),
        "@timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        "type": F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("event_id") % len(_TYPES) + 1).cast("int")),
        "src_ip": F.when((F.col("type") != "error") | (F.col("value") <= 90), F.col("src_ip")),
        "t-pot_hostname": F.col("sensor"),
        "dest_port": F.when(F.col("dst_port") % 3 > 0, F.col("dst_port")),
        "geoip": F.struct(F.lower(F.concat(F.lit("N"), F.char(65 + F.col("user_id") % 26))).alias("country_code2"), (64500 + F.col("user_id") % 7).alias("asn")),
        "session": session,
        "session_id": session,
        "username": user,
        "password": F.concat(F.lit("p"), user),
        "command": F.when(F.col("type") == "purchase", F.concat(F.lit("run "), (F.col("dst_port") % 11).cast("string"))),
        "protocol": F.lit("TCP"),
        "alert": F.when(even, F.struct(F.concat(F.lit("ET cve-2021-"), (10000 + F.col("dst_port")).cast("string"), F.lit(" seen")).alias("signature"))),
    }
    rows = events_of(spark, folder).select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("value"))
    return rows.select(F.expr("try_parse_json(value)").alias("doc"))


def normalised(spark: SparkSession, folder: str) -> DataFrame:
    return families.normalise(documents(spark, folder))


@query(f"WITH {_NORMAL_SQL} SELECT event_id, family, ts, src_ip, sensor, dst_port, protocol, country, asn, session, username, password, command, cve FROM n")
def p7_normalised(spark, folder):
    out = normalised(spark, folder).withColumn("event_id", F.try_variant_get("doc", "$.event_id", "bigint"))
    return out.select("event_id", "family", F.col("ts").cast("timestamp_ntz").alias("ts"), "src_ip", "sensor", "dst_port", "protocol", "country", "asn", "session", "username", "password", "command", F.get("cves", 0).alias("cve"))


_SESSION_SQL = f"""{_NORMAL_SQL}, g AS (SELECT *, CASE WHEN epoch_ms(ts) - epoch_ms(lag(ts) OVER o) > 300000 THEN 1 ELSE 0 END AS new, bool_or(session IS NOT NULL) OVER p AS any_, bool_and(session IS NOT NULL) OVER p AS all_
 FROM n WHERE src_ip IS NOT NULL WINDOW p AS (PARTITION BY family, sensor, src_ip), o AS (PARTITION BY family, sensor, src_ip ORDER BY ts, event_id)),
b AS (SELECT *, 'burst-' || sum(new) OVER (PARTITION BY family, sensor, src_ip ORDER BY ts, event_id) AS burst, coalesce(session, 'alone-' || event_id) AS by_id FROM g),
k AS (SELECT *, CASE WHEN how = 'gap' OR how = 'any' AND NOT any_ OR how = 'all' AND NOT all_ THEN burst WHEN how IN ('key', 'any', 'all') THEN by_id ELSE 'alone-' || event_id END AS key FROM b),
s AS (SELECT family, sensor, src_ip, key, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS events, array_to_string(list_sort(list(DISTINCT dst_port) FILTER (dst_port IS NOT NULL)), ',') AS ports,
 coalesce(string_agg(username || ':' || password, ',' ORDER BY ts, event_id) FILTER (username IS NOT NULL), '') AS credentials, coalesce(string_agg(command, ',' ORDER BY ts, event_id) FILTER (command IS NOT NULL), '') AS commands,
 coalesce(array_to_string(list_sort(list(DISTINCT cve) FILTER (cve IS NOT NULL)), ','), '') AS cves, min(country) AS country, min(asn) AS asn FROM k GROUP BY 1, 2, 3, 4)"""


def _sessions(spark, folder):
    return correlate.correlate(families.addressed(normalised(spark, folder)))


@query(f"WITH {_SESSION_SQL} SELECT * EXCLUDE (key, ports), coalesce(ports, '') AS ports FROM s")
def c4_document_sessions(spark, folder):
    joined = lambda c: F.array_join(c, ",")
    tried = F.transform("credentials", lambda x: F.concat(x["username"], F.lit(":"), x["password"]))
    return _sessions(spark, folder).select(
        "family", "sensor", "src_ip", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"), F.col("last_seen").cast("timestamp_ntz").alias("last_seen"), "events",
        joined("ports").alias("ports"), joined(tried).alias("credentials"), joined("commands").alias("commands"), joined("cves").alias("cves"), "country", "asn",
    )


@query(f"WITH {_SESSION_SQL} SELECT family, count(*) AS sessions, count(*) FILTER (commands = '' AND credentials = '' AND len(string_split(coalesce(ports, ''), ',')) < 3) AS bare FROM s GROUP BY 1")
def f10_bare_scans(spark, folder):
    rows = _sessions(spark, folder)
    return rows.groupBy("family").agg(F.count("*").alias("sessions"), F.count_if(correlate.bare_scan(rows)).alias("bare"))


@query(
    f"WITH {_SESSION_SQL}, u AS (SELECT 'sensor' AS kind, sensor AS name, first_seen, last_seen FROM s UNION ALL SELECT 'country', country, first_seen, last_seen FROM s UNION ALL SELECT 'network', CAST(asn AS VARCHAR), first_seen, last_seen FROM s "
    "UNION ALL SELECT 'address', src_ip, first_seen, last_seen FROM s UNION ALL SELECT 'vulnerability', unnest(string_split(cves, ',')), first_seen, last_seen FROM s WHERE cves <> '') SELECT kind, name, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM u GROUP BY 1, 2"
)
def b3_document_nodes(spark, folder):
    nodes = observables.observable_nodes(observables.with_evidence(_sessions(spark, folder)))
    kept = nodes.where(F.col("kind").isin("sensor", "country", "network", "address", "vulnerability"))
    return kept.select("kind", "name", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"), F.col("last_seen").cast("timestamp_ntz").alias("last_seen"))


@query(
    f"WITH {_SESSION_SQL} SELECT 'located-at' AS kind, count(DISTINCT (src_ip, country)) AS edges FROM s UNION ALL SELECT 'belongs-to', count(DISTINCT (src_ip, asn)) FROM s UNION ALL SELECT 'based-on', count(DISTINCT src_ip) FROM s"
)
def b18_document_edges(spark, folder):
    edges = observables.observable_edges(observables.with_evidence(_sessions(spark, folder)))
    return edges.where(F.col("kind").isin("located-at", "belongs-to", "based-on")).groupBy("kind").agg(F.count("*").alias("edges"))
