"""Sensor documents of many families to one event model, by a table of where each family keeps each field.

A document is a VARIANT, so fields may be nested, dotted (`http.url`), missing or of another type than usual; a field
that can't be read as asked is missing. Everything is built-in expressions over one scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hivelens.functions import ics, ports, text, web
from hivelens.functions.network import canonical_ip, is_ipv4


@dataclass(frozen=True)
class Family:
    """type: the documents' type; how: how its events form sessions (single, key, gap, any, all)."""

    type: str
    how: str = "single"
    protocol: str | None = None
    port: int | None = None
    fields: dict[str, tuple[str, ...]] = field(default_factory=dict)
    aliases: tuple[str, ...] = ()


_WEB = {
    "method": ("request_method", "method", "request.method", "http_method"),
    "path": ("request_uri", "request_path", "uri", "path_info", "target", "url", "http.url", "request.requestURI"),
    "user_agent": ("http_user_agent", "user_agent", "user-agent", "header_user-agent", "agent", "request.userAgent"),
    "body": ("request_body", "body", "http_body", "request.body"),
    "host_header": ("http_host", "header_host", "host_header", "request.headers.Host", "headers.http_host"),
    "status": ("status", "status_code", "response"),
}
_LOGIN = {"username": ("username",), "password": ("password",)}

FAMILIES = (
    Family("Cowrie", "key", fields={"session": ("session",), **_LOGIN, "command": ("input", "command"), "sha256": ("shasum", "sha256", "file_sha256"), "url": ("url", "file_url"), "hassh": ("hassh",), "ssh_version": ("version",), "event": ("eventid",)}),
    Family("Suricata", fields={"signature": ("alert.signature",), "category": ("alert.category",), "severity": ("alert.severity",), "flow": ("flow_id",), "method": ("http.http_method",), "path": ("http.url",), "host_header": ("http.hostname", "tls.sni"), "user_agent": ("http.http_user_agent",), "technique": ("alert.metadata.mitre_technique_id", "mitre_technique_id"), "sha256": ("fileinfo.sha256",), "event": ("event_type",)}),
    Family("Honeytrap", "gap", fields={"payload_hex": ("attack_connection.payload.data_hex", "payload_hex"), "payload_sha512": ("attack_connection.payload.sha512_hash", "payload_sha512"), "url": ("download_url", "url"), "sha256": ("sha256_hash", "sha256"), "protocol": ("attack_connection.protocol", "protocol", "proto")}),
    Family("Dionaea", fields={"protocol": ("connection.protocol", "connection_protocol", "protocol"), "sha256": ("sha256_hash", "sha256", "primary_hash"), "url": ("download_url", "url"), **_LOGIN}),
    Family("Heralding", "key", fields={"session": ("session_id",), "protocol": ("proto", "protocol"), **_LOGIN}),
    Family("ConPot", "key", fields={"session": ("id", "session_id"), "protocol": ("data_type", "protocol"), "body": ("request", "conpot_request"), "event": ("event_type",)}),
    Family("H0neytr4p", protocol="http", port=80, fields=_WEB),
    Family("Galah", protocol="http", port=80, fields=_WEB, aliases=("info", "error", "successfulResponse", "cachedResponse", "staticResponse", "failedResponse")),
    Family("ElasticPot", protocol="http", port=9200, fields={**_WEB, "path": ("http.url", "request_url", "url")}),
    Family("Ciscoasa", fields={"payload": ("payload_printable", "payload", "message")}),
    Family("RDPHoneypot", "key", protocol="rdp", port=3389, fields={"session": ("session_id", "session"), **_LOGIN, "event": ("eventid",), "payload": ("hashcat", "message")}),
    Family("Tanner", protocol="http", port=80, fields={**_WEB, "path": ("path", "url"), "attack": ("response_msg.response.message.detection.name", "attack_type")}),
    Family("Redishoneypot", protocol="redis", port=6379, fields={"command": ("action", "msg")}),
    Family("Router", "all", fields={"session": ("session_id", "session", "connection_id"), "command": ("command",)}),
    Family("Mailoney", "any", protocol="smtp", port=25, fields={"session": ("session_id",), "username": ("auth_user",), "password": ("auth_pass",)}),
    Family("Sentrypeer", protocol="sip", port=5060, fields={"method": ("sip_method", "method"), "called": ("called_number",), "user_agent": ("sip_user_agent",), "payload": ("sip_message",)}),
    Family("Fatt", "gap", fields={"hassh": ("fatt_ssh.hassh", "fatt_ssh.hasshServer", "hassh"), "ja3": ("fatt_tls.ja3", "ja3"), "ja3s": ("fatt_tls.ja3s", "ja3s"), "ssh_version": ("fatt_ssh.client", "fatt_ssh.server")}),
    Family("Adbhoney", protocol="adb", port=5555, fields={"session": ("session",), "command": ("command", "input"), "sha256": ("data_sha256", "shasum")}),
    Family("Beelzebub", "gap", fields={"command": ("command", "input"), **_LOGIN, "payload": ("output",), "ssh_version": ("client", "ssh_client"), "protocol": ("protocol", "service")}),
    Family("NGINX", protocol="http", port=80, fields={**_WEB, "path": ("request_uri", "request")}),
    Family("Wordpot", protocol="http", port=80, fields={**_WEB, "path": ("url", "request_path")}),
    Family("Honeyaml", protocol="http", port=8080, fields={**_WEB, "path": ("target", "path", "request_path", "request_uri")}),
    Family("Miniprint", port=9100, protocol="printer", fields={"command": ("action",), "path": ("request_path", "info"), "event": ("event",)}),
    Family("Ipphoney", protocol="ipp", port=631, fields={**_WEB, "path": ("http.url", "url")}),
    Family("Dicompot", protocol="dicom", port=11112, fields={"session": ("session_id", "id"), "command": ("command_type", "msg")}),
    Family("Medpot", protocol="hl7", port=2575, fields={"command": ("msg_type", "message"), "payload": ("data",)}),
)
FALLBACK = "fallback"
# Names of protocols that industrial sensors spell in another way.
INDUSTRIAL_NAMES = {"kamstrup_protocol": "kamstrup", "kamstrup_meter": "kamstrup", "kamstrup_management_protocol": "kamstrup-management"}
_STRINGS = tuple(dict.fromkeys(c for f in FAMILIES for c in f.fields))


def _get(path: str, kind: str = "string") -> Column:
    """A field: as one dotted key, else as a nested path. An empty string is missing."""
    quoted = '$["' + path + '"]'
    value = F.try_variant_get("doc", quoted, kind)
    if "." in path:
        value = F.coalesce(value, F.try_variant_get("doc", "$" + "".join(f'["{p}"]' for p in path.split(".")), kind))
    return F.nullif(value, F.lit("")) if kind == "string" else value


def _first(paths: tuple[str, ...], kind: str = "string") -> Column:
    return F.coalesce(*[_get(p, kind) for p in paths])


def family_of() -> Column:
    """The family of a document: by its type, else by the folder /data/<name>/ of its log path, else the fallback."""
    kinds = {n: f.type for f in FAMILIES for n in (f.type, *f.aliases)}
    by_type = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    by_folder = F.create_map(*[F.lit(x) for f in FAMILIES for x in (f.type.lower(), f.type)])
    parts = F.split(F.lower(_get("path")), "/")
    folder = F.when(F.get(parts, 1) == "data", F.get(parts, 2))
    return F.coalesce(F.try_element_at(by_type, _get("type")), F.try_element_at(by_folder, folder), F.lit(FALLBACK))


def _per_family(column: str) -> Column:
    """The column by each family's own table, missing where a family has none."""
    cases = [(f.type, f.fields[column]) for f in FAMILIES if column in f.fields]
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, paths in cases:
        groups.setdefault(paths, []).append(name)
    out = None
    for paths, names in groups.items():
        cond = F.col("family").isin(names)
        out = F.when(cond, _first(paths)) if out is None else out.when(cond, _first(paths))
    return out


def normalise(docs: DataFrame) -> DataFrame:
    """Events of documents (a VARIANT column doc). Documents without time or, but for the fallback, address go; so do flow
    records without an alert."""
    rows = docs.withColumn("family", family_of())
    v = {c: _per_family(c) for c in _STRINGS}
    port = _first(("dest_port", "dst_port"), "int")
    default_port = reduce(lambda e, f: e.when(F.col("family") == f.type, f.port), [f for f in FAMILIES if f.port][1:], F.when(F.col("family") == [f for f in FAMILIES if f.port][0].type, [f for f in FAMILIES if f.port][0].port))
    fixed = [f for f in FAMILIES if f.protocol]
    protocol = reduce(lambda e, f: e.when(F.col("family") == f.type, f.protocol), fixed[1:], F.when(F.col("family") == fixed[0].type, fixed[0].protocol))
    geo = lambda *names, kind="string": F.coalesce(*[_get(f"{g}.{n}", kind) for n in names for g in ("geoip", "src_geoip")])
    out = rows.select(
        "doc",
        "family",
        _get("type").alias("type"),
        F.try_to_timestamp(_first(("@timestamp", "timestamp"))).alias("ts"),
        F.trim(F.split_part(_get("src_ip"), F.lit(","), F.lit(1))).alias("raw_ip"),
        _get("src_port", "int").alias("src_port"),
        _first(("dest_ip", "dst_ip")).alias("dst_ip"),
        F.coalesce(port, default_port).alias("dst_port"),
        F.coalesce(_get("t-pot_hostname"), F.try_variant_get("doc", "$.host.name", "string"), F.lit("unknown")).alias("sensor"),
        F.upper(geo("country_code2", "country_iso_code", "country_code")).alias("country"),
        geo("country_name").alias("country_name"),
        geo("city_name", "city").alias("city"),
        geo("asn", kind="int").alias("asn"),
        geo("as_org", "organization").alias("as_org"),
        F.lower(_get("ip_rep")).alias("reputation"),
        *[e.alias(c if c != "protocol" else "own_protocol") for c, e in v.items()],
        F.coalesce(protocol, _first(("protocol", "proto", "app_proto"))).alias("said_protocol"),
        F.try_variant_get("doc", "$.alert", "variant").isNotNull().alias("has_alert"),
    )
    ssh = F.when(F.col("family") == "Cowrie", F.when(F.coalesce(F.col("dst_port"), F.lit(22)).isin(22, 2222), "ssh").otherwise("telnet"))
    out = out.withColumn("protocol", F.lower(F.coalesce(ssh, "own_protocol", "said_protocol"))).drop("own_protocol", "said_protocol")
    out = out.withColumn("protocol", F.when(F.col("family") == "ConPot", F.coalesce(F.try_element_at(F.create_map(*map(F.lit, sum(INDUSTRIAL_NAMES.items(), ()))), F.col("protocol")), "protocol")).otherwise(F.col("protocol")))
    out = out.withColumn("src_ip", canonical_ip(F.col("raw_ip")))
    out = out.withColumn("login_ok", F.coalesce(F.col("event").isin("cowrie.login.success"), F.lit(False)))
    sha = F.lower("sha256")
    out = out.withColumn("sha256", F.when(sha.rlike("^[0-9a-f]{64}$"), sha))
    out = out.withColumn("cves", F.coalesce(text.cve_ids(F.col("signature")), F.array().cast("array<string>")))
    out = out.withColumn("keys", F.coalesce(text.planted_keys(F.col("command")), F.array().cast("array<struct<type:string,key:string,fingerprint:string>>")))
    printable = F.regexp_replace(F.decode(F.try_to_binary(F.col("payload_hex"), F.lit("hex")), "ISO-8859-1"), r"[^\x20-\x7e]", ".")
    out = out.withColumn("payload", F.coalesce("payload", printable))
    out = out.withColumn("international", F.coalesce(F.regexp_replace("called", r"[^0-9+]", "").rlike(r"^(?:\+|00|011)[1-9][0-9]{6,14}$"), F.lit(False)))
    keep = F.col("ts").isNotNull() & (F.col("raw_ip").isNotNull() | (F.col("family") == FALLBACK)) & ((F.col("family") != "Suricata") | F.col("has_alert"))
    return out.where(keep).drop("has_alert")


def signals(events: DataFrame) -> DataFrame:
    """events with what only some families tell, read from doc: requests (mail verbs, industrial requests), mail_bytes, ntlm,
    the URL and host that a request named, credentials in a body, industrial findings, and jndi (see jndi_events).

    A missing field leaves its column missing or its list empty.
    """
    family = F.col("family")
    of = lambda name, value: F.when(family == name, value)
    is_text = lambda v: F.schema_of_variant(v) == "STRING"
    said = F.try_variant_get("doc", "$.commands", "variant")
    each = F.coalesce(F.try_variant_get("doc", "$.commands", "array<variant>"), F.array(said))
    lines = F.transform(F.filter(each, is_text), lambda v: F.try_variant_get(v, "$", "string"))
    verbs = F.filter(F.transform(lines, web.mail_verb), lambda v: v != "")
    host, path = F.col("host_header"), F.coalesce("path", F.lit(""))
    scheme = F.when(F.col("dst_port").isin(443, 8443), "https://").otherwise("http://")
    named = F.when(host.isNotNull() & (path != ""), F.concat(scheme, host, F.when(path.startswith("/"), "").otherwise("/"), path)).when(path.rlike("^https?://"), path)
    bare_host = F.split_part(host, F.lit(":"), F.lit(1))
    response = F.trim(_get("nt_response"))
    capture = F.struct(
        response.alias("response"), F.nullif(F.regexp_extract(_get("message"), r"hashcat:\s*'([^']+)'", 1), F.lit("")).alias("line"),
        ports.ntlm_target_name(of("RDPHoneypot", response)).alias("target"), F.trim("username").alias("username"),
        F.coalesce(F.nullif(F.trim(_get("domain")), F.lit("")), F.nullif(F.trim(_get("derived_domain")), F.lit(""))).alias("domain"), F.coalesce(F.trim(_get("auth_method")), F.lit("unknown")).alias("method"),
    )
    out = events if "jndi" in events.columns else jndi_events(events)
    return out.withColumns({
        "requests": of("Mailoney", verbs).when(family == "ConPot", F.array_compact(F.array("body"))),
        "mail_bytes": of("Mailoney", F.length(_get("data"))),
        "ntlm": of("RDPHoneypot", F.when(F.length(response) > 0, capture)),
        "request_url": of("H0neytr4p", named),
        "request_host": of("H0neytr4p", F.when(F.contains(bare_host, F.lit(".")) & ~bare_host.rlike("^[0-9.]+$"), bare_host)),
        "body_credentials": of("Galah", web.body_credentials(F.col("body"), F.col("method"))),
        "finding": of("ConPot", ics.ics_finding(F.col("protocol"), F.col("body"))),
    })


def jndi_events(events: DataFrame) -> DataFrame:
    """events with jndi: look-up payloads in the address, path, body, agent, host header, and each top-level string of doc."""
    named = F.array("raw_ip", "path", "body", "user_agent", "host_header")
    top = F.map_values(F.expr("try_variant_get(doc, '$', 'map<string, variant>')"))
    strings = F.transform(F.filter(top, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    texts = F.array_distinct(F.concat(named, F.coalesce(strings, F.array().cast("array<string>"))))
    return events.withColumn("jndi", text.jndi_payloads_each(texts))


def addressed(events: DataFrame) -> DataFrame:
    """Events whose source is an address."""
    return events.where(F.col("src_ip").isNotNull() & (is_ipv4(F.col("src_ip")) | F.contains("src_ip", F.lit(":"))))
