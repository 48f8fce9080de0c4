"""Services behind ports, shapes of scans and fingerprints of payloads."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Port, service name, service family.
PORTS = {
    21: ("FTP", "ftp"),
    22: ("SSH", "ssh"),
    23: ("Telnet", "telnet"),
    25: ("SMTP", "smtp"),
    53: ("DNS", "dns"),
    80: ("HTTP", "http"),
    81: ("HTTP-alt", "http"),
    88: ("Kerberos", "kerberos"),
    110: ("POP3", "pop3"),
    111: ("RPCbind", "rpc"),
    135: ("MSRPC", "msrpc"),
    137: ("NetBIOS", "netbios"),
    139: ("NetBIOS-SSN", "smb"),
    143: ("IMAP", "imap"),
    161: ("SNMP", "snmp"),
    389: ("LDAP", "ldap"),
    443: ("HTTPS", "https"),
    445: ("SMB", "smb"),
    465: ("SMTPS", "smtp"),
    512: ("rexec", "r-services"),
    513: ("rlogin", "r-services"),
    514: ("rsh/syslog", "r-services"),
    587: ("SMTP-submission", "smtp"),
    623: ("IPMI", "ipmi"),
    631: ("IPP/CUPS", "ipp"),
    993: ("IMAPS", "imap"),
    995: ("POP3S", "pop3"),
    1025: ("MS-RPC-alt", "msrpc"),
    1080: ("SOCKS", "proxy"),
    1099: ("Java-RMI", "rmi"),
    1433: ("MS-SQL", "mssql"),
    1521: ("Oracle-DB", "oracle"),
    1723: ("PPTP", "vpn"),
    1883: ("MQTT", "mqtt"),
    2049: ("NFS", "nfs"),
    2082: ("cPanel", "cpanel"),
    2083: ("cPanel-SSL", "cpanel"),
    2086: ("WHM", "cpanel"),
    2087: ("WHM-SSL", "cpanel"),
    2095: ("cPanel-webmail", "cpanel"),
    2096: ("cPanel-webmail-SSL", "cpanel"),
    2222: ("SSH-alt", "ssh"),
    2323: ("Telnet-alt", "telnet"),
    2375: ("Docker-API", "docker"),
    2376: ("Docker-API-TLS", "docker"),
    2379: ("etcd", "etcd"),
    3000: ("HTTP-dev/Grafana", "http"),
    3128: ("Squid-proxy", "proxy"),
    3306: ("MySQL", "mysql"),
    3389: ("RDP", "rdp"),
    3690: ("SVN", "svn"),
    4444: ("Metasploit/CobaltStrike", "c2"),
    5000: ("HTTP-UPnP/Docker-registry", "http"),
    5432: ("PostgreSQL", "postgres"),
    5555: ("ADB/Android", "adb"),
    5601: ("Kibana", "kibana"),
    5672: ("AMQP/RabbitMQ", "amqp"),
    5900: ("VNC", "vnc"),
    5901: ("VNC-1", "vnc"),
    5984: ("CouchDB", "couchdb"),
    6000: ("X11", "x11"),
    6379: ("Redis", "redis"),
    6443: ("Kubernetes-API", "kubernetes"),
    7001: ("WebLogic", "weblogic"),
    8000: ("HTTP-alt", "http"),
    8008: ("HTTP-alt", "http"),
    8009: ("AJP", "ajp"),
    8080: ("HTTP-proxy/alt", "http"),
    8081: ("HTTP-alt", "http"),
    8086: ("InfluxDB", "influxdb"),
    8088: ("HTTP-alt/Hadoop", "http"),
    8443: ("HTTPS-alt", "https"),
    8888: ("HTTP-alt", "http"),
    9000: ("HTTP-alt/SonarQube", "http"),
    9001: ("Tor/Supervisor", "http"),
    9042: ("Cassandra", "cassandra"),
    9092: ("Kafka", "kafka"),
    9200: ("Elasticsearch", "elasticsearch"),
    9300: ("Elasticsearch-transport", "elasticsearch"),
    10000: ("Webmin", "webmin"),
    11211: ("Memcached", "memcached"),
    27017: ("MongoDB", "mongodb"),
    50070: ("Hadoop-HDFS", "hadoop"),
}

# Substrings of payloads and first bytes of them in hex, with their labels; the first that fits counts.
PAYLOAD_SIGNS = [
    ("zgrab", "scanner:zgrab"),
    ("masscan", "scanner:masscan"),
    ("nmap", "scanner:nmap"),
    ("l9scan", "scanner:leakix"),
    ("netsystemsresearch", "scanner:netsystems"),
    ("censys", "scanner:censys"),
    ("paloaltonetworks", "scanner:paloalto"),
    ("internet-measurement", "scanner:driftnet"),
    ("/shell?cd+/tmp", "botnet:mirai"),
    ("busybox", "botnet:mirai"),
    ("tr-064", "exploit:tr064"),
    ("soap:body", "exploit:soap"),
    ("${jndi:", "exploit:log4shell"),
    ("/cgi-bin/", "exploit:cgi"),
    ("hello", "probe:hello"),
]
HEX_SIGNS = [("160301", "proto:tls"), ("160302", "proto:tls"), ("160303", "proto:tls"), ("5353482d", "proto:ssh"), ("0000", "proto:smb-or-null")]
_REQUEST = r"(?i)^(GET|POST|HEAD|PUT|DELETE|OPTIONS|CONNECT|TRACE|PATCH)\s+(\S+)\s+HTTP/"


def _lookup(k: int) -> Column:
    return F.create_map(*[F.lit(x) for p, v in PORTS.items() for x in (p, v[k])])


def service(port: Column) -> Column:
    return F.try_element_at(_lookup(0), port)


def service_family(port: Column) -> Column:
    return F.try_element_at(_lookup(1), port)


def port_summary(ports: Column, most: int = 12) -> Column:
    """Distinct ports in order with their services, the first `most` of them and how many more."""
    clean = F.array_sort(F.array_distinct(F.array_compact(ports)))
    names = _lookup(0)
    one = lambda p: F.concat(F.lit("tcp/"), p.cast("string"), F.coalesce(F.concat(F.lit(" ("), F.try_element_at(names, p), F.lit(")")), F.lit("")))
    more = F.when(F.size(clean) > most, F.concat(F.lit(", … +"), (F.size(clean) - most).cast("string"), F.lit(" more"))).otherwise("")
    return F.concat(F.array_join(F.transform(F.slice(clean, 1, most), one), ", "), more)


def scan_labels(ports: Column) -> Column:
    """Shape of a scan, the families it went for, and recon:broad from four families on."""
    clean = F.array_distinct(F.array_compact(ports))
    names = _lookup(1)
    families = F.array_sort(F.array_distinct(F.array_compact(F.transform(clean, lambda p: F.try_element_at(names, p)))))
    n = F.size(clean)
    shape = F.when(n == 1, "scan:single").when(n.between(2, 5), "scan:multi-port").when(n > 5, "scan:vertical")
    return F.array_compact(F.concat(F.array(shape), F.transform(families, lambda f: F.concat(F.lit("target:"), f)), F.array(F.when(F.size(families) >= 4, "recon:broad"))))


def payload_label(printable: Column, hex_text: Column) -> Column:
    """Label of a payload: a sign in its text, else that it is an HTTP request, else its first bytes; missing if unknown."""
    low, raw = F.lower(F.trim(printable)), F.lower(F.trim(hex_text))
    rule = F
    for needle, label in PAYLOAD_SIGNS:
        rule = rule.when(F.contains(low, F.lit(needle)), label)
    rule = rule.when(F.trim(printable).rlike(_REQUEST), "proto:http")
    for prefix, label in HEX_SIGNS:
        rule = rule.when(raw.startswith(prefix), label)
    return rule


def http_request(printable: Column) -> Column:
    """struct<method, path> of an HTTP request line, missing where there is none."""
    t = F.trim(printable)
    return F.when(t.rlike(_REQUEST), F.struct(F.upper(F.regexp_extract(t, _REQUEST, 1)).alias("method"), F.left(F.regexp_extract(t, _REQUEST, 2), F.lit(200)).alias("path")))


def span_text(seconds: Column) -> Column:
    """A length of time in its two largest units."""
    two = lambda a, u, b, v: F.concat(a.cast("string"), F.lit(u), F.lpad(b.cast("string"), 2, "0"), F.lit(v))
    s = seconds.cast("long")
    div = lambda n: F.floor(s / n)
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.concat(div(60).cast("string"), F.lit("m")))
        .when(s < 86400, two(div(3600), "h", F.floor(s % 3600 / 60), "m"))
        .otherwise(two(div(86400), "d", F.floor(s % 86400 / 3600), "h"))
    )


def plausible_username(name: Column) -> Column:
    """Printable ASCII of at most 64 signs that isn't the spelling of a byte string."""
    return F.coalesce(name.rlike("^[ -~]{1,64}$") & ~name.rlike("^b['\"]"), F.lit(False))


def ntlm_target(response: str | None) -> str | None:
    """The target name (pair 9) in the attribute list of an NTLMv2 response in hex; nothing if it doesn't parse."""
    try:
        raw = bytes.fromhex(response or "")
        at = 44  # after the proof and the fixed part of the blob
        while True:
            kind, n = struct.unpack_from("<HH", raw, at)
            if kind == 0:
                return None
            if kind == 9:
                return raw[at + 4 : at + 4 + n].decode("utf-16le").rstrip("\0")
            at += 4 + n
    except (ValueError, struct.error):
        return None


@F.pandas_udf(returnType=T.StringType())
def _ntlm(response: pd.Series) -> pd.Series:
    return response.map(ntlm_target)


def ntlm_target_name(response: Column) -> Column:
    return F.when(response.isNotNull(), _ntlm(response))
