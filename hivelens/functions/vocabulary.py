"""Labels, names and ids that come from fixed tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type of a sensor family's documents, its label, the label of its protocols, and the name of an indicator
# that it gave rise to, with the word that counts what was seen.
FAMILIES = {
    "Cowrie": ("cowrie", "ssh-telnet", "Cowrie SSH/Telnet Attack", "session"),
    "Suricata": ("suricata", "network-ids", "Suricata Alert", "alert"),
    "Honeytrap": ("honeytrap", "tcp-catchall", "Honeytrap Probe", "probe"),
    "Dionaea": ("dionaea", "malware-capture", "Dionaea Malware Drop", "drop"),
    "Heralding": ("heralding", "credential-capture", "Heralding Credential Attack", "session"),
    "Mailoney": ("mailoney", "smtp", "Mailoney SMTP Abuse", "session"),
    "ConPot": ("conpot", "ics-scada", "ConPot ICS Probe", "probe"),
    "Dicompot": ("dicompot", "dicom-medical", "Dicompot DICOM Probe", "probe"),
    "Medpot": ("medpot", "hl7-medical", "Medpot HL7 Probe", "probe"),
    "ElasticPot": ("elasticpot", "elasticsearch", "ElasticPot ES API Abuse", "session"),
    "Redishoneypot": ("redishoneypot", "redis", "RedisHoneypot Probe", "session"),
    "Ciscoasa": ("ciscoasa", "cisco-asa", "CiscoASA Probe", "probe"),
    "Adbhoney": ("adbhoney", "android-adb", "ADBhoney Android Debug Bridge Abuse", "session"),
    "Ipphoney": ("ipphoney", "ipp-printer", "IppHoney Printer Probe", "probe"),
    "Miniprint": ("miniprint", "printer", "Miniprint Printer Probe", "probe"),
    "Tanner": ("tanner", "web-app", "Tanner Web Attack", "session"),
    "Wordpot": ("wordpot", "wordpress", "Wordpot WordPress Probe", "probe"),
    "Sentrypeer": ("sentrypeer", "sip-voip", "SentryPeer SIP/VoIP Abuse", "session"),
    "Fatt": ("fatt", "tls-fingerprint", "FATT Fingerprint Observation", "burst"),
    "NGINX": ("nginx", "web", "NGINX Web Probe", "session"),
    "Honeyaml": ("honeyaml", "iac-config", "Honeyaml IaC Config Probe", "probe"),
    "Router": ("router", "telnet", "Router Telnet Abuse", "session"),
    "H0neytr4p": ("h0neytr4p", "web-app", "H0neytr4p Web Probe", "probe"),
    "Beelzebub": ("beelzebub", "ssh-llm", "Beelzebub LLM SSH Session", "session"),
    "Galah": ("galah", "web-llm", "Galah LLM Web Probe", "probe"),
    "RDPHoneypot": ("rdphoneypot", "remote-desktop", "RDP NTLM Credential Capture", "session"),
    "__fallback__": ("fallback", "unknown-type", "Honeypot Activity (unknown type)", "event"),
}
# Ids of the traffic-light markings.
MARKINGS = {
    "white": "marking-definition--613f2e26-407d-48c7-9eca-b8e91df99dc9",
    "clear": "marking-definition--94868c89-83c2-464b-929b-a1a8aa3c8487",
    "green": "marking-definition--34098fce-860f-48ae-8e50-ebd3cc5e41da",
    "amber": "marking-definition--f88d31f6-486f-44da-b317-01333bde0b82",
    "amber+strict": "marking-definition--826578e1-40ad-459f-bc73-ede076f81f37",
    "red": "marking-definition--5e57c739-391a-4eb3-b6be-7d15ca92d5ed",
}
# Signs of two exploits in the body of a search request, in order.
SEARCH_EXPLOITS = {
    "CVE-2014-3120": r"(?is)" + r'"script"\s*:.*?' + r'(?:java\.lang\.Runtime|getRuntime\s*\(\s*\)|Runtime\.getRuntime|exec\s*\(|"lang"\s*:\s*"groovy")',
    "CVE-2015-1427": r"(?is)" + r'"template"\s*:\s*\{.*?(?:"inline"|"file"|"id").*?' + r'(?:Math\.class\.forName|java\.lang|getRuntime|"lang"\s*:\s*"groovy")',
}
#: Positive verdicts of scanners from which a sample is surely malicious.
SURE_VERDICTS = 10


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*map(F.lit, chain(*table.items()))), key)


def family_labels(kind: Column, sensor: Column | None = None) -> Column:
    """Labels of a document type: honeypot, family, protocols, and the sensor if given. Unknown types stand for themselves."""
    known = [_looked_up({k: v[j] for k, v in FAMILIES.items()}, kind) for j in (0, 1)]
    named = F.when(F.coalesce(kind, F.lit("")) != "", F.coalesce(known[0], F.lower(kind)))
    place = F.lit(None) if sensor is None else F.when(F.coalesce(sensor, F.lit("")) != "", F.concat(F.lit("sensor:"), sensor))
    return F.array_compact(F.array(F.lit("honeypot"), named, known[1], place))


def indicator_name(kind: Column, ip: Column, n: Column) -> Column:
    """Name of an address's indicator, with how often it was seen."""
    title, unit = (_looked_up({k: v[j] for k, v in FAMILIES.items()}, kind) for j in (2, 3))
    counted = F.concat(F.coalesce(unit, F.lit("event")), F.when(n == 1, "").otherwise("s"))
    return F.concat(F.coalesce(title, F.lit("Honeypot Attacker")), F.lit(" - "), ip, F.lit(" ("), n.cast("string"), F.lit(" "), counted, F.lit(")"))


def marking_id(level: Column) -> Column:
    """Id of a traffic-light level, in any case and with or without a tlp prefix; missing for others."""
    return _looked_up(MARKINGS, F.regexp_replace(F.lower(F.trim(level)), "^(tlp:)?(tlp-)?", ""))


def search_exploit(body: Column) -> Column:
    """The first exploit whose signs a search request's body shows."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(SEARCH_EXPLOITS.items()):
        out = F.when(F.regexp_like(body, F.lit(pattern)), name).otherwise(out)
    return out


def sample_labels(sectors: Column, file_type: Column, verdicts: Column) -> Column:
    """Labels of a captured sample, sorted: sectors but the general one, file type, and whether scanners are sure."""
    named = F.transform(F.filter(F.coalesce(sectors, F.array().cast("array<string>")), lambda s: s.isNotNull() & (s != "") & (s != "general")), lambda s: F.concat(F.lit("sector:"), s))
    kind = F.lower(F.trim(F.coalesce(file_type, F.lit(""))))
    rest = F.array_compact(F.array(F.lit("malware-sample"), F.lit("source:malware-collector"), F.when(kind != "", F.concat(F.lit("filetype:"), kind)), F.when(F.coalesce(verdicts, F.lit(0)) >= SURE_VERDICTS, "confidence:high")))
    return F.array_sort(F.array_distinct(F.concat(rest, named)))


def iso_seconds(duration: Column, default: float = 900.0) -> Column:
    """Seconds of a duration PT..H..M..S; the default where it is none or not over zero."""
    text = F.trim(F.coalesce(duration, F.lit("")))
    number = r"(\d+(?:\.\d+)?)"
    shape = rf"^PT(?:{number}H)?(?:{number}M)?(?:{number}S)?$"
    part = lambda k: F.coalesce(F.regexp_extract(text, shape, k).try_cast("double"), F.lit(0.0))
    total = part(1) * 3600 + part(2) * 60 + part(3)
    return F.when(F.regexp_like(text, F.lit(shape)) & (total > 0), total).otherwise(default)
