"""Content-addressed ids: version-5 UUIDs under the DNS namespace, from built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 9562.
_NS_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(seed: Column) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(_NS_DNS)), seed.cast("binary")))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def object_id(kind: str, *seed: Column | str) -> Column:
    """<kind>--<uuid5 of the seed parts joined by colons>; strings are literal parts."""
    parts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in seed]
    return F.concat(F.lit(f"{kind}--"), uuid5(F.concat_ws(":", *parts)))


def identity_id(name: Column, kind: str) -> Column:
    return object_id("identity", "identity", kind, F.lower(name))


def sensor_id(host: Column) -> Column:
    return object_id("identity", "identity", "sensor", host)


def ipv4_id(ip: Column) -> Column:
    return object_id("ipv4-addr", "ipv4-addr", ip)


def ipv6_id(ip: Column) -> Column:
    return object_id("ipv6-addr", "ipv6-addr", ip)


def address_id(ip: Column) -> Column:
    return F.when(F.contains(ip, F.lit(":")), ipv6_id(ip)).otherwise(ipv4_id(ip))


def file_id(sha256: Column) -> Column:
    return object_id("file", "stixfile", "sha256", F.lower(sha256))


def url_id(url: Column) -> Column:
    return object_id("url", "url", url)


def domain_id(name: Column) -> Column:
    return object_id("domain-name", "domain-name", F.lower(name))


def process_id(command_line: Column) -> Column:
    return object_id("process", "process", command_line)


def key_id(value: Column) -> Column:
    return object_id("cryptographic-key", "cryptographic-key", value)


def autonomous_system_id(asn: Column) -> Column:
    return object_id("autonomous-system", "autonomous-system", asn)


def country_id(code: Column) -> Column:
    return object_id("location", "location", "country", F.upper(code))


def city_id(code: Column, city: Column) -> Column:
    return object_id("location", "location", "city", F.upper(code), F.lower(city))


def session_note_id(sensor: Column, session: Column) -> Column:
    return object_id("note", "note", "session", sensor, session)


def profile_note_id(ip: Column) -> Column:
    return object_id("note", "note", "attacker-profile", ip)


def credential_note_id(ip: Column) -> Column:
    return object_id("note", "note", "credentials", ip)


def daily_note_id(ip: Column, day: Column) -> Column:
    return object_id("note", "note", "attacker-daily", ip, day)


def weekly_note_id(ip: Column, year: Column, week: Column) -> Column:
    return object_id("note", "note", "attacker-weekly", ip, year, week)


def technique_id(name: Column) -> Column:
    return object_id("attack-pattern", "attack-pattern", name)


def ip_indicator_id(ip: Column) -> Column:
    return object_id("indicator", "indicator", "ip", ip)


def file_indicator_id(sha256: Column) -> Column:
    return object_id("indicator", "indicator", "file", "sha256", F.lower(sha256))


def campaign_id(key: Column) -> Column:
    return object_id("campaign", "campaign", key)


def malware_id(family: Column) -> Column:
    return object_id("malware", "malware", "family", F.regexp_replace(F.trim(F.lower(family)), r"\s+", "-"))


def vulnerability_id(cve: Column) -> Column:
    return object_id("vulnerability", "vulnerability", F.upper(cve))


def infrastructure_id(name: Column) -> Column:
    return object_id("infrastructure", "infrastructure", F.lower(name))


def relationship_id(source: Column, target: Column, kind: Column) -> Column:
    return object_id("relationship", source, target, kind)


def sighting_id(sensor: Column, target: Column, extra: Column | None = None) -> Column:
    return object_id("sighting", "sighting", sensor, target, *([] if extra is None else [extra]))
