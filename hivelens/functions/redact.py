"""Hiding of own hosts and addresses in outgoing text, and ceilings of scores."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hivelens.functions.network import cidr_bounds, ipv4_number


def hmac_sha256(message: Column, key: bytes) -> Column:
    """HMAC-SHA256 in hex from two built-in digests over padded keys."""
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pad = lambda x: F.lit(bytearray(b ^ x for b in block))
    inner = F.sha2(F.concat(pad(0x36), message.cast("binary")), 256)
    return F.sha2(F.concat(pad(0x5C), F.unhex(inner)), 256)


def pseudonym(host: Column, key: bytes) -> Column:
    return F.left(hmac_sha256(F.lower(host), key), F.lit(8))


def redact_text(text: Column, hosts: list[str], addresses: list[str], mark: str = "[redacted]") -> Column:
    """Text without the named hosts and addresses, whatever their case; longer names first."""
    names = sorted({*hosts, *addresses}, key=lambda x: (-len(x), x))
    if not names:
        return text
    return F.regexp_replace(text, "(?i)(?<![A-Za-z0-9.-])(?:" + "|".join(map(re.escape, names)) + ")(?![A-Za-z0-9-])", mark)


def capped_score(score: Column, ip: Column, labels: Column, edge_networks: list[str], ceiling: int = 25) -> Column:
    """Scores of edge networks and known scanners are at most the ceiling."""
    n = ipv4_number(ip)
    edge = F.lit(False)
    for lo, hi in map(cidr_bounds, edge_networks):
        edge = edge | n.between(lo, hi)
    scanner = F.exists(labels, lambda x: x.startswith("scanner:"))
    return F.when(F.coalesce(edge, F.lit(False)) | F.coalesce(scanner, F.lit(False)), F.least(score, F.lit(ceiling))).otherwise(score)
