"""Addresses and networks. IPv4 stays in built-in expressions; IPv6 spelling goes through one Arrow UDF, behind a filter."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"

# Networks that are private, shared, link-local, reserved, multicast or unspecified.
INTERNAL_V4 = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
    "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
]


def is_ipv4(text: Column) -> Column:
    return F.coalesce(text.rlike(IPV4), F.lit(False))


def ipv4_number(text: Column) -> Column:
    """The 32-bit number of a dotted address; missing for anything else."""
    p = lambda k: F.split_part(text, F.lit("."), F.lit(k)).cast("long")
    return F.when(is_ipv4(text), ((p(1) * 256 + p(2)) * 256 + p(3)) * 256 + p(4))


def cidr_bounds(cidr: str) -> tuple[int, int]:
    net = ipaddress.ip_network(cidr, strict=False)
    return int(net.network_address), int(net.broadcast_address)


@F.pandas_udf(returnType=T.StringType())
def _canonical(text: pd.Series) -> pd.Series:
    def one(x):
        try:
            a = ipaddress.ip_address(x.strip())
        except (ValueError, AttributeError):
            return None
        return str(a.ipv4_mapped or a) if a.version == 6 else str(a)

    return text.map(one)


def canonical_ip(text: Column) -> Column:
    """Canonical spelling; IPv4 mapped into IPv6 becomes IPv4; missing where it is no address."""
    plain = F.trim(text)
    return F.when(is_ipv4(plain), plain).when(F.contains(plain, F.lit(":")), _canonical(F.when(F.contains(plain, F.lit(":")), plain)))


def is_internal(text: Column, networks: list[str] = INTERNAL_V4) -> Column:
    """Whether an IPv4 address lies in one of the networks."""
    n = ipv4_number(text)
    inside = F.lit(False)
    for lo, hi in map(cidr_bounds, networks):
        inside = inside | n.between(lo, hi)
    return F.coalesce(inside, F.lit(False))


def network_table(nets: DataFrame, cidr: str = "cidr") -> DataFrame:
    """IPv4 networks as bounds lo and hi, host bits cleared; rows that are no network go."""
    base, bits = F.split_part(F.col(cidr), F.lit("/"), F.lit(1)), F.split_part(F.col(cidr), F.lit("/"), F.lit(2))
    length = F.when(bits == "", 32).otherwise(bits.try_cast("int"))
    size = F.expr("1L").cast("long") * F.pow(F.lit(2), 32 - F.col("__len")).cast("long")
    out = nets.withColumns({"__len": length, "__n": ipv4_number(base)}).where("__n is not null and __len between 0 and 32")
    out = out.withColumn("__size", size).withColumn("lo", F.col("__n") - F.col("__n") % F.col("__size"))
    return out.withColumn("hi", F.col("lo") + F.col("__size") - 1).drop("__len", "__n", "__size")


def hostname_suffix(name: Column, suffix: Column) -> Column:
    """Whether a host name is a domain or lies under it, on a label boundary."""
    return (name == suffix) | name.endswith(F.concat(F.lit("."), suffix))
