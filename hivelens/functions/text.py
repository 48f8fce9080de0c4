"""Validators and extractors over text."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hivelens.functions.network import is_ipv4

_DOMAIN = r"^(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,63}$"
_KEY = r"((?:ssh-(?:rsa|ed25519|dss)|ecdsa-sha2-nistp(?:256|384|521)) [A-Za-z0-9+/]{20,}={0,3})"
SCHEMES = ("http", "https", "ftp", "ftps", "tftp", "ldap", "ldaps", "rmi", "dns")


def valid_domain(name: Column) -> Column:
    """Whether a name has the shape of a domain, at most 253 characters, and is no IPv4 address."""
    return F.coalesce(name.rlike(_DOMAIN) & (F.length(name) <= 253) & ~is_ipv4(name), F.lit(False))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:]*)", 1))


def valid_url(url: Column) -> Column:
    """Whether a URL has a known scheme, a host that is a domain or an address, a port that can be one, and no blanks."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    port = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:\[]*):([^/?#]*)", 1)
    host = url_host(url)
    port_ok = (port == "") | (port.rlike("^[0-9]{1,5}$") & (F.coalesce(port.try_cast("int"), F.lit(99999)) <= 65535))
    ok = scheme.isin(*SCHEMES) & (valid_domain(host) | is_ipv4(host) | host.startswith("[")) & port_ok & ~url.rlike(r"[\s\x00-\x1f]")
    return F.coalesce(ok, F.lit(False))


def cve_ids(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)CVE-\d{4}-\d{4,7}"), F.lit(0)), lambda x: F.upper(x))))


def technique_list(values: Column) -> Column:
    """Technique ids of an array that have the right form, each once, in order."""
    return F.array_distinct(F.filter(values, lambda x: x.rlike(r"^T\d{4}(\.\d{3})?$")))


def planted_keys(command: Column) -> Column:
    """SSH public keys in a command with the SHA-256 of type and blob, each once."""
    keys = F.array_distinct(F.regexp_extract_all(command, F.lit(_KEY), F.lit(1)))
    return F.transform(keys, lambda k: F.struct(F.split_part(k, F.lit(" "), F.lit(1)).alias("type"), k.alias("key"), F.sha2(k.cast("binary"), 256).alias("fingerprint")))


def process_line(commands: Column, most: int = 50) -> Column:
    """A transcript of the first `most` commands, names of temporary files made alike, and a mark of the rest."""
    shown = F.transform(F.slice(commands, 1, most), lambda c: F.regexp_replace(c, r"(/tmp|/var/tmp|/dev/shm|/run/shm)/[A-Za-z0-9._-]{5,}", "$1/<tmpfile>"))
    rest = F.slice(commands, most + 1, 2**31 - most - 2)
    mark = F.when(F.size(commands) > most, F.concat(F.lit("\n... +"), (F.size(commands) - most).cast("string"), F.lit(" "), F.left(F.sha2(F.array_join(rest, "\n").cast("binary"), 256), F.lit(16))))
    return F.concat(F.array_join(shown, "\n"), F.coalesce(mark, F.lit("")))


_RECON = r"^\s*(?:uname|whoami|id|w|who|uptime|hostname|ifconfig|ip a|cat /proc/|lscpu|free|df|ls|pwd|ps|nproc|lspci|echo)\b"
_FETCH = r"(?i)\b(?:wget|curl|tftp|ftpget|scp)\b"
_MEATY = r"(?i)(?:chmod|rm -rf|crontab|authorized_keys|base64 -d|nohup|/dev/tcp|mkfifo|useradd|passwd|iptables|>\s*/|\./)"


def recon_only(commands: Column) -> Column:
    """Whether all commands only look around."""
    return (F.size(commands) > 0) & F.forall(commands, lambda c: ~c.rlike(_FETCH) & ~c.rlike(_MEATY) & c.rlike(_RECON))


# Family names that say nothing.
GENERIC_FAMILIES = ("agent", "generic", "trojan", "malware", "linux", "win32", "unix", "variant", "application", "backdoor", "heuristic")


def malware_family(raw: Column) -> Column:
    """The last part of a detection name if it can be a family: 4 or more letters, fewer than 2 digits, not generic."""
    last = F.lower(F.element_at(F.split(F.trim(raw), r"[./:\\]"), -1))
    ok = last.rlike("^[a-z][a-z0-9_-]{3,}$") & ~last.isin(*GENERIC_FAMILIES) & (F.length(F.regexp_replace(last, "[^0-9]", "")) < 2)
    return F.when(ok, last)


_INNER = re.compile(r"\$\{([^${}]*)\}")
_LOOKUPS = 40


def plain_lookups(text: str) -> str:
    """Resolves nested ${...} look-ups from the inside out: defaults (:-) and lower: and upper:; others stay."""
    text = text[:16_384]
    kept: list[str] = []
    for _ in range(_LOOKUPS):

        def one(m: re.Match) -> str:
            body = m.group(1)
            kind, colon, rest = body.partition(":")
            if colon and kind.strip().lower() in ("lower", "upper"):
                return rest.lower() if kind.strip().lower() == "lower" else rest.upper()
            if ":-" in body:
                return body.split(":-", 1)[1]
            kept.append(body)
            return f"\0{len(kept) - 1}\1"

        new = _INNER.sub(one, text)
        if new == text:
            break
        text = new
    while "\0" in text:
        text = re.sub("\0(\\d+)\1", lambda m: "${" + kept[int(m.group(1))] + "}", text)
    return text


_JNDI = re.compile(r"\$\{\s*jndi\s*:\s*((?:ldaps?|rmi|dns|iiop|corba|nis|https?)://?[^\s\"'<>}]+)", re.IGNORECASE)


_PAYLOADS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("url", "scheme", "host")]))


def _found_jndi(text: str, found: dict) -> None:
    for m in _JNDI.finditer(plain_lookups(text)):
        url = m.group(1)
        scheme, _, rest = url.partition(":")
        host = re.match(r"(?:[^/@]*@)?(\[[^\]]*\]|[^/:?#]*)", rest.lstrip("/")).group(1).lower()
        found.setdefault(url, (url, scheme.lower(), host if host and "$" not in host else None))


@F.pandas_udf(returnType=_PAYLOADS)
def _jndi(texts: pd.Series) -> pd.Series:
    def one(values):
        found = {}
        for x in [] if values is None else values:
            _found_jndi(x, found)
        return list(found.values())

    return texts.map(one)


def jndi_payloads_each(texts: Column) -> Column:
    """JNDI URLs in an array of texts, look-ups of each text resolved on its own. Only texts with ${ go to Python."""
    none = F.array().cast("array<struct<url:string,scheme:string,host:string>>")
    some = F.filter(texts, lambda x: F.contains(x, F.lit("${")))
    return F.when(F.size(some) > 0, _jndi(some)).otherwise(none)


def jndi_payloads(text: Column) -> Column:
    """JNDI URLs in a text, look-ups resolved."""
    return jndi_payloads_each(F.array(text))
