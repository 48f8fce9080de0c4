"""Signs of attacks in web requests: exploit hints, scanner agents, attack types, credentials in bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of exploit attempts in a request's target, body and headers.
EXPLOIT_HINTS = [
    r"(?i)/\.env(?:$|[/?])",
    r"(?i)/\.git(?:$|[/?])",
    r"(?i)/\.aws/credentials",
    r"(?i)/config(?:\.json|\.yaml|\.yml|\.php)?(?:$|[/?])",
    r"(?i)/etc/passwd",
    r"(?i)/wp-config\.php",
    r"(?i)/actuator/env",
    r"(?i)/actuator/heapdump",
    r"(?i)/actuator/gateway/",
    r"(?i)/shell(?:\.php|\.jsp|\.aspx)?(?:$|[/?])",
    r"(?i)/cmd(?:\.php|\.jsp)?(?:$|[/?])",
    r"(?i)/wso\.php",
    r"(?i)/c99\.php",
    r"(?i)/wp-admin/",
    r"(?i)/wp-login\.php",
    r"(?i)/admin/(?:config|login|index)",
    r"(?i)/api/v\d+/(?:cmd|exec|shell|eval)",
    r"(?i)eval\s*\(",
    r"(?i)base64_decode\s*\(",
    r"(?i)system\s*\(",
    r"(?i)exec\s*\(",
    r"(?i)passthru\s*\(",
    r"(?i)\$\{jndi:",
    r"\.\./",
    r"(?i)%2e%2e",
    r"(?i)\bunion\s+select\b",
    r"(?i)\bor\s+1\s*=\s*1\b",
]
# Names of tools in agents.
SCANNER_AGENTS = ["sqlmap", "nikto", "nmap", "masscan", "zgrab", "dirbuster", "gobuster", "hydra", "metasploit"]
# Attack types of an emulator and their techniques.
ATTACK_TECHNIQUES = {
    "sqli": "T1190",
    "rfi": "T1190",
    "lfi": "T1190",
    "cmd_exec": "T1190",
    "php_object_injection": "T1190",
    "xxe": "T1190",
    "crlf": "T1190",
    "template": "T1190",
    "xss": "T1189",
}
# Keys of users and passwords in bodies.
USER_KEYS = ("email", "username", "user", "login", "name", "uid")
PASSWORD_KEYS = ("password", "pass", "pwd", "passwd", "secret")


def exploit_hints(*parts: Column) -> Column:
    """Numbers of the hints that a request shows."""
    joined = F.concat_ws("\n", *parts)
    return F.array_compact(F.array(*[F.when(joined.rlike("(?m)" + p), F.lit(i)) for i, p in enumerate(EXPLOIT_HINTS)]))


def scanner_agent(agent: Column) -> Column:
    """The tool that an agent names."""
    return F.nullif(F.lower(F.regexp_extract(agent, r"(?i)\b(" + "|".join(SCANNER_AGENTS) + r")\b", 1)), F.lit(""))


def attack_technique(kind: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in ATTACK_TECHNIQUES.items() for x in p]), F.lower(kind))


def body_credentials(body: Column, method: Column, most: int = 4) -> Column:
    """User and password pairs in a JSON or form body, at most `most`; none for GET requests."""
    flat = F.from_json(body, "map<string,string>")
    nested = [F.from_json(F.try_element_at(flat, F.lit(k)), "map<string,string>") for k in ("data", "user", "credentials", "auth")]
    decoded = lambda x: F.try_url_decode(F.regexp_replace(x, r"\+", " "))
    pairs = F.transform(F.filter(F.split(body, "&"), lambda x: F.contains(x, F.lit("="))), lambda x: F.struct(F.lower(decoded(F.split_part(x, F.lit("="), F.lit(1)))).alias("key"), decoded(F.regexp_replace(x, "^[^=]*=", "")).alias("value")))
    entries = lambda m: F.coalesce(F.transform(F.map_entries(m), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))), F.array().cast("array<struct<key:string,value:string>>"))
    is_json = F.ltrim(body).rlike(r"^[{\[]")
    found = F.when(is_json, F.flatten(F.array(entries(flat), *map(entries, nested)))).otherwise(pairs)
    values = lambda keys: F.transform(F.filter(found, lambda e: e["key"].isin(*keys) & (F.length(e["value"]) > 0) & ~e["value"].startswith("{")), lambda e: e["value"])
    crossed = F.flatten(F.transform(values(USER_KEYS), lambda u: F.transform(values(PASSWORD_KEYS), lambda p: F.struct(u.alias("username"), p.alias("password")))))
    none = F.array().cast("array<struct<username:string,password:string>>")
    return F.when((F.upper(F.coalesce(method, F.lit(""))) != "GET") & (F.length(body) > 0), F.slice(F.array_distinct(crossed), 1, most)).otherwise(none)


def firewall_cve(payload: Column) -> Column:
    """CVE-2018-0101 where a payload has the shape of its exploit."""
    low = F.lower(F.ltrim(payload))
    shape = F.contains(low, F.lit("<host>")) & F.contains(low, F.lit("<key>")) & F.contains(low, F.lit("webvpn"))
    return F.when(low.startswith("tcp_test") | shape, F.lit("CVE-2018-0101"))


def mail_verb(command: Column) -> Column:
    return F.upper(F.regexp_extract(F.trim(command), r"^(\S*)", 1))
