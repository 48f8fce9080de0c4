"""Scores, validity, techniques and labels of sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASELINE = 50

# Technique ids and names that sessions can show.
TECHNIQUES = {
    "T1059": "Command and Scripting Interpreter",
    "T1059.004": "Unix Shell",
    "T1078": "Valid Accounts",
    "T1098": "Account Manipulation",
    "T1098.004": "SSH Authorized Keys",
    "T1105": "Ingress Tool Transfer",
    "T1110": "Brute Force",
    "T1110.001": "Password Guessing",
    "T1595": "Active Scanning",
    "T1595.001": "Scanning IP Blocks",
}
SHELL_TYPES = ("Cowrie", "Adbhoney", "Beelzebub", "Router")


def clamp(score: Column) -> Column:
    return F.greatest(F.lit(10), F.least(F.lit(100), score)).cast("int")


def signal_score(auth: Column, commands: Column, hashes: Column, credentials: Column) -> Column:
    """Score of a session: auth is a flag, the others are counts."""
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    return clamp(BASELINE + points(auth, 30) + points(commands > 0, 25) + points(hashes > 0, 35) + F.least(F.lit(15), 5 * credentials))


def reputation_bonus(reputation: Column) -> Column:
    r = F.lower(F.coalesce(reputation, F.lit("")))
    return F.when(F.contains(r, F.lit("known attacker")), 25).when(F.contains(r, F.lit("bad reputation")), 12).otherwise(0)


def ip_score(signal: Column, reputation: Column, ics_write: Column) -> Column:
    return clamp(signal + reputation_bonus(reputation) + F.when(ics_write, 30).otherwise(0))


def validity_days(score: Column) -> Column:
    return F.when(score >= 80, 90).when(score >= 70, 45).when(score > BASELINE, 21).otherwise(7).cast("int")


def techniques(kind: Column, auth: Column, commands: Column, hashes: Column, credentials: Column, keys: Column, ports: Column) -> Column:
    """Technique ids that a session's behaviour shows, in a fixed order; counts but for kind and auth."""
    shown = [
        (credentials > 0, "T1110"),
        (credentials > 1, "T1110.001"),
        (auth, "T1078"),
        (commands > 0, "T1059"),
        ((commands > 0) & kind.isin(*SHELL_TYPES), "T1059.004"),
        (hashes > 0, "T1105"),
        (keys > 0, "T1098"),
        (keys > 0, "T1098.004"),
        (ports >= 3, "T1595"),
        (ports >= 3, "T1595.001"),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(t)) for cond, t in shown]))


def scan_shape(ports: Column) -> Column:
    """Label by the number of distinct ports."""
    return F.when(ports == 1, "scan:single").when(ports.between(2, 5), "scan:multi-port").when(ports > 5, "scan:vertical")


def noise_labels(types: Column, ports: Column, substance: Column, fanout: int = 3) -> Column:
    """noise:fleet-scan for addresses that touch many surfaces, targeted:substantive for those that did something; either, both or none."""
    surfaces = F.greatest(types, F.expr("0") + F.floor(F.least(ports, F.lit(99)) / 5))
    return F.array_compact(F.array(F.when(surfaces >= fanout, "noise:fleet-scan"), F.when(substance > 0, "targeted:substantive")))


def evidence(kind: Column, international: Column, ics: Column | None = None) -> Column:
    """struct<accept, reason>: whether a session may mint an indicator. ics: struct<write, snmp_only, industrial_tier, research_scanner>."""
    say = lambda ok, why: F.struct(F.lit(ok).alias("accept"), F.lit(why).alias("reason"))
    rule = F.when((kind == "Sentrypeer") & F.coalesce(international, F.lit(False)), say(True, "sip-fraud")).when(kind == "Sentrypeer", say(False, "sip-no-evidence"))
    if ics is not None:
        known = kind.isin("ConPot", "Heralding") & ics.isNotNull()
        tier = ics["industrial_tier"]
        rule = (
            rule.when(known & ics["write"], say(True, "ics-write"))
            .when(known & ics["snmp_only"], say(False, "ics-snmp-only"))
            .when(known & tier.isNull(), say(True, "stub-accept"))
            .when(known & (tier == "interaction") & F.coalesce(ics["research_scanner"], F.lit(False)), say(False, "ics-research-scanner"))
            .when(known & (tier == "interaction"), say(False, "ics-interaction"))
            .when(known & (tier == "handshake"), say(False, "ics-handshake-only"))
            .when(known, say(False, "ics-connect-only"))
        )
    return rule.otherwise(say(True, "stub-accept"))
