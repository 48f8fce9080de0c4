"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score. JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hivelens.llm.common import whole_text

#: Order of the kinds in every result.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")

# Each pattern begins only where a run of its first class begins or where the match before ended, and takes such runs
# whole: that finds the same leftmost matches as the plain pattern without trying each place inside a run.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Cards inside longer runs of digits, account numbers and social security numbers; these come on top of the plain ones.
_CARD_INSIDE = r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?:[0-9]{1,3})?(?![0-9])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_SSN = r"(?<![0-9A-Za-z.-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"

#: Words that raise the score of a kind when they stand shortly before or after.
CONTEXT = {
    "email": "mail|contact|write to|address",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment|master",
    "phone": "phone|tel|call|fax|mobile|contact",
    "iban": "iban|account|bank|transfer",
    "ssn": r"\bssn\b|social security|taxpayer|\btax id",
}
#: A kind without a checksum of its own starts under LEAST_SCORE: only words nearby admit its spans.
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT_BONUS = 0.2
LEAST_SCORE = 0.5
CONTEXT_CHARS = 48


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces leaves 1 by ISO 7064 mod 97-10."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.left(account, F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), step) == 1


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _ip_ok(x: Column) -> Column:
    return F.forall(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _card_ok(x: Column) -> Column:
    d = _digits(x)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)


#: Kind, whether it is a plain one, pattern, what the text must hold, and the check.
_RULES = (
    ("email", True, _EMAIL, lambda t: F.contains(t, F.lit("@")), lambda x: F.lit(True)),
    ("ip", True, _IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _ip_ok),
    ("card", True, _CARD, lambda t: t.rlike("[0-9][ -]?[0-9]"), _card_ok),
    ("phone", True, _PHONE, lambda t: F.contains(t, F.lit("+")), lambda x: F.length(_digits(x)).between(8, 15)),
    ("card", False, _CARD_INSIDE, lambda t: t.rlike("[0-9]{4}[ -]?[0-9]"), _card_ok),
    ("iban", False, _IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), lambda x: mod97(F.regexp_replace(x, " ", ""))),
    ("ssn", False, _SSN, lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"), lambda x: F.lit(True)),
)
_SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double,plain:boolean>>"


#: Spans that one inner fold handles: an append copies its list, so lists stay short and are joined at the end.
_FOLD = 256


def _starts(hit: str, gap: str) -> Column:
    """Where each match starts, from the lengths of what stands between matches and of the matches before."""
    start = lambda acc, k: acc["at"] + F.length(F.get(gap, k))

    def step(acc: Column, k: Column) -> Column:
        return F.struct((start(acc, k) + F.length(F.get(hit, k))).alias("at"), F.array_append(acc["starts"], start(acc, k)).alias("starts"))

    none = F.array().cast("array<int>")
    last = F.size(hit) - 1

    def part(acc: Column, first: Column) -> Column:
        inner = F.aggregate(F.sequence(first, F.least(first + (_FOLD - 1), last)), F.struct(acc["at"].alias("at"), none.alias("starts")), step)
        return F.transform(F.array(inner), lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["parts"], x["starts"]).alias("parts")))[0]

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("parts"))
    folded = F.aggregate(F.sequence(F.lit(0), last, F.lit(_FOLD)), begin, part, lambda acc: F.flatten(acc["parts"]))
    return F.when(F.size(hit) > 0, folded).otherwise(none)


def _spans(kind: str, plain: bool, hit: str, gap: str, check, place: str, min_score: float) -> Column:
    def span(x: Column, k: Column) -> Column:
        nearby = F.concat_ws(" ", F.right(F.get(gap, k), F.lit(CONTEXT_CHARS)), F.left(F.get(gap, k + 1), F.lit(CONTEXT_CHARS)))
        bonus = F.when(F.lower(nearby).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), F.get(place, k).alias("start"), (F.get(place, k) + F.length(x)).alias("end"), x.alias("value"),
            F.round(F.lit(BASE_SCORE[kind]) + bonus, 3).alias("score"), F.lit(plain).alias("plain"),
        )

    return F.filter(F.transform(hit, span), lambda s: check(s["value"]) & (s["score"] >= min_score)).cast(_SPAN)


def _has_kind(kind: str):
    return lambda s: s["kind"] == kind


def find_pii(docs: DataFrame, text: str = "text", min_score: float = LEAST_SCORE) -> DataFrame:
    """docs with pii: spans (kind, start, end, value, score, plain) of each whole text, by kind as listed, then start.

    start and end count code points, end exclusive. plain marks spans of the four plain patterns; others are card
    numbers inside longer runs of digits, account numbers (IBAN) and social security numbers. Checks: parts of an address at most 255, Luhn for
    cards of 16 to 19 digits, 8 to 15 digits of a phone number, mod 97 for accounts. A score is that of its kind plus
    CONTEXT_BONUS where a word of CONTEXT stands within CONTEXT_CHARS; spans under min_score go, so a social security
    number, which no checksum confirms, counts only beside such words. A missing or empty text
    has an empty list. Rows are independent, so missing and repeated ids and ties don't matter; an input column named
    pii gives way. Time is linear in a text's length, memory follows it, and an empty table stays empty.
    """
    taken = {c.lower() for c in docs.columns}
    temp = lambda n: next(x for x in (f"__{n}{'_' * k}" for k in range(99)) if x not in taken)
    t = temp("text")
    out = docs.drop("pii").withColumn(t, whole_text(text))
    found = []
    for i, (kind, plain, pattern, may, check) in enumerate(_RULES):
        hit, gap = temp(f"hit{i}"), temp(f"gap{i}")
        has, none = may(F.col(t)), F.array().cast("array<string>")
        out = out.withColumns({hit: F.when(has, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none), gap: F.when(has, F.split(t, pattern, -1)).otherwise(none)})
        found.append((kind, plain, hit, gap, check))
    for i, rule in enumerate(found):
        out = out.withColumn(temp(f"at{i}"), _starts(*rule[2:4]))
        out = out.withColumn(f"{temp(f'at{i}')}s", _spans(*rule, temp(f"at{i}"), min_score))
    per = [f"{temp(f'at{i}')}s" for i in range(len(found))]
    inside = F.filter(per[4], lambda s: ~F.exists(F.col(per[2]), lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"])))
    by_start = lambda x: F.array_sort(x, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["end"] - b["end"]))
    cards = F.when(F.size(per[4]) > 0, by_start(F.concat(per[2], inside))).otherwise(F.col(per[2]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "pii"], F.concat(per[0], per[1], cards, per[3], per[5], per[6]).alias("pii"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", min_score: float = LEAST_SCORE) -> DataFrame:
    """docs with each span of personal data in the text replaced by its kind in square brackets.

    Spans that overlap one before them are covered by its mark. Missing texts stay missing; other columns stay.
    """
    found = find_pii(docs.select(*[F.col(f"`{c}`") for c in docs.columns]), text, min_score)
    order = F.array_sort("pii", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(b["end"] - a["end"]))

    state = lambda at, parts: F.struct(at.alias("at"), parts.alias("parts"))
    none = F.array().cast("array<string>")

    def part(acc: Column, first: Column) -> Column:
        # The stretch of the text that these spans reach; places are taken within it.
        spans = F.slice(F.col("pii"), first + 1, F.lit(_FOLD))
        upto = F.greatest(acc["at"], F.array_max(F.transform(spans, lambda x: x["end"])))
        stretch = F.struct(spans.alias("spans"), acc["at"].alias("base"), F.substring(F.col(text), acc["at"] + 1, upto - acc["at"]).alias("text"))

        def within(z: Column) -> Column:
            def step(inner: Column, x: Column) -> Column:
                new = F.concat(F.substring(z["text"], inner["at"] - z["base"] + 1, x["start"] - inner["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
                return F.when(x["start"] < inner["at"], state(F.greatest(inner["at"], x["end"]), inner["parts"])).otherwise(state(x["end"], F.array_append(inner["parts"], new)))

            return F.aggregate(z["spans"], state(z["base"], none), step, lambda inner: state(inner["at"], F.array_append(acc["parts"], F.array_join(inner["parts"], ""))))

        return F.transform(F.array(stretch), within)[0]

    firsts = F.sequence(F.lit(0), F.size("pii") - 1, F.lit(_FOLD))
    done = F.aggregate(firsts, state(F.lit(0), none), part, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    found = found.withColumn("pii", order)
    columns = [F.when(F.size("pii") > 0, done).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return found.select(*columns)


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row for each document: counts of the plain spans, a digest of them, and all spans as text."""
    found = find_pii(docs.select("doc_id", "text"))
    plain = found.select("doc_id", "pii", F.filter("pii", lambda s: s["plain"]).alias("plain"))
    counts = [F.size(F.filter("plain", _has_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return plain.select("doc_id", *counts, F.sha2(spans_text(F.col("plain")).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("pii")).alias("spans"), F.round(F.aggregate("pii", F.lit(0.0), lambda acc, s: acc + s["score"]), 3).alias("score_sum"))
