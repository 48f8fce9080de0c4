"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other values in it keeps its template. Windows
of template tokens of documents and benchmark items are hash-joined; windows that line up at one offset form a segment,
and a segment counts if its slots are consistent: equal values of the item stand for equal values of the document, and
different names for different names. A second template of the case-folded text, in which names are words, finds copies
in capitals, title case or lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hivelens.llm.common import frugal, ship_package, stage_table, texts_of, whole_text
from hivelens.llm.scan import mix, span_hashes

WINDOW = 8
#: Items with fewer template tokens match by their own values only; shorter ones than WINDOW match as a whole.
LEAST_TOKENS = 5
#: Share of a window's tokens that must be words for values to be free; in other windows values are part of the hash.
LEAST_LITERAL = 0.5
#: Share of an item's tokens that must be found for a document to be contaminated by it.
COVERAGE = 0.6
#: Benchmark windows that are broadcast as a filter at most (8 bytes each); with more, all windows take part in the join.
MOST_BROADCAST = 4_000_000
UNITS = "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs day days week weeks month months year years kb mb gb tb hz khz mhz ghz w kw mw kwh v a c f k pa bar usd eur gbp dollars euros pounds cents percent miles meters metres grams liters litres hours minutes seconds".split()

NUMBER, NAME, UNIT = 1, 2, 3
_KIND = np.zeros(256, dtype=np.int8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;|\n\r"]] = True
_SLOT = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _units() -> np.ndarray:
    joined = " ".join(UNITS).encode()
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    return np.sort(span_hashes(np.frombuffer(joined, dtype=np.uint8), ends - [len(u) for u in UNITS], ends))


_UNIT_HASHES = _units()
#: Keep hashes of case-blind templates and of windows with their values apart from the others.
_BLIND, _EXACT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def case_blind(text: bytes) -> bytes:
    """The case-folded text; bytes that aren't UTF-8 stay."""
    return text.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")


class Templates:
    """Template tokens of a run of texts: code (hash of a word or of a placeholder), slot (0 or its kind), value, text index."""

    def __init__(self, texts: list[bytes]):
        buf = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8)
        firsts = np.cumsum([1, *(len(t) + 1 for t in texts)])
        kind = _KIND[buf].copy()
        digit = kind == 2
        inner = np.zeros(len(buf), dtype=bool)
        inner[1:-1] = digit[:-2] & digit[2:] & ((buf[1:-1] == ord(".")) | (buf[1:-1] == ord(",")))
        kind[inner] = 2
        percent = (buf == ord("%")) & np.append(False, kind[:-1] == 2)
        kind[percent] = 3
        change = np.flatnonzero(np.diff(kind)) + 1
        opens = change[kind[change] > 0]
        closes = np.append(change, len(buf))[np.searchsorted(change, opens) + 1] if len(opens) else opens
        of = kind[opens]
        doc = np.searchsorted(firsts, opens, "right") - 1
        value = span_hashes(_LOWER[buf], opens, closes)
        slot = np.zeros(len(opens), dtype=np.int8)
        slot[of == 2] = NUMBER
        if len(opens):
            stops = np.concatenate(([0], np.cumsum(_STOP[buf] & ~inner)))
            before = np.append(0, closes[:-1])
            fresh = (stops[opens] > stops[before]) | np.append(True, doc[1:] != doc[:-1])
            upper = (buf[opens] >= 65) & (buf[opens] < 91) | (buf[opens] == 0xC3) & (buf[opens + 1] >= 0x80) & (buf[opens + 1] <= 0x9E)
            after_number = np.append(False, (of[:-1] == 2) & (doc[1:] == doc[:-1])) & (opens - before <= 1)
            at = np.minimum(np.searchsorted(_UNIT_HASHES, value), len(_UNIT_HASHES) - 1)
            slot[(of == 1) & upper & ~fresh] = NAME
            slot[after_number & ((of == 3) | (of == 1) & (_UNIT_HASHES[at] == value))] = UNIT
            again = np.append(False, (slot[1:] == NAME) & (slot[:-1] == NAME) & (doc[1:] == doc[:-1]))
            keep = np.flatnonzero(~again)
            value = np.add.reduceat(value, keep)
            doc, slot = doc[keep], slot[keep]
        self.doc, self.slot, self.value = doc, slot, value
        self.code = np.where(slot > 0, _SLOT[slot], value)
        self.count = np.bincount(doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First tokens of the windows, their hashes, and whether these are of values: so where there are too few words."""
        n = len(self.code) - width + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        words = np.concatenate(([0], np.cumsum(self.slot == 0)))
        at = np.flatnonzero(self.doc[:n] == self.doc[width - 1 :])
        exact = (words[at + width] - words[at] < LEAST_LITERAL * width) | (width < LEAST_TOKENS)
        out = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            out = out * np.uint64(0x2545F4914F6CDD1D) + self.code[k : k + n]
        h = mix(out[at] + np.uint64(width))
        few = at[exact]
        out = np.zeros(len(few), dtype=np.uint64)
        for k in range(width):
            out = out * np.uint64(0x2545F4914F6CDD1D) + self.value[few + k]
        h[exact] = mix((out + np.uint64(width)) ^ _EXACT)
        return at, h, exact


_WINDOW_FIELDS = "hash long, pos int, width int, slots array<byte>, values array<long>"


def _window_rows(ids: list, texts: list[bytes], widths, known: np.ndarray | None, whole_only: bool, name: str) -> pa.RecordBatch | None:
    parts = []
    for blind in (False, True):
        t = Templates([case_blind(x) for x in texts] if blind else texts)
        for w in widths:
            at, h, exact = t.windows(w)
            if blind:
                h = mix(h ^ _BLIND)
            if whole_only:  # items: windows of WINDOW tokens, or the whole of a shorter one
                ok = t.count[t.doc[at]] >= w if w == WINDOW else t.count[t.doc[at]] == w
                at, h, exact = at[ok], h[ok], exact[ok]
            if known is not None and len(known):
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                ok = known[place] == h
                at, h, exact = at[ok], h[ok], exact[ok]
            if len(at):
                parts.append((t, blind, at, h, exact, w))
    if not parts:
        return None
    cols: dict[str, list] = {k: [] for k in (name, "blind", "n", "hash", "pos", "width", "slots", "values")}
    for t, blind, at, h, exact, w in parts:
        doc = t.doc[at]
        grid = at[:, None] + np.arange(w)
        cols[name] += [ids[d] for d in doc]
        cols["blind"] += [blind] * len(at)
        cols["n"] += t.count[doc].tolist()
        cols["hash"] += h.view(np.int64).tolist()
        cols["pos"] += (at - t.first[doc]).tolist()
        cols["width"] += [w] * len(at)
        slots = np.where(exact[:, None], 0, t.slot[grid]).astype(np.int8)  # equal values have no slot to prove
        cols["slots"] += list(slots)
        cols["values"] += list(np.where(slots > 0, t.value[grid], np.uint64(0)).view(np.int64))
    types = {name: pa.int64(), "blind": pa.bool_(), "n": pa.int32(), "hash": pa.int64(), "pos": pa.int32(), "width": pa.int32(), "slots": pa.list_(pa.int8()), "values": pa.list_(pa.int64())}
    return pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in cols.items()})


def _windows(df: DataFrame, name: str, widths, shared, whole_only: bool) -> DataFrame:
    """Template windows of texts with ids in column `name`; only those in the shared filter, if there is one."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared is None else shared.value
        for batch in batches:
            ids, texts, i = batch.column(name).to_pylist(), texts_of(batch), 0
            while i < len(texts):
                j, n = i, 0
                while j < len(texts) and (j == i or n < 1 << 21):
                    n += len(texts[j])
                    j += 1
                rows = _window_rows(ids[i:j], texts[i:j], widths, known, whole_only, name)
                if rows is not None:
                    yield rows
                i = j

    return df.mapInArrow(frugal(run), f"{name} long, blind boolean, n int, {_WINDOW_FIELDS}")


def find_contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Pairs of a document and a benchmark item whose template it holds: doc_id, item_id, coverage, n_windows, same_values.

    docs has doc_id and text, benchmark has item_id and text; other columns are ignored. coverage is the share of the
    item's template tokens in consistent segments, same_values whether all its slots hold the item's own values; both are
    those of the case-blind template where the other doesn't reach the coverage. Windows with few words, and items of
    under LEAST_TOKENS tokens, match only with their own values (an item of one word is in each text with that word). Missing
    and empty texts hold nothing and match nothing. Rows with equal ids count as one document (or item); a missing id is
    an id of its own. Items with equal templates are all reported. Either table may be empty.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    widths = [*range(1, WINDOW), WINDOW]
    bench = stage_table(_windows(items, "item_id", widths, None, True), "windows")
    widths = [r["width"] for r in bench.select("width").distinct().collect()] or [WINDOW]
    n = bench.count()
    shared = None
    if n <= most_broadcast:
        known = np.unique(bench.select("hash").toArrow()["hash"].to_numpy().view(np.uint64))
        shared = spark.sparkContext.broadcast(known if n else np.zeros(1, dtype=np.uint64))
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    left = _windows(mine, "doc_id", widths, shared, False).select("doc_id", "blind", "hash", F.col("pos").alias("doc_pos"), "width", F.col("values").alias("doc_values"))
    right = bench.select("item_id", "blind", "hash", "width", "n", F.col("pos").alias("item_pos"), "slots", F.col("values").alias("item_values"))
    met = left.join(right, ["hash", "width", "blind"]).withColumn("offset", F.col("doc_pos") - F.col("item_pos"))
    pairs = F.filter(F.arrays_zip("slots", F.col("item_values").alias("item"), F.col("doc_values").alias("doc")), lambda x: x["slots"] > 0)
    covered = F.sequence(F.col("item_pos"), F.col("item_pos") + F.col("width") - 1)
    segments = met.groupBy("doc_id", "item_id", "blind", "offset").agg(
        F.max("n").alias("n"), F.countDistinct("item_pos").alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"), F.array_distinct(F.flatten(F.collect_set(covered))).alias("covered"),
    )
    side = lambda what, kind: F.array_distinct(F.transform(F.filter("pairs", kind), lambda x: F.struct(x["slots"], x[what])))
    names = lambda x: x["slots"] == NAME
    all_ = lambda x: F.lit(True)
    consistent = segments.where((F.size(side("item", all_)) == F.size("pairs")) & (F.size(side("doc", names)) == F.size(F.filter("pairs", names))))
    found = consistent.groupBy("doc_id", "item_id", "blind").agg(
        F.max("n").alias("n"), F.sum("windows").alias("n_windows"), F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("covered"),
        F.min(F.forall("pairs", lambda x: x["item"] == x["doc"])).alias("same_values"),
    )
    enough = found.withColumn("coverage", F.round(F.col("covered") / F.col("n"), 4)).where(F.col("coverage") >= coverage)
    best = enough.groupBy("doc_id", "item_id").agg(F.min_by(F.struct("coverage", "n_windows", "same_values"), "blind").alias("x"))
    return best.select("doc_id", "item_id", "x.coverage", "x.n_windows", "x.same_values")
