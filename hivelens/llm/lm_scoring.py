"""Language-model scores by prediction by partial matching (PPM) over bytes.

Training counts every run of ORDER context bytes and the byte that follows, over all training texts; shorter contexts
are sums of longer ones, so the counts form a trie. To code a byte, the model starts at the longest context. A context
with n observations of d symbols gives a symbol seen c times c / (n + d) and an escape d / (n + d) (method C); on an
escape the next shorter context is asked, with the symbols of the longer one excluded from its counts. Below the empty
context all symbols not yet excluded are equally likely. A text ends with its own symbol. The model is fixed after
training, and a text's score is the sum of the log10 probabilities of its bytes and its end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hivelens.llm.common import bucket_of, ship_package, stage_table, texts_of, total_bytes, whole_text
from hivelens.llm.scan import Words

ORDER = 5
#: Neither byte occurs in UTF-8: contexts before a text's first byte, and the symbol of its end.
START, END = b"\xfe", b"\xff"
#: Entries of the trie that are broadcast whole at most (16 bytes each). A larger trie is dealt into shards, with equal scores.
MOST_BROADCAST = 6_000_000
#: Context bytes of the levels that all shards share: at most 2 ** 24 entries.
SHARED_ORDER = 2
SHARD_ENTRIES = 1 << 20
BLOCK_BYTES = 8 << 20
LEAST_BLOCKS = 64
_PIECE = 1 << 19
#: Key of the token that ends a text; words' keys are hashes.
_END_KEY = -1


def context_codes(texts: list[bytes], order: int = ORDER) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of (first text, text index from there, code): each predicted symbol with `order` bytes before it."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= _PIECE):
            n += len(texts[j])
            j += 1
        pad = START * order
        stream = np.frombuffer(b"".join(x for t in texts[i:j] for x in (pad, t.lower(), END)), dtype=np.uint8)
        ends = np.cumsum([len(t) + order + 1 for t in texts[i:j]])
        for a in range(order, len(stream), _PIECE):
            b = min(len(stream), a + _PIECE)
            code = np.zeros(b - a, dtype=np.int64)
            for k in range(order, -1, -1):
                code = code << 8 | stream[a - k : b - k]
            at = np.flatnonzero(stream[a:b] != START[0])
            yield i, np.searchsorted(ends, at + a, "right"), code[at]
        i = j


class Trie:
    """The model: for each context length the known (context, symbol) codes and the sums that coding needs.

    With a base, which has the shorter contexts of all texts, codes may be those of some contexts only: all codes that
    share their last base.order + 1 context bytes.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int = ORDER, base: Trie | None = None):
        self.order = order
        least = 0 if base is None else base.order + 1
        levels = []
        for k in range(order, least - 1, -1):
            if k < order:
                codes, counts = _summed(codes & ((1 << 8 * (k + 1)) - 1), counts)
            else:
                codes, counts = _summed(codes, counts)
            context = codes >> 8
            first = np.flatnonzero(np.diff(context, prepend=-1)) if len(codes) else np.zeros(0, dtype=np.int64)
            levels.append([codes, counts, context[first], np.add.reduceat(counts, first) if len(first) else counts, np.diff(np.append(first, len(codes))), first])
        self.levels = ([] if base is None else base.levels) + levels[::-1]
        for k in range(order, max(least, 1) - 1, -1):
            codes, first = self.levels[k][0], self.levels[k][5]
            shorter, their = self.levels[k - 1][0], self.levels[k - 1][1]
            seen = their[np.searchsorted(shorter, codes & ((1 << 8 * k) - 1))] if len(codes) else their
            self.levels[k][5] = np.add.reduceat(seen, first) if len(first) else seen
        if base is None:
            self.levels[0][5] = np.zeros(len(self.levels[0][2]), dtype=np.int64)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each coded symbol."""
        out = np.zeros(len(code))
        left = np.arange(len(code))
        excluded, symbols = np.zeros(len(code), dtype=np.int64), np.zeros(len(code), dtype=np.int64)
        for k in range(self.order, -1, -1):
            codes, counts, contexts, total, distinct, below = self.levels[k]
            if not len(codes):
                continue
            c = code[left] & ((1 << 8 * (k + 1)) - 1)
            near = np.argsort(c)  # in order, neighbours are looked up near each other
            c, left, excluded, symbols = c[near], left[near], excluded[near], symbols[near]
            at, known = _find(contexts, c >> 8)
            n = np.where(known, total[at], 0) - np.where(known, excluded, 0)
            d = np.where(known, distinct[at], 0) - np.where(known, symbols, 0)
            place, hit = _find(codes, c)
            whole = np.maximum(n + d, 1)
            out[left[hit]] += np.log10(counts[place[hit]] / whole[hit])
            escape = ~hit & (d > 0)
            out[left[escape]] += np.log10(d[escape] / whole[escape])
            rest = ~hit
            excluded = np.where(known, below[at], 0)[rest]
            symbols = np.where(known, distinct[at], 0)[rest]
            left = left[rest]
        out[left] -= np.log10(np.maximum(1, 256 - symbols))
        return out


def text_scores(texts: list[bytes], order: int, log10: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums of the log10 probabilities of each text's symbols."""
    out = np.zeros(len(texts))
    for i, doc, code in context_codes(texts, order):
        inverse, kinds = pd.factorize(code)
        sums = np.bincount(doc, weights=log10(kinds)[inverse])
        out[i : i + len(sums)] += sums
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1)) if len(codes) else np.zeros(0, dtype=np.int64)
    return codes[first], (np.add.reduceat(counts, first) if len(first) else counts).astype(np.int64)


def count_contexts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, n) over all texts of a frame's text column, summed in each task before the shuffle."""
    ship_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, waiting = [], [], 0
        for batch in batches:
            for _, _, code in context_codes(texts_of(batch), order):
                inverse, kinds = pd.factorize(code)
                codes.append(kinds)
                counts.append(np.bincount(inverse, minlength=len(kinds)))
                waiting += len(kinds)
                if waiting > 1 << 20:
                    a, b = _summed(np.concatenate(codes), np.concatenate(counts))
                    codes, counts, waiting = [a], [b], 0
                    if len(a) > 1 << 19:
                        yield pa.RecordBatch.from_pydict({"code": a, "n": b})
                        codes, counts = [], []
        if codes:
            a, b = _summed(np.concatenate(codes), np.concatenate(counts))
            yield pa.RecordBatch.from_pydict({"code": a, "n": b})

    return texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _lowered(counts: DataFrame, order: int) -> DataFrame:
    """Counts of all contexts cut to their last `order` bytes."""
    return counts.groupBy((F.col("code").bitwiseAND((1 << 8 * (order + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n"))


def _trie(counts: DataFrame, order: int) -> Trie:
    table = counts.toArrow()
    return Trie(table["code"].to_numpy(), table["n"].to_numpy(), order)


def _block_codes(dealt: DataFrame, order: int) -> DataFrame:
    """(block, code): the distinct codes of each block's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            block, texts = batch.column("block").to_numpy(), texts_of(batch)
            for b in np.unique(block):
                mine = found.setdefault(int(b), [])
                for _, _, code in context_codes([texts[i] for i in np.flatnonzero(block == b)], order):
                    mine.append(pd.unique(code))
                    if sum(map(len, mine)) > max(1 << 20, 2 * len(mine[0])):
                        mine[:] = [np.unique(np.concatenate(mine))]
        for b, parts in found.items():
            codes = np.unique(np.concatenate(parts))
            for i in range(0, len(codes), _PIECE):
                some = codes[i : i + _PIECE]
                yield pa.RecordBatch.from_pydict({"block": np.full(len(some), b, dtype=np.int32), "code": some})

    return dealt.select("block", "text").mapInArrow(run, "block int, code long")


def _sharded_logs(counts: DataFrame, wanted: DataFrame, order: int, shards: int) -> DataFrame:
    """(block, key, log): log10 probabilities of each block's codes, by shards of the trie that hold whole contexts."""
    shared = counts.sparkSession.sparkContext.broadcast(_trie(_lowered(counts, SHARED_ORDER), SHARED_ORDER))
    context = F.shiftright("code", 8).bitwiseAND((1 << 8 * (SHARED_ORDER + 1)) - 1)
    dealt = lambda df: df.withColumn("shard", F.pmod(F.xxhash64(context), F.lit(shards)).cast("int")).groupBy("shard")

    def price(left: pa.Table, right: pa.Table) -> pa.Table:
        inverse, kinds = pd.factorize(left["code"].to_numpy())
        model = Trie(right["code"].to_numpy(), right["n"].to_numpy(), order, shared.value)
        return pa.table({"block": left["block"], "key": left["code"], "log": model.log10(kinds)[inverse]})

    return dealt(wanted).cogroup(dealt(counts)).applyInArrow(price, "block int, key long, log double")


def _word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words of texts, none of them that of the end, and words before each text."""
    words = Words(texts)
    keys = words.hash.view(np.int64)
    return np.where(keys == _END_KEY, 0, keys), words.first


def score_texts(docs: DataFrame, modulus: int = 7, held_out: int = 2, order: int = ORDER, most_entries: int | None = None, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """PPM score and unigram base score of each whole text; training rows are those whose crc32(doc_id) mod modulus isn't held_out.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (seen in training), train_tokens, base_score (sum of
    log10((c + 1) / (N + V + 1)) over tokens), score (log10 probability of the lower-cased text with its end), n_symbols.
    A missing text is empty and has its end only; a missing doc_id counts as bucket 0, so it trains; repeated rows count
    and return each time; other columns are ignored. Without training rows all symbols are equally likely. An empty table
    gives an empty table. Words are compared by 64-bit hashes. Documents are dealt into blocks by a hash of their id; a
    block's distinct words are counted once and their totals come back to it, so no task holds the whole vocabulary.
    A trie of more than most_broadcast entries isn't broadcast: its shards meet the distinct codes of the blocks in a
    shuffle, and their probabilities come back as the words' totals do. Only a caller that gives most_entries gets a lower
    order (two at least) for a larger trie.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), (bucket_of("doc_id", modulus) == held_out).alias("held_out"))
    counts = stage_table(count_contexts(rows.where("not held_out"), order), "contexts")
    entries = counts.count()
    while most_entries is not None and entries > most_entries and order > 2:
        order -= 1
        counts = stage_table(_lowered(counts, order), "contexts")
        entries = counts.count()
    sharded = entries > most_broadcast and order > SHARED_ORDER
    shared = None if sharded else spark.sparkContext.broadcast(_trie(counts, order))
    blocks = max(LEAST_BLOCKS, math.ceil(total_bytes(rows) / BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            block = batch.column("block").to_numpy()
            trains = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            texts = texts_of(batch)
            for b in np.unique(block):
                for some, weight in ((trains, 1), (~trains, 0)):
                    at = np.flatnonzero((block == b) & some)
                    if len(at):
                        keys, _ = _word_keys([texts[i] for i in at])
                        kinds, n = np.unique(np.append(keys, _END_KEY), return_counts=True)
                        n[kinds == _END_KEY] += len(at) - 1
                        found.setdefault(int(b), []).append((kinds, n * weight))
        for b, parts in found.items():
            kinds, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"block": np.full(len(kinds), b, dtype=np.int32), "key": kinds, "n": n})

    own = dealt.mapInArrow(count_words, "block int, key long, n long")
    by_key = Window.partitionBy("key")
    known = own.select("block", "key", "n", F.sum("n").over(by_key).alias("c"), (F.min(F.when(F.col("n") > 0, F.col("block"))).over(by_key) == F.col("block")).alias("first"))
    if sharded:
        logs_ = _sharded_logs(counts, _block_codes(dealt, order), order, max(blocks, math.ceil(entries / SHARD_ENTRIES)))
        known = known.unionByName(logs_, allowMissingColumns=True)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if sharded:
            codes = right.filter(pc.is_valid(right["log"])).sort_by("key")
            right = right.filter(pc.is_null(right["log"]))
            known_codes, known_logs = codes["key"].to_numpy(), codes["log"].to_numpy()
            log10 = lambda kinds: known_logs[np.searchsorted(known_codes, kinds)]
        else:
            log10 = shared.value.log10
        keys, c = right["key"].to_numpy(), right["c"].to_numpy()
        order_ = np.argsort(keys)
        keys, c = keys[order_], c[order_]
        first = right["first"].to_numpy(zero_copy_only=False).astype(object) == True  # noqa: E712
        out: dict[str, list] = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "n_symbols")}
        ids, held = left["doc_id"].to_pylist(), left["held_out"].to_pylist()
        texts = [x or b"" for x in left["text"].cast(pa.large_binary()).to_pylist()]
        i = 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n < _PIECE):
                n += len(texts[j])
                j += 1
            run = texts[i:j]
            words, begins = _word_keys(run)
            inverse, kinds = pd.factorize(words)
            at = np.searchsorted(keys, kinds)
            end_c = c[np.searchsorted(keys, _END_KEY)]
            logs, seen = np.log10(c[at] + 1.0), (c[at] > 0).astype(np.int64)
            doc = np.repeat(np.arange(len(run)), np.diff(begins))
            sums = np.bincount(doc, weights=logs[inverse], minlength=len(run)) + math.log10(end_c + 1)
            hits = np.bincount(doc, weights=seen[inverse], minlength=len(run)).astype(np.int64) + int(end_c > 0)
            out["doc_id"] += ids[i:j]
            out["held_out"] += held[i:j]
            out["n_tokens"] += (np.diff(begins) + 1).tolist()
            out["n_known"] += hits.tolist()
            out["logs"] += sums.tolist()
            out["score"] += text_scores(run, order, log10).tolist()
            out["n_symbols"] += [len(t) + 1 for t in run]
            i = j
        total = {"doc_id": None, "held_out": None, "n_tokens": int(right["n"].to_numpy().sum()), "n_known": int(first.sum()), "logs": 0.0, "score": 0.0, "n_symbols": None}
        for k, v in total.items():
            out[k].append(v)
        types = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "logs": pa.float64(), "score": pa.float64(), "n_symbols": pa.int64()}
        return pa.table({k: pa.array(out[k], t) for k, t in types.items()})

    scored = stage_table(
        dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, n_symbols long"),
        "scores",
    )
    sums = scored.where("held_out is null").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("train_tokens"), F.coalesce(F.sum("n_known"), F.lit(0)).alias("v"))
    joined = scored.where("held_out is not null").crossJoin(F.broadcast(sums))  # one row
    return joined.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", (F.col("logs") - F.col("n_tokens") * F.log10((F.col("train_tokens") + F.col("v") + 1).cast("double"))).alias("base_score"), "score", "n_symbols")
