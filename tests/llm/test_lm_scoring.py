import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from hivelens.llm.lm_scoring import score_texts
from tests.llm.fixtures import TEXTS, empty, frame


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def symbols(text, order):
    data = b"\xfe" * order + lower(text).encode() + b"\xff"
    return [(data[i - order : i], data[i]) for i in range(order, len(data))]


class Plain:
    """The same model, one symbol at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            for context, s in symbols(t, order):
                for k in range(order + 1):
                    self.seen[context[order - k :]][s] += 1

    def probability(self, context, s):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            counts = {x: n for x, n in self.seen.get(context[self.order - k :], {}).items() if x not in excluded}
            n, d = sum(counts.values()), len(counts)
            if s in counts:
                return p * counts[s] / (n + d)
            if d:
                p *= d / (n + d)
            excluded |= set(counts)
        return p / (256 - len(excluded))

    def score(self, text):
        return sum(math.log10(self.probability(*x)) for x in symbols(text, self.order))


@pytest.mark.parametrize("order", [2, 4])
def test_scores_against_plain_model(spark, order):
    texts = {i if i != 3 else None: t for i, t in enumerate(TEXTS)}
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    model = Plain([t for i, t in texts.items() if not held(i)], order)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    counts = Counter(w for i, t in texts.items() if not held(i) for w in words(t))
    total, kinds = sum(counts.values()), len(counts)
    rows = score_texts(frame(spark), order=order).collect()
    assert len(rows) == len(TEXTS) and {r.held_out for r in rows} == {True, False}
    for r in rows:
        mine = words(texts[r.doc_id])
        assert r.held_out == held(r.doc_id) and r.train_tokens == total
        assert r.n_tokens == len(mine) and r.n_known == sum(counts[w] > 0 for w in mine)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in mine), rel_tol=1e-9)
        assert math.isclose(r.score, model.score(texts[r.doc_id]), rel_tol=1e-9), r


def test_probabilities_sum_to_one():
    model = Plain(["abracadabra", "alakazam"], 2)
    for context in (b"ab", b"zz", b"\xfe\xfe", b"ra"):
        assert math.isclose(sum(model.probability(context, s) for s in range(256)), 1.0)


def test_order_falls_when_the_trie_is_too_large(spark):
    few = score_texts(frame(spark), order=4, most_entries=10).collect()
    two = score_texts(frame(spark), order=2).collect()
    assert {r.doc_id: round(r.score, 9) for r in few} == {r.doc_id: round(r.score, 9) for r in two}


def test_empty_and_untrained(spark):
    assert score_texts(empty(spark)).count() == 0
    only = score_texts(frame(spark).where("doc_id is not null and crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")).collect()
    for r in only:
        assert r.train_tokens == 0 and r.n_known == 0
        assert math.isclose(r.score, -r.n_symbols * math.log10(256), rel_tol=1e-9)


@pytest.mark.parametrize("order", [3, 5])
def test_shards_of_a_large_trie_keep_every_score(spark, order):
    key = lambda r: str(r.doc_id)
    whole = sorted(score_texts(frame(spark), order=order).collect(), key=key)
    parts = sorted(score_texts(frame(spark), order=order, most_broadcast=10).collect(), key=key)
    assert len(whole) == len(parts) == len(TEXTS)
    for a, b in zip(whole, parts):
        assert a[:-2] == b[:-2] and a.n_symbols == b.n_symbols and math.isclose(a.score, b.score, rel_tol=1e-12)
