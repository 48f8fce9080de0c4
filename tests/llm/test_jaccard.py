import random
import re

import numpy as np
import pytest

from hivelens.llm.jaccard import connected, similar_components, suffix_distance
from tests.llm.fixtures import empty, frame

WORDS = [f"w{i}" for i in range(400)]


def shingle_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rng, texts = random.Random(seed), []
    common = [rng.choice(WORDS) for _ in range(60)]
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.randint(3, 120))]
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            new = list(base)
            for _ in range(rng.randint(0, 4)):
                new[rng.randrange(len(new))] = rng.choice(WORDS)
            texts.append(new)
    chain = [rng.choice(WORDS) for _ in range(80)]
    for k in range(12):  # links run along the chain, not across it
        texts.append(list(chain))
        chain[6 * k : 6 * k + 2] = [rng.choice(WORDS), rng.choice(WORDS)]
    for k in range(10):  # mostly a passage that many share
        texts.append(common + [rng.choice(WORDS) for _ in range(rng.randint(0, 25))])
    texts += [[], ["one"], ["one"], ["a", "b", "c", "d"], ["a", "b", "c", "d"], texts[0], texts[0]]
    rng.shuffle(texts)
    return [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, few", [(1, 8), (2, 0), (3, 1000)])
def test_components_against_all_pairs(spark, seed, few):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_components(df, few_pairs=few, local_links=10**6 if few else 0, part_bytes=2000, chunk_bytes=700 if few else 10**6).collect()}
    assert got == plain(rows)


def test_large_groups_of_exact_and_near_copies(spark):
    rng, texts = random.Random(5), []
    base = [rng.choice(WORDS) for _ in range(44)]
    texts += [list(base)] * 60
    for _ in range(220):  # one change keeps a link with the base, more don't; copies with one change link only by the base
        new = list(base)
        for k in rng.sample(range(44), rng.choice((1, 1, 1, 2, 3))):
            new[k] = f"u{rng.randrange(10**6)}" if rng.random() < 0.8 else rng.choice(WORDS)
        texts.append(new)
    for _ in range(40):  # other words around one passage: one core, sizes that may or may not link
        texts.append(base[:30] + [f"v{rng.randrange(10**6)}" for _ in range(rng.randint(0, 12))])
    texts += [[], []]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for few in (0, 64):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_components(df, few_pairs=few, chunk_bytes=2000).collect()}
        assert got == plain(rows)


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(5, "a b c d e f g", 1, "x"), (5, "a b c d e f g", 1, "x"), (7, "A b c d e f  g", 2, "y"), (None, "a b c d e f g", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, component_id string")
    got = similar_components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == [(5, 3, 5), (5, 3, 5), (7, 3, 5), (None, 3, None)]


def test_awkward_rows(spark):
    got = similar_components(frame(spark)).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got}
    assert by[5].component_id == by[4].component_id == 4 and by[None].component_id is None
    assert (by[0].n_shingles, by[0].component_id) == (0, 0) and by[2].component_id == 2
    assert similar_components(empty(spark)).count() == 0
    assert similar_components(frame(spark).where("doc_id < 2")).count() == 2


def test_components_of_paths_and_stars(spark):
    rng = random.Random(9)
    order = list(range(200))
    rng.shuffle(order)
    edges = list(zip(order[:99], order[1:100])) + [(order[150], order[k]) for k in range(151, 200)]
    comp = {r.node: r.comp for r in connected(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert {comp[i] for i in order[:100]} == {min(order[:100])} and {comp[i] for i in order[150:]} == {min(order[150:])}


def test_suffix_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(2))
        true = len(np.setxor1d(a, b))
        for most in (0, 3, 100):
            assert suffix_distance(a, b, most) <= true
