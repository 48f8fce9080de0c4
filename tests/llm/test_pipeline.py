import random

import pytest
import tiktoken
import base64

import public_tokenizers as P

import corpus_pipeline
from hivelens.llm.common import stage_table
from tests.llm.test_jaccard import shingle_set

WORDS = [f"{a}{b}" for a in "river stone garden yellow window morning travel market paper silver".split() for b in ("", "s", "ed", "ing", "er")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(tmp, spark):
    rng, rows = random.Random(8), []
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."
    bench = [(i, prose(30)) for i in range(4)]
    for i in range(400):
        text = prose(rng.randint(30, 90))
        if i % 5 == 0:
            text = "\n".join([text, " ".join(w + "***" for w in prose(40).split())])
        if i % 40 == 1:
            text = f"{prose(10)} {bench[i % 4][1]} {prose(10)}"
        if i % 40 == 2:
            text = f"{text} Write to anna.b{i}@mail.example.com now."
        if i % 40 == 3:
            text = rows[-1][1].replace("now", "soon")
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows.append((900, rows[17][1], "en", "s0", len(rows[17][1])))
    rows += [(901, None, None, None, None), (902, "", "en", "s0", 0)]
    labels = [(i, int(i % 5 != 0), 0) for i in range(400) if i % 3]
    folder = str(tmp)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {r[0]: r[1] for r in rows}, bench


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder, texts, bench = make(tmp_path_factory.mktemp("pipe") / "in", spark)
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage_table(stage(spark, docs, folder), name)
        out.append(docs)
    return folder, texts, bench, out


def texts_after(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(steps, spark):
    folder, _, _, out = steps
    for df in out[:-1]:
        assert df.dtypes == spark.read.parquet(f"{folder}/documents.parquet").dtypes


def test_quality_drops_junk_and_keeps_the_rest(steps):
    _, texts, _, out = steps
    kept = texts_after(out[0])
    junk = {i for i, t in texts.items() if t and "***" in t}
    clean = {i for i, t in texts.items() if t and "***" not in t}
    assert len(junk & set(kept)) <= 0.02 * len(junk) and len(clean - set(kept)) <= 0.02 * len(clean)


def test_one_of_each_group_stays(steps):
    _, _, _, out = steps
    before, after = texts_after(out[0]), texts_after(out[1])
    sets = {i: shingle_set(t) for i, t in before.items()}
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
    assert set(after) == {root(i) for i in ids} and 900 not in after


def test_benchmark_passages_go(steps):
    _, _, bench, out = steps
    before, after = texts_after(out[1]), texts_after(out[2])
    held = {i for i, t in before.items() if t and any(b in t for _, b in bench)}
    assert held and set(before) - set(after) == held


def test_personal_data_is_hidden(steps):
    _, _, _, out = steps
    before, after = texts_after(out[2]), texts_after(out[3])
    changed = {i for i in before if before[i] != after[i]}
    assert changed == {i for i, t in before.items() if t and "@" in t} and all("[EMAIL]" in after[i] and "@" not in after[i] for i in changed)
    assert all(r.n_chars == len(r.text) for r in out[3].collect() if r.text is not None)


def test_encoding_of_what_is_left(steps, spark):
    folder, _, _, out = steps
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = texts_after(out[3])
    assert {r.doc_id: r.ids for r in out[4].collect()} == {i: enc.encode_ordinary(t or "") for i, t in texts.items()}
    assert corpus_pipeline.run(spark, folder).count() == out[4].count()


def test_repeated_rows_stay_once(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(5, text, "en", "s", 1), (5, text, "en", "s", 1), (7, text, "en", "s", 1), (8, "other words here", None, None, None), (None, text, "en", "s", 1)], SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [5, 8, None]
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
