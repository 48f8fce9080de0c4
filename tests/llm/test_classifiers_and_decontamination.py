import random
import zlib

import numpy as np
import pytest

from hivelens.llm import quality, toxicity
from hivelens.llm.decontamination import NAME, NUMBER, UNIT, Templates, find_contamination
from hivelens.llm.linear import Logistic, Sparse, fit_nnpu, sigmoid
from tests.llm.fixtures import TEXTS, empty, frame

WORDS = "river stone garden yellow window morning travel market paper silver forest bridge candle winter summer letter harbor meadow copper violin".split()
BAD = ["grobnax", "snivelwit", "muckhead"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def test_nnpu_recovers_the_sign_of_features():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    rows = [np.array(sorted({0 if t else 1, *rng.integers(2, 30, 3)})) for t in y]
    w = fit_nnpu(Sparse([r for r, t in zip(rows, y) if t][:300], 30), Sparse(rows, 30), 0.2)
    p = sigmoid(Sparse(rows, 30).times(w[:-1]) + w[-1])
    assert ((p > 0.5) == y).mean() > 0.99


def make_documents(spark, n=900):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        toxic, junk = rng.random() < 0.15, rng.random() < 0.25
        text = prose(rng, rng.randint(20, 80))
        if toxic:
            text += " " + " ".join(rng.choice(BAD) for _ in range(4)) + " " + prose(rng, 10)
        if junk:
            text = "\n".join([text, *[" ".join(rng.choice(WORDS) + "***" for _ in range(40))]])
        rows.append((i, text, "en", f"s{i % 5}", len(text)))
        if rng.random() < 0.6:
            labels.append((i, int(not junk), int(toxic)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = make_documents(spark)
    return docs.cache(), labels.cache()


def test_toxicity_on_held_out_rows(spark, corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert len(got) == 900 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert np.mean([got[i].predicted == t for i, t in truth.items()]) > 0.97
    assert (toxicity.train(docs.drop("lang", "source"), labels).weight == model.weight).all()


def test_toxicity_ignores_held_out_labels(spark, corpus):
    docs, labels = corpus
    held = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"
    flipped = labels.selectExpr("doc_id", "quality", f"case when {held} then 1 - toxic else toxic end as toxic")
    assert (toxicity.train(docs, labels).weight == toxicity.train(docs, flipped).weight).all()


def test_toxicity_on_awkward_rows(spark, corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    rows = toxicity.score_toxicity(frame(spark), model).collect()
    assert len(rows) == len(TEXTS) and all(r.score is not None for r in rows)
    assert toxicity.score_toxicity(empty(spark), model).count() == 0
    none = toxicity.train(empty(spark), labels.limit(0))
    assert all(r.predicted == 0 for r in toxicity.score_toxicity(frame(spark), none).collect())


def test_quality_on_rows_without_label(spark, corpus):
    docs, labels = corpus
    known = {r.doc_id for r in labels.collect()}
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    truth = [("***" not in r.text, r.keep) for r in rows if r.doc_id not in known]
    assert len(truth) > 200 and np.mean([a == b for a, b in truth]) > 0.98
    assert any(a for a, _ in model.exchanged)


def auc(score, truth):
    order = np.argsort(np.argsort(score)) + 1.0
    truth = np.array(truth, dtype=bool)
    return (order[truth].sum() - truth.sum() * (truth.sum() + 1) / 2) / (truth.sum() * (~truth).sum())


def test_both_views_hand_labels_over_and_learn(spark):
    rng, rows, labels = random.Random(8), [], []
    for i in range(1500):
        good = rng.random() < 0.6
        text = prose(rng, rng.randint(10, 40)) if good else " ".join(rng.choice(WORDS)[::-1] for _ in range(rng.randint(10, 40)))
        rows.append((i, text, "en", rng.choice("abcd" if good else "cdef"), len(text)))
        if i % 15 == 0:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), per_round=100)
    assert all(a > 0 and b > 0 for a, b in model.exchanged), model.exchanged
    assert (np.abs(model.combine) < 10).all() and all(0 <= s[0] < 5 for s in model.scale)
    got = [r for r in quality.score_quality(docs, model).collect() if r.doc_id % 15]
    truth = [not r.text.islower() for r in got]
    assert auc([r.p_text for r in got], truth) > 0.95 and auc([r.p_meta for r in got], truth) > 0.75
    assert auc([r.quality_score for r in got], truth) > 0.97


def test_quality_without_metadata_columns_and_with_repeats(spark, corpus):
    docs, labels = corpus
    bare = docs.select("doc_id", "text", docs.source.alias("vector"), docs.n_chars.alias("p0"))
    model = quality.train(bare.unionByName(bare.limit(50)), labels.unionByName(labels.limit(50)))
    rows = quality.score_quality(bare, model).collect()
    assert len(rows) == 900 and np.mean([("***" not in r.text) == r.keep for r in rows]) > 0.97
    assert quality.train(docs.limit(0), labels) is None and quality.train(docs, labels.limit(0)) is None


def test_quality_on_awkward_rows(spark, corpus):
    docs, labels = corpus
    model = quality.train(docs, labels)
    wide = frame(spark).selectExpr("doc_id", "text", "lang", "cast(null as string) as source", "cast(null as long) as n_chars", "'x' as keep")
    rows = quality.score_quality(wide, model).collect()
    assert len(rows) == len(TEXTS) and all(isinstance(r.keep, bool) and 0 <= r.quality_score <= 1 for r in rows)
    assert quality.score_quality(wide.limit(0), model).count() == 0
    one_kind = quality.train(docs, labels.where("quality = 1"))
    assert one_kind is None and all(r.keep for r in quality.score_quality(wide, one_kind).collect())


def test_text_features_do_not_depend_on_the_batch():
    texts = [(t or "").encode() for t in TEXTS]
    together = quality.text_features(texts)
    alone = np.vstack([quality.text_features([t]) for t in texts])
    assert np.allclose(together, alone)
    features = [toxicity.features_of([t])[1].tolist() for t in texts]
    doc, f = toxicity.features_of(texts)
    assert [f[doc == i].tolist() for i in range(len(texts))] == features


def test_logistic_separates():
    x = np.random.default_rng(1).normal(size=(500, 3))
    y = (x[:, 0] > 0).astype(float)
    assert ((Logistic().fit(x, y).logit(x) > 0) == y).mean() > 0.97


ITEM = "A train leaves Boston at 9.30 and travels 120 km to meet Alice Smith near the old bridge before 45 minutes pass"


def contaminated(spark, docs, items=(ITEM,), **more):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in find_contamination(d, b, **more).collect()}


def test_template_kinds():
    t = Templates(["He paid 5kg and 12.5 % to Mr Jones Brown in 1,000 days. Then New York slept 7%".encode()])
    assert [int(x) for x in t.slot if x] == [NUMBER, UNIT, NUMBER, NAME, NUMBER, UNIT, NAME, NUMBER, UNIT]


@pytest.mark.parametrize("most", [0, 1000])
def test_reparameterised_items_are_found(spark, most):
    other = ITEM.replace("Boston", "Chicago").replace("9.30", "7.15").replace("120 km", "88 mi").replace("Alice Smith", "Bob Jones").replace("45", "30")
    rng = random.Random(2)
    docs = [prose(rng, 50), f"{prose(rng, 20)} {ITEM}. {prose(rng, 20)}", f"{prose(rng, 9)}\n{other}", ITEM[: len(ITEM) // 3], None, ""]
    got = contaminated(spark, docs, most_broadcast=most)
    assert set(got) == {(1, 0), (2, 0)}
    assert got[1, 0].same_values and not got[2, 0].same_values and got[2, 0].coverage >= 0.6


def test_slots_must_be_consistent(spark):
    item = "when Anna gives 3 of the green apples to Bert then Anna keeps the rest while Bert eats what Anna gave"
    same = item.replace("Anna", "Carla").replace("Bert", "Dario")
    mixed = "when Carla gives 3 of the green apples to Dario then Emil keeps the rest while Fred eats what Gwen gave"
    merged = item.replace("Bert", "Anna")
    assert set(contaminated(spark, ["so " + same, "so " + mixed, "so " + merged], ["so " + item])) == {(0, 0)}


def test_contamination_of_awkward_rows(spark):
    bench = spark.createDataFrame([(0, None), (1, ""), (2, "short one"), (3, "The cat sat. The cat sat."), (3, "The cat sat. The cat sat.")], "item_id long, text string")
    got = find_contamination(frame(spark), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(4, 3), (5, 3)}
    assert find_contamination(empty(spark), bench).count() == find_contamination(frame(spark), bench.limit(0)).count() == 0
    null_id = frame(spark).selectExpr("cast(null as long) as doc_id", "text", "1 as item_id")
    assert [r.doc_id for r in find_contamination(null_id, bench).collect()] == [None]


@pytest.mark.parametrize("most", [0, 1000])
def test_copies_in_another_case_are_found(spark, most):
    german = "Im März fährt Jürgen Groß 12 km nach Überlingen, weil dort die Straße zum großen See für 3 Tage offen ist"
    copies = [c(x) for x in (ITEM, german) for c in (str.upper, str.lower, str.title)]
    rng = random.Random(5)
    got = contaminated(spark, [f"{prose(rng, 20)} {c} {prose(rng, 20)}" for c in copies] + [prose(rng, 60).upper()], [ITEM, german], most_broadcast=most)
    assert set(got) == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1)}
    assert all(r.same_values for r in got.values())


@pytest.mark.parametrize("most", [0, 1000])
def test_items_of_few_words_are_found_with_their_values(spark, most):
    items = ["What is 12 + 7 - 3 + 5 * 2?", "What is 2 + 2?", "Sum 3 8 15 4 99 27 6 51 kg of 17 30 42 18 5 and 64 23 11 7", "Who is Ada Byron?"]
    rng = random.Random(6)
    docs = [f"{prose(rng, 20)} {x} {prose(rng, 20)}" for x in items] + [prose(rng, 40), "What is 13 + 7 - 3 + 5 * 2?", "What is 2 + 3?"]
    got = contaminated(spark, docs, items, most_broadcast=most)
    assert set(got) == {(i, i) for i in range(len(items))}
    assert all(r.same_values and r.coverage == 1 for r in got.values())


def test_equal_values_beside_changed_ones(spark):
    item = "12 7 3 5 2 9 4 1 are the lengths of the long boards that the old carpenter cut into 12 pieces for the barn"
    doc = "so 12 7 3 5 2 9 4 1 are the lengths of the long boards that the old carpenter cut into 30 pieces for the barn"
    assert contaminated(spark, [doc], [item])[0, 0].coverage == 1
