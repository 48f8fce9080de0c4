"""A quality classifier by co-training of a text view and a metadata view.

The text view sees frequencies of hashed byte trigrams and shares of signs and words of some kinds; the metadata view sees
language, source and stated length and nothing of the text. Both are fitted on labelled rows. In each round each view
scores all unlabelled rows, and the rows it is surest of, in both classes, go to the other view's training rows as
pseudo-labels (unless that view is surer of the opposite), weighted by how much surer it is than the class's share. At
the end both views are calibrated on labelled rows that neither was fitted on, and their calibrated log-odds are combined.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hivelens.llm.common import appended, stage_table, texts_of, whole_text
from hivelens.llm.linear import Logistic, sigmoid
from hivelens.llm.scan import Words, shingles

#: Labelled rows that the classifiers are fitted on at most, half of each class, chosen by a hash of their id.
MOST_LABELLED = 12_000
#: Rounds, and pseudo-labels that a view hands over in each, split as the classes of the labelled rows.
ROUNDS, PER_ROUND = 3, 400
#: Weight of a pseudo-label of a view that is certain.
PSEUDO_WEIGHT = 0.5
WINDOW = 12
THRESHOLD = 0.5
LANGS, SOURCES, TRIGRAMS = 16, 64, 128
_SYMBOL = np.zeros(256)
_SYMBOL[[ord(c) for c in "*#&%$|^~<>{}[]\\_=@"]] = 1
_UPPER, _LOWER, _DIGIT, _END, _HIGH = (np.array([f(i) for i in range(256)], dtype=float) for f in (lambda i: 65 <= i < 91, lambda i: 97 <= i < 123, lambda i: 48 <= i < 58, lambda i: chr(i) in ".!?", lambda i: i >= 128))


def text_features(texts: list[bytes]) -> np.ndarray:
    """A row for each text: shares of signs and words of some kinds, over the text and in its worst run of WINDOW words,
    and square roots of the frequencies of byte trigrams hashed into TRIGRAMS kinds."""
    return np.column_stack([_shares(texts), _trigrams(texts)])


def _trigrams(texts: list[bytes]) -> np.ndarray:
    buf = np.frombuffer(b"".join(x for t in texts for x in (t, b"\0\0")) + b"\0\0", dtype=np.uint8).astype(np.uint32)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    kind = ((buf[:-2] << np.uint32(16) | buf[1:-1] << np.uint32(8) | buf[2:]) * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAMS.bit_length() + 1)
    inside = np.ones(len(kind), dtype=bool)
    ends = np.cumsum(size + 2)
    inside[ends - 1] = inside[ends - 2] = False
    doc = np.repeat(np.arange(len(texts)), size)
    counts = np.bincount(doc * TRIGRAMS + kind[inside], minlength=len(texts) * TRIGRAMS).reshape(-1, TRIGRAMS)
    return np.sqrt(counts / np.maximum(size, 1)[:, None])


def _shares(texts: list[bytes]) -> np.ndarray:
    words = Words(texts, lower=False)
    n = np.diff(words.first)
    many = np.maximum(n, 1)
    out = [np.log1p(n), np.log1p([len(t) for t in texts])]
    if not len(words.start):
        return np.column_stack([*out, *[np.zeros(len(texts))] * 22])
    per = lambda table: np.add.reduceat(table[words.buf], words.start)
    length = (words.end - words.start).astype(float)
    mean = lambda x: np.bincount(words.doc, weights=x, minlength=len(texts)) / many
    symbol, upper, lower, high = per(_SYMBOL), per(_UPPER), per(_LOWER), per(_HIGH)
    same = np.append(False, words.hash[1:] == words.hash[:-1])
    same[words.first[:-1][n > 0]] = False
    odd, loud, digit = symbol > 0, (upper > 1) & (lower == 0), per(_DIGIT) > 0
    shout = np.append(words.buf, 0)[words.end - 1] == ord("!")
    bare = symbol == length
    for flag in (odd, loud, same, shout, bare, digit):
        sums = np.concatenate(([0], np.cumsum(flag)))
        at = np.arange(len(flag))
        last = np.minimum(at + WINDOW, words.first[words.doc + 1])
        run = (sums[last] - sums[at]) / WINDOW
        worst = np.zeros(len(texts))
        np.maximum.at(worst, words.doc, run)
        out += [mean(flag.astype(float)), worst, np.minimum(n, worst * n) > 0.5 * many]
    distinct = np.zeros(len(texts))
    again = np.zeros(len(texts))
    for d in np.flatnonzero(n):
        h = words.hash[words.first[d] : words.first[d + 1]]
        distinct[d] = len(np.unique(h)) / n[d]
        s = shingles(h, 3)
        again[d] = 1 - len(np.unique(s)) / len(s)
    out += [mean(length), mean(high / length), distinct, again]
    return np.column_stack(out)


def metadata_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """A row for each page from its language, source and stated length; nothing of the text."""
    out = np.zeros((len(lang), LANGS + SOURCES + 3))
    for offset, size, values in ((0, LANGS, lang), (LANGS, SOURCES, source)):
        for i, v in enumerate(values):
            out[i, offset + zlib.crc32(str(v).encode()) % size] = 1
    size = np.log1p([max(0, x or 0) for x in n_chars])
    out[:, -3:] = np.column_stack([size, size**2, [x is None for x in n_chars]])
    return out


@dataclass
class Model:
    """Both views, their calibration on rows that they weren't fitted on, and how the calibrated views combine."""

    views: tuple[Logistic, Logistic]
    scale: tuple[np.ndarray, np.ndarray]
    combine: np.ndarray
    exchanged: list[tuple[int, int]] = field(default_factory=list)

    def view(self, k: int, x: np.ndarray) -> np.ndarray:
        """Calibrated logit of a view."""
        return np.clip(self.views[k].logit(x) * self.scale[k][0] + self.scale[k][1], -15, 15)

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return sigmoid(self.combine[0] * self.view(0, text) + self.combine[1] * self.view(1, meta) + self.combine[2])


def _calibrate(logits: np.ndarray, y: np.ndarray, hold: float = 1.0) -> np.ndarray:
    """Factors and shift of logits (one column for each view) that fit the labels.

    Factors aren't negative and are held at 1 as by `hold` rows, so labels that a view tells apart wholly, or not at all,
    leave them finite.
    """
    z = np.column_stack([logits, np.ones(len(logits))])
    w = np.append(np.ones(logits.shape[1]), 0.0)
    pull = np.append(np.full(logits.shape[1], hold), 1e-3)
    goal = w.copy()
    for _ in range(50):
        p = sigmoid(z @ w)
        grad = z.T @ (p - y) + pull * (w - goal)
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(pull)
        delta = np.linalg.solve(h, grad)
        w = w - delta * min(1.0, 2.0 / (np.abs(delta).max() + 1e-12))
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(delta).max() < 1e-6:
            break
    return w


class CoTraining:
    """Both views on labelled rows, a quarter of which is set aside for calibration, and the pseudo-labels of either."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray):
        aside = np.arange(len(y)) % 4 == 3
        if len(np.unique(y[~aside])) < 2 or len(np.unique(y[aside])) < 2:
            aside = np.zeros(len(y), dtype=bool)
        self.calibrating = aside if aside.any() else np.ones(len(y), dtype=bool)
        self.fitting, self.x, self.y = ~aside, (text, meta), y
        self.extra: tuple[list, list] = ([], [])
        self.exchanged: list[tuple[int, int]] = []
        self._fit()

    def _fit(self) -> None:
        views, scale = [], []
        for v in (0, 1):
            xs, ys, ws = (np.concatenate([own, *(e[j] for e in self.extra[v])]) for j, own in enumerate((self.x[v][self.fitting], self.y[self.fitting], np.ones(self.fitting.sum()))))
            views.append(Logistic().fit(xs, ys, ws))
            scale.append(_calibrate(views[v].logit(self.x[v][self.calibrating])[:, None], self.y[self.calibrating]))
        self.model = Model(tuple(views), tuple(scale), np.zeros(3), self.exchanged)

    def share(self) -> float:
        """The share of good rows among the labelled ones."""
        return float(self.y.mean())

    def hand_over(self, picked: list[list[tuple[np.ndarray, np.ndarray, float, float]]]) -> None:
        """A round: picked[v] are rows (text, metadata, label, sureness) that view v labels for the other; both are fitted again."""
        for v in (0, 1):
            rows = picked[v]
            if rows:
                self.extra[1 - v].append((np.array([r[1 - v] for r in rows]), np.array([r[2] for r in rows]), PSEUDO_WEIGHT * np.array([(r[3] - b) / (1 - b) for r in rows for b in (self.y.mean() if r[2] else 1 - self.y.mean(),)])))
        self.exchanged.append((len(picked[0]), len(picked[1])))
        self._fit()

    def finish(self) -> Model:
        """The model with both calibrated views combined."""
        m = self.model
        both = np.column_stack([m.view(v, self.x[v][self.calibrating]) for v in (0, 1)])
        m.combine = _calibrate(both, self.y[self.calibrating])
        return m


def _metadata(docs: DataFrame) -> list:
    """lang, source and n_chars; columns that docs lacks are missing values."""
    have = {c.lower() for c in docs.columns}
    return [(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    get = lambda c: batch.column(c).to_pylist()
    return _grouped(texts_of(batch)), metadata_features(get("lang"), get("source"), get("n_chars"))


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> Model | None:
    """A model from labels.quality of documents; None unless both labels occur.

    Features of all rows with an id are worked out once, on executors, and staged. At most MOST_LABELLED labelled rows come
    to the driver, as numbers; all other rows are scored in each round where they lie, and the per_round rows that a view
    is surest of (ties by a hash of the id) come too. Missing texts are empty, missing metadata is a value of its own;
    rows with a missing id take no part; of repeated ids one row does; a document with both labels counts as good. Other
    columns don't matter. Empty tables give None.
    """
    wide, spark = TRIGRAMS + 24, docs.sparkSession
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *_metadata(docs))
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        text, _ = _vectors(batch)
        return {"vector": pa.array([v.tobytes() for v in text.astype("<f4")], pa.binary())}

    made = appended(rows, lambda: run, [T.StructField("vector", T.BinaryType())]).drop("text")
    table = stage_table(made.join(known, "doc_id", "left"), "features")
    mine = table.where("quality is not null").dropDuplicates(["doc_id"])
    some = lambda q: mine.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(MOST_LABELLED // 2)
    labelled = some(0).unionByName(some(1)).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    y = np.array(labelled["quality"].to_pylist(), dtype=float)
    if len(np.unique(y)) < 2:
        return None
    vectors = lambda t: (np.frombuffer(b"".join(t["vector"].to_pylist()), dtype="<f4").reshape(-1, wide).astype(float), metadata_features(t["lang"].to_pylist(), t["source"].to_pylist(), t["n_chars"].to_pylist()))
    training = CoTraining(*vectors(labelled), y)
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    free, given = table.where("quality is null"), []
    for _ in range(rounds):
        shared, share = spark.sparkContext.broadcast(training.model), training.share()

        def surest(batch: pa.RecordBatch, shared=shared) -> dict[str, pa.Array]:
            x = vectors({c: batch.column(c) for c in ("vector", "lang", "source", "n_chars")})
            return {f"p{v}": pa.array(sigmoid(shared.value.view(v, x[v])), pa.float64()) for v in (0, 1)}

        scored = appended(free, lambda f=surest: f, [T.StructField(f"p{v}", T.DoubleType()) for v in (0, 1)])
        if given:  # at most 2 * rounds * per_round ids
            scored = scored.where(~F.col("doc_id").isin(given))
        # The surest rows of either view and class, first from each task's rows, then of all.
        says = lambda v, good: F.col(f"p{v}") if good else 1 - F.col(f"p{v}")
        by = lambda v, good: F.struct(says(v, good).alias("sure"), says(1 - v, 1 - good).alias("against"), F.xxhash64("doc_id").alias("tie"), *[F.col(c) for c in ("doc_id", "vector", "lang", "source", "n_chars")])
        count = lambda good: max(1, round(per_round * (share if good else 1 - share)))
        most = scored.select(F.explode(F.array(*[F.struct(F.lit(2 * v + good).alias("k"), by(v, good).alias("row")) for v in (0, 1) for good in (0, 1)])).alias("e")).select("e.k", "e.row").where("row.sure > row.against")
        top = max(count(0), count(1))
        order = [F.col("row.sure").desc(), "row.tie", "row.doc_id"]
        most = most.withColumn("rank", F.row_number().over(Window.partitionBy("k", F.pmod(F.col("row.tie"), F.lit(64))).orderBy(*order))).where(F.col("rank") <= top)
        best = most.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order))).where(F.col("rank") <= top).orderBy("k", "rank").toArrow().to_pylist()
        picked: list[list] = [[], []]
        for r in best:
            v, good = divmod(r["k"], 2)
            row = r["row"]
            if r["rank"] <= count(good) and row["sure"] > (share if good else 1 - share):
                text, meta = vectors(pa.Table.from_pylist([row], schema=pa.schema([("vector", pa.binary()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])))
                picked[v].append((text[0], meta[0], float(good), row["sure"]))
                given.append(row["doc_id"])
        training.hand_over(picked)
    model = training.finish()
    shift = np.log(max(1, sizes.get(1, 1)) / max(1, sizes.get(0, 1))) - np.log(max(1, y.sum()) / max(1, len(y) - y.sum()))
    model.combine[2] += shift  # the sample holds as many rows of either label as there are; the tables don't
    return model


def _grouped(texts: list[bytes]) -> np.ndarray:
    parts, i = [], 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n < 1 << 20):
            n += len(texts[j])
            j += 1
        parts.append(text_features(texts[i:j]))
        i = j
    return np.vstack(parts) if parts else text_features([b""])[:0]


def score_quality(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """docs with p_text, p_meta (calibrated views), quality_score (both combined) and keep (score >= threshold).

    Whole texts are looked at; missing texts are empty, missing metadata is a value of its own. Rows are independent, so
    missing or repeated ids and ties don't matter. Without a model (labels of one kind only) scores are missing and all
    rows are kept. Input columns of these names give way; an empty table stays empty.
    """
    fields = [T.StructField(n, T.DoubleType()) for n in ("p_text", "p_meta", "quality_score")] + [T.StructField("keep", T.BooleanType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers
    have = {c.lower() for c in docs.columns}

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        m, n = shared.value, batch.num_rows
        if m is None:
            return {f: pa.nulls(n, pa.float64()) for f in ("p_text", "p_meta", "quality_score")} | {"keep": pa.array([True] * n, pa.bool_())}
        get = lambda c: batch.column(c).to_pylist() if c in have else [None] * n
        text, meta = _grouped(texts_of(batch)), metadata_features(get("lang"), get("source"), get("n_chars"))
        score = m.score(text, meta)
        return {"p_text": pa.array(sigmoid(m.view(0, text))), "p_meta": pa.array(sigmoid(m.view(1, meta))), "quality_score": pa.array(score), "keep": pa.array(score >= threshold, pa.bool_())}

    return appended(docs, lambda: run, fields)
