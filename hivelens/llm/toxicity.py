"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hivelens.llm.common import appended, bucket_of, texts_of, whole_text
from hivelens.llm.linear import Sparse, fit_nnpu, sigmoid
from hivelens.llm.scan import Words

#: Words and beginnings of words (HEAD bytes) are hashed into so many features.
FEATURES, HEAD = 1 << 18, 4
#: Rows that the classifier is fitted on at most, chosen by a hash of their id.
MOST_POSITIVE, MOST_UNLABELLED = 6_000, 12_000
#: Features that take part, those most tied to the positive rows.
SELECTED = 4_096
#: At least this share of a feature's texts must be toxic, by the prior, for it to take part.
LEAST_SHARE = 0.25
#: Features whose texts are toxic more often than the prior by fewer standard errors take no part; the ridge is divided by the positive rows.
LEAST_Z, RIDGE = 6.0, 0.002
THRESHOLD = 0.7


def features_of(texts: list[bytes], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs present, each once, in order; only features in the mask keep, if given."""
    words = Words(texts, prefix=HEAD)
    half = np.uint64(FEATURES // 2)
    pairs = []
    for h, offset in ((words.hash, 0), (words.head, FEATURES // 2)):
        f = (h % half).astype(np.int64) + offset
        at = slice(None) if keep is None else np.flatnonzero(keep[f])
        pairs.append(words.doc[at] * FEATURES + f[at])
    both = np.unique(np.concatenate(pairs))
    return both // FEATURES, both % FEATURES


def _rows(texts: list[bytes]) -> list[np.ndarray]:
    doc, f = features_of(texts)
    return np.split(f, np.searchsorted(doc, np.arange(1, len(texts)))) if texts else []


@dataclass
class Model:
    """Weight of each feature (0 if it takes no part) and intercept."""

    weight: np.ndarray
    intercept: float
    prior: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        doc, f = features_of(texts, self.weight != 0)
        return sigmoid(np.bincount(doc, weights=self.weight[f], minlength=len(texts)) + self.intercept)


def fit(positive: list[bytes], unlabelled: list[bytes], prior: float) -> Model:
    """A model from toxic texts and texts of any kind, of which a share `prior` is toxic. Without toxic texts it scores 0."""
    if not positive or not unlabelled:
        return Model(np.zeros(FEATURES), -40.0, 0.0)
    p, u = ([r for i in range(0, len(x), 500) for r in _rows(x[i : i + 500])] for x in (positive, unlabelled))
    in_p, in_u = Sparse(p, FEATURES).counts(), Sparse(u, FEATURES).counts()
    share_p, share_u = (in_p + 0.5) / (len(p) + 1), (in_u + 0.5) / (len(u) + 1)
    tied = (share_p - share_u) / np.sqrt(share_u * (1 - share_u) / len(p))
    tied[(in_p < 2) | (share_p * prior < LEAST_SHARE * share_u)] = 0
    chosen = np.argsort(-tied, kind="stable")[:SELECTED]
    chosen = np.sort(chosen[tied[chosen] > LEAST_Z])
    if not len(chosen):
        return Model(np.zeros(FEATURES), float(np.log(prior / (1 - prior))), prior)
    place = np.full(FEATURES, -1)
    place[chosen] = np.arange(len(chosen))
    slim = lambda rows: Sparse([place[r][place[r] >= 0] for r in rows], len(chosen))
    w = fit_nnpu(slim(p), slim(u), prior, ridge=RIDGE / len(p))
    weight = np.zeros(FEATURES)
    weight[chosen] = np.where(w[:-1] == 0, 1e-12, w[:-1])
    return Model(weight, float(w[-1]), prior)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> Model:
    """A model from rows whose crc32(doc_id) mod modulus isn't held_out; of labels only the toxic rows and their share count."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", whole_text().alias("text")).where(bucket_of("doc_id", modulus) != held_out)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(bucket_of("doc_id", modulus) != held_out)
    share = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("k")).first()
    prior = min(0.5, max(1e-3, share["k"] / max(1, share["n"])))
    toxic = known.where("toxic = 1").select("doc_id").distinct()
    some = lambda df, n, seed: df.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n)
    ids = some(toxic, MOST_POSITIVE, 1)
    positive = rows.join(ids, "doc_id", "left_semi").select("text")
    others = rows.join(some(rows.select("doc_id"), MOST_UNLABELLED, 2).distinct(), "doc_id", "left_semi").select("text")
    as_bytes = lambda df: [x or b"" for x in df.toArrow()["text"].cast(pa.large_binary()).to_pylist()]
    return fit(as_bytes(positive), as_bytes(others), prior)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score (0 to 1, the probability of toxicity) and predicted (1 if score >= threshold) of each whole text.

    A missing or empty text has the score of a text without features. Rows are independent: missing or repeated ids and
    ties don't matter. Input columns named score or predicted give way; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts, scores, i = texts_of(batch, text), [], 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n < 1 << 21):
                n += len(texts[j])
                j += 1
            scores.append(shared.value.score(texts[i:j]))
            i = j
        score = np.concatenate(scores) if scores else np.zeros(0)
        return {"score": pa.array(score, pa.float64()), "predicted": pa.array((score >= threshold).astype(np.int32), pa.int32())}

    return appended(docs, lambda: run, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
