"""The registered queries of this subpackage, opN_<name>, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hivelens.llm.common import bucket_of, read_table


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.lm_scoring import score_texts

    return score_texts(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.decontamination import find_contamination

    return find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.bpe_tree import bpe_encode

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False).drop("text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.quality import score_quality, train

    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", "p_text", "p_meta", "quality_score", "keep")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.toxicity import score_toxicity, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", (bucket_of("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op6_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.bitplane import bitplane_digests, write_bitplanes

    docs = read_table(spark, sf_dir, "documents")
    return bitplane_digests(write_bitplanes(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.pii import pii_digest

    return pii_digest(read_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.jaccard import similar_components

    return similar_components(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.token_counts import count_tokens, write_flat

    end_id = 65_535
    files, places = write_flat(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id)
    return count_tokens(files, end_id).join(places, ["shard", "ordinal"]).select("doc_id", "shard", "ordinal", "start", "n_tokens")


def op10_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hivelens.llm.media_ts import encode_media, media_features

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return media_features(encode_media(docs)).drop("text", "media")


QUERIES = {
    f.__name__: f
    for f in (op1_ppm, op2_decontamination, op3_bpe, op4_quality, op5_toxicity, op6_bitplanes, op7_pii, op8_jaccard_join, op9_token_counts, op10_transport_stream)
}
ORACLE: dict[str, str] = {
    "op8_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, (SELECT min(y) FROM reach WHERE x = doc_id))::BIGINT AS component_id FROM sets
""",
}
