"""The corpus pipeline: quality filter, near-duplicate removal, decontamination, redaction of personal data, BPE ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hivelens.llm import bpe_tree, decontamination, jaccard, pii, quality
from hivelens.llm.common import read_table, stage_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier, fitted on the labelled ones among them, rejects."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of the Jaccard join, and repeated rows once.

    Rows without id stay, as nothing tells which of them would; rows with equal ids and different texts are different documents.
    """
    found = stage_table(jaccard.similar_components(docs), "components")
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(again)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, its values changed or not."""
    found = decontamination.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the text by marks of its kind; n_chars follows."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_tree.bpe_encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("encode", encode),
]

#: Classifiers, tokenizers and set joins by hashes have no SQL form; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table through all stages; what each returns is written into the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
