"""A training corpus from the documents table: language, near duplicates, secrets, mix, packing.

Each stage takes (spark, docs, sf_dir) and calls one operator of ``changeflow.llm`` on all its
predecessor kept; all but the last return the columns of documents. :func:`run` writes each
stage's rows as Parquet in the shared folder and reads them as the next one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import crf, mix, pack, secrets, simhash
from changeflow.llm.common import cut, read
from changeflow.llm.queries import JSON, RANKS

LEAST_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language go on; those without letters, or without a leading language, go."""
    return crf.keep_identified(docs, LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the least doc_id."""
    return simhash.dedup(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secrets.redact_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: never, once or twice."""
    return mix.mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents with their sequences and offsets."""
    return pack.pack(docs.select("doc_id", "text"), JSON, RANKS)


STAGES = [("language_id", language), ("simhash_dedup", near_duplicates), ("secret_scan", secret_scan),
          ("source_mix", mixture), ("best_fit_packing", packing)]

#: No SQL can express the CRF, nor the packing; tests/llm hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
