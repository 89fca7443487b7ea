"""From documents to tokens: toxicity, near-dedup, substring dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zpoints.llm import bpe, mixing, probminhash, substring, toxicity
from zpoints.llm.common import save, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity grammar does not reject (score below 0.5)."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, similarity 0.8 or more): the one with the least doc_id."""
    return probminhash.drop_near_duplicates(docs, threshold=0.8, k=5)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words under windows of 20 words that start earlier."""
    return substring.remove_repeats(docs, size=20)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each as often as the mix takes it."""
    return mixing.training_order(docs, mixing.mix_sources(docs))


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, one row per row of the mix."""
    import public_tokenizers

    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("mixing", mix_stage),
    ("bpe", tokenize_stage),
]

#: Learned scores, sketches and merges cannot be said in SQL; tests/llm/test_queries.py holds it against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
