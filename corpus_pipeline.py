"""From raw documents to token ids: five stages, each over all its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's result to the
shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm.byte_bpe import decode, encode
from tableloom.llm.common import store, table
from tableloom.llm.decontaminate import keep_clean
from tableloom.llm.near_copies import keep_one
from tableloom.llm.quality import keep_good
from tableloom.llm.secret_scan import mask_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a rule learned from ``labels`` rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: texts linked
    by a Jaccard of 0.8 or more of their five-word shingles, or by SimHashes within two bits."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a near copy of a ``benchmark`` passage."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted again."""
    return mask_secrets(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the digest of the text decoded from them."""
    tokens = decode(encode(docs))
    return tokens.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("data", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None
"""SQL has neither the learned rules, nor XXH64, nor the merges; see tests/llm."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


query = run
