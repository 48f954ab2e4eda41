"""The corpus pipeline: stages that each keep or change whole documents.

Every stage takes documents with an id, a text and any further columns, may get an empty
table, and keeps rows of null id apart from those that have one. Null and empty texts
fail the quality rules of the first stage; the later ones would keep them. Repeated rows are judged alike
and stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrametry.llm import bpe, decontaminate, jaccard, quality, secrets
from terrametry.session import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null, empty and very short texts go. Without labels only the base rules reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies; documents without words or id stay."""
    return jaccard.one_per_group(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; an empty benchmark, or a null or empty text, has none."""
    return decontaminate.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def safe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and ``n_chars``, if there, counted anew; null texts stay null."""
    safe = secrets.redact(docs)
    return safe.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else safe


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of all documents; null and empty texts have no ids."""
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", good_documents),
    ("jaccard_join", distinct_documents),
    ("benchmark_decontamination", clean_documents),
    ("secret_scans", safe_documents),
    ("bpe", encoded_documents),
]
#: No SQL says the same: the last stage encodes texts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
