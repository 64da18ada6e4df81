"""A corpus pipeline made of the operators: each stage works on all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes every
stage's result as Parquet below the scratch folder and reads it again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard, language, packing, quality, secret_scan
from millrace.llm.runtime import documents, ready
from millrace.llm.tokens import tokenizer_path
from millrace.session import staged

#: Workers serve all stages one after the other, so packing remembers less than it would by itself.
REMEMBERED_BYTES = 96 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; others go, and texts without a letter."""
    ready(spark)
    return language.keep_identified(docs, language.fit_profiles(docs))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees."""
    ready(spark)
    return quality.keep_good(docs, quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-equal ones."""
    ready(spark)
    return jaccard.keep_first(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    ready(spark)
    return secret_scan.redact(docs, secret_scan.fit_models(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents in sequences of 2048 tokens."""
    ready(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), remembered=REMEMBERED_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", remove_secrets),
    ("packing", pack),
]

#: SQL cannot express the stages; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(ready(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
