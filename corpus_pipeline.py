"""Corpus pipeline: documents that fail the quality rules go, one document of
each near-duplicate group stays, repeated passages are cut from the later
documents, and what is left is packed into training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. ``run`` writes each stage's
result as Parquet to the shared scratch folder and reads it back, so a lost
executor costs part of one stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.common import table, written
from daybook.llm.packing import pack
from daybook.llm.quality import keep_quality
from daybook.llm.simhash import keep_one
from daybook.llm.substring_dedup import dedup_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, unchanged."""
    return keep_quality(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; words of passages that also start in a document with a
    smaller id are cut from ``text``, and ``n_chars`` follows."""
    return dedup_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    import public_tokenizers
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the compression bands, the components or the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
