"""A corpus from documents: judge, drop near copies, cut repeats, mix sources, pack.

All stages but the last give the columns of ``documents``, whatever others these have.  Null
and empty texts are rejected by the first stage, which asks for 50 words.  Of rows with a null or a
repeated ``doc_id`` each is a document: in the second stage a group keeps one row, in the third rows
of one id are no copies of each other.  A null source is the last source of the mix.  Very long texts
are worked on whole.  A table without rows, or one of which a stage keeps nothing, gives none from
there on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from schemagate.llm import bottomk, mixing, packing, repetition, substrings
from schemagate.storage import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return repetition.passed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    return bottomk.one_of_each(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that one with a smaller id holds as well."""
    return substrings.shortened(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as often as their source's target takes them; the last one taken may be cut."""
    return mixing.taken_rows(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts as token sequences: which piece stands where."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("source mix", source_mix),
    ("best-fit packing", best_fit),
]

ORACLE_SQL = None
"""Suffix arrays, tokenizers and the genetic packing have no SQL; tests compare with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's rows are written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
