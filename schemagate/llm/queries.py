"""One query per operator, named ``opN_<name>``, and its DuckDB counterpart where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemagate.llm import (
    bottomk, hamming, interactions, language, licenses, mixing, packing, positional, ranking, repetition, sharding, substrings, warc,
)
from schemagate.llm.common import documents, stored


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substrings.deduplicated(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(documents(spark, sf_dir).select("doc_id", "text", "source"))
    taken = (F.col("times") * F.col("size") + F.col("part")).alias("taken")
    return mix.select("doc_id", "size", "source_size", "target", taken)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(documents(spark, sf_dir).select("doc_id", "text"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir).select("doc_id", "text"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bottomk.classes(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records against a replica in which every 97th page's neighbours are damaged."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    laid = stored(warc.manifest(pages, {"first": lambda content: content, "second": warc.damaged}), "manifest")
    found = warc.audited(warc.leaves(laid, "first"), warc.leaves(laid, "second")).select("file", "offset", F.col("second").alias("copy"))
    fault = F.when(F.col("copy").isNull(), "lost").otherwise("changed").alias("fault")
    return laid.select("file", "offset", "page_id", "url").join(found, ["file", "offset"]).select("page_id", "url", fault)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.searched(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judged(documents(spark, sf_dir)).drop("longest_repeat")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.searched(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional.decontaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audited(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_source_mix": op3_source_mix,
    "op4_shards": op4_shards,
    "op5_license_scan": op5_license_scan,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_warc_audit": op7_warc_audit,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_decontamination": op12_decontamination,
    "op13_filter_interactions": op13_filter_interactions,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": substrings.ORACLE,
    "op3_source_mix": mixing.ORACLE,
    "op5_license_scan": licenses.ORACLE,
    "op6_near_duplicates": bottomk.ORACLE,
    "op7_warc_audit": warc.ORACLE,
    "op8_exact_top_k": hamming.ORACLE,
    "op9_quality_rules": repetition.ORACLE,
    "op11_ranked_search": ranking.ORACLE,
    "op12_decontamination": positional.ORACLE,
    "op13_filter_interactions": interactions.ORACLE,
}
