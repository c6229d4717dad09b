"""The operators of this subpackage, applied to whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, langid, licenses, mixing, packing, quality, sharding, simhash, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, mix_source, mix_copy) for each time that a document is taken."""
    return mixing.mix(_table(spark, sf_dir, "documents"), labelled=True).select("doc_id", "mix_source", "mix_copy")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op5_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_harmonic_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_pack(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(urls.LIST, "entry string, day string, action string")
    listing = rows.select("entry", F.col("day").cast("timestamp_ntz").alias("listed_at"), "action")
    return urls.filter_urls(urls.with_fetch_time(_table(spark, sf_dir, "pages")), listing)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_mix_sources, op2_toxicity, op3_license_scan, op4_shard_documents, op5_language_spans, op6_harmonic_pack, op7_exact_dedup, op8_quality_rules, op9_url_filter, op10_simhash_near_dedup)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    """Operators 1, 2, 4, 5 and 10 solve a flow, train, iterate or search; tests/llm holds them against brute force."""
    return {
        "op3_license_scan": licenses.scan_licenses_sql(),
        "op6_harmonic_pack": packing.harmonic_pack_sql(),
        "op7_exact_dedup": """
            SELECT doc_id, text, lang, source, n_chars FROM (
              SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) AS r FROM documents
            ) WHERE r = 1 OR text IS NULL""",
        "op8_quality_rules": quality.quality_filter_sql(),
        "op9_url_filter": urls.filter_urls_sql(),
    }
