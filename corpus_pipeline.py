"""From documents to packed training sequences: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lensgrove.llm import exact_dedup, langid, mixing, packing, simhash
from lensgrove.llm.common import Workspace


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the model is fitted on labelled rows of the stage's own input.

    Null, empty and letterless texts go, as they have no language; null ids and repeated rows stay if their text does."""
    return langid.keep_identified(docs)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the least id first; rows with a null text all stay."""
    return exact_dedup.exact_dedup(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the least id; null ids, null texts and texts without words stay."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled and repeated so that sources get tokens by their weights; ties go by a seeded hash of the row."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences; repeated rows are packed each."""
    return packing.harmonic_pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("mix", mix_sources),
    ("pack", pack),
]

#: Viterbi, the tries and the flow aren't SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of sf_dir; what a stage returns is written and read again."""
    space = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, space.put(stage(spark, docs, sf_dir))
        space.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
