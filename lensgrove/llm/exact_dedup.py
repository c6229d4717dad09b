"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, require

SALTS = 16


def exact_dedup(docs: DataFrame, *, text: str = "text", order_by: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row for each distinct content of ``text``; the other columns are those of the kept row.

    Three steps of combining, each by digest *and* full content, so that a digest collision never merges:

    1. local: the map side of the first aggregation deduplicates inside each task, so that a task sends one row a text
       however often it holds that text;
    2. salted: these rows meet in groups of (digest, salt), a task's rows having one salt, so that the copies of any
       text spread over ``salts`` reducers;
    3. global: the winners of the salts are combined; at most ``salts`` rows of a text meet.

    All digests are salted alike, frequent or not. The table is scanned once for these steps, and once for its null
    texts (a scan that Parquet statistics mostly skip).

    Kept is the row with the smallest ``order_by`` (nulls last); ties go to the smaller hash of the whole row (but
    for maps and variants), and rows that tie there as well are taken for repetitions of one row. Null texts are
    unknown content and are all kept; empty texts equal one another; long texts are compared whole. Other columns,
    whatever their names, are carried along. No row is added, and an empty table gives an empty table.
    """
    require(docs, text, order_by)
    rest = [c for c in docs.columns if c != text]
    hashed = [c for c, kind in docs.dtypes if c != text and "map<" not in kind and "variant" not in kind]
    rows = docs.where(col(text).isNotNull()).select(
        F.xxhash64(col(text)).alias("digest"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
        col(text).alias("body"),
        F.struct(
            col(order_by).isNull().alias("n"),
            col(order_by).alias("o"),
            F.xxhash64(*[col(c) for c in hashed]).alias("h"),
            F.struct(*[col(c) for c in rest]).alias("r"),
        ).alias("best"),
    )
    least = F.min_by("best", F.struct("best.n", "best.o", "best.h")).alias("best")
    salted = rows.groupBy("digest", "salt", "body").agg(least)
    winners = salted.groupBy("digest", "body").agg(least)
    kept = [(F.col("body") if c == text else F.col("best.r").getField(c)).alias(c) for c in docs.columns]
    return winners.select(*kept).unionByName(docs.where(col(text).isNull()))
