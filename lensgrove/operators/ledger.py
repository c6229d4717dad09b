"""The ledger of a run: append, read, merge, render."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lensgrove import schemas
from lensgrove.functions import scores_text
from lensgrove.functions.arrays import colours_text
from lensgrove.sources.files import exists


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet ledger; a path that doesn't exist is an empty one."""
    return spark.read.schema(schemas.LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], schemas.LEDGER)


def append(rows: DataFrame, path: str) -> None:
    """Add rows; columns that they lack are null. A failed job adds nothing, as the committer publishes at the end."""
    have = set(rows.columns)
    rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LEDGER.fields]).write.mode("append").parquet(path)


def merge(ledgers: Sequence[DataFrame], keys: Sequence[str] = ("shard", "global_index")) -> DataFrame:
    """Union of shards' ledgers with one row a key: a successful one if there is any, else the first by status."""
    out = ledgers[0]
    for x in ledgers[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    best = W.partitionBy(*keys).orderBy((F.col("status") == "ok").desc_nulls_last(), "status", *[F.asc_nulls_last(c) for c in ("image_relpath", "error") if c in out.columns])
    return out.withColumn("__r", F.row_number().over(best)).where("__r = 1").drop("__r")


def render(ledger: DataFrame) -> DataFrame:
    """Arrays as the delimited texts of a CSV ledger."""
    return ledger.withColumns({"mask_files": F.array_join("mask_files", ";"), "mask_scores": scores_text(F.col("mask_scores")), "avg_rgb": colours_text(F.col("avg_rgb"))})


def errors(ledger: DataFrame) -> DataFrame:
    """One line for each failure, tagged by its kind."""
    tag = F.when(F.col("status") == "dl_failed", "[DL_FAIL]").otherwise("[SEG_FAIL]")
    return ledger.where(F.col("status").isin("dl_failed", "seg_failed")).select(F.concat_ws(" ", tag, F.col("global_index").cast("string"), F.trim(F.coalesce("error", F.lit("")))).alias("value"))


def counters(ledger: DataFrame) -> DataFrame:
    """One row of totals: rows, by status, and instances."""
    return ledger.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "dl_failed").alias("n_dl_failed"),
        F.count_if(F.col("status") == "seg_failed").alias("n_seg_failed"),
        F.coalesce(F.sum("num_instances"), F.lit(0)).cast("bigint").alias("n_instances"),
    )
