"""A stream of pages into tables, exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lensgrove.operators.worklist import explode_photos
from lensgrove.sources.paged import register


def read_pages(spark: SparkSession, **options: str) -> DataFrame:
    """The paged source as a stream; its offset is the last id, kept in the query's checkpoint."""
    register(spark)
    return spark.readStream.format("paged_observations").options(**options).load()


def photo_rows(observations: DataFrame, *more: str) -> DataFrame:
    """Metadata rows: observation and taxon fields beside each photo's, and columns that are asked for besides; missing
    values are null."""
    flat = explode_photos(observations)
    return flat.select(
        F.col("id").alias("observation_id"),
        "quality_grade",
        "observed_on",
        F.col("user.login").alias("user_login"),
        F.col("taxon.id").alias("taxon_id"),
        F.col("taxon.name").alias("taxon_name"),
        "photo_pos",
        F.col("photo.id").alias("photo_id"),
        F.col("photo.url").alias("photo_url"),
        F.col("photo.original_url").alias("original_url"),
        *more,
    )


def append_batches(stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = photo_rows) -> StreamingQuery:
    """Write each micro-batch to its own folder of a Parquet table; a batch that is run again replaces its folder, so
    every row is there once. Stops when the source has no more."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def ledger_counts(events: DataFrame, at: str = "ts", status: str = "event_type", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows by window and status, with a watermark; an extension, for ledgers that arrive as events."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), F.col(status).alias("status")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "status", "n")
