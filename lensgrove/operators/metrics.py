"""Run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_counters(rows: DataFrame, status: str = "status") -> DataFrame:
    """(status, n) for each status."""
    return rows.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def page_totals(rows: DataFrame, page: str = "page", key: str = "id") -> DataFrame:
    """For each page: distinct keys, rows, and both as running totals; pages are few, so they are ordered in one place."""
    from pyspark.sql import Window as W

    per = rows.groupBy(page).agg(F.count_distinct(key).alias("n_keys"), F.count("*").alias("n_rows"))
    upto = W.orderBy(page).rowsBetween(W.unboundedPreceding, W.currentRow)
    return per.select(page, "n_keys", "n_rows", F.sum("n_keys").over(upto).alias("keys_so_far"), F.sum("n_rows").over(upto).alias("rows_so_far"))


def last_key(rows: DataFrame, group: str, order: str, key: str = "id") -> DataFrame:
    """The last key of each group in the given order; null keys are passed over."""
    return rows.where(F.col(key).isNotNull()).groupBy(group).agg(F.max_by(key, order).alias("last_key"))


def first_event(events: DataFrame, group: str, code: str, at: str, order: list[str]) -> DataFrame:
    """(group, code, first_at): time of the first event of each code in each group."""
    return events.groupBy(group, code).agg(F.min_by(at, F.struct(*order)).alias("first_at"))


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double, null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def kpis(images: DataFrame, wall_seconds: float, busy_seconds: float, bytes_out: int = 0, load_seconds: float = 0.0) -> DataFrame:
    """(metric, value) of a run; images: (observation_id, scores array), an empty array where nothing was found.

    The mean over observations is the mean of their mean confidences, observations without a detection left out.
    """
    rows = images.select("observation_id", F.coalesce("scores", F.array().cast("array<double>")).alias("scores"))
    per_image = rows.withColumn("n", F.size("scores")).withColumn("total", F.aggregate("scores", F.lit(0.0), lambda a, x: a + x))
    whole = per_image.agg(
        F.count("*").alias("images"),
        F.count_if(F.col("n") > 0).alias("hits"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("masks"),
        F.sum("total").alias("sum_score"),
        F.avg(F.when(F.col("n") > 0, F.col("total") / F.col("n"))).alias("image_mean"),
    )
    middle = rows.select(F.explode("scores").alias("s")).agg(F.median("s").alias("median_score"))
    by_obs = per_image.groupBy("observation_id").agg(F.avg(F.when(F.col("n") > 0, F.col("total") / F.col("n"))).alias("m")).agg(F.count("*").alias("observations"), F.avg("m").alias("obs_mean"))
    one = whole.crossJoin(middle).crossJoin(by_obs)  # one row each
    wall, busy = F.lit(float(wall_seconds)), F.lit(float(busy_seconds))
    c = F.col
    values = {
        "images": c("images"),
        "with_detection": c("hits"),
        "without_detection": c("images") - c("hits"),
        "detection_rate_pct": ratio(c("hits"), c("images")) * 100,
        "masks": c("masks"),
        "masks_per_hit": ratio(c("masks"), c("hits")),
        "mean_score": ratio(c("sum_score"), c("masks")),
        "median_score": c("median_score"),
        "mean_score_per_image": c("image_mean"),
        "wall_s": wall,
        "busy_s": busy,
        "busy_pct": ratio(busy, wall) * 100,
        "images_per_s": ratio(c("images"), wall),
        "images_per_busy_s": ratio(c("images"), busy),
        "mb_per_image": ratio(F.lit(bytes_out), c("images")) / 1e6,
        "load_s": F.lit(float(load_seconds)),
        "observations": c("observations"),
        "images_per_observation": ratio(c("images"), c("observations")),
        "mean_score_per_observation": c("obs_mean"),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()])
    return one.select(F.explode(pairs).alias("p")).select("p.metric", "p.value")


def transfer_metrics(n_bytes: int, seconds: float) -> dict[str, float | None]:
    """Size and speed of a build or a transfer; a GB is 1e9 bytes, and no time gives no speed."""
    return {"bytes": n_bytes, "gb": n_bytes / 1e9, "seconds": round(seconds, 3), "minutes": seconds / 60, "mb_per_s": n_bytes / 1e6 / seconds if seconds > 0 else None}


def folder_bytes(spark, path: str) -> int:
    """Bytes under a path of any file system that Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
