"""Write derived attributes back to metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

KEYS = ("observation_id", "image_index", "photo_url")


def write_back(metadata: DataFrame, ledger: DataFrame, value: str = "avg_rgb", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """metadata with the ledger's value of successful rows, null where there is none; an older value is replaced.

    Null keys match null keys. A key that the ledger has more than once repeats its metadata row. Metadata without
    a key column, or a ledger without what is needed, leaves metadata as it is.
    """
    if not set(keys) <= set(metadata.columns) or not {*keys, value, "status"} <= set(ledger.columns):
        return metadata
    base = metadata.drop(value)
    new = ledger.where(F.col("status") == "ok").select(*[F.col(k).alias(f"__{k}") for k in keys], value)
    match = [base[k].eqNullSafe(new[f"__{k}"]) for k in keys]
    return base.join(new, match, "left").drop(*[f"__{k}" for k in keys])


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a replace_table() that was cut off between its two renames: the new table if it was whole, else the old."""
    now, fs = _path(spark, path)
    if fs.exists(now):
        return
    for suffix in (".new", ".old"):
        found, _ = _path(spark, path + suffix)
        whole, _ = _path(spark, f"{path}{suffix}/_SUCCESS")
        if fs.exists(whole) or (suffix == ".old" and fs.exists(found)):
            fs.rename(found, now)
            return


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Overwrite a Parquet table that df may be reading: write beside it, then swap. A crash in between leaves the old
    table or a whole new one beside it, and recover_table(), which readers and the next call start with, puts it back."""
    recover_table(spark, path)
    now, fs = _path(spark, path)
    fresh, old = _path(spark, path + ".new")[0], _path(spark, path + ".old")[0]
    df.write.mode("overwrite").parquet(path + ".new")
    fs.delete(old, True)
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(fresh, now)
    fs.delete(old, True)
