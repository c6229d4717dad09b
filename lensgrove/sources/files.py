"""Files: tab-separated dumps, the index, CSV with quoted newlines, JSON documents, logs, images, and a census."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _system(spark: SparkSession, path: str):
    """A path's file system, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, in any file system that Spark knows, exists."""
    system, where = _system(spark, path)
    return system.exists(where)


def local(path: str) -> str:
    """The path of a mounted file system that all executors share; object stores have none (ValueError)."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: mount it, or write to a shared folder and move it with sources.files")
    return path


def scratch(spark: SparkSession) -> str:
    """A new folder's path under the shared folder that the session names in spark.checkpoint.dir; only a local master
    may do without, and has a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lensgrove-")
    return f"{base}/files-{uuid.uuid4().hex}"


def read_dump(spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None) -> DataFrame:
    """A gzip or plain tab-separated dump with a header; all columns are strings, unquoted empty fields are null.

    A gzip file can't be split, so one large file is spread over ``partitions`` after the scan.
    """
    out = spark.read.schema(schema).csv(path, sep="\t", header=True, escape='"', quote='"')
    return out.repartition(partitions) if partitions else out


#: White space at the ends of a field belongs to it; Spark's writer takes it away unless it is told not to.
_WHOLE_FIELDS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """CSV with doubled quotes and newlines in fields, by header name and explicit schema; optionally some columns.

    The escape of escapes is the quote itself: by default it is NUL, and NULs before a quote are lost.
    """
    out = spark.read.schema(schema).csv(path, header=True, escape='"', quote='"', charToEscapeQuoteEscaping='"', multiLine=True, enforceSchema=False, **_WHOLE_FIELDS)
    return out.select(*columns) if columns else out


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV that read_csv() reads back, texts as they are; only '' comes back as null."""
    df.write.mode(mode).csv(path, header=True, escape='"', quote='"', emptyValue="", **_WHOLE_FIELDS)


def read_index(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The Parquet index; a filter on the result reaches the scan."""
    out = spark.read.parquet(path)
    return out.select(*columns) if columns else out


def write_index(df: DataFrame, path: str, key: str = "taxon_id", then: str = "photo_id", row_group: int = 500_000, mode: str = "ignore") -> None:
    """Parquet, range-partitioned and sorted by key, so that a lookup reads the row groups that can hold it.

    An index that exists is left as it is unless ``mode`` says otherwise.
    """
    ordered = df.repartitionByRange(F.col(key)).sortWithinPartitions(key, then)
    ordered.write.mode(mode).option("compression", "snappy").option("parquet.block.row.count.limit", str(row_group)).parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON document as one row with present = true; a missing file gives one row of nulls with present = false."""
    if exists(spark, path):
        return spark.read.schema(schema).json(path, multiLine=True).withColumn("present", F.lit(True))
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.lit(False).alias("present"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small report as one JSON-lines file."""
    df.coalesce(1).write.mode(mode).json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A text file as one row (path, text); bytes that aren't UTF-8 are replaced."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_binary(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files as (path, modificationTime, length, content)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def _named(spark: SparkSession, pattern: str | None) -> re.Pattern:
    """Names that a pattern of the file system means; Spark's listing knows the same."""
    if pattern is None:
        return re.compile("")
    return re.compile(spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern() + r"\Z", re.DOTALL)


def _hidden(name: str) -> bool:
    """Whether Spark's listing passes over a file or folder."""
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name


def _counted(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    """(files, bytes) in rows to be added up, of files below a folder of a mounted file system. Tasks list one of its
    folders each: Spark's listing keeps all files on the driver and makes a task of every 32."""
    named = _named(spark, pattern)
    with os.scandir(local(path)) as listed:
        folders = [e.path for e in listed if e.is_dir() and not _hidden(e.name)]

    def count(folder: str, below: bool) -> tuple[int, int]:
        files = size = 0
        todo = [folder]
        while todo:
            with os.scandir(todo.pop()) as listed:
                for e in listed:
                    if _hidden(e.name):
                        continue
                    if e.is_dir():
                        if below:
                            todo.append(e.path)
                    elif named.match(e.name):
                        files += 1
                        size += e.stat().st_size
        return files, size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([count(p, below) for p, below in zip(b["path"], b["below"])], columns=["files", "bytes"])

    parts = spark.createDataFrame([(local(path), False), *((p, True) for p in folders)], "path string, below boolean")
    return parts.repartition(min(len(folders) + 1, 200)).mapInPandas(run, "files bigint, bytes bigint")


def census(spark: SparkSession, base: str, kinds: dict[str, tuple[str, str | None]]) -> DataFrame:
    """(kind, files, bytes) for each kind: (folder, name pattern) under ``base``; missing folders count 0. Contents
    aren't read."""
    parts = []
    for kind, (folder, pattern) in kinds.items():
        path = f"{base}/{folder}"
        if not exists(spark, path):
            listed = spark.createDataFrame([], "files bigint, bytes bigint")
        elif _system(spark, path)[0].getUri().getScheme() == "file":
            listed = _counted(spark, path, pattern)
        else:
            listed = read_binary(spark, path, pattern).select(F.lit(1).alias("files"), F.col("length").alias("bytes"))
        parts.append(listed.agg(F.lit(kind).alias("kind"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "bytes")]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def download_states(wanted: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    """wanted with ``download``: 'exists' where ``present`` has a file of the key with bytes in it, else 'missing'."""
    have = present.where("length > 0").select(F.col(key).alias("__have")).distinct()
    return wanted.join(have, F.col(key) == F.col("__have"), "left").withColumn("download", F.when(F.col("__have").isNotNull(), "exists").otherwise("missing")).drop("__have")
