"""Pack a run's folder, put it where it is kept, and write a receipt."""

from __future__ import annotations

import os
import tarfile
import time

from pyspark.sql import DataFrame, SparkSession

from lensgrove import schemas
from lensgrove.sources.files import write_json

from .enrich import local


def archive(folder: str, tar_path: str) -> int:
    """A tar file of all files under ``folder``, by name, whole or not at all; its bytes."""
    folder, tar_path = local(folder), local(tar_path)
    os.makedirs(os.path.dirname(tar_path) or ".", exist_ok=True)
    with tarfile.open(tar_path + ".part", "w") as tar:
        for root, dirs, names in os.walk(folder):
            dirs.sort()
            for n in sorted(names):
                tar.add(os.path.join(root, n), os.path.relpath(os.path.join(root, n), folder))
    os.replace(tar_path + ".part", tar_path)
    return os.path.getsize(tar_path)


def put(spark: SparkSession, tar_path: str, target: str) -> list[str]:
    """Copy a file into a folder of any file system that Spark knows, replacing one of its name; what is there then."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    where = path(target)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.copyFromLocalFile(False, True, path(local(tar_path)), where)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if not s.getPath().getName().endswith(".crc"))


def send(spark: SparkSession, folder: str, tar_path: str, share: str, subpath: str, receipt: str | None = None) -> DataFrame:
    """archive(), put() to ``share``/``subpath``, and one row of the receipt's schema, written as JSON if a path is given."""
    began = time.perf_counter()
    size = archive(folder, tar_path)
    packed = time.perf_counter()
    listing = put(spark, tar_path, f"{share}/{subpath}")
    row = (local(folder), share, subpath, local(tar_path), size, round(packed - began, 3), round(time.perf_counter() - packed, 3), "\n".join(listing))
    out = spark.createDataFrame([row], schemas.RECEIPT)
    if receipt:
        write_json(out, receipt)
    return out
