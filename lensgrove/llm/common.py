"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "__row"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_HALF = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits."""
    x = (x ^ (x >> _HALF)) * _MIX[1]
    x = (x ^ (x >> _HALF)) * _MIX[1]
    return x ^ (x >> _HALF)


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: 0 for what parts words, 2 for letters of scripts that don't part words, 1 for others; and hashes."""
    kind = np.array([chr(c).isalnum() or c == 0x5F for c in range(0x30000)], np.uint8)
    for a, b in ((0x0E00, 0x0E80), (0x3040, 0x3100), (0x3400, 0xA000), (0x20000, 0x30000)):
        kind[a:b] *= 2
    return kind, mixed(np.arange(1, len(kind) + 1, dtype=np.uint64) * _MIX[0])


def hashed_words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, in order and lower case, and the number of words of each text.

    A word is a run of letters, digits and underscores; letters of Han, Kana and Thai, which don't part words, stand
    alone. A null text has no words. Words are hashed whole, whatever their length.
    """
    low = [t.lower() if t else "" for t in texts]
    size = np.fromiter(map(len, low), np.int64, len(low)) + 1
    codes = np.frombuffer(" ".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, hashes = _letters()
    codes = np.minimum(codes, len(kinds) - 1)
    kind = kinds[codes]
    before = np.r_[np.uint8(0), kind[:-1]]
    starts = np.flatnonzero((kind == 2) | ((kind == 1) & (before != 1)))
    counts = np.diff(np.searchsorted(starts, np.r_[0, np.cumsum(size)]))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    inside = np.flatnonzero(kind)
    first = np.searchsorted(inside, starts)
    length = np.diff(np.r_[first, len(inside)])
    place = np.arange(len(inside)) - np.repeat(first, length)
    power = np.cumprod(np.full(int(length.max()), _MIX[0]))
    return mixed(np.add.reduceat(hashes[codes[inside]] * power[place], first) + length.astype(np.uint64)), counts


def portions(texts: Sequence[str | None], size: int = 500_000) -> Iterator[Sequence[str | None]]:
    """All texts in order, some of about ``size`` characters together at a time, a longer one alone."""
    at = 0
    while at < len(texts):
        upto, total = at, 0
        while upto < len(texts) and (upto == at or total < size):
            total += len(texts[upto] or "")
            upto += 1
        yield texts[at:upto]
        at = upto


def require(df: DataFrame, *names: str) -> None:
    """Raise ValueError if a named column is missing."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")


def col(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """The whole row as one struct, beside computed columns: no name can clash."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias(ROW), *[c.alias(n) for n, c in extra.items()])


def unpacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Undo packed()."""
    return df.select(*[F.col(ROW).getField(n).alias(n) for n in names])


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Have texts sent to Python in batches of some megabytes instead of 10,000 rows of any length: what a task holds
    then doesn't depend on how long texts are. This is a setting of the session (there is none of a single query); one
    that it has already stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(size))


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, as the session has it.

    Only a local master may do without it: its one machine then has one temporary folder for each application. The
    session's settings are only read.
    """
    sc = spark.sparkContext
    if found := spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir"):
        return found
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="lensgrove-")
    return _local[sc.applicationId]


_within: ContextVar[str | None] = ContextVar("_within", default=None)


class Workspace:
    """Tables written in the shared folder, so that lineage is cut and lost executors cost no rerun."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{_within.get() or shared_dir(spark)}/work-{uuid.uuid4().hex}"
        self.count = 0

    def put(self, df: DataFrame) -> DataFrame:
        """Write df and read it back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lensgrove_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Delete a table that nothing needs any more."""
        if path := getattr(df, "_lensgrove_path", None):
            self._delete(path)

    @contextmanager
    def scope(self) -> Iterator[None]:
        """Every workspace that is made inside is deleted at the end: what is to stay is put into this one before."""
        path = f"{self.root}/scope-{uuid.uuid4().hex}"
        token = _within.set(path)
        try:
            yield
        finally:
            _within.reset(token)
            self._delete(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
