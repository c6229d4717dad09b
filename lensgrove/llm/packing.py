"""Harmonic packing of documents into training sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, require

CAPACITY = 4096
CLASSES = 64
#: Rows of the table for each worker, about; workers grow with the table, so a worker's share doesn't.
WORKER_ROWS = 8192
#: Repetitions of one piece that are written out together.
_RUN = 4096


def token_count(text: Column) -> Column:
    """ceil(UTF-8 bytes / 4) as BIGINT; 0 for null."""
    return F.shiftright(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 3, 2)


def harmonic_pack(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, classes: int = CLASSES, workers: int | None = None) -> DataFrame:
    """(bin_id, slot, doc_id, piece, start, length, place): where each piece of each document goes.

    Lengths are token_count() of the text. A document longer than ``capacity`` is cut into pieces of ``capacity``
    tokens and a rest. A piece of length l is of class j = min(capacity // l, ``classes``), so that j pieces of a
    class always fit a bin, and each bin of class j takes exactly j of them. Workers fill their own bins of each
    class in the order of (doc_id, piece, length); they need no knowledge of one another, and each leaves at most one
    bin a class unfilled. There is a worker for every WORKER_ROWS rows unless ``workers`` says how many; a document's
    is chosen by its id and length together, so that rows without an id spread as well. ``start`` is the token at
    which the piece begins in its document, ``place`` the one at which it begins in its bin.

    Null and empty texts have no tokens and take no place. Documents with a null id come first. Repeated rows are
    packed as often as they occur; they are counted before the shuffle and written out after it, so that one row that
    is repeated without end is still one row to its worker. An empty table gives no rows. Other columns aren't read.
    doc_id must be an integer (ValueError if not).
    """
    require(docs, text, doc_id)
    if dict(docs.dtypes)[doc_id] not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{doc_id} must be an integer")
    if workers is None:
        workers = max(1, -(-docs.count() // WORKER_ROWS))  # of Parquet: from the footers
    sized = docs.select(col(doc_id).cast("long").alias("doc_id"), token_count(col(text)).alias("total")).where("total > 0")
    pieces = sized.select("doc_id", "total", F.explode(F.sequence(F.lit(0), F.expr(f"cast((total - 1) div {capacity} as int)"))).alias("piece"))
    pieces = pieces.withColumn("start", F.col("piece").cast("long") * capacity).withColumn("length", F.least(F.col("total") - F.col("start"), F.lit(capacity)))
    pieces = pieces.withColumn("kind", F.least(F.expr(f"{capacity} div length"), F.lit(classes).cast("long")))
    pieces = pieces.withColumn("worker", F.pmod(F.coalesce("doc_id", F.lit(0)) + F.col("total"), F.lit(workers)).cast("long"))
    counted = pieces.groupBy("kind", "worker", "doc_id", "piece", "start", "length").agg(F.count("*").alias("n"))
    group = W.partitionBy("kind", "worker").orderBy(F.asc_nulls_first("doc_id"), "piece", "length")
    ahead = counted.withColumn("before", F.sum("n").over(group.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n"))
    runs = ahead.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_RUN}"))))
    each = runs.withColumn("r", F.explode(F.expr(f"sequence(before + run * {_RUN}, before + least(n, (run + 1) * {_RUN}) - 1)")))
    ranked = each.withColumn("seq", F.expr("r div kind")).withColumn("slot", F.expr("cast(r % kind as int)"))
    inside = W.partitionBy("kind", "worker", "seq").orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    return ranked.select(
        ((F.col("kind") * workers + F.col("worker")) * F.lit(1 << 32) + F.col("seq")).alias("bin_id"),
        "slot",
        "doc_id",
        "piece",
        "start",
        "length",
        (F.sum("length").over(inside) - F.col("length")).alias("place"),
    )


def harmonic_pack_sql(table: str = "documents", capacity: int = CAPACITY, classes: int = CLASSES) -> str:
    """The same rows as DuckDB SQL."""
    return f"""
    WITH w AS (SELECT greatest(1, (count(*) + {WORKER_ROWS - 1}) // {WORKER_ROWS}) AS workers FROM {table}),
    sized AS (SELECT doc_id, (coalesce(strlen(text), 0) + 3) // 4 AS total FROM {table}),
    pieces AS (SELECT doc_id, total, unnest(range((total - 1) // {capacity} + 1)) AS piece FROM sized WHERE total > 0),
    cut AS (SELECT doc_id, total, piece, piece * {capacity} AS start, least(total - piece * {capacity}, {capacity}) AS length FROM pieces),
    kinds AS (SELECT *, least({capacity} // length, {classes}) AS kind, ((coalesce(doc_id, 0) + total) % workers + workers) % workers AS worker FROM cut, w),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, worker ORDER BY doc_id NULLS FIRST, piece, length) - 1 AS r FROM kinds)
    SELECT CAST((kind * workers + worker) * 4294967296 + r // kind AS BIGINT) AS bin_id, CAST(r % kind AS INTEGER) AS slot, doc_id,
           CAST(piece AS INTEGER) AS piece, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
           CAST(sum(length) OVER (PARTITION BY kind, worker, r // kind ORDER BY r % kind ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS place
    FROM ranked"""
