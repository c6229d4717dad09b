"""Work-lists: filter, number, name, shard, and leave out what is done."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lensgrove.config import DONE_STATUSES, RunConfig
from lensgrove.functions import artefact_name, batch_name, binomial, image_name, storage_ext, to_long

from .catalog import require_columns


def filled(*names: str) -> Column:
    """All named columns are neither null nor ''."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() & (F.length(F.col(n)) > 0) for n in names])


def explode_photos(observations: DataFrame) -> DataFrame:
    """One row for each photo with its place; an observation without photos (null or empty) gives one with nulls."""
    return observations.select("*", F.posexplode_outer("photos").alias("photo_pos", "photo")).drop("photos")


def image_ordinal(df: DataFrame, group: str, order: Sequence[str], name: str = "image_index") -> DataFrame:
    """Place in its group from 1, in the given order; null for a null group."""
    at = F.row_number().over(W.partitionBy(group).orderBy(*[F.asc_nulls_last(c) for c in order])).cast("bigint")
    return df.withColumn(name, F.when(F.col(group).isNotNull(), at))


def global_index(df: DataFrame, order: Sequence[str], name: str = "global_index", ranges: int = 256) -> DataFrame:
    """Place in the whole frame from 1, without sorting it in one place.

    The first column of ``order`` must be numeric: its approximate quantiles cut the frame into ranges. Rows are
    counted by range; a row's number is its place in its range plus the sizes of the ranges before. A range is a
    function of the value alone, so retried tasks agree. Nulls come last. ``order`` should identify a row.
    """
    lead = F.col(order[0])
    points = df.agg(F.percentile_approx(lead, [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0] or []
    edges = sorted(set(points))

    # how many edges are less than the value, by halving; a step each, as one expression of them all is too long to be compiled
    table, step = F.array(*[F.lit(e) for e in edges]), 1 << len(edges).bit_length() >> 1
    ranged = df.withColumn("__range", F.when(lead.isNull(), F.lit(ranges)).otherwise(F.lit(0)))
    while step:
        at = F.col("__range")
        ranged = ranged.withColumn("__range", at + F.when(F.get(table, at + F.lit(step - 1)) < lead, F.lit(step)).otherwise(F.lit(0)))
        step >>= 1
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # over at most ``ranges`` + 1 rows
    starts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(W.partitionBy("__range").orderBy(*[F.asc_nulls_last(c) for c in order]))
    return ranged.withColumn("__place", place).join(F.broadcast(starts), "__range").withColumn(name, F.col("__start") + F.col("__place")).drop("__range", "__start", "__place")


def shard(df: DataFrame, number: int, shards: int, index: str = "global_index") -> DataFrame:
    """Rows whose index belongs to a shard; indices are given before, so they don't depend on it."""
    return df.where(F.pmod(F.col(index), F.lit(shards)) == number % shards)


def done_keys(ledger: DataFrame, key: str = "global_index", statuses: Sequence[str] = DONE_STATUSES, retry_failed: bool = False) -> DataFrame:
    """Distinct keys that need no further work. Failures count as done unless they are to be tried again."""
    wanted = ["ok"] if retry_failed else list(statuses)
    return ledger.where(F.col("status").isin(wanted)).select(key).where(F.col(key).isNotNull()).distinct()


def remaining(work: DataFrame, done: DataFrame, key: str = "global_index") -> DataFrame:
    """Work whose key isn't done; rows with a null key stay."""
    return work.join(done.select(key), key, "left_anti")


def limited(work: DataFrame, done: DataFrame, limit: int | None, scope: str, key: str = "global_index") -> DataFrame:
    """Remaining work with a limit on what remains, or on the list before what is done is left out."""
    if limit is None:
        return remaining(work, done, key)
    if scope == "total":
        return remaining(work.orderBy(F.asc_nulls_last(key)).limit(limit), done, key)
    return remaining(work, done, key).orderBy(F.asc_nulls_last(key)).limit(limit)


def union_all(frames: Sequence[DataFrame], ordinal: str = "taxon_ord") -> DataFrame:
    """Frames one after the other, each row with its frame's place in the list."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn(ordinal, F.lit(k)) for k, f in enumerate(frames)])


def with_paths(df: DataFrame, base: str, config: RunConfig = RunConfig(), url: str = "photo_url") -> DataFrame:
    """Names and paths of a row's artefacts; needs global_index, genus_species, image_index or photo_id, and a URL."""
    ext = storage_ext(F.col(url))
    if config.naming == "observation":
        name = image_name(F.col("genus_species"), F.col("observation_id"), ext, F.col("image_index"))
    elif config.naming == "photo":
        name = image_name(F.col("genus_species"), F.col("photo_id"), ext, F.col("image_index"))
    else:
        name = image_name(F.col("genus_species"), F.col("photo_id"), ext)
    named = df.withColumns({"batch_name": batch_name(F.col("global_index"), config.batch_size), "image_name": name})
    named = named.withColumn("stem", F.regexp_replace("image_name", r"\.[^.]*$", ""))
    relative = {
        "image_relpath": F.concat_ws("/", F.lit("images"), "batch_name", "image_name"),
        "mask_batch_relpath": F.concat_ws("/", F.lit("masks"), "batch_name"),
        "overlay_relpath": F.concat_ws("/", F.lit("overlays"), "batch_name", artefact_name(F.col("stem"), "overlay")),
    }
    named = named.withColumns(relative)
    full = {a: F.concat_ws("/", F.lit(base), b) for a, b in (("image_path", "image_relpath"), ("mask_dir", "mask_batch_relpath"), ("overlay_path", "overlay_relpath"))}
    folders = {k: F.concat_ws("/", F.lit(base), F.lit(v), "batch_name") for k, v in (("image_dir", "images"), ("overlay_dir", "overlays"))}
    if config.cutouts:
        folders["segment_dir"] = F.concat_ws("/", F.lit(base), F.lit("segments"), "batch_name")
    return named.withColumns(full | folders)


def build_worklist(metadata: DataFrame, base: str, config: RunConfig = RunConfig(), order: Sequence[str] = ("source_pos",)) -> DataFrame:
    """The list of images to work on: rows with a URL and a numeric observation, numbered, named and sharded.

    Numbering comes before sharding, so that indices and batches are the same for any number of shards.
    """
    require_columns(metadata, "observation_id", "taxon_name", "photo_url", *order)
    rows = metadata.where(filled("photo_url")).withColumn("observation_id", to_long(F.col("observation_id").cast("string"))).where(F.col("observation_id").isNotNull())
    rows = global_index(image_ordinal(rows, "observation_id", order), order)
    if config.num_shards > 1:
        rows = shard(rows, config.shard, config.num_shards)
    return with_paths(rows.withColumn("genus_species", binomial(F.col("taxon_name"))), base, config)
