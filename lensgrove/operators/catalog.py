"""The index of photos: build and look up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgrove.functions import lenient_float, lenient_int

QUALITY = "research"


class NothingFound(LookupError):
    """A lookup or work-list has no rows."""


def require_columns(df: DataFrame, *names: str) -> None:
    """ValueError naming the columns that are missing."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")


def build_index(photos: DataFrame, observations: DataFrame, taxa: DataFrame, quality: str = QUALITY) -> DataFrame:
    """One row for each photo of each observation of the wanted quality, with its taxon's name if that is known.

    Keys are joined as the texts that they are, so '007' isn't '7'; only then are numbers read, leniently. The
    filter reaches the scan of observations. Taxa are small by nature, but which join is used is left to their size.
    """
    require_columns(photos, "photo_id", "observation_uuid", "extension")
    require_columns(observations, "observation_uuid", "taxon_id", "quality_grade", "latitude", "longitude")
    require_columns(taxa, "taxon_id", "name")
    wanted = observations.where(F.col("quality_grade") == quality).select("observation_uuid", "taxon_id", "quality_grade", "latitude", "longitude")
    names = taxa.select("taxon_id", F.col("name").alias("taxon_name"))
    joined = photos.select("photo_id", "observation_uuid", "extension").join(wanted, "observation_uuid").join(names, "taxon_id", "left")
    return joined.select(
        lenient_int(F.col("taxon_id")).alias("taxon_id"),
        lenient_int(F.col("photo_id"), "bigint").alias("photo_id"),
        "extension",
        "taxon_name",
        "quality_grade",
        lenient_float(F.col("latitude")).alias("latitude"),
        lenient_float(F.col("longitude")).alias("longitude"),
    )


def look_up(index: DataFrame, taxon_id: int, *columns: str) -> DataFrame:
    """Rows of exactly one taxon, by photo_id; nulls last."""
    found = index.where(F.col("taxon_id") == taxon_id)
    return (found.select(*columns) if columns else found).orderBy(F.asc_nulls_last("photo_id"))


def must_have_rows(df: DataFrame, what: str) -> DataFrame:
    """df, or NothingFound if it is empty."""
    if df.isEmpty():
        raise NothingFound(f"no rows for {what}")
    return df


def first_row(df: DataFrame) -> dict | None:
    """The first row as a dict, or None."""
    row = df.first()
    return row.asDict() if row else None
