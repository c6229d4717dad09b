"""URL functions of photo links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHOTO_BASE = "https://photos.example.org/photos"
SIZES = tuple("square small medium large original".split())


def url_ext(url: Column) -> Column:
    """Lower-case extension of a URL's path if it is jpg, jpeg, png or gif, else null."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*", "")
    ext = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.when(ext.isin("jpg", "jpeg", "png", "gif"), ext)


def object_url(photo_id: Column, ext: Column, base: str = PHOTO_BASE) -> Column:
    """Address of the original in the object store; null without an id, for id 0, and without an extension."""
    return F.when((photo_id != 0) & (F.length(ext) > 0), F.concat(F.lit(base + "/"), photo_id.cast("string"), F.lit("/original."), ext))


def best_url(photo_id: Column, ext: Column, original: Column, url: Column, base: str = PHOTO_BASE) -> Column:
    """The best address of a photo: in the object store, else its original, else its URL with the size replaced by
    'original' (the first size, in the order of SIZES, that the URL has), else the URL, else null."""
    sized = F.nullif(url, F.lit(""))
    for size in reversed(SIZES):
        sized = F.when(F.contains(url, F.lit(f"/{size}.")), F.replace(url, F.lit(f"/{size}."), F.lit("/original."))).otherwise(sized)
    return F.coalesce(object_url(photo_id, ext, base), F.nullif(original, F.lit("")), sized)


def storage_ext(url: Column) -> Column:
    """Extension to store an image under: that of the URL before '?', if it is jpg, jpeg or png, else jpg."""
    ext = F.lower(F.regexp_extract(F.substring_index(url, "?", 1), r"[^/]\.([^./]*)$", 1))
    return F.when(ext.isin("jpg", "jpeg", "png"), ext).otherwise(F.lit("jpg"))


def value_ext(ext: Column) -> Column:
    """The same for an extension itself, with or without leading dots."""
    low = F.lower(F.regexp_replace(ext, r"^\.+", ""))
    return F.when(low.isin("jpg", "jpeg", "png"), low).otherwise(F.lit("jpg"))
