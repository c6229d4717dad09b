"""Names and short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(value: Column) -> Column:
    """Without white space, of any script, at both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def sanitize(value: Column) -> Column:
    """Ends stripped, runs of white space to '_', all but ASCII letters, digits and '_' deleted; null gives ''."""
    spaced = F.regexp_replace(stripped(F.coalesce(value, F.lit(""))), r"(?U)\s+", "_")
    return F.regexp_replace(spaced, r"[^A-Za-z0-9_]", "")


def binomial(name: Column) -> Column:
    """Genus_species of a taxon name: first word capitalised, second in lower case, each sanitised. One word alone is
    sanitised as it is; null and blank give 'Unknown_unknown'."""
    clean = stripped(name)
    words = F.split(clean, r"(?U)\s+")
    two = F.concat(sanitize(F.initcap(words[0])), F.lit("_"), sanitize(F.lower(F.try_element_at(words, F.lit(2)))))
    return F.when(name.isNull() | (clean == ""), F.lit("Unknown_unknown")).when(F.size(words) >= 2, two).otherwise(sanitize(clean))


def batch_name(global_index: Column, size: int = 10_000) -> Column:
    """batch_00001 for the first ``size`` indices, and so on; more digits where five don't suffice."""
    return F.format_string("batch_%05d", F.floor((global_index - 1) / F.lit(size)).cast("bigint") + 1)


def image_name(species: Column, key: Column, ext: Column, ordinal: Column | None = None) -> Column:
    """{species}_{key}_image{ordinal}.{ext}, or {species}_{key}.{ext} without an ordinal."""
    middle = [F.lit("_image"), ordinal.cast("string")] if ordinal is not None else []
    return F.concat(species, F.lit("_"), key.cast("string"), *middle, F.lit("."), ext)


def artefact_name(stem: Column, kind: str, number: Column | None = None) -> Column:
    """Overlay, instance mask or segment file of an image; numbers count from 0 in order of confidence."""
    if kind == "overlay":
        return F.concat(stem, F.lit("_overlay.png"))
    suffix = {"instance": ".npy", "segment": ".png"}[kind]
    return F.concat(stem, F.lit(f"_{kind}_"), number.cast("string"), F.lit(suffix))


def rgb_text(rgb: Column) -> Column:
    """(r,g,b), or '' for null."""
    return F.when(rgb.isNotNull(), F.format_string("(%d,%d,%d)", rgb["r"], rgb["g"], rgb["b"])).otherwise(F.lit(""))


def score_text(score: Column, digits: int = 4) -> Column:
    """A score below 1000 with fixed decimals, the double's exact value being rounded."""
    return F.format_number(score, digits)


def int_list(text: Column) -> Column:
    """'1, 2,,3' as [1, 2, 3]: blanks are skipped."""
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(parts, lambda x: x.cast("int"))


def marker(status: Column) -> Column:
    """PASS, FAIL or SKIP; null for anything else."""
    return F.when(status == "ok", "PASS").when(status == "failed", "FAIL").when(status == "skipped", "SKIP")


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor ''."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])
