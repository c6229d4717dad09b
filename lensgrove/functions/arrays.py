"""Functions of arrays of instances: structs with score, mask figures and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import rgb_text, score_text


def sort_instances(instances: Column) -> Column:
    """By score, highest first; ties keep their order. Null scores come last."""
    placed = F.transform(instances, lambda x, i: F.struct(F.coalesce(-x["score"], F.lit(float("inf"))).alias("k"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(placed), lambda p: p["x"])


def top_scores(instances: Column, min_score: float) -> Column:
    """Those with a score of ``min_score`` or more."""
    return F.filter(instances, lambda x: x["score"] >= min_score)


def drop_empty(instances: Column) -> Column:
    """Those whose mask has a pixel."""
    return F.filter(instances, lambda x: x["n_pixels"] > 0)


def drop_null_rgb(colours: Column) -> Column:
    """Colours that are there; the result may be shorter than the scores."""
    return F.filter(colours, lambda x: x.isNotNull())


def scores_text(scores: Column) -> Column:
    """Scores with four decimals, comma between."""
    return F.array_join(F.transform(scores, lambda s: score_text(s)), ",")


def colours_text(colours: Column) -> Column:
    """(r,g,b),(r,g,b) of the colours that are there."""
    return F.array_join(F.transform(drop_null_rgb(colours), rgb_text), ",")


def ordered_join(value: Column, order: Column, separator: str = ",") -> Column:
    """Aggregate: texts of a group joined in the order of ``order``."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), separator)


def any_of(mask: Column) -> Column:
    """Whether a 0/1 array has a 1."""
    return F.exists(mask, lambda x: x > 0)


def all_of(values: Column) -> Column:
    """Whether all booleans of an array are true; true for none."""
    return F.forall(values, lambda x: x)
