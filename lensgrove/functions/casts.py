"""Casts that give null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_int(value: Column, kind: str = "int") -> Column:
    """A decimal text as an integer of ``kind``: fractions are rounded half away from zero, exponents are read, and
    whatever is no number or doesn't fit is null."""
    number = value.try_cast("decimal(38,10)")
    return F.when(value.rlike(_NUMBER), F.round(number, 0).try_cast(kind))


def lenient_float(value: Column) -> Column:
    """A text as a 32-bit float, or null."""
    return value.try_cast("float")


def to_long(value: Column) -> Column:
    """A text as a 64-bit integer, or null: '12', '12.0' and '1e3' are whole numbers, true fractions are null."""
    number = value.try_cast("decimal(38,10)")
    return F.when(value.rlike(_NUMBER) & (number == F.floor(number)), F.round(number, 0).try_cast("bigint"))
