"""Functions of job logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JOB, _TIME = r"[0-9]+(?:\.[0-9]+){2}", "[0-9]{4}(?:-[0-9]{2}){2} [0-9]{2}(?::[0-9]{2}){2}"
EVENT = rf"^([0-9]{{3}})\s+[(]({_JOB})[)]\s+({_TIME})\s+(.+)$"


def log_events(text: Column) -> Column:
    """Events of a log in their order: array of (pos, code, job_id, at, message)."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    hits = F.filter(lines, lambda x: x["line"].rlike(EVENT))
    part = lambda x, k: F.regexp_extract(x["line"], EVENT, k)
    return F.transform(
        hits,
        lambda x: F.struct(
            x["pos"].alias("pos"),
            part(x, 1).alias("code"),
            part(x, 2).alias("job_id"),
            F.try_to_timestamp(part(x, 3), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("at"),
            part(x, 4).alias("message"),
        ),
    )


def exit_code(text: Column) -> Column:
    """The job's return value, or null."""
    return F.nullif(F.regexp_extract(text, r"\(return value (\d+)\)", 1), F.lit("")).cast("int")


def hold_reason(text: Column) -> Column:
    """The line after 'Job was held.', stripped, or null."""
    return F.nullif(F.trim(F.regexp_extract(text, r"Job was held\.[ \t]*\r?\n[ \t]*([^\r\n]*)", 1)), F.lit(""))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end as a double; null if either is."""
    return F.timestamp_diff("SECOND", start, end).cast("double")


def tail_lines(text: Column, n: int = 20) -> Column:
    """The last n lines; all if there are fewer."""
    lines = F.split(F.regexp_replace(text, r"\r?\n$", ""), r"\r?\n")
    count = F.least(F.lit(n), F.size(lines))
    return F.array_join(F.slice(lines, -count, count), "\n")


def tail_chars(text: Column, n: int = 2000) -> Column:
    """The last n characters."""
    return F.right(text, F.lit(n))
