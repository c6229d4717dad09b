"""Gated checks, and the report of a run."""

from __future__ import annotations

import os
import platform
import shutil
import subprocess
import sys
import time
import traceback
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lensgrove import schemas
from lensgrove.functions import exit_code, hold_reason, log_events, marker, seconds_between, tail_chars, tail_lines


def run_checks(checks: Sequence[tuple[str, Callable[[], dict], str | None]]) -> list[dict]:
    """Run (name, probe, depends on) in order. A check is skipped unless the first check of the name that it depends
    on is ok; a probe that raises has failed. Durations have three decimals."""
    out: list[dict] = []
    for name, probe, needs in checks:
        row = dict.fromkeys(schemas.CHECK.names) | {"status": "skipped", "name": name, "detail": {}, "duration_sec": 0.0}
        before = next((r["status"] for r in out if r["name"] == needs), None)
        if needs is not None and before != "ok":
            row["error"] = f"{needs} is {before or 'missing'}"
        else:
            began = time.perf_counter()
            try:
                row |= {"detail": {k: str(v) for k, v in (probe() or {}).items()}, "status": "ok"}
            except Exception as e:
                row |= {"status": "failed", "error": str(e).strip() or repr(e), "traceback": traceback.format_exc()}
            row["duration_sec"] = round(time.perf_counter() - began, 3)
        out.append(row)
    return out


def environment(path: str = ".") -> dict:
    """Facts of this machine: interpreter, processors, free disk."""
    return {"python": sys.version.split()[0], "platform": platform.platform(), "cpus": os.cpu_count(), "free_gb": round(shutil.disk_usage(path).free / 1e9, 3)}


def subprocess_check(command: Sequence[str], timeout: float = 3600.0) -> dict:
    """Run a command; its exit code must be 0. The ends of its outputs are kept."""
    got = subprocess.run(list(command), capture_output=True, text=True, timeout=timeout)
    detail = {"exit_code": got.returncode, "stdout_tail": got.stdout[-2000:], "stderr_tail": got.stderr[-2000:]}
    if got.returncode:
        raise RuntimeError(f"exit code {got.returncode}: {got.stderr[-2000:]}")
    return detail


def checks_frame(spark: SparkSession, results: list[dict], started: float, finished: float, args: dict | None = None) -> DataFrame:
    """Results as one row of the check-run schema."""
    row = (started, finished, round(finished - started, 3), {k: str(v) for k, v in (args or {}).items()}, [tuple(r[f.name] for f in schemas.CHECK.fields) for r in results], all_ok(results))
    return spark.createDataFrame([row], schemas.CHECK_RUN)


def all_ok(results: list[dict]) -> bool:
    """Whether no check failed or was skipped; true for none."""
    return {r["status"] for r in results} <= {"ok"}


def exit_status(results: list[dict]) -> int:
    """What a program should exit with: 0 if all checks are ok, else 1."""
    return 0 if all_ok(results) else 1


def gate(steps: DataFrame, run: str, order: str, ok: str = "ok") -> DataFrame:
    """steps with ``gated``: 'skipped' once an earlier step of the run wasn't ok (a linear chain), else its own status."""
    before = W.partitionBy(run).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    broken = F.coalesce(F.bool_or(F.col(ok) == F.lit(False)).over(before), F.lit(False))
    return steps.withColumn("gated", F.when(broken, "skipped").when(F.col(ok), "ok").otherwise("failed"))


def job_summary(logs: DataFrame) -> DataFrame:
    """One row for each (path, text): when it was submitted, started and ended, waiting and running seconds, exit
    code, hold reason, and the last lines. The first event of a code counts; 005 ends a job, else 009."""
    ev = logs.withColumn("events", log_events(F.col("text")))

    def at(code: str):
        return F.try_element_at(F.filter("events", lambda e: e["code"] == code), F.lit(1))["at"]

    timed = ev.select("path", "text", F.size("events").alias("n_events"), at("000").alias("submitted"), at("001").alias("started"), F.coalesce(at("005"), at("009")).alias("ended"))
    return timed.select(
        "path",
        "n_events",
        "submitted",
        "started",
        "ended",
        seconds_between(F.col("submitted"), F.col("started")).alias("wait_s"),
        seconds_between(F.col("started"), F.col("ended")).alias("run_s"),
        exit_code(F.col("text")).alias("exit_code"),
        hold_reason(F.col("text")).alias("hold_reason"),
        tail_lines(F.col("text"), 30).alias("tail"),
        tail_chars(F.col("text"), 2000).alias("tail_chars"),
    )


def report(summary: DataFrame, checks: DataFrame, receipt: DataFrame) -> DataFrame:
    """One text from a job summary, a check run and an upload receipt, each of one row and perhaps absent.

    summary: of job_summary(); checks and receipt: of read_json(), with their ``present``.
    """
    s = summary.select(F.struct("*").alias("s")).limit(1)
    c = checks.select(F.struct("*").alias("c")).limit(1)
    r = receipt.select(F.struct("*").alias("r")).limit(1)
    one = s.sparkSession.range(1).select(F.lit(1).alias("k"))
    for part in (s, c, r):
        one = one.join(part.withColumn("k", F.lit(1)), "k", "left")
    text = lambda x: F.coalesce(x.cast("string"), F.lit("-"))
    lines = F.transform("c.results", lambda x: F.concat(marker(x["status"]), F.lit(" "), x["name"], F.lit(" "), F.format_number(x["duration_sec"], 1), F.lit(" s"), F.when(x["error"].isNotNull(), F.concat(F.lit(": "), x["error"])).otherwise(F.lit(""))))
    body = F.concat_ws(
        "\n",
        F.lit("Job"),
        F.concat(F.lit("  waited "), text(F.col("s.wait_s")), F.lit(" s, ran "), text(F.col("s.run_s")), F.lit(" s, exit code "), text(F.col("s.exit_code"))),
        F.when(F.col("s.hold_reason").isNotNull(), F.concat(F.lit("  held: "), F.col("s.hold_reason"))),
        F.lit("Checks"),
        F.when(F.col("c.present"), F.concat(F.lit("  "), F.array_join(lines, "\n  "))).otherwise(F.lit("  no results")),
        F.lit("Upload"),
        F.when(F.col("r.present"), F.concat(F.lit("  "), F.format_number(F.col("r.tar_bytes") / 1e9, 3), F.lit(" GB to "), F.col("r.remote_subpath"))).otherwise(F.lit("  no receipt")),
    )
    return one.select(body.alias("report"))
