"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, col, require

#: Rows of the sample on which rules are timed; the order that it gives decides how much work is done, not the result.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """A predicate that is true of what has to go, in Spark SQL and in DuckDB SQL: over ``t``, a text that isn't null,
    ``w``, its words between blanks, and ``z``, its letters of scripts that don't part words."""

    name: str
    spark: str
    duckdb: str


_ALONE = "฀-๿぀-ヿ㐀-鿿"
#: Counting by what a replacement leaves or a split gives is several times cheaper than listing matches.
_W = r"size(split(trim(BOTH ' \t\r\n' FROM t), '[ \\t\\r\\n]+'))"
_Z = f"length(regexp_replace(t, '[^{_ALONE}]+', ''))"
_W_SQL = r"greatest(1, len(regexp_extract_all(t, '[^ \t\r\n]+')))"
_Z_SQL = f"len(regexp_extract_all(t, '[{_ALONE}]'))"


def _left(pattern: str) -> tuple[str, str]:
    """Length of what the pattern doesn't match."""
    return f"length(regexp_replace(t, '{pattern}', ''))".replace("\\", "\\\\"), f"length(regexp_replace(t, '{pattern}', '', 'g'))"


_SIGNS, _LETTERS, _CAPITALS = _left(r"[^#$%&*|{}<>=_~^!]+"), _left(r"[\p{L}\p{M}\p{N}]+"), _left(r"\P{Lu}+")

#: Each bound has an allowance for chance that weighs the less the longer a text is: no length is exempt.
RULES = [
    Rule("no_words", r"NOT (t RLIKE '[\\p{L}\\p{N}]')", r"NOT regexp_matches(t, '[\p{L}\p{N}]')"),
    Rule("symbols", *[f"{x} > 0.3 * (w + z) + 1" for x in _SIGNS]),
    Rule("few_letters", *[f"{x} > 0.4 * length(t) + 4" for x in _LETTERS]),
    Rule("capitals", *[f"{x} > 0.4 * length(t) + 10" for x in _CAPITALS]),
    Rule("word_length", *["length(t) > 14 * (w + z) + 60 OR length(t) < 2.6 * (w - z) - 20"] * 2),
    Rule(
        "repeated_words",
        r"size(array_distinct(split(lower(t), '[ \\t\\r\\n]+'))) + z < 0.4 * (w + z - 10) / sqrt(1 + (w + z) / 400)",
        r"len(list_distinct(regexp_split_to_array(lower(t), '[ \t\r\n]+'))) + z < 0.4 * (w + z - 10) / sqrt(1 + (w + z) / 400)",
    ),
    Rule("repeated_lines", r"size(array_distinct(split(t, '\\n'))) < 0.5 * (size(split(t, '\\n')) - 2)", "len(list_distinct(string_split(t, chr(10)))) < 0.5 * (len(string_split(t, chr(10))) - 2)"),
]


def _measured(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    return docs.select(*keep, F.coalesce(col(text), F.lit("")).alias("t")).select("*", F.expr(_W).alias("w"), F.expr(_Z).alias("z"))


def _cpu_seconds(spark: SparkSession, job) -> tuple[float, object]:
    """CPU seconds of the tasks of an action, from the session's own task metrics, and what the action gives."""
    sc = spark.sparkContext
    group, before = f"cost-{uuid.uuid4().hex}", sc.getLocalProperty("spark.jobGroup.id")
    sc.setLocalProperty("spark.jobGroup.id", group)
    try:
        got = job()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", before)
    jsc = sc._jsc.sc()
    jsc.listenerBus().waitUntilEmpty()
    store, tracker, total = jsc.statusStore(), sc.statusTracker(), 0
    for j in tracker.getJobIdsForGroup(group):
        for s in tracker.getJobInfo(j).stageIds:
            try:
                total += store.lastStageAttempt(s).executorCpuTime()
            except Exception as e:  # a stage that was skipped has no attempt
                if "NoSuchElement" not in str(e):
                    raise
    return total / 1e9, got


def estimate(docs: DataFrame, *, rules: list[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 8) -> list[tuple[Rule, float, float]]:
    """(rule, CPU seconds a row, share it rejects) on a seeded sample of about ``sample_rows`` rows, best rejection per
    cost first.

    The cost is the tasks' CPU time, the least of three runs, rounded to powers of four, so that what else the machines do
    doesn't change the order; ties go by name. Rules that reject nothing come last, the cheapest first. An empty table
    gives the rules as they are, with zeros. Null texts count as empty.
    """
    total = docs.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    spark = docs.sparkSession
    space = Workspace(spark)
    sample = space.put(_measured(docs.sample(fraction=min(1.0, sample_rows / total), seed=seed), text).repartition(spark.sparkContext.defaultParallelism))
    rows = max(1, sample.count())

    def cost(rule: str) -> tuple[float, int]:
        runs = [_cpu_seconds(spark, lambda: sample.agg(F.count_if(F.expr(rule))).first()[0]) for _ in range(3)]  # the first compiles
        return min(r[0] for r in runs), runs[0][1]

    idle, _ = cost("length(t) < 0")
    out = []
    for r in rules:
        took, hits = cost(r.spark)
        out.append((r, 4.0 ** round(math.log(max(took - idle, 1e-3) / rows, 4)), hits / rows))
    space.drop(sample)
    return sorted(out, key=lambda x: (-x[2] / x[1], x[1], x[0].name))


def quality_filter(docs: DataFrame, *, rules: list[Rule] = RULES, text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, keep) for every row: whether its text passes all rules.

    estimate() measures cost and rejection of each rule on a sample; the cascade tests the rule with the most
    rejection per cost first, and the first failure ends a document's evaluation. A conditional expression that
    short-circuits holds the cascade, inside one scan without a shuffle. ``keep`` doesn't depend on the order. A
    null text counts as empty, and an empty text has no words and isn't kept. Texts of any length are judged whole and
    by the same rules. Null ids, ties and repeated rows stay as they are, other columns aren't read, and an empty table
    gives no rows.
    """
    require(docs, text, doc_id)
    order = [r for r, _, _ in estimate(docs, rules=rules, text=text, sample_rows=sample_rows)]
    held = _measured(docs.select(col(doc_id).alias("doc_id"), col(text).alias("t")), "t", "doc_id")
    out = None
    for r in order:
        out = F.when(F.expr(r.spark), F.lit(False)) if out is None else out.when(F.expr(r.spark), F.lit(False))
    keep = F.lit(True) if out is None else out.otherwise(F.lit(True))
    return held.select("doc_id", keep.alias("keep"))


def quality_filter_sql(table: str = "documents", rules: list[Rule] = RULES) -> str:
    """The same rows as DuckDB SQL."""
    return f"SELECT doc_id, NOT ({' OR '.join('(' + r.duckdb + ')' for r in rules)}) AS keep FROM (SELECT *, {_W_SQL} AS w, {_Z_SQL} AS z FROM (SELECT doc_id, coalesce(text, '') AS t FROM {table}))"
