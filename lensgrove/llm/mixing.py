"""Mixing of overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ROW, Workspace, col, packed, require, unpacked
from .packing import token_count

#: A document may belong to several of these at once.
SOURCES = {
    "hot_feed": "source = 'src0'",
    "other_feeds": "source <> 'src0'",
    "english": "lang = 'en'",
    "european": "lang in ('de', 'es', 'fr')",
    "long_form": "n_chars >= 6000",
}
WEIGHTS = {"hot_feed": 0.1, "other_feeds": 0.1, "english": 0.15, "european": 0.5, "long_form": 0.15}
#: What each further pass over the same documents costs a token; rising, so that repetition is spread evenly.
EPOCH_COSTS = (0, 1, 3, 7)
SEED = 20
BUDGET_RATIO = 1.0
MOST_SOURCES = 16
_BUCKET_BITS = 12


def min_cost_flow(capacity: Mapping[int, int], quotas: Sequence[int], costs: Sequence[int] = EPOCH_COSTS) -> dict[tuple[int, int], int]:
    """Tokens that each membership pattern gives to each source: {(pattern, source): tokens > 0}.

    capacity: tokens of each pattern, a pattern being a bit set of source numbers. A pattern can be passed over
    len(costs) times, the e-th pass at costs[e] a token. As many tokens as possible go to the quotas, at the least
    total cost among such flows. Successive shortest paths over integers; the graph has a node for each pattern
    and source and doesn't grow with the documents. Equal costs are resolved by the order of patterns and sources.
    """
    patterns = sorted(p for p, c in capacity.items() if c > 0 and p)
    first, sink = 1, 1 + len(patterns) + len(quotas)
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, left, price = [], [], []

    def arc(u: int, v: int, room: int, cost: int) -> int:
        for a, b, r, c in ((u, v, room, cost), (v, u, 0, -cost)):
            graph[a].append(len(to))
            to.append(b)
            left.append(r)
            price.append(c)
        return len(to) - 2

    shares = {}
    for k, p in enumerate(patterns):
        for c in costs:
            arc(0, first + k, capacity[p], c)
        for s in range(len(quotas)):
            if p >> s & 1:
                shares[p, s] = arc(first + k, first + len(patterns) + s, capacity[p] * len(costs), 0)
    for s, q in enumerate(quotas):
        arc(first + len(patterns) + s, sink, q, 0)
    while True:
        far: list[float] = [float("inf")] * (sink + 1)
        via = [-1] * (sink + 1)
        far[0], moved = 0, True
        while moved:
            moved = False
            for u in range(sink + 1):
                for a in graph[u]:
                    if left[a] and far[u] + price[a] < far[to[a]]:
                        far[to[a]], via[to[a]], moved = far[u] + price[a], a, True
        if via[sink] < 0:
            break
        path, v = [], sink
        while v:
            path.append(via[v])
            v = to[via[v] ^ 1]
        room = min(left[a] for a in path)
        for a in path:
            left[a] -= room
            left[a ^ 1] += room
    return {k: left[a ^ 1] for k, a in shares.items() if left[a ^ 1]}


def _key(docs: DataFrame, doc_id: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), col(doc_id), col(text))


def _mask(sources: Mapping[str, str]) -> Column:
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(sources.values())]
    out = bits[0]
    for b in bits[1:]:
        out = out + b
    return out


def plan_mix(docs: DataFrame, *, sources: Mapping[str, str] = SOURCES, weights: Mapping[str, float] = WEIGHTS, budget_ratio: float = BUDGET_RATIO, costs: Sequence[int] = EPOCH_COSTS, seed: int = SEED, text: str = "text", doc_id: str = "doc_id") -> dict:
    """What mix() is going to do: capacities, quotas, flow, and for each pattern its passes.

    passes[pattern] is a list of (epoch, low, high, source): documents of the pattern whose seeded key is in
    [low, high) go to the source once more. Keys are 64-bit; None is an open end.
    """
    require(docs, text, doc_id)
    if not sources or len(sources) > MOST_SOURCES:
        raise ValueError(f"1 to {MOST_SOURCES} sources")
    if set(sources) != set(weights) or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("every source needs a weight, none negative, not all 0")
    space = Workspace(docs.sparkSession)
    narrow = space.put(docs.select(_mask(sources).alias("mask"), _key(docs, doc_id, text, seed).alias("key"), token_count(col(text)).alias("tokens")).where("mask > 0"))
    sums = narrow.groupBy("mask", F.shiftright("key", 64 - _BUCKET_BITS).alias("bucket")).agg(F.sum("tokens").alias("tokens"))
    per: dict[int, dict[int, int]] = {}
    for r in sums.collect():  # patterns x 4096 rows at most, whatever the number of documents
        per.setdefault(r["mask"], {})[r["bucket"]] = r["tokens"]
    capacity = {m: sum(b.values()) for m, b in per.items()}
    budget = int(sum(capacity.values()) * Fraction(budget_ratio))
    total = sum(Fraction(w) for w in weights.values())
    quotas = [int(budget * Fraction(weights[s]) / total) for s in sources]
    flow = min_cost_flow(capacity, quotas, costs)
    names = list(sources)
    tapes: dict[int, list[tuple[int, int, str]]] = {}
    for (m, s), n in sorted(flow.items()):
        tape = tapes.setdefault(m, [])
        begin = tape[-1][1] if tape else 0
        tape.append((begin, begin + n, names[s]))
    # the tape of a pattern is laid over its documents, again and again; cut it where an epoch or a source ends
    cuts: dict[int, set[int]] = {m: {p % capacity[m] for piece in tape for p in piece[:2]} - {0} for m, tape in tapes.items()}
    asked = []
    for m, points in cuts.items():
        buckets = sorted(per[m])
        starts, at = [], 0
        for b in buckets:
            starts.append(at)
            at += per[m][b]
        for p in sorted(points):
            k = bisect_right(starts, p) - 1
            asked.append((m, buckets[k], p - starts[k], p))
    keys: dict[tuple[int, int], int | None] = {}
    if asked:
        spark = docs.sparkSession
        want = spark.createDataFrame(asked, "mask int, bucket long, inside long, point long")
        ahead = W.partitionBy("mask", "bucket").orderBy("key").rangeBetween(W.unboundedPreceding, -1)
        # only the buckets that hold a cut are ordered; rows with equal keys stay together
        some = narrow.withColumn("bucket", F.shiftright("key", 64 - _BUCKET_BITS)).join(F.broadcast(want.select("mask", "bucket").distinct()), ["mask", "bucket"])
        some = some.groupBy("mask", "bucket", "key").agg(F.sum("tokens").alias("tokens"))
        placed = some.withColumn("before", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)))
        hit = placed.join(F.broadcast(want), ["mask", "bucket"]).where("before >= inside").groupBy("mask", "point").agg(F.min("key").alias("key"))
        keys = {(r["mask"], r["point"]): r["key"] for r in hit.collect()}
        for m, b, _, p in asked:  # the cut lies in the last document of its bucket: the next bucket begins after it
            keys.setdefault((m, p), None if b + 1 >= 1 << (_BUCKET_BITS - 1) else (b + 1) << (64 - _BUCKET_BITS))
    passes: dict[int, list[tuple[int, int | None, int | None, str]]] = {}
    for m, tape in tapes.items():
        size, out = capacity[m], []
        for begin, end, name in tape:
            while begin < end:
                epoch, low = divmod(begin, size)
                high = min(end - epoch * size, size)
                a, b = (keys[m, low] if low else None), (keys[m, high] if high < size else None)
                last = high == size
                if not (low and a is None):
                    out.append((epoch, a, None if last else b, name))
                begin = epoch * size + high
        passes[m] = out
    space.drop(narrow)
    return {"capacity": capacity, "quotas": dict(zip(names, quotas)), "flow": {(m, names[s]): n for (m, s), n in flow.items()}, "passes": passes}


def mix(docs: DataFrame, *, sources: Mapping[str, str] = SOURCES, weights: Mapping[str, float] = WEIGHTS, budget_ratio: float = BUDGET_RATIO, costs: Sequence[int] = EPOCH_COSTS, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", labelled: bool = False) -> DataFrame:
    """``docs`` sampled, and repeated where needed, so that sources get tokens by their weights.

    sources: name -> SQL predicate; a document may satisfy several, and its satisfied set is its pattern (a
    predicate that is null isn't satisfied). The token budget is ``budget_ratio`` times the tokens of all documents
    of some source; each source's quota is its weight of that. min_cost_flow() routes each pattern's tokens to
    quotas; then the documents of a pattern, in a seeded order, are laid against what the pattern gives: a document
    is taken for a source if it begins within that source's stretch, and once more for each further pass.

    Same columns, one row for each time that a document is taken; with ``labelled``, two more: ``mix_source`` and
    ``mix_copy`` (from 0), which replace input columns of those names. No text is shuffled: the plan is a handful
    of key ranges for each pattern. Sources' sums exceed or miss the flow by a document a range at most. Documents
    of no source, and those that the flow leaves over, aren't taken. Empty or null texts have no tokens and follow
    their key. Identical rows have one key, so they are taken or left together. A quota that nothing can fill stays
    short. An empty table gives an empty table.
    """
    plan = plan_mix(docs, sources=sources, weights=weights, budget_ratio=budget_ratio, costs=costs, seed=seed, text=text, doc_id=doc_id)
    names = [c for c in docs.columns if not labelled or c not in ("mix_source", "mix_copy")]
    rows = packed(docs, mask=_mask(sources), key=_key(docs, doc_id, text, seed))
    taken = F.lit(None).cast("array<struct<mix_source:string,mix_copy:int>>")
    for m, passes in plan["passes"].items():
        each = []
        for epoch, low, high, name in passes:
            inside = F.lit(True)
            if low is not None:
                inside = inside & (F.col("key") >= low)
            if high is not None:
                inside = inside & (F.col("key") < high)
            each.append(F.when(inside, F.struct(F.lit(name).alias("mix_source"), F.lit(epoch).alias("mix_copy"))))
        if each:
            taken = F.when(F.col("mask") == m, F.array_compact(F.array(*each))).otherwise(taken)
    out = rows.withColumn("taken", F.explode(taken))
    if not labelled:
        return unpacked(out, names)
    return out.select(*[F.col(ROW).getField(n).alias(n) for n in names], "taken.mix_source", "taken.mix_copy")
