"""Sharding by balanced label propagation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, col, hashed_words, mixed, portions, require, small_batches
from .packing import token_count

SHARDS = 16
ROUNDS = 10
SLACK = 0.02
SEED = 4
#: Words of a passage, and passages of a window: any SHINGLE + WINDOW - 1 words that two texts share link them.
SHINGLE = 8
WINDOW = 8
#: Classes of gain, each wider by the square root of two, up to the largest number there is.
_GAINS = 128
#: Weights are counted in these parts of a line: whole numbers, so that sums don't depend on their order.
_UNIT = 1 << 32
_PARTS = 64
_BUCKETS = 4096
#: Characters whose words are hashed at a time, about: arrays of them stay in a cache.
_PORTION = 1 << 17
#: Marks that a task sorts at a time, about, and tokens of the table for each bucket of marks, at most.
_BLOCK = 1 << 20
#: Rows that a task hands to Spark at a time, at most.
_SLICE = 1 << 16
_SPREAD = 1 << 23
#: Holders of a node that one task joins at a time, about.
_CHUNK = 1 << 20
#: Rows of a task of the rounds, about.
_LAYOUT = 1 << 17
#: A shard with less than this part of its quota left isn't asked.
_TIGHT = 0.005


def _winnowed(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of passages() of all texts, in their order, and their number for each text; some of a text's may repeat."""
    h, lengths = hashed_words(texts)
    doc, begin = np.repeat(np.arange(len(texts)), lengths), np.cumsum(lengths) - lengths
    n = max(0, len(h) - SHINGLE + 1)
    g = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    g = mixed(g)
    inside = doc[:n] == doc[min(SHINGLE - 1, len(doc)) :]
    low, owner = g[inside], doc[:n][inside]
    if len(low):
        most = np.uint64(2**64 - 1)
        padded, beyond = np.r_[low, np.full(WINDOW, most)], np.r_[owner, np.full(WINDOW, -1)]
        for j in range(1, WINDOW):
            np.minimum(low, np.where(beyond[j : j + len(low)] == owner, padded[j : j + len(low)], most), out=low)
        first = np.r_[True, owner[1:] != owner[:-1]]
        taken = first | (beyond[WINDOW - 1 : WINDOW - 1 + len(low)] == owner)
        low, owner = low[taken], owner[taken]
        new = np.r_[True, (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])]
        low, owner = low[new], owner[new]
    few = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    whole = lengths[few].astype(np.uint64)
    for j in range(SHINGLE - 1):
        more = lengths[few] > j
        whole[more] = mixed(whole[more] * np.uint64(0x9E3779B97F4A7C15) + h[begin[few[more]] + j])
    order = np.argsort(np.r_[owner, few], kind="stable")
    return np.r_[low, whole][order].view(np.int64), np.bincount(np.r_[owner, few], minlength=len(texts))


def passages(texts: Sequence[str | None]) -> list[np.ndarray]:
    """For each text the distinct hashes of some of its runs of SHINGLE words, in lower case: the least of every WINDOW
    that follow one another (winnowing). A text of fewer windows has the least of all, one of fewer words than a run
    has all its words as one; one without words has none."""
    found, counts = _winnowed(texts)
    return [np.unique(x) for x in np.split(found, np.cumsum(counts)[:-1])] if len(texts) else []


def _passages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for b in batches:
        found = [_winnowed(texts) for texts in portions(b.to_pylist(), _PORTION)]
        counts = np.concatenate([np.zeros(1, np.int64), *[c for _, c in found]])
        yield pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *[x for x, _ in found]])))


def _marks(text: Column) -> Column:
    """Hashes of the lines and passages of a text; some may repeat."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    return F.concat(F.transform(lines, lambda x: F.xxhash64(x)), F.arrow_udf(_passages, T.ArrayType(T.LongType()))(text))


def holders(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(node, id, n, w): a node stands for the w lines, of any length but blank ones, and passages(), that the same n
    documents hold, two at least. All pairs of holders are linked by it, in one row a holder. Null ids and texts hold
    nothing; repeated rows of one id are one holder."""
    require(docs, text, doc_id)
    small_batches(docs.sparkSession)
    space = Workspace(docs.sparkSession)
    with space.scope():
        inner = Workspace(docs.sparkSession)
        rows = docs.where(col(doc_id).isNotNull()).select(col(doc_id).alias("id"), token_count(col(text)).alias("tokens"), _marks(col(text)).alias("marks"))
        return space.put(_holders(inner.put(rows), inner))


def _sorted(marks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(marks, kind="stable")
    return marks[order], ids[order]


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])


def _send(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (id, marks) with ids of their own: (bucket, marks, ids), the last two as bytes of as many numbers."""

    def block(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        # passages are least hashes: mixed again they spread evenly. What a row has twice is side by side once sorted
        m, d = _sorted(mixed(np.concatenate([x for x, _ in held]).view(np.uint64)), np.concatenate([x for _, x in held]))
        new = np.r_[True, (m[1:] != m[:-1]) | (d[1:] != d[:-1])]
        m, d = m[new], d[new]
        to = (m >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = _starts(to)
        spans = list(zip(cuts, [*cuts[1:], len(m)]))
        return pa.record_batch([pa.array(to[cuts].astype(np.int32)), *[pa.array([x[i:j].tobytes() for i, j in spans], pa.binary()) for x in (m, d)]], ["bucket", "marks", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            marks = b.column("marks")
            ids = np.repeat(b.column("id").to_numpy(zero_copy_only=False), marks.value_lengths().to_numpy(zero_copy_only=False))
            held.append((marks.flatten().to_numpy(zero_copy_only=False), ids))
            size += len(ids)
            if size >= _BLOCK:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    return run


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of what _send() made: (mark, id) for the holders of marks that have two at least, and (mark, node, n) for each
    such mark. Holders are handed on as they come and not kept: a task keeps a row for each mark of its buckets."""
    golden = np.uint64(0x9E3779B97F4A7C15)
    known = np.empty(0, np.uint64)  # sorted, each with its first holder, and the number and two sums of hashes of all
    table = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)]

    def out(m: np.ndarray, *values: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(m), _SLICE):
            some = [pa.nulls(len(m[k : k + _SLICE]), pa.int64()) if x is None else pa.array(x[k : k + _SLICE].view(np.int64)) for x in (m, *values)]
            yield pa.record_batch(some, ["mark", "id", "node", "n"])

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, size = [], 0
        for b in batches:
            for m, d in zip(b.column("marks"), b.column("ids")):
                held.append((np.frombuffer(m.as_buffer(), np.uint64), np.frombuffer(d.as_buffer(), np.int64)))
                size += len(held[-1][0])
                if size >= _BLOCK:
                    yield _sorted(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
                    held, size = [], 0
        if size:
            yield _sorted(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))

    for m, d in blocks():
        cuts = _starts(m)
        u, c, h = m[cuts], np.diff(np.r_[cuts, len(m)]), mixed(d.view(np.uint64) * golden + golden)
        more = [d[cuts], c, np.add.reduceat(h, cuts), np.add.reduceat(mixed(h + golden), cuts)]
        at = np.searchsorted(known, u)
        old = np.zeros(len(u), bool)
        inside = at < len(known)
        old[inside] = known[at[inside]] == u[inside]
        before = np.zeros(len(u), np.int64)
        before[old] = table[1][at[old]]
        late = before == 1
        yield from out(u[late], table[0][at[late]], None, None)
        shared = np.repeat(before + c > 1, c)
        yield from out(m[shared], d[shared], None, None)
        for x, y in zip(table[1:], more[1:]):
            x[at[old]] += y[old]
        order = np.argsort(np.r_[known, u[~old]], kind="stable")
        known = np.r_[known, u[~old]][order]
        table = [np.r_[x, y[~old]][order] for x, y in zip(table, more)]
    several = table[1] > 1
    n, s, t = (x[several] for x in table[1:])
    yield from out(known[several], None, mixed(mixed(mixed(s + golden) * golden + t) * golden + n.view(np.uint64)), n)


def _holders(signed: DataFrame, space: Workspace) -> DataFrame:
    kind, names, spark = dict(signed.dtypes)["id"], None, signed.sparkSession
    rows = signed.select("id", "marks")
    if kind not in ("tinyint", "smallint", "int", "bigint"):  # tasks sort numbers
        names = space.put(signed.select("id").distinct().select("id", F.monotonically_increasing_id().alias("key")))
        rows = rows.join(names, "id").select(F.col("key").alias("id"), "marks")
    again = space.put(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    if not again.isEmpty():  # repeated rows of one id are one holder
        whole = rows.join(again, "id", "left_semi").select("id", F.explode("marks").alias("mark")).distinct()
        rows = rows.join(again, "id", "left_anti").unionByName(whole.select("id", F.array("mark").alias("marks")))
    # most marks have one holder: they are sent by blocks and go in the tasks that sort them
    tokens = signed.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // _SPREAD + 1)
    sent = rows.select(F.col("id").cast("long").alias("id"), "marks").mapInArrow(_send(buckets), "bucket int, marks binary, ids binary")
    found = space.put(sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_share, "mark long, id long, node long, n long"))
    # marks of one node have one set of holders: one of them stands for all, with their number
    nodes = space.put(found.where("node is not null").groupBy("node", "n").agg(F.min("mark").alias("mark"), F.count("*").alias("w")))
    # both sides come from shuffles of their own, so that the holders of a hot mark are split at run time; the other side
    # has a row a node, and is hashed
    held = found.where("node is null").select("mark", "id").join(nodes.hint("shuffle_hash"), "mark")
    if names is None:
        return held.select("node", F.col("id").cast(kind).alias("id"), "n", "w")
    return held.select("node", F.col("id").alias("key"), "n", "w").join(names, "key").select("node", "id", "n", "w")


def cut_pairs(held: DataFrame, shards: DataFrame) -> tuple[int, int]:
    """Weight of the pairs of holders in different shards, and of all. held: as of holders(), shards: (doc_id, shard)."""
    per = held.join(shards.select(F.col("doc_id").alias("id"), "shard"), "id").groupBy("node", "w", "shard").agg(F.count("*").alias("c"))
    node = per.groupBy("node", "w").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("q"))
    got = node.agg(F.sum(F.expr("w * (n * n - q) div 2")).alias("cut"), F.sum(F.expr("w * n * (n - 1) div 2")).alias("total")).first()
    return got["cut"] or 0, got["total"] or 0


def _pick(values: Column, table: dict[int, Column], default: Column) -> Column:
    out = default
    for k, v in table.items():
        out = F.when(values == k, v).otherwise(out)
    return out


def _spread(sizes: Mapping[int, int], held: Mapping[int, int], shards: int) -> tuple[dict[int, int], dict[int, int]]:
    """Shard of each bucket, and the shards' sizes then: the largest bucket first, each to the shard that holds least."""
    heap = [(held.get(s, 0), s) for s in range(shards)]
    heapify(heap)
    out = {}
    for b, t in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        size, s = heap[0]
        heapreplace(heap, (size + t, s))
        out[b] = s
    return out, {s: size for size, s in heap}


def _by_bucket(rows: DataFrame, held: Mapping[int, int], shards: int) -> tuple[DataFrame, dict[int, int]]:
    """rows with a shard by their bucket, and the shards' sizes."""
    per = {r["bucket"]: r["t"] for r in rows.groupBy("bucket").agg(F.sum("tokens").alias("t")).collect()}  # _BUCKETS rows at most
    where, sizes = _spread(per, held, shards)
    table = rows.sparkSession.createDataFrame(sorted(where.items()) or [(0, 0)], "bucket int, shard int")
    return rows.join(F.broadcast(table), "bucket"), sizes


def _wishes(asks: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds (to, gain): the other shard that a document asks for, if any gains weight and it is its turn, and the class
    of the gain. asks: what room each shard has, for documents to ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = np.array(asks, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            get = lambda n: b.column(n).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            weights, own, row = np.stack([get(f"w{s}") for s in range(len(asks))], axis=1), get("own"), np.arange(b.num_rows)
            stay = weights[row, own] - get("self")  # without the document itself
            may = (get("tokens")[:, None] <= room) & (weights > 0)
            may[row, own] = False
            open_to = np.where(may, weights, 0)
            to = np.argmax(open_to, axis=1)  # the first of equal ones
            more = np.where(may.any(axis=1), open_to[row, to] - stay, 0)
            gains = more > 0
            gain = (2 * np.log2(np.where(gains, more, 1))).astype(np.int32)
            asked = gains & (get("part") < _PARTS)
            yield pa.record_batch([*b.columns, pa.array(to.astype(np.int32), mask=~asked), pa.array(gain, mask=~gains)], [*b.schema.names, "to", "gain"])

    return run


def shard_documents(docs: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK, seed: int = SEED, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, shard) for every distinct id: shards of even token sizes that keep linked documents together.

    holders() joins documents by shared lines and by passages anywhere in them: nodes, of which all holders are
    linked. Linked documents start in seeded hash buckets, spread evenly over the shards. Each round counts the holders
    of each node in each shard, and a seeded half of the documents asks to move to the shard, of those with room,
    that holds most of the weight of its nodes' other holders, if that is more than in its own. A shard admits as
    much as it has room for below its quota, by classes of gain, the largest first. Who finds the best shard full
    gathers in the next best. Rounds end when nobody moves, or after ``rounds``. Documents without links then fill the
    shards up, by hash buckets, the largest to the emptiest shard.

    The quota is (1 + ``slack``) times an even share, and is never exceeded, unless single documents or hash buckets
    are larger than the slack: then it is what the even spread at the start needs. What the driver sees is
    bounded by ``shards`` and the number of buckets; each round's shards are written to the shared folder. Rows with
    a null id are left out; rows with one id are one document, with all their tokens. Null and empty texts have size
    0 and no links. Other columns aren't read. An empty table gives no rows.
    """
    require(docs, text, doc_id)
    space = Workspace(docs.sparkSession)
    with space.scope():
        return space.put(_shard_documents(docs, shards, rounds, slack, seed, text, doc_id))


def _shard_documents(docs: DataFrame, shards: int, rounds: int, slack: float, seed: int, text: str, doc_id: str) -> DataFrame:
    small_batches(docs.sparkSession)
    space = Workspace(docs.sparkSession)
    rows = docs.where(col(doc_id).isNotNull()).select(col(doc_id).alias("id"), token_count(col(text)).alias("tokens"), _marks(col(text)).alias("marks"))
    signed = space.put(rows)
    # a node pulls each holder with its lines and passages, of which each of the n - 1 others has an even part; the
    # holders of a node are in parts of some CHUNK rows
    parts = F.ceil(F.col("n") / _CHUNK).cast("int")
    part = F.pmod(F.xxhash64("id", F.lit(seed)), "parts").cast("int").alias("part")
    pull = F.expr(f"w * {_UNIT}L div (n - 1)").alias("w")
    both = space.put(_holders(signed, space).select("node", "id", pull, parts.alias("parts")).select("node", "id", "w", "parts", part))
    sizes = signed.groupBy("id").agg(F.sum("tokens").alias("tokens"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(_BUCKETS)).cast("int")
    every = space.put(sizes.join(both.groupBy("id").agg(F.sum("w").alias("self")), "id", "left").withColumn("bucket", bucket))
    space.drop(signed)
    even = (every.agg(F.sum("tokens")).first()[0] or 0) / shards
    begin, held = _by_bucket(every.where("self is not null"), {}, shards)
    quota = max(int(even * (1 + slack)), max(held.values()))
    now = space.put(begin.select("id", "tokens", "self", "shard"))
    loop, state, moves = now, None, now.withColumn("was", F.lit(None).cast("int"))
    # every round joins these rows by id and by node: they are laid out once for each, in tasks of some LAYOUT rows
    tasks = both.count() // _LAYOUT + 1
    by_id = both.select("node", "id", "parts").repartition(tasks, "id").persist(StorageLevel.DISK_ONLY)
    by_node = both.select("node", "part", "id", "w").repartition(tasks, "node", "part").persist(StorageLevel.DISK_ONLY)
    every_shard = range(shards)
    names = [f"w{s}" for s in every_shard]
    for k in range(rounds):
        held = {r["shard"]: r["s"] for r in now.groupBy("shard").agg(F.sum("tokens").alias("s")).collect()}
        room = [quota - held.get(s, 0) for s in every_shard]
        # what changed of a node's holders in each shard is one row, for each part of the node; at first, all did
        there = by_id.join(moves.select("id", "shard", "was").hint("shuffle_hash"), "id")
        change = [F.count(F.when(F.col("shard") == s, 1)) - F.count(F.when(F.col("was") == s, 1)) for s in every_shard]
        count = there.groupBy("node").agg(F.first("parts").alias("parts"), *[c.alias(f"c{s}") for s, c in enumerate(change)])
        count = count.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        weights = by_node.join(count.hint("shuffle_hash"), ["node", "part"]).groupBy("id").agg(*[F.sum(F.col("w") * F.col(f"c{s}")).alias(n) for s, n in enumerate(names)])
        own = now.select("id", "tokens", "self", F.col("shard").alias("own"))
        if state is None:
            weighed = own.hint("shuffle_hash").join(weights, "id")
        else:
            more = weights.select("id", *[F.col(n).alias(f"d{n}") for n in names])
            weighed = now.withColumnRenamed("shard", "own").join(more.hint("shuffle_hash"), "id", "left")
            weighed = weighed.select("id", "tokens", "self", "own", *[(F.col(n) + F.coalesce(F.col(f"d{n}"), F.lit(0))).alias(n) for n in names])
        # a round's salt is a row and not part of the plan: the code that is compiled for one round serves all
        table = docs.sparkSession.createDataFrame([(seed * 1000 + k,)], "salt int")
        part = F.pmod(F.xxhash64("salt", "id"), F.lit(2 * _PARTS)).cast("int").alias("part")
        weighed = weighed.crossJoin(F.broadcast(table)).select("id", "tokens", "self", "own", *names, part)
        asks = [r if r >= _TIGHT * quota else -1 for r in room]
        kinds = ", ".join([f"id {dict(weighed.dtypes)['id']}, tokens bigint, self bigint, own int", *[f"{n} bigint" for n in names], "part int, to int, gain int"])
        wish = weighed.mapInArrow(_wishes(asks), kinds)
        wish = space.put(wish)
        space.drop(loop)
        asked = wish.where("to is not null").groupBy("to", "gain", "part").agg(F.sum("tokens").alias("t")).collect()  # shards x _GAINS x _PARTS rows at most
        limit = []
        for s in every_shard:
            left, last = room[s], -1
            for r in sorted((r for r in asked if r["to"] == s), key=lambda r: (-r["gain"], r["part"])):
                left -= r["t"]
                if left < 0:
                    break
                last = (_GAINS - r["gain"]) * _PARTS + r["part"]
            limit.append(last)
        rank = (F.lit(_GAINS) - F.col("gain")) * _PARTS + F.col("part")
        moved = F.col("to").isNotNull() & (rank <= F.element_at(F.array(*map(F.lit, limit)), F.col("to") + 1))
        loop = state = wish
        now = wish.select("id", "tokens", "self", F.when(moved, F.col("to")).otherwise(F.col("own")).cast("int").alias("shard"), *names)
        moves = wish.where(moved).select("id", F.col("to").cast("int").alias("shard"), F.col("own").alias("was"))
        if not asked:
            break
    by_id.unpersist()
    by_node.unpersist()
    held = {r["shard"]: r["s"] for r in now.groupBy("shard").agg(F.sum("tokens").alias("s")).collect()}
    loose, _ = _by_bucket(every.where("self is null"), held, shards)
    return now.select(F.col("id").alias("doc_id"), "shard").unionByName(loose.select(F.col("id").alias("doc_id"), "shard"))
