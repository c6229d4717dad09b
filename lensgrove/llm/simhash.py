"""SimHash near-duplicates by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, col, hashed_words, mixed, packed, portions, require, small_batches, unpacked
from .components import components

BITS = 128
BLOCKS = 8
WIDTH = BITS // BLOCKS
BUDGET = 23
#: Fingerprints of one trie that a task holds, about; more of them are parted by longer prefixes, and by chunks.
SUBTRIE_ROWS = 1 << 20
#: Row pairs compared, rows gathered for that, and node pairs expanded, at a time: they bound a task's memory, not what
#: it finds.
CELLS = 1 << 16
GATHERED = 1 << 19
NODES = 60_000
#: Node pairs of as many row pairs are compared outright, of DEEP times as many below the first block: there one bit
#: more hardly prunes. Nodes that have fewer than SPARSE row pairs with all their partners are compared together.
LEAF = 1024
DEEP = 64
SPARSE = 256

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: A byte's bits as eight bytes, in one word: sums of these words count bits.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
#: Features whose bits are counted together, as binary digits.
_GROUP = 15


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and carries of three bit vectors."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _bit_counts(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often each of BITS bits is set in each run of rows (n, 2) uint64; sizes: rows of each run, none 0."""
    groups = -(-sizes // _GROUP)
    start, begin = np.cumsum(groups) - groups, np.cumsum(sizes) - sizes
    total = int(groups.sum())
    place = np.arange(len(rows)) - np.repeat(begin, sizes)
    flat = np.zeros((_GROUP * total, 2), np.uint64)
    flat[place % _GROUP * total + np.repeat(start, sizes) + place // _GROUP] = rows
    level = list(flat.reshape(_GROUP, total, 2))
    counts = None
    for digit in range(4):  # full adders, until one vector of each binary digit is left
        carries = []
        while len(level) > 1:
            s, c = _add(*level[:3])
            level = [*level[3:], s]
            carries.append(c)
        some = _SPREAD[level[0].astype(">u8").view(np.uint8).reshape(total, BITS // 8)] << np.uint64(digit)
        counts = some if counts is None else counts + some
        level = carries
    # bytes hold the counts of 17 groups at most; then the sums of a run's parts
    parts = -(-groups // 17)
    first = np.cumsum(parts) - parts
    at = np.repeat(start, parts) + 17 * (np.arange(parts.sum()) - np.repeat(first, parts))
    return np.add.reduceat(np.add.reduceat(counts, at, axis=0).view(np.uint8).reshape(-1, BITS), first, axis=0, dtype=np.int64)


def simhash(texts: Sequence[str | None]) -> list[bytes | None]:
    """128-bit fingerprints; a text that is null or has no word has none.

    A document is compared by all its words, in lower case, and by all pairs of words that follow one another. A word
    weighs 1 however often it occurs; a pair weighs the number of binary digits of its count, so order and
    repetition both tell. A bit is set if more than half of the weight has it set.
    """
    out: list[bytes | None] = [None] * len(texts)
    h, lengths = hashed_words(texts)
    if not len(h):
        return out
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
    same = doc[1:] == doc[:-1]
    double = mixed(h[:-1] * _MIX[0] + h[1:])[same]
    # a feature is 47 bits of hash and whether it is a pair; sorting puts a document's together and counts them
    doc <<= np.uint64(48)
    key = np.concatenate([doc | h >> np.uint64(16) & ~np.uint64(1), doc[1:][same] | double >> np.uint64(16) | np.uint64(1)])
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    weight = np.where(key & np.uint64(1), np.frexp(count)[1], 1)
    if (weight > 1).any():
        key = np.repeat(key, weight)
    total = np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=len(texts))
    have = np.flatnonzero(total)
    feature = key & np.uint64((1 << 48) - 1)
    ones = _bit_counts(np.stack([mixed(feature * _MIX[0]), mixed(feature * _MIX[1] + _MIX[0])], 1), total[have])
    for k, p in zip(have, np.packbits(2 * ones > total[have][:, None], axis=1)):
        out[k] = p.tobytes()
    return out


_SIGNED = T.StructType([T.StructField("fp", T.BinaryType()), T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())])


def _simhash_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for b in batches:
        fp = [x for texts in portions(b.tolist(), 250_000) for x in simhash(texts)]
        halves = np.frombuffer(b"".join(x or bytes(BITS // 8) for x in fp), ">i8").reshape(-1, 2).astype(np.int64)
        yield pd.DataFrame({"fp": pd.Series(fp, dtype=object), "hi": halves[:, 0], "lo": halves[:, 1]})


def allowance(depth: int, budget: int) -> int:
    """Most errors that the first ``depth`` bits may hold.

    If two fingerprints differ in at most ``budget`` bits, some rotation by whole blocks keeps, for every j, the
    errors of its first j blocks at or below j/BLOCKS of the budget (the cycle lemma); only that rotation has to
    find the pair, so each may prune by the share of the budget that belongs to the blocks entered so far.
    """
    return budget * min(BLOCKS, -(-depth // WIDTH)) // BLOCKS


def forest(i: np.ndarray, j: np.ndarray, label: np.ndarray) -> np.ndarray:
    """label, each row's least row of its component, after the pairs (i, j) have been joined as well."""
    label = label.copy()
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label != (up := label[label])).any():
            label = up


def _near(keys: np.ndarray, i: np.ndarray, j: np.ndarray, budget: int) -> np.ndarray:
    return np.bitwise_count(keys[i, 0] ^ keys[j, 0]) + np.bitwise_count(keys[i, 1] ^ keys[j, 1]) <= budget


class _Pairs:
    """Found pairs; if ``linked``, folded into a spanning forest as they come, by which settled nodes are known."""

    def __init__(self, n: int, linked: bool):
        self.n, self.linked, self.i, self.j, self.waiting, self.total = n, linked, [], [], 0, 0
        self.label = np.arange(n) if linked else None
        self.changes: np.ndarray | None = None

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.i.append(i)
        self.j.append(j)
        self.waiting += len(i)
        self.total += len(i)
        if self.linked and self.waiting > max(self.n // 4, 1000):
            self.fold()

    def fold(self) -> None:
        if self.i:
            self.label = forest(np.concatenate(self.i), np.concatenate(self.j), self.label)
        self.i, self.j, self.waiting = [], [], 0
        if 4 * self.total > self.n:  # where links are few, looking for settled nodes costs more than it saves
            self.changes = np.r_[0, np.cumsum(self.label[1:] != self.label[:-1])]

    def open(self, a0, a1, b0, b1) -> np.ndarray | None:
        """Which node pairs aren't within one component already; None for all."""
        c = self.changes
        if c is None:
            return None
        return (self.label[a0] != self.label[b0]) | (c[a1 - 1] != c[a0]) | (c[b1 - 1] != c[b0])

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if self.linked:
            self.fold()
            rows = np.flatnonzero(self.label != np.arange(self.n))
            return rows, self.label[rows]
        none = np.empty(0, np.int64)
        return np.concatenate([none, *self.i]), np.concatenate([none, *self.j])


def trie_pairs(keys: np.ndarray, budget: int, middle: int | None = None, depth: int = 0, errors: int = 0, leaf: int = LEAF, linked: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows at most ``budget`` bits apart, of tries that are traversed together.

    keys: (n, 2) uint64, most significant word first. A trie node is a range of sorted rows with a common prefix, and
    the traversal starts with the pair (root, root) of all rows; with ``middle``, with the roots of two tries, the
    rows before it and those from it on, each sorted, whose common prefixes of ``depth`` bits differ in ``errors``.
    A step descends both nodes of a pair by one bit: equal bits keep the errors, unequal bits add one, and a pair
    beyond allowance() is dropped. Pairs of small nodes are compared outright, all partners of a node at once, and
    their rows again are held against allowance() at the end of the first word.

    With ``linked``, a spanning forest of what the pairs connect, as (row, least row of its component): pairs are
    folded into it as they come, neighbours in sorted order first, and node pairs within one component are not
    descended further. A group of thousands then takes time and memory for its members and not for its pairs.
    """
    n = len(keys)
    found = _Pairs(n, linked)
    if n < 2 or middle is not None and not 0 < middle < n:
        return found.result()
    at = np.array([0, n if middle is None else middle, 0 if middle is None else middle, n], np.int64)
    stack = [(depth, *(at[k : k + 1] for k in range(4)), np.array([errors], np.int16))]
    bits: dict[int, np.ndarray] = {}
    if linked and middle is None:
        i = np.arange(n - 1)
        i = i[_near(keys, i, i + 1, budget)]
        found.add(i, i + 1)

    def split(a: np.ndarray, b: np.ndarray, d: int) -> np.ndarray:
        """First row of each node [a, b) whose bit d is set."""
        word, shift = d // 64, np.uint64(63 - d % 64)
        if d < 28:
            if d not in bits:
                bits[d] = np.r_[0, np.cumsum((keys[:, word] >> shift) & np.uint64(1), dtype=np.int32)].astype(np.int32)
            return b - (bits[d][b] - bits[d][a])
        low, high = a.copy(), b.copy()  # deep nodes are small: halving takes few steps
        while (going := low < high).any():
            at = (low + high) >> 1
            one = (keys[np.minimum(at, n - 1), word] >> shift & np.uint64(1)).astype(bool)
            high = np.where(going & one, at, high)
            low = np.where(going & ~one, at + 1, low)
        return low

    first = np.ascontiguousarray(keys[:, 0])
    half = allowance(64, budget)  # of the rotation that has to find the pair
    xor, errs, good = np.empty(CELLS, np.uint64), np.empty(CELLS, np.uint8), np.empty(CELLS, bool)

    def keep(i, j):
        ok = (i < j) & _near(keys, i, j, budget)
        found.add(i[ok], j[ok])

    def compare(a0, a1, b0, b1):
        order = np.argsort(a0, kind="stable")
        a0, a1, b0, b1 = (x[order] for x in (a0, a1, b0, b1))
        begin = np.flatnonzero(np.r_[True, a0[1:] != a0[:-1]])
        few = np.add.reduceat((a1 - a0) * (b1 - b0), begin) < SPARSE
        of = np.repeat(few, np.diff(np.r_[begin, len(a0)]))
        if of.any():
            sparse(a0[of], a1[of], b0[of], b1[of])
            a0, a1, b0, b1 = (x[~of] for x in (a0, a1, b0, b1))
        at = 0
        while at < len(a0):
            upto = max(at + 1, int(np.searchsorted(np.cumsum(b1[at:] - b0[at:]), GATHERED, side="right")) + at)
            dense(a0[at:upto], a1[at:upto], b0[at:upto], b1[at:upto])
            at = upto

    def sparse(a0, a1, b0, b1):
        nb, size = b1 - b0, (a1 - a0) * (b1 - b0)
        ends = np.cumsum(size)
        for begin in range(0, int(ends[-1]), CELLS):
            cell = np.arange(begin, min(begin + CELLS, int(ends[-1])))
            which = np.searchsorted(ends, cell, side="right")
            k = cell - (ends[which] - size[which])
            i, j = a0[which] + k // nb[which], b0[which] + k % nb[which]
            ok = np.bitwise_count(first[i] ^ first[j]) <= half
            keep(i[ok], j[ok])

    def dense(a0, a1, b0, b1):
        """One node's rows against those of all its partners at once, by first words."""
        nb = b1 - b0
        ends = np.cumsum(nb)
        rows = np.arange(ends[-1]) + np.repeat(b0 - ends + nb, nb)
        right = first[rows]
        cuts = np.flatnonzero(np.r_[True, a0[1:] != a0[:-1]])
        i, j, many = [], [], 0
        for x0, x1, y0, y1 in zip(a0[cuts].tolist(), a1[cuts].tolist(), np.r_[0, ends][cuts].tolist(), np.r_[ends[cuts[1:] - 1], ends[-1]].tolist()):
            for x in range(x0, x1, CELLS):
                height = min(x1 - x, CELLS)
                left, step = first[x : x + height, None], CELLS // height
                for y in range(y0, y1, step):
                    width = min(y1 - y, step)
                    u, e, g = (t[: height * width].reshape(height, width) for t in (xor, errs, good))
                    np.bitwise_xor(left, right[y : y + width], out=u)
                    np.bitwise_count(u, out=e)
                    np.less_equal(e, half, out=g)
                    f = np.flatnonzero(good[: height * width])
                    if len(f):
                        i.append(x + f // width)
                        j.append(rows[y + f % width])
                        many += len(f)
                        if many > CELLS:
                            keep(np.concatenate(i), np.concatenate(j))
                            i, j, many = [], [], 0
        if many:
            keep(np.concatenate(i), np.concatenate(j))

    while stack:
        d, a0, a1, b0, b1, err = stack.pop()
        if len(a0) > NODES:  # a node's pairs stay together
            order, middle = np.argsort(a0, kind="stable"), len(a0) // 2
            stack += [(d, *(x[some] for x in (a0, a1, b0, b1, err))) for some in (order[:middle], order[middle:])]
            continue
        ok = found.open(a0, a1, b0, b1)
        if ok is not None and not ok.all():
            a0, a1, b0, b1, err = (x[ok] for x in (a0, a1, b0, b1, err))
        small = ((a1 - a0) * (b1 - b0) <= (leaf if d < WIDTH else DEEP * leaf)) | (d >= BITS)
        if small.any():
            compare(a0[small], a1[small], b0[small], b1[small])
            a0, a1, b0, b1, err = (x[~small] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        am, bm, own = split(a0, a1, d), split(b0, b1, d), a0 == b0
        apart = err + np.int16(1)
        parts = [(a0, am, b0, bm, err, None), (am, a1, bm, b1, err, None), (a0, am, bm, b1, apart, None), (am, a1, b0, bm, apart, ~own)]
        most, new = allowance(d + 1, budget), []
        for x0, x1, y0, y1, e, only in parts:
            ok = (x1 > x0) & (y1 > y0) & (e <= most)
            if only is not None:
                ok &= only
            new.append(tuple(x[ok] for x in (x0, x1, y0, y1, e)))
        stack.append((d + 1, *(np.concatenate(x) for x in zip(*new))))
    return found.result()


def rotated(keys: np.ndarray, turn: int) -> np.ndarray:
    """Fingerprints (n, 2) uint64, turned left by ``turn`` blocks."""
    turn %= BLOCKS
    a, b = (keys[:, 0], keys[:, 1]) if turn < BLOCKS // 2 else (keys[:, 1], keys[:, 0])
    s = np.uint64(turn % (BLOCKS // 2) * WIDTH)
    if not s:
        return np.stack([a, b], 1)
    r = np.uint64(64) - s
    return np.stack([a << s | b >> r, b << s | a >> r], 1)


def _turned(turn: int) -> tuple[Column, Column]:
    """rotated() of the columns (hi, lo)."""
    a, b = (F.col("hi"), F.col("lo")) if turn < BLOCKS // 2 else (F.col("lo"), F.col("hi"))
    s = turn % (BLOCKS // 2) * WIDTH
    if not s:
        return a, b
    return tuple(F.shiftleft(x, s).bitwiseOR(F.shiftrightunsigned(y, 64 - s)) for x, y in ((a, b), (b, a)))


_PAIR = T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())])


def _join_tries(budget: int, prefix: int, linked: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b, turn = map(int, key)
        right = rows["right"].to_numpy(bool)
        keys = rows[["x", "y"]].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((keys[:, 1], keys[:, 0], right))
        keys, middle = keys[order], int((~right).sum())
        errors = ((a ^ b) >> 32).bit_count()
        i, j = trie_pairs(keys, budget, None if a == b else middle, prefix, errors, linked=linked)  # a == b: a trie with itself
        names = rotated(keys, -turn).astype(">u8").view("V16").ravel()
        return pd.DataFrame({"u": [x.tobytes() for x in names[i]], "v": [x.tobytes() for x in names[j]]}, dtype=object)

    return run


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, hi, lo) of every document that has a word; others have no fingerprint and resemble nothing.

    fp is hi and lo, its halves, as bytes. Repeated rows and null ids have one like any others.
    """
    require(docs, text, doc_id)
    small_batches(docs.sparkSession)
    signed = docs.select(col(doc_id).alias("doc_id"), F.pandas_udf(_simhash_batches, _SIGNED)(col(text)).alias("s"))
    return signed.select("doc_id", "s.fp", "s.hi", "s.lo").where("fp is not null")


def fingerprint_pairs(distinct: DataFrame, *, budget: int = BUDGET, linked: bool = False, rows: int = SUBTRIE_ROWS) -> DataFrame:
    """All pairs (u, v) of distinct fingerprints at most ``budget`` bits apart; with ``linked``, a spanning forest of
    what the pairs connect, which grows with the fingerprints however large their groups are.

    distinct: one row (hi, lo) for each distinct fingerprint, so that thousands of copies count once. Each of BLOCKS
    rotations is a trie. Its nodes at the depth at which they hold ``rows`` rows on average are what tasks work on:
    pairs of these nodes within allowance() are traversed together from there, so a fingerprint goes to its own node
    and to those that differ in as few bits (1 + k + k(k-1)/2 of them at depth k, 1 as long as there are fewer
    than ``rows`` fingerprints). A node with more rows than four times that is cut into chunks by hash, each paired
    with each. No task holds more, whatever fingerprints have in common; nothing is left out. ``distinct`` is read
    up to three times.
    """
    count = distinct.count()
    depth = min(WIDTH, max(0, (-(-count // rows) - 1).bit_length()))
    each = F.array(*[F.struct(F.lit(r).alias("turn"), *[c.alias(n) for n, c in zip("xy", _turned(r))]) for r in range(BLOCKS)])
    p = F.shiftrightunsigned("x", 64 - depth).cast("int") if depth else F.lit(0)
    turned = distinct.select(F.explode(each).alias("to")).select("to.*").withColumn("p", p)
    most = allowance(depth, budget)
    masks = [sum(1 << b for b in some) for e in range(min(most, depth) + 1) for some in combinations(range(depth), e)]
    routed = turned.withColumn("q", F.explode(F.array([F.col("p").bitwiseXOR(F.lit(m)) for m in masks])))
    c = d = F.lit(0)
    if depth:
        hot = turned.groupBy("turn", "p").agg(F.count("*").alias("size")).where(F.col("size") > 4 * rows)
        hot = hot.select("turn", "p", F.ceil(F.col("size") / (2 * rows)).cast("int").alias("s")).collect()  # of BLOCKS * 2**16 nodes at most
        if hot:
            table = distinct.sparkSession.createDataFrame(hot, "turn int, p int, s int")
            routed = routed.join(F.broadcast(table), ["turn", "p"], "left").join(F.broadcast(table.select("turn", F.col("p").alias("q"), F.col("s").alias("t"))), ["turn", "q"], "left")
            routed = routed.select("turn", "x", "y", "p", "q", F.pmod(F.xxhash64("x", "y"), F.coalesce("s", F.lit(1))).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.coalesce("t", F.lit(1)) - 1)).alias("d"))
            c, d = F.col("c"), F.col("d")
    # a cell is two nodes' chunks, as numbers: there are many more rows here than anywhere else
    own, other = (F.shiftleft(node.cast("bigint"), 32) + chunk for node, chunk in ((F.col("p"), c), (F.col("q"), d)))
    cells = routed.select("turn", F.least(own, other).alias("a"), F.greatest(own, other).alias("b"), "x", "y", (own > other).alias("right"))
    found = cells.groupBy("a", "b", "turn").applyInPandas(_join_tries(budget, depth, linked), _PAIR)
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """(doc_id, keep_id) of every document that another one of its near-duplicate group stands for.

    Two documents are linked if their 128-bit SimHashes differ in at most ``budget`` bits; groups are the connected
    components of the links, and the smallest doc_id of a group stays. Exact copies have equal fingerprints and so
    are one group. The search is exact: the tries miss no link between groups. Documents with a null id, a null or
    empty text, or no word are in no group; repeated rows of one doc_id count as one document; extra columns aren't
    read. An empty table gives no rows.
    """
    space = Workspace(docs.sparkSession)
    with space.scope():
        return space.put(_near_duplicates(docs, text, doc_id, budget, Workspace(docs.sparkSession)))


def _near_duplicates(docs: DataFrame, text: str, doc_id: str, budget: int, space: Workspace) -> DataFrame:
    prints = space.put(fingerprints(docs, text=text, doc_id=doc_id).where("doc_id is not null"))
    # copies are counted by fingerprint first: later steps see a row a fingerprint, however many documents have it
    owners = space.put(prints.groupBy("fp", "hi", "lo").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")))
    edges = fingerprint_pairs(owners.select("hi", "lo"), budget=budget, linked=True)
    roots = components(edges, space)
    own = owners.join(roots, owners.fp == roots.node, "left").select("fp", "first", "last", F.coalesce("root", "fp").alias("root"))
    least = own.groupBy("root").agg(F.min("first").alias("keep_id"), F.max("last").alias("most")).where("keep_id < most").select("root", "keep_id")
    gone = own.join(least, "root").select(F.col("fp").alias("print"), "keep_id")
    member = prints.join(gone, prints.fp == gone.print).where("doc_id <> keep_id")
    return member.groupBy("doc_id").agg(F.min("keep_id").alias("keep_id"))


def drop_near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """``docs`` without the documents that near_duplicates() would have another one stand for.

    Columns are unchanged, whatever their names. Rows that near_duplicates() doesn't group (null id or text, no word)
    all stay, as do repeated rows of a kept doc_id; an empty table stays empty.
    """
    gone = near_duplicates(docs, text=text, doc_id=doc_id, budget=budget).select(F.col("doc_id").alias("gone"))
    rows = packed(docs, id=col(doc_id))
    return unpacked(rows.join(gone, F.col("id") == F.col("gone"), "left_anti"), docs.columns)
