"""Toxicity by a bidirectional gated recurrent network over characters and words."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, require, small_batches

#: Labelled documents, clean and toxic, that training reads at most.
TRAIN_DOCS = (1500, 750)
WINDOW = 64
STRIDE = 48
HIDDEN = 16
CHAR_HIDDEN = 8
CHAR_DIM = 8
WORD_DIM = 16
#: Words in fewer training documents share one embedding: single documents' words can't be learnt by heart.
LEAST_DOCS = 4
LONGEST_WORD = 24
#: Words whose gate inputs a task remembers.
CACHED_WORDS = 120_000
EPOCHS = 10
SEED = 2

_WORD = re.compile(r"[^\W_]+(?:[@$*!'’][^\W_]+)*")
_LETTERS = {c: k for k, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789@$*!'’àáâäãåæçèéêëìíîïñòóôöõøœùúûüýß", 1)}
#: Letters that aren't listed share this many ids.
_SHARED = 64
_ID_OF = np.array([_LETTERS.get(chr(c), len(_LETTERS) + 1 + c % _SHARED) for c in range(0x2100)], np.int64)


def words_of(text: str) -> list[str]:
    """Lower-case words; signs inside a word, as in 's@me', stay. Words of more than LONGEST_WORD letters come in pieces."""
    words = _WORD.findall(text.lower())
    if words and max(map(len, words)) > LONGEST_WORD:
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return words


def windows_of(n: int, window: int = WINDOW, stride: int = STRIDE) -> list[tuple[int, int]]:
    """Overlapping windows (begin, end) that cover n words; the last may be shorter; none for n = 0."""
    out, at = [], 0
    while n:
        out.append((at, min(n, at + window)))
        if at + window >= n:
            break
        at += stride
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGRU:
    """A bidirectional GRU with attention pooling: forward and backward pass over padded batches, in numpy.

    Parameters are views into a dict, by name: W (2, in, 3h), b (2, 3h), U (2, h, 3h), c (2, 3h), q (2h). The gates
    are reset, update, candidate; the reset gate acts on the recurrent part of the candidate.
    """

    def __init__(self, p: dict[str, np.ndarray], prefix: str, inputs: int, hidden: int, rng: np.random.Generator | None = None):
        self.p, self.x, self.h = p, prefix, hidden
        if rng is not None:
            p[prefix + "W"] = rng.normal(0, inputs**-0.5, (2, inputs, 3 * hidden)).astype(np.float32)
            p[prefix + "b"] = np.zeros((2, 3 * hidden), np.float32)
            p[prefix + "U"] = rng.normal(0, hidden**-0.5, (2, hidden, 3 * hidden)).astype(np.float32)
            p[prefix + "c"] = np.zeros((2, 3 * hidden), np.float32)
            p[prefix + "q"] = rng.normal(0, 0.1, 2 * hidden).astype(np.float32)

    def project(self, inputs: np.ndarray) -> np.ndarray:
        """Gate inputs of both directions, (2, n, 3h), of n input vectors: shared by all places that a vector is at."""
        return np.matmul(inputs[None], self.p[self.x + "W"]) + self.p[self.x + "b"][:, None]

    def forward(self, gates: np.ndarray, ids: np.ndarray, lengths: np.ndarray, tape: list | None = None) -> np.ndarray:
        """Pooled states (batch, 2h). ids (batch, time) are rows of gates; only the first lengths[k] of row k count."""
        p, x, h = self.p, self.x, self.h
        batch, time = ids.shape
        U, c = p[x + "U"], p[x + "c"][:, None]
        full = bool((lengths == time).all())
        live = (np.arange(time)[None] < lengths[:, None]).astype(np.float32)
        states = np.empty((time, 2, batch, h), np.float32)
        now = np.zeros((2, batch, h), np.float32)
        gx = np.empty((2, batch, 3 * h), np.float32)
        for t in range(time):
            u = time - 1 - t
            np.take(gates[0], ids[:, t], axis=0, out=gx[0], mode="clip")
            np.take(gates[1], ids[:, u], axis=0, out=gx[1], mode="clip")
            gh = np.matmul(now, U)
            gh += c
            rz = gx[..., : 2 * h] + gh[..., : 2 * h]
            rz *= 0.5
            np.tanh(rz, out=rz)
            rz *= 0.5
            rz += 0.5
            r, z = rz[..., :h], rz[..., h:]
            cand = gh[..., 2 * h :] * r
            cand += gx[..., 2 * h :]
            np.tanh(cand, out=cand)
            new = now - cand
            new *= z
            new += cand
            if not full:
                on = np.stack([live[:, t], live[:, u]])[..., None]
                new = new * on + now * (1 - on)
            if tape is not None:
                tape.append((now, gh[..., 2 * h :].copy(), r.copy(), z.copy(), cand))
            states[t, 0], states[u, 1] = new[0], new[1]
            now = new
        q = p[x + "q"].reshape(2, h)
        score = np.matmul(states, q[None, :, :, None])[..., 0].sum(1)  # (time, batch)
        if not full:
            score = np.where(live.T > 0, score, -1e9)
        score -= score.max(0)
        weight = np.exp(score)
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tb,tdbh->bdh", weight, states).reshape(batch, 2 * h)
        if tape is not None:
            tape.append((states, weight, pooled, live, full))
        return pooled

    def backward(self, grad: np.ndarray, gates: np.ndarray, ids: np.ndarray, tape: list, g: dict[str, np.ndarray]) -> np.ndarray:
        """Adds parameter gradients to g; returns the gradient of gates."""
        p, x, h = self.p, self.x, self.h
        batch, time = ids.shape
        states, weight, pooled, live, full = tape.pop()
        U = p[x + "U"]
        q = p[x + "q"].reshape(2, h)
        gd = grad.reshape(batch, 2, h).transpose(1, 0, 2)
        dw = (states * gd[None]).sum((1, 3))
        ds = weight * (dw - (weight * dw).sum(0, keepdims=True))
        g[x + "q"] += (ds[:, None, :, None] * states).sum((0, 2)).reshape(-1)
        dstates = weight[:, None, :, None] * gd[None] + ds[:, None, :, None] * q[None, :, None, :]
        dgates = np.zeros_like(gates)
        carry = np.zeros((2, batch, h), np.float32)
        UT = U.transpose(0, 2, 1)
        for t in range(time - 1, -1, -1):
            u = time - 1 - t
            before, rec, r, z, cand = tape.pop()
            d = carry + np.stack([dstates[t, 0], dstates[u, 1]])
            if full:
                keep = 0
            else:
                on = np.stack([live[:, t], live[:, u]])[..., None]
                keep, d = d * (1 - on), d * on
            dz = d * (before - cand) * z * (1 - z)
            dc = d * (1 - z) * (1 - cand * cand)
            dr = dc * rec * r * (1 - r)
            dgh = np.concatenate([dr, dz, dc * r], 2)
            dgx = np.concatenate([dr, dz, dc], 2)
            np.add.at(dgates[0], ids[:, t], dgx[0])
            np.add.at(dgates[1], ids[:, u], dgx[1])
            g[x + "U"] += np.matmul(before.transpose(0, 2, 1), dgh)
            g[x + "c"] += dgh.sum(1)
            carry = d * z + np.matmul(dgh, UT) + keep
        return dgates

    def input_grad(self, dgates: np.ndarray, inputs: np.ndarray, g: dict[str, np.ndarray]) -> np.ndarray:
        """Backward of project()."""
        g[self.x + "W"] += np.matmul(inputs.T[None], dgates)
        g[self.x + "b"] += dgates.sum(1)
        return np.matmul(dgates, self.p[self.x + "W"].transpose(0, 2, 1)).sum(0)


@dataclass
class ToxicityModel:
    """Characters -> BiGRU with attention -> word vector; with the word's embedding -> BiGRU with attention -> logit."""

    p: dict[str, np.ndarray]
    vocabulary: dict[str, int]  # rows of p["words"]; 0 is for all other words
    threshold: float = 0.5
    known: dict[str, int] = field(default_factory=dict, repr=False)
    gates: np.ndarray | None = field(default=None, repr=False)

    def __post_init__(self):
        self.chars, self.words = BiGRU(self.p, "c_", CHAR_DIM, CHAR_HIDDEN), BiGRU(self.p, "w_", 2 * CHAR_HIDDEN + WORD_DIM, HIDDEN)

    def __getstate__(self):
        return {"p": self.p, "vocabulary": self.vocabulary, "threshold": self.threshold}

    def __setstate__(self, state):
        self.__dict__.update(state, known={}, gates=None)
        self.__post_init__()

    def spell(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letter ids (padded with 0), lengths and embedding rows of words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids = np.zeros((len(words), int(lengths.max(initial=1))), np.int64)
        ids[np.arange(ids.shape[1])[None] < lengths[:, None]] = np.where(codes < len(_ID_OF), _ID_OF[np.minimum(codes, len(_ID_OF) - 1)], len(_LETTERS) + 1 + codes % _SHARED)
        find = self.vocabulary.get
        return ids, lengths, np.fromiter((find(w, 0) for w in words), np.int64, len(words))

    def embed(self, words: Sequence[str]) -> np.ndarray:
        """Gate inputs (2, n, 3h) of the word network for n distinct words."""
        gates = self.chars.project(self.p["chars"])
        out = np.empty((2, len(words), 3 * HIDDEN), np.float32)
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        for a in range(0, len(order), 4096):
            part = order[a : a + 4096]
            ids, lengths, buckets = self.spell([words[k] for k in part])
            vec = np.concatenate([self.chars.forward(gates, ids, lengths), self.p["words"][buckets]], 1)
            out[:, part] = self.words.project(vec)
        return out

    def look_up(self, words: list[str]) -> np.ndarray:
        """Rows of self.gates for words, each distinct word being embedded once as long as it is remembered."""
        if len(self.known) > CACHED_WORDS:  # those seen first are mostly the frequent ones: they stay
            self.known = dict(islice(self.known.items(), CACHED_WORDS // 3))
        if new := [w for w in dict.fromkeys(words) if w not in self.known]:
            made = self.embed(new)
            for k, w in enumerate(new, len(self.known)):
                self.known[w] = k
            have = len(self.known) - len(new)  # rows beyond are free
            if self.gates is None or len(self.known) > self.gates.shape[1]:
                grown = np.empty((2, max(2 * have, len(self.known), 32_768), made.shape[2]), np.float32)
                if have:
                    grown[:, :have] = self.gates[:, :have]
                self.gates = grown
            self.gates[:, have : len(self.known)] = made
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def logits(self, gates: np.ndarray, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, batch: int = 512) -> np.ndarray:
        """Of windows [begin, end) of ids; windows of like length go together."""
        size = ends - begins
        order = np.argsort(-size, kind="stable")
        out = np.empty(len(begins), np.float32)
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            at = begins[part][:, None] + np.arange(size[part].max())[None]
            pooled = self.words.forward(gates, ids[np.minimum(at, len(ids) - 1)], size[part])
            out[part] = pooled @ self.p["v"] + self.p["a"]
        return out

    def score_texts(self, texts: Sequence[str | None]) -> list[list[tuple[int, int, float]]]:
        """For each text, (first word, last word + 1, probability) of all its windows."""
        flat, begins, ends, owner = [], [], [], []
        for k, t in enumerate(texts):
            words = words_of(t) if t else []
            for a, b in windows_of(len(words)):
                begins.append(len(flat) + a)
                ends.append(len(flat) + b)
                owner.append((k, a, b))
            flat += words
        out: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        if owner:
            ids = self.look_up(flat)
            found = _sigmoid(self.logits(self.gates, ids, np.array(begins), np.array(ends)))
            for (k, a, b), s in zip(owner, found.tolist()):
                out[k].append((a, b, s))
        return out


def fit(texts: Sequence[str], toxic: Sequence[int], *, epochs: int = EPOCHS, seed: int = SEED) -> ToxicityModel:
    """Trains on labelled documents: a document is as toxic as its worst window (multiple-instance learning).

    Every other epoch scores all windows; each learns from the worst of each document, and for clean documents from a
    random one too; in the first epochs the worst is the window whose words are most peculiar to toxic documents.
    Adam, logistic loss with classes weighted alike. A word's letters or its embedding are left out at times, so
    that neither is relied on alone. The threshold lies between the scores of clean and of toxic documents that
    were kept out of training.
    """
    rng = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {
        "chars": rng.normal(0, 0.5, (len(_LETTERS) + 1 + _SHARED, CHAR_DIM)).astype(np.float32),
        "words": np.zeros((1, WORD_DIM), np.float32),
        "v": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
        "a": np.zeros((), np.float32),
    }
    BiGRU(p, "c_", CHAR_DIM, CHAR_HIDDEN, rng)
    BiGRU(p, "w_", 2 * CHAR_HIDDEN + WORD_DIM, HIDDEN, rng)
    model = ToxicityModel(p, {})
    y = np.array(toxic, np.float32)
    if not len(y) or y.min() == y.max():
        model.threshold = 1.0 if not len(y) or y.max() == 0 else 0.5
        p["v"][:], p["a"] = 0, np.float32(-9.0 if model.threshold == 1.0 else 9.0)
        return model
    tokens = [words_of(t) for t in texts]
    spans = [windows_of(len(w)) for w in tokens]
    vocabulary = sorted({w for t in tokens for w in t})
    number = {w: k for k, w in enumerate(vocabulary)}
    ids = np.array([number[w] for t in tokens for w in t] + [0], np.int64)
    start = np.cumsum([0] + [len(t) for t in tokens])
    begins = np.array([start[k] + a for k, s in enumerate(spans) for a, b in s], np.int64)
    ends = np.array([start[k] + b for k, s in enumerate(spans) for a, b in s], np.int64)
    owner = np.array([k for k, s in enumerate(spans) for _ in s], np.int64)
    held = rng.random(len(y)) < 0.15
    share = {c: max(1, int(((y == c) & ~held).sum())) for c in (0, 1)}
    seen = np.zeros((2, len(vocabulary)))
    for t, c, h in zip(tokens, y, held):
        if not h:
            seen[int(c), [number[w] for w in set(t)]] += 1
    odds = np.log((seen[1] + 2) / (share[1] + 4)) - np.log((seen[0] + 2) / (share[0] + 4))
    frequent = np.flatnonzero(seen.sum(0) >= LEAST_DOCS)
    odds[seen.sum(0) < LEAST_DOCS] = 0
    own = {vocabulary[k]: r for r, k in enumerate(frequent, 1)}
    p["words"] = rng.normal(0, 0.1, (len(own) + 1, WORD_DIM)).astype(np.float32)
    p["words"][1:, 0] = np.clip(odds[frequent], -2, 4) / 2  # how peculiar to toxic documents, to begin with
    p["words"][0] = 0
    model = ToxicityModel(p, own)
    letters, sizes, buckets = model.spell(vocabulary)
    odds = np.cumsum(np.r_[0, np.maximum(odds - 1.2, 0)[ids[:-1]]])
    prior = odds[ends] - odds[begins]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch < 3:
            scores = prior
        elif epoch % 2:
            scores = model.logits(model.embed(vocabulary), ids, begins, ends)
        worst: dict[int, int] = {}
        for k in np.argsort(scores, kind="stable"):
            worst[int(owner[k])] = int(k)
        chosen = [w for d, w in worst.items() if not held[d]]
        clean = np.flatnonzero((y[owner] == 0) & ~held[owner])
        if len(clean):
            chosen += rng.choice(clean, min(len(clean), share[0]), replace=False).tolist()
        chosen = np.array(chosen)[rng.permutation(len(chosen))]
        rate = 0.006 * (1 - epoch / epochs) + 0.0005
        for a in range(0, len(chosen), 32):
            part = chosen[a : a + 32]
            size = ends[part] - begins[part]
            at = np.minimum(begins[part][:, None] + np.arange(size.max())[None], len(ids) - 1)
            local, where = np.unique(ids[at], return_inverse=True)
            where = where.reshape(at.shape)
            g = {k: np.zeros_like(v) for k, v in p.items()}
            tape_c: list = []
            tape_w: list = []
            cgates = model.chars.project(p["chars"])
            no_word, no_char = rng.random(len(local)) < 0.4, rng.random(len(local)) < 0.1
            cvec = model.chars.forward(cgates, letters[local], sizes[local], tape_c)
            vec = np.concatenate([cvec * ~no_char[:, None], p["words"][buckets[local]] * ~no_word[:, None]], 1).astype(np.float32)
            wgates = model.words.project(vec)
            pooled = model.words.forward(wgates, where, size, tape_w)
            logit = pooled @ p["v"] + p["a"]
            label = y[owner[part]]
            d = _sigmoid(logit) - label
            d *= np.where(label == 1, 0.5 / share[1], 0.25 / share[0]) * share[1] * 2 / len(part)
            g["v"] += pooled.T @ d
            g["a"] += d.sum()
            dgates = model.words.backward(d[:, None] * p["v"][None], wgates, where, tape_w, g)
            dvec = model.words.input_grad(dgates, vec, g)
            np.add.at(g["words"], buckets[local], dvec[:, 2 * CHAR_HIDDEN :] * ~no_word[:, None])
            dchar = model.chars.backward(dvec[:, : 2 * CHAR_HIDDEN] * ~no_char[:, None], cgates, letters[local], tape_c, g)
            g["chars"] += model.chars.input_grad(dchar, p["chars"], g)
            step += 1
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for x in g.values():
                x *= min(1.0, 2.0 / max(norm, 1e-9))
            for k, v in p.items():
                m, s = moments[k]
                m *= 0.9
                m += 0.1 * g[k]
                s *= 0.99
                s += 0.01 * g[k] ** 2
                move = rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
                p[k] = v - move.astype(np.float32)
            model = ToxicityModel(p, own)
    scores = model.logits(model.embed(vocabulary), ids, begins, ends)
    top = np.full(len(y), -30.0)
    np.maximum.at(top, owner, scores)
    clean, hot = top[(y == 0) & held], top[(y == 1) & held]
    if len(clean) and len(hot):
        # where misses and three times the false alarms are fewest; the middle of equally good places
        places = np.sort(np.r_[clean, hot])
        between = np.r_[places[0] - 1, (places[1:] + places[:-1]) / 2, places[-1] + 1]
        wrong = np.array([(hot <= x).mean() + 3 * (clean > x).mean() for x in between])
        best = between[wrong <= wrong.min() + 1e-9]
        model.threshold = float(_sigmoid(np.clip((best.min() + best.max()) / 2, 0, 12)))
    return model


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", train_docs: tuple[int, int] = TRAIN_DOCS) -> ToxicityModel:
    """fit() on at most ``train_docs`` labelled documents, clean and toxic, chosen by a hash of their ids."""
    require(docs, text, doc_id)
    require(labels, doc_id, label)
    rows = labels.where(col(doc_id).isNotNull() & col(label).isin(0, 1)).groupBy(col(doc_id).alias("id")).agg(F.max(col(label)).alias("y"))
    order = F.xxhash64(F.lit(SEED), F.col("id"))
    picked = [rows.where(F.col("y") == c).orderBy(order, "id").limit(train_docs[c]) for c in (0, 1)]
    some = [(r["id"], int(r["y"])) for x in picked for r in x.collect()]
    if not some:
        return fit([], [])
    want = docs.sparkSession.createDataFrame(some, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("y", T.IntegerType())]))
    got = docs.select(col(doc_id).alias("id"), col(text).alias("t")).join(F.broadcast(want), "id").where("t is not null").groupBy("id").agg(F.min("t").alias("t"), F.first("y").alias("y"))
    read = sorted((r["id"], r["t"], r["y"]) for r in got.collect())
    return fit([r[1] for r in read], [r[2] for r in read])


_WINDOWS = T.ArrayType(T.StructType([T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType()), T.StructField("score", T.FloatType())]))


def _scorer(model: ToxicityModel, best: bool):
    @F.pandas_udf(T.DoubleType() if best else _WINDOWS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            texts, rows, at = b.tolist(), [], 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size < 500_000):
                    size += len(texts[upto] or "")
                    upto += 1
                rows += model.score_texts(texts[at:upto])
                at = upto
            if best:
                yield pd.Series([max((w[2] for w in r), default=0.0) for r in rows], dtype="float64")
            else:
                yield pd.Series([[{"first_word": a, "end_word": e, "score": s} for a, e, s in r] for r in rows])

    return run


def score_windows(docs: DataFrame, model: ToxicityModel, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, first_word, end_word, score) of every window of every document."""
    require(docs, text, doc_id)
    small_batches(docs.sparkSession)
    found = docs.select(col(doc_id).alias("doc_id"), F.explode(_scorer(model, False)(col(text))).alias("w"))
    return found.select("doc_id", "w.first_word", "w.end_word", "w.score")


def toxic_documents(docs: DataFrame, labels: DataFrame | None = None, *, model: ToxicityModel | None = None, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", train_docs: tuple[int, int] = TRAIN_DOCS) -> DataFrame:
    """(doc_id, score) of the documents that have a window above the model's threshold.

    Windows of WINDOW words overlap by WINDOW - STRIDE; all windows of all documents are scored, whatever their
    length, and the score of a document is that of its worst window. Without ``model``, train() fits one on
    ``labels``. Texts that are null, empty or without words have no window and are never toxic; null ids and
    repeated rows stay as they are. Empty tables give no rows; labels of one class only give a constant model.
    """
    require(docs, text, doc_id)
    small_batches(docs.sparkSession)
    if model is None:
        if labels is None:
            raise ValueError("labels or a model")
        model = train(docs, labels, text=text, doc_id=doc_id, label=label, train_docs=train_docs)
    scored = docs.select(col(doc_id).alias("doc_id"), _scorer(model, True)(col(text)).alias("score"))
    return scored.where(F.col("score") > model.threshold)
