"""Language spans of mixed-language texts."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, packed, portions, require, small_batches, unpacked

#: Labelled documents a language that the word model is fitted on, at most.
TRAIN_DOCS = 150
SWITCH_PENALTY = 14.0
MIN_SHARE = 0.5
BLOCK = 64
#: Words whose scores a task remembers.
CACHED_WORDS = 150_000
#: Labels that the model learns, the most frequent ones if there are more.
MOST_LANGUAGES = 64
#: Standard errors of a text's mean letter score by which it may lie below what labelled texts have.
ERRORS = 6.0
#: (first, last, script, its languages if the labelled rows have none in that script)
SCRIPTS = [
    (0x3400, 0x9FFF, "Han", ("zh", "ja")),
    (0x0041, 0x024F, "Latin", ("la",)),
    (0x1E00, 0x1EFF, "Latin", ("la",)),
    (0x0370, 0x03FF, "Greek", ("el",)),
    (0x1F00, 0x1FFF, "Greek", ("el",)),
    (0x0400, 0x052F, "Cyrillic", ("ru",)),
    (0x0530, 0x058F, "Armenian", ("hy",)),
    (0x0590, 0x05FF, "Hebrew", ("he",)),
    (0x0600, 0x077F, "Arabic", ("ar",)),
    (0x0900, 0x097F, "Devanagari", ("hi",)),
    (0x0980, 0x09FF, "Bengali", ("bn",)),
    (0x0B80, 0x0BFF, "Tamil", ("ta",)),
    (0x0E00, 0x0E7F, "Thai", ("th",)),
    (0x10A0, 0x10FF, "Georgian", ("ka",)),
    (0x3040, 0x30FF, "Kana", ("ja",)),
    (0x31F0, 0x31FF, "Kana", ("ja",)),
    (0xAC00, 0xD7AF, "Hangul", ("ko",)),
    (0x1100, 0x11FF, "Hangul", ("ko",)),
]


_OTHER = "Other"


def script(letter: str) -> str:
    """The script of a letter by code point ranges; 'Other' outside all of them."""
    c = ord(letter)
    return next((s for a, b, s, _ in SCRIPTS if a <= c <= b), _OTHER)


def _class(*names: str) -> str:
    """The inside of a character class: letters and marks of scripts, as ranges."""
    own = sorted({c for a, b, s, _ in SCRIPTS if s in names for c in range(a, b + 1) if unicodedata.category(chr(c))[0] in "LM"})
    firsts = [c for k, c in enumerate(own) if not k or own[k - 1] != c - 1]
    lasts = [c for k, c in enumerate(own) if k + 1 == len(own) or own[k + 1] != c + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts))


_NAMES = sorted(dict.fromkeys(s for _, _, s, _ in SCRIPTS), key=lambda s: s != "Latin")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Runs of letters of one script, for texts that have letters outside Latin; letters of no known script form runs too.
_RUNS = re.compile("|".join(f"[{_class(n)}]+" for n in _NAMES) + rf"|(?:(?![{_class(*_NAMES)}])[^\W\d_])+")
_FOREIGN = re.compile(r"[\u0250-\u02af\u0370-\u1dff\u1f00-\u1fff\u2c00-\ud7ff\uf900-\uffdc\U00010000-\U0003ffff]")


def letter_runs(text: str) -> list[str]:
    """The words of a text in the case it has, cut where the script changes."""
    return _RUNS.findall(text) if _FOREIGN.search(text) else _LETTERS.findall(text)


def _starts(text: str) -> list[int]:
    return [m.start() for m in (_RUNS if _FOREIGN.search(text) else _LETTERS).finditer(text)]


def _lower(text: str) -> list[str]:
    """letter_runs() in lower case, one for each, whatever lowering does to lengths."""
    low = text.lower()
    return letter_runs(low) if len(low) == len(text) else [w.lower() for w in letter_runs(text)]


def _grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


@dataclass
class LanguageModel:
    """Word scores: log-likelihoods of letter trigrams for each language, and which languages a script admits."""

    languages: list[str]
    by_script: dict[str, list[int]]
    grams: dict[str, int]
    table: np.ndarray  # a row for each of grams, and a last one for all others
    floor: float = -np.inf
    #: Standard deviation of a letter's score, by which short texts' means scatter more.
    spread: float = 0.0
    #: Scripts with a labelled language. The others admit fallback languages, whose scores say nothing of a text.
    learnt: frozenset[str] = frozenset()
    #: Words scored so far: rows of scored, and their scripts.
    cache: dict[str, int] = field(default_factory=dict, repr=False)
    scored: np.ndarray | None = field(default=None, repr=False)
    scripts: list[str] = field(default_factory=list, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "scored": None, "scripts": []}

    def look_up(self, words: Sequence[str]) -> list[int]:
        """Cache rows of lower-case words; scored gets, for new ones, each language's log-likelihood (-inf where
        the word's script rules the language out)."""
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
            self.scripts.clear()
            self.scored = None
        if new := [w for w in set(words) if w not in cache]:
            other, find, flat, sizes = len(self.grams), self.grams.get, [], []
            for w in new:
                x = f"^{w}$"
                flat += [find(x[i : i + 3], other) for i in range(len(w))]
                sizes.append(len(w))
            total = np.add.reduceat(self.table[flat], np.cumsum([0] + sizes[:-1]), axis=0)
            first = {c: script(c) for c in {w[0] for w in new}}
            scripts = [first[w[0]] for w in new]
            masks = {}
            for name in set(scripts):
                masks[name] = np.full(len(self.languages), -np.inf, np.float32)
                masks[name][self.by_script.get(name, [])] = 0
            total += np.array([masks[x] for x in scripts])
            for k, w in enumerate(new, len(self.scripts)):
                cache[w] = k
            have = len(self.scripts)
            if self.scored is None or have + len(new) > len(self.scored):
                grown = np.empty((max(2 * have, have + len(new), 65_536), total.shape[1]), np.float32)
                grown[:have] = self.scored[:have] if have else 0
                self.scored = grown
            self.scored[have : have + len(new)] = total
            self.scripts += scripts
        return [cache[w] for w in words]


def fit(texts: Sequence[str], labels: Sequence[str]) -> LanguageModel:
    """A model from labelled texts. Labels in any script are learnt; each further script brings one language."""
    counts: dict[str, Counter] = defaultdict(Counter)
    where: dict[str, Counter] = defaultdict(Counter)
    for t, label in zip(texts, labels):
        for w in _lower(t):
            counts[label].update(_grams(w))
            where[script(w[0])][label] += 1
    languages = sorted(counts)
    by_script: dict[str, list[int]] = {}
    for s, seen in where.items():
        # a label counts for a script if a noticeable part of its words is in it
        own = [x for x in languages if seen[x] > 0.2 * sum(v[x] for v in where.values())]
        if s != "Other" and own:
            by_script[s] = [languages.index(x) for x in own]
    learnt = frozenset(by_script)
    for _, _, s, own in SCRIPTS:
        if s not in by_script:
            languages += [x for x in own if x not in languages]
            by_script[s] = [languages.index(x) for x in own]
    vocabulary = {g for c in counts.values() for g in c}
    vocabulary = sorted(vocabulary)
    table = np.full((len(vocabulary) + 1, len(languages)), -12.0, np.float32)
    for k, x in enumerate(languages):
        if x in counts:
            total = sum(counts[x].values()) + 0.5 * (len(vocabulary) + 1)
            table[:, k] = np.log((np.array([counts[x][g] for g in vocabulary] + [0]) + 0.5) / total)
    model = LanguageModel(languages, by_script, {g: k for k, g in enumerate(vocabulary)}, table, learnt=learnt)
    # how labelled texts score: the level of a language, and how far words scatter about it
    low, square, letters = np.inf, 0.0, 0
    for x in sorted(set(labels)):
        own = [w for t, label in zip(texts, labels) if label == x for w in _lower(t)]
        if not own:
            continue
        rows = model.look_up(own)
        score = model.scored[rows].max(1)
        size = np.fromiter(map(len, own), np.int64, len(own))
        use = np.isfinite(score) & np.isin([script(w[0]) for w in own], list(learnt))
        score, size = score[use].astype(np.float64), size[use]
        if not len(size):
            continue
        level = score.sum() / size.sum()
        low = min(low, level)
        square += ((score - level * size) ** 2).sum()
        letters += size.sum()
    if letters:
        model.floor, model.spread = float(low) - 1.0, float(np.sqrt(square / letters))
    return model


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float, block: int = BLOCK) -> np.ndarray:
    """Best state of each word of many documents at once, for ``penalty`` a switch; ties keep the state.

    scores: (words, states) of documents one after the other, lengths: words of each. Exact for any length: blocks
    of words are first summarised as max-plus matrices from entry to exit state, all blocks in step; a scan along
    each document's blocks gives the true score at every block's entry; a second sweep from there records the
    choices, which are then followed backwards.
    """
    n, states = scores.shape
    if not n:
        return np.empty(0, np.int64)
    if states == 1:
        return np.zeros(n, np.int64)
    have = np.flatnonzero(lengths)
    size = lengths[have].astype(np.int64)
    have_at = np.cumsum(np.r_[0, size[:-1]])
    order = np.argsort(-size, kind="stable")
    blocks = -(-size // block)
    first = np.cumsum(np.r_[0, blocks[:-1]])
    total = int(blocks.sum())
    word_block = np.repeat(first, size) + (np.arange(n) - np.repeat(have_at, size)) // block
    word_place = (np.arange(n) - np.repeat(have_at, size)) % block
    emit = np.zeros((block, total, states), np.float32)
    emit[word_place, word_block] = np.maximum(scores, -1e4)
    penalty = np.float32(penalty)
    # summary of each block for every entry state
    move = np.full((states, states), -penalty, np.float32)
    np.fill_diagonal(move, 0)
    through = move[None] + emit[0][:, None, :]
    for t in range(1, block):
        through = np.maximum(through, through.max(2, keepdims=True) - penalty) + emit[t][:, None, :]
    # scores at the entry of each block
    entry = np.zeros((total, states), np.float32)
    many = blocks[order]
    for k in range(1, int(many[0])):
        docs = order[: np.searchsorted(-many, -k, side="left")]
        b = first[docs] + k
        now = (entry[b - 1][:, :, None] + through[b - 1]).max(1)
        entry[b] = now - now.max(1, keepdims=True)
    del through
    # choices: stay, or come from the best state
    came = np.empty((block, total, states), np.int8)
    own = np.arange(states, dtype=np.int8)[None]
    value = entry
    for t in range(block):
        best = value.argmax(1)
        jump = value[np.arange(total), best][:, None] - penalty
        came[t] = np.where(value >= jump, own, best[:, None].astype(np.int8))
        value = np.maximum(value, jump) + emit[t]
    # the entry of a document's first block is free, so its first word's origin doesn't matter
    back = np.empty((block, total, states), np.int8)  # state of word t if the block ends in state s
    back[block - 1] = own
    for t in range(block - 1, 0, -1):
        back[t - 1] = np.take_along_axis(came[t], back[t].astype(np.int64), 1)
    origin = np.take_along_axis(came[0], back[0].astype(np.int64), 1)
    exit_state = np.empty(total, np.int64)
    last = first + blocks - 1
    exit_state[last] = value[last].argmax(1)
    for k in range(1, int(many[0])):
        docs = order[: np.searchsorted(-many, -k, side="left")]
        b = last[docs] - k
        exit_state[b] = origin[b + 1, exit_state[b + 1]]
    return back[word_place, word_block, exit_state[word_block]].astype(np.int64)


def label_texts(texts: Sequence[str | None], model: LanguageModel, penalty: float = SWITCH_PENALTY) -> list[tuple[list[tuple[int, int, str]], str | None, float, float]]:
    """For each text: spans (start, end, language) that cover it, its main language, that one's share of letters, and
    how far the mean score of a letter, in the scripts that labelled languages have, lies above what labelled texts let
    expect of as many letters: model.floor less ERRORS standard errors, so that the fewer letters a text has the less
    they tell. Texts without such letters get 0.0. A text without a word of a known script has no span, language None and 0.0 twice."""
    ids, lengths, letters = [], [], []
    for t in texts:
        words = _lower(t) if t else []
        ids += words
        lengths.append(len(words))
    letters = np.fromiter(map(len, ids), np.int64, len(ids))
    ids = model.look_up(ids)
    scripts = model.scripts
    out: list = [([], None, 0.0, 0.0)] * len(texts)
    ids, lengths = np.array(ids, np.int64), np.array(lengths, np.int64)
    if not len(ids):
        return out
    uniq, place = np.unique(ids, return_inverse=True)
    scores = model.scored[uniq]
    known = np.isfinite(scores).any(1)
    doc = np.repeat(np.arange(len(texts)), lengths)
    # only the languages that some word of a document admits are its states: documents of like scripts go together
    kinds = {s: k for k, s in enumerate(dict.fromkeys(scripts[k] for k in uniq))}
    bits = np.array([1 << kinds[scripts[k]] for k in uniq], np.int64)
    mask = np.zeros(len(texts), np.int64)
    np.bitwise_or.at(mask, doc, bits[place])
    state = np.full(len(ids), -1, np.int64)
    for m in np.unique(mask[lengths > 0]):
        some = (mask == m) & (lengths > 0)
        which = sorted({x for s, k in kinds.items() if m >> k & 1 for x in model.by_script.get(s, [])})
        if not which:
            continue
        words = np.flatnonzero(some[doc])
        part = scores[place[words]][:, which]
        part[~known[place[words]]] = 0  # a word of no known script goes with its neighbours
        top = part.max(1, keepdims=True)
        part = np.where(np.isfinite(part), part - np.where(np.isfinite(top), top, 0), -60.0)
        state[words] = np.array(which)[viterbi(part.astype(np.float32), lengths[some], penalty)]
    weight = letters * (state >= 0)
    top = np.where(known, np.where(np.isfinite(scores), scores, -np.inf).max(1, initial=-np.inf), 0)
    total = np.bincount(doc, weight, len(texts))
    judged = np.array([scripts[k] in model.learnt for k in uniq])[place]
    read = np.bincount(doc, letters * judged, len(texts))
    mean, some = np.bincount(doc, top[place] * judged, len(texts)), np.maximum(read, 1)
    level = np.where((read > 0) & np.isfinite(model.floor), mean / some - model.floor + ERRORS * model.spread / np.sqrt(some), 0)
    by = np.zeros((len(texts), len(model.languages)))
    np.add.at(by, (doc[state >= 0], state[state >= 0]), weight[state >= 0])
    ends = np.cumsum(lengths)
    change = np.flatnonzero((state[1:] != state[:-1]) & (doc[1:] == doc[:-1])) + 1
    cuts = np.split(change, np.searchsorted(change, ends[:-1])) if len(texts) > 1 else [change]
    names = model.languages
    ranked = sorted(range(len(names)), key=lambda k: names[k])
    for k, t in enumerate(texts):
        if not total[k]:
            continue
        begin = ends[k] - lengths[k]
        best = max(ranked, key=lambda x: by[k, x])
        if len(cuts[k]):
            inside = [0, *(int(c - begin) for c in cuts[k])]
            low = t.lower()
            starts = _starts(low if len(low) == len(t) else t)
            at = [0, *(starts[i] for i in inside[1:]), len(t)]
            spans = [(at[i], at[i + 1], names[state[begin + inside[i]]]) for i in range(len(inside))]
        else:
            spans = [(0, len(t), names[state[begin]])]
        out[k] = (spans, names[best], float(by[k, best] / total[k]), float(level[k]))
    return out


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", train_docs: int = TRAIN_DOCS) -> LanguageModel:
    """fit() on ``train_docs`` labelled documents a language at most, chosen by a hash of ids and texts.

    Labels are counted first; a language's share of hashes is then cut so that little more than ``train_docs`` documents
    are expected below it, and only these are sent anywhere, each once. Rows without label or text aren't labelled;
    texts of any length are. No labelled row gives a model that knows scripts only.
    """
    require(docs, text, lang, doc_id)
    rows = docs.where(col(lang).isNotNull() & (col(lang) != "") & col(text).isNotNull()).select(col(lang).alias("lang"), col(text).alias("text"), col(doc_id).alias("id"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return fit([], [])
    few = train_docs + 6 * train_docs**0.5 + 10
    cut = None
    for r in sizes:
        below = int(min(1.0, few / r["n"]) * 2.0**63) - 1
        cut = (F if cut is None else cut).when(F.col("lang") == r["lang"], F.lit(below))
    hashed = rows.withColumn("h", F.xxhash64(F.lit(5), "id", "text").bitwiseAND(F.lit((1 << 63) - 1)))
    got: dict[str, list[tuple[int, str]]] = {}
    for r in hashed.where(F.col("h") <= cut).select("lang", "h", "text").collect():  # MOST_LANGUAGES x few texts, about
        got.setdefault(r["lang"], []).append((r["h"], r["text"]))
    some = [(x, t) for x in sorted(got) for _, t in sorted(got[x])[:train_docs]]
    return fit([t for _, t in some], [x for x, _ in some])


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
_FOUND = T.StructType([T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType()), T.StructField("level", T.DoubleType())])


def _labeller(model: LanguageModel, penalty: float):
    @F.pandas_udf(_FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r for texts in portions(b.tolist()) for r in label_texts(texts, model, penalty)]
            yield pd.DataFrame({"spans": [[{"start": a, "end": e, "lang": x} for a, e, x in r[0]] for r in rows], "lang": [r[1] for r in rows], "share": [r[2] for r in rows], "level": [r[3] for r in rows]})

    return run


def identify(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", languages: Sequence[str] | None = None, penalty: float = SWITCH_PENALTY, min_share: float = MIN_SHARE, train_docs: int = TRAIN_DOCS, model: LanguageModel | None = None) -> DataFrame:
    """(doc_id, lang, share, spans, keep) for every row.

    Script ranges narrow each word's candidate languages; where several remain, letter trigrams score them; Viterbi
    over the word scores, with ``penalty`` for each switch, labels spans (start, end, lang), in characters, that
    cover the text. ``lang`` is the language with most letters, ``share`` its part of them. ``keep`` is false for a
    text without a word of a known script (null and empty texts too: lang null, no spans), for one unlike all
    languages (letters less likely than in the labelled texts of any language, by a margin that is the wider the fewer
    letters a text has; letters in scripts that no labelled text is in don't count), and, if ``languages`` is
    given, for one of which spans in those make up less than ``min_share``. Mixing languages is no reason to go.

    The model is fitted on ``train_docs`` labelled documents a language unless one is given; ties between languages
    go to the first by name. Null ids and repeated rows stay as they are, other columns aren't read, an empty table gives
    no rows. Words are cut where the script changes within them.
    """
    require(docs, text, doc_id)
    small_batches(docs.sparkSession)
    model = model or train(docs, text=text, lang=lang, doc_id=doc_id, train_docs=train_docs)
    found = docs.select(col(doc_id).alias("doc_id"), _labeller(model, penalty)(col(text)).alias("f"))
    return found.select("doc_id", "f.lang", "f.share", "f.spans", _keep(model, languages, min_share).alias("keep"))


def _keep(model: LanguageModel, languages: Sequence[str] | None, min_share: float):
    keep = F.col("f.lang").isNotNull()
    keep = keep & (F.col("f.level") >= 0.0)
    if languages is not None:
        size = lambda a, x: a + x["end"] - x["start"]
        wanted = F.aggregate(F.filter("f.spans", lambda x: x["lang"].isin(list(languages))), F.lit(0), size)
        keep = keep & (wanted >= min_share * F.aggregate("f.spans", F.lit(0), size))
    return F.coalesce(keep, F.lit(False))


def keep_identified(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", languages: Sequence[str] | None = None, penalty: float = SWITCH_PENALTY, min_share: float = MIN_SHARE, train_docs: int = TRAIN_DOCS, model: LanguageModel | None = None) -> DataFrame:
    """``docs`` without the rows that identify() rejects; columns are unchanged, whatever their names.

    Null and empty texts go, as do others without a letter; long texts are read whole; repeated rows and null ids stay or
    go by their texts. An empty table stays empty.
    """
    require(docs, text, doc_id)
    small_batches(docs.sparkSession)
    model = model or train(docs, text=text, lang=lang, doc_id=doc_id, train_docs=train_docs)
    rows = packed(docs, f=_labeller(model, penalty)(col(text)))
    return unpacked(rows.where(_keep(model, languages, min_share)), docs.columns)
