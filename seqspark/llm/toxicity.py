"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqspark.llm.common import id_remainder, per_batch, settle, text_or_empty

WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORD_SIZE = CHAR_SIZE = 8
CHAR_BUCKETS = 4_096
MAX_WORDS = 20_000

# The labelled rows the network is fitted on: so many of each label, by a hash of their ids, among texts up
# to so many characters. This bounds what reaches the driver; scores are given to all whole texts.
SAMPLE_PER_LABEL = 1_500
SAMPLE_CHARS = 8_000

TOXIC_AT = 0.7

# Distinct words a worker keeps projected.
MAX_KEPT = 250_000

_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»…“”‘’"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bare(word: str) -> str:
    return word.strip(_PUNCTUATION)


def char_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' character trigrams, their ends marked, and how many each word has.

    A word of n characters has n of them; an empty word counts as a blank.
    """
    marked = [f"<{w or ' '}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked)) - 2
    begin = np.cumsum(sizes + 2) - (sizes + 2)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
    mixed = (codes[at] * np.uint64(1_000_003) + codes[at + 1]) * np.uint64(1_000_003) + codes[at + 2]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS, sizes


def windows_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over all word numbers, as rows padded with -1, and their lengths.

    The last window ends with the text. A text without words has one window of length 0.
    """
    n = len(ids)
    if n <= WINDOW:
        rows = np.full((1, WINDOW), -1, dtype=np.int64)
        rows[0, :n] = ids
        return rows, np.array([n])
    starts = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    starts[-1] = min(starts[-1], n - WINDOW)
    return ids[starts[:, None] + np.arange(WINDOW)], np.full(len(starts), WINDOW)


def _sigmoid(x):
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-x))


class Words:
    """Distinct words as input features: a vocabulary row, and the buckets of their character trigrams."""

    def __init__(self, words: list[str], vocabulary: dict[str, int]):
        names = [bare(w) for w in words]
        # The row after the vocabulary stands for all other words.
        self.rows = np.array([vocabulary.get(n, len(vocabulary)) for n in names], dtype=np.int64)
        self.flat, self.sizes = char_grams(names)

    def take(self, at: np.ndarray) -> Words:
        """The words at some places."""
        part = object.__new__(Words)
        ends = np.cumsum(self.sizes)
        part.rows, part.sizes = self.rows[at], self.sizes[at]
        begin = (ends - self.sizes)[at]
        inner = np.arange(part.sizes.sum()) - np.repeat(np.cumsum(part.sizes) - part.sizes, part.sizes)
        part.flat = self.flat[np.repeat(begin, part.sizes) + inner]
        return part


def _add_rows(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Adds each row of ``values`` to the row of ``out`` it belongs to."""
    if len(at):
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
        out[at[order][starts]] += np.add.reduceat(values[order], starts, axis=0)


class Network:
    """Word and character input, a gated recurrent layer each way, attention pooling, one output.

    The two ways are the leading axis of the gate weights. While running they are stacked: rows of the
    forward way first, then those of the backward one, which reads the window from its end.
    """

    def __init__(self, vocabulary: list[str], seed: int = 0, rate: float = 0.0):
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        size = WORD_SIZE + CHAR_SIZE
        self.vocabulary = {w: i for i, w in enumerate(vocabulary)}
        self.constant = rate
        self.p = {
            "words": draw(len(vocabulary) + 1, WORD_SIZE, scale=0.05), "chars": draw(CHAR_BUCKETS, CHAR_SIZE, scale=0.05),
            "W": draw(2, size, 3 * HIDDEN, scale=size**-0.5), "c": np.zeros((2, 3 * HIDDEN), dtype=np.float32),
            "U": draw(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "A": draw(2 * HIDDEN, HIDDEN, scale=0.25), "a": draw(HIDDEN, scale=0.5),
            "o": draw(2 * HIDDEN, scale=0.5), "ob": np.zeros(1, dtype=np.float32),
        }

    def inputs(self, words: Words) -> np.ndarray:
        """Input vectors. Trigram vectors are added and divided by the root of their number."""
        starts = np.cumsum(words.sizes) - words.sizes
        chars = np.add.reduceat(self.p["chars"][words.flat], starts, axis=0) / np.sqrt(words.sizes)[:, None]
        return np.concatenate([self.p["words"][words.rows], chars], axis=1).astype(np.float32)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of either way; it is the same at every place of the word."""
        return np.matmul(x, self.p["W"]) + self.p["c"][:, None, :]

    def run(self, table: np.ndarray, rows: np.ndarray, keep: bool = False):
        """Outputs before the sigmoid for windows of row numbers into ``table[way]``; -1 is padding."""
        n, steps = rows.shape
        rows = np.ascontiguousarray(rows.T)
        real = rows >= 0
        whole = bool(real.all())
        safe = rows if whole else np.where(real, rows, 0)
        at = np.concatenate([safe, safe[::-1] + table.shape[1]], axis=1)
        on_all = np.concatenate([real, real[::-1]], axis=1)[:, :, None]
        flat = table.reshape(-1, 3 * HIDDEN)
        ahead, back = self.p["U"]
        h = np.zeros((2 * n, HIDDEN), dtype=np.float32)
        hu = np.empty((2 * n, 3 * HIDDEN), dtype=np.float32)
        states = np.empty((steps, 2 * n, HIDDEN), dtype=np.float32)
        trail = []
        for t in range(steps):
            g = flat.take(at[t], axis=0)
            np.matmul(h[:n], ahead, out=hu[:n])
            np.matmul(h[n:], back, out=hu[n:])
            zr = _sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            after = new + z * (h - new)
            if not whole:
                after = np.where(on_all[t], after, h)
            if keep:
                trail.append((h, z, r, new, hu[:, 2 * HIDDEN :].copy(), on_all[t]))
            h = states[t] = after
        forth, back = states[:, :n], states[::-1, n:]
        hidden = np.tanh(forth @ self.p["A"][:HIDDEN] + back @ self.p["A"][HIDDEN:])
        score = hidden @ self.p["a"]
        if not whole:
            score = np.where(real, score, np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0)) * real
        total = weight.sum(axis=0)
        weight = np.divide(weight, total, out=np.zeros_like(weight), where=total > 0)
        pooled = np.concatenate([(weight[:, :, None] * forth).sum(axis=0), (weight[:, :, None] * back).sum(axis=0)], axis=1)
        out = pooled @ self.p["o"] + self.p["ob"][0]
        return (out, (forth, back, hidden, weight, pooled, trail)) if keep else out

    def gradients(self, words: Words, rows: np.ndarray, target: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted cross-entropy over windows."""
        p, x = self.p, self.inputs(words)
        out, (forth, back, hidden, weight, pooled, trail) = self.run(self.projected(x), rows, keep=True)
        n, steps = rows.shape
        d = {k: np.zeros_like(v) for k, v in p.items()}
        dout = ((_sigmoid(out) - target) * weights).astype(np.float32)
        d["o"], d["ob"][0] = pooled.T @ dout, dout.sum()
        dpooled = dout[:, None] * p["o"]
        dweight = (forth * dpooled[:, :HIDDEN]).sum(axis=2) + (back * dpooled[:, HIDDEN:]).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        d["a"] = (dscore[:, :, None] * hidden).sum(axis=(0, 1))
        dhidden = dscore[:, :, None] * p["a"] * (1 - hidden**2)
        flat = dhidden.reshape(-1, HIDDEN)
        d["A"] = np.concatenate([forth.reshape(-1, HIDDEN).T @ flat, back.reshape(-1, HIDDEN).T @ flat])
        dforth = weight[:, :, None] * dpooled[:, :HIDDEN] + dhidden @ p["A"][:HIDDEN].T
        dback = weight[:, :, None] * dpooled[:, HIDDEN:] + dhidden @ p["A"][HIDDEN:].T
        dstates = np.concatenate([dforth, dback[::-1]], axis=1)
        dh = np.zeros((2 * n, HIDDEN), dtype=np.float32)
        dgates = np.empty((steps, 2 * n, 3 * HIDDEN), dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            before, z, r, new, hn, on = trail[t]
            dh = dh + dstates[t]
            live = dh * on
            dz = live * (before - new) * z * (1 - z)
            dn = live * (1 - z) * (1 - new**2)
            dr = dn * hn * r * (1 - r)
            dhu = np.concatenate([dz, dr, dn * r], axis=1)
            dgates[t] = np.concatenate([dz, dr, dn], axis=1)
            for way, part in enumerate((slice(0, n), slice(n, 2 * n))):
                d["U"][way] += before[part].T @ dhu[part]
                dh[part] += dhu[part] @ p["U"][way].T - live[part] + (live * z)[part]
        real = (rows >= 0).T
        dx = np.zeros_like(x)
        for way, part in enumerate((dgates[:, :n], dgates[::-1, n:])):
            per_word = np.zeros((len(x), 3 * HIDDEN), dtype=np.float32)
            _add_rows(per_word, rows.T[real], part[real])
            d["W"][way], d["c"][way] = x.T @ per_word, per_word.sum(axis=0)
            dx += per_word @ p["W"][way].T
        _add_rows(d["words"], words.rows, dx[:, :WORD_SIZE])
        _add_rows(d["chars"], words.flat, np.repeat(dx[:, WORD_SIZE:] / np.sqrt(words.sizes)[:, None], words.sizes, axis=0))
        return d


class _Steps:
    """Steps along averaged gradients.

    Input tables are scaled by their largest gradient, so that features seen once move less than those many
    texts share, other weights one by one.
    """

    SHARED = ("words", "chars")

    def __init__(self, p: dict[str, np.ndarray]):
        self.t = 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: 0.0 if k in self.SHARED else np.zeros_like(v) for k, v in p.items()}

    def step(self, p: dict[str, np.ndarray], d: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for k, g in d.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            shared = k in self.SHARED
            square = float((g * g).max()) if shared else g * g
            self.v[k] = 0.99 * self.v[k] + 0.01 * square
            move = (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-8)
            p[k] -= rate * (6.0 if shared else 1.0) * move
            if shared:
                p[k] *= 1 - 0.1 * rate


def _leaning(present: list[np.ndarray], target: np.ndarray, size: int, weight: float = 10.0) -> np.ndarray:
    """Smoothed log-odds of each feature from the texts it occurs in; 0 for one without evidence."""
    count = np.zeros((2, size))
    for rows, label in zip(present, target, strict=True):
        count[int(label), rows] += 1
    total = np.array([(target == 0).sum(), (target == 1).sum()], dtype=float)
    part = (count + weight * (total / total.sum())[:, None]) / total[:, None]
    return np.log(part[1] / part[0]).astype(np.float32)


def train(
    texts: list[str], labels: list[int], epochs: int = 8, least_steps: int = 200, batch: int = 64, rate: float = 0.01, seed: int = 0
) -> Network:
    """Fit the network on whole texts with labels 0 and 1.

    A text is toxic if one of its windows is: its output is that of its highest window, which alone is
    corrected. One input of each word and trigram starts as its log-odds in the texts; they also choose the
    windows of the first epoch. With fewer than two kinds of label the network answers a constant, the
    share of label 1.
    """
    if len(set(labels)) < 2:
        return Network([], seed, rate=float(np.mean(labels)) if labels else 0.0)
    rng = np.random.default_rng(seed)
    target = np.array(labels, dtype=np.float32)
    split = [words_of(t) for t in texts]
    counts = Counter(n for words in split for n in {bare(w) for w in words})
    network = Network(sorted((w for w, c in counts.items() if c >= 3), key=lambda w: (-counts[w], w))[:MAX_WORDS], seed)
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64) for words in split]
    windows = [windows_of(i)[0] for i in ids]
    every = Words(list(number) or [""], network.vocabulary)
    owned = [every.take(np.unique(i)) if len(i) else None for i in ids]
    none = np.zeros(0, dtype=np.int64)
    network.p["words"][:, 0] += _leaning([np.unique(o.rows) if o else none for o in owned], target, len(network.p["words"]))
    network.p["chars"][:, 0] += _leaning([np.unique(o.flat) if o else none for o in owned], target, CHAR_BUCKETS)
    start = network.inputs(every)
    leaning = start[:, 0] + start[:, WORD_SIZE]
    # Both labels weigh the same.
    share = target.mean()
    importance = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    steps = _Steps(network.p)
    # Small samples are gone through more often.
    epochs = max(epochs, -(-least_steps * batch // len(texts)))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            rows = np.concatenate([windows[i] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(windows[i]) for i in part])
            used, place = np.unique(rows[rows >= 0], return_inverse=True)
            words = every.take(used if len(used) else np.array([0]))
            local = np.full(rows.shape, -1, dtype=np.int64)
            local[rows >= 0] = place
            if epoch:
                out = network.run(network.projected(network.inputs(words)), local)
            else:
                out = np.where(rows >= 0, np.maximum(leaning[rows], 0) ** 2, 0).sum(axis=1)
            best = np.lexsort((-out, owner))
            chosen = best[np.unique(owner[best], return_index=True)[1]]
            local, owner = local[chosen], owner[chosen]
            pace = rate * (1.0 if epoch < 0.7 * epochs else 0.3)
            steps.step(network.p, network.gradients(words, local, target[part], importance[part] / len(part)), pace)
    return network


class Scorer:
    """Scores whole texts; every distinct word is projected once per worker."""

    def __init__(self, network: Network):
        self.network = network
        self._number: dict[str, int] = {}
        self._table = np.zeros((2, 1, 3 * HIDDEN), dtype=np.float32)
        self._used = 0

    def _ids(self, split: list[list[str]]) -> list[np.ndarray]:
        if len(self._number) > MAX_KEPT:
            self._number.clear()
            self._used = 0
        new = list(set().union(*split).difference(self._number)) if split else []
        if new:
            rows = self.network.projected(self.network.inputs(Words(new, self.network.vocabulary)))
            if self._used + len(new) > self._table.shape[1]:
                grown = np.zeros((2, 2 * (self._used + len(new)), 3 * HIDDEN), dtype=np.float32)
                grown[:, : self._used] = self._table[:, : self._used]
                self._table = grown
            self._table[:, self._used : self._used + len(new)] = rows
            self._number.update(zip(new, range(self._used, self._used + len(new)), strict=True))
            self._used += len(new)
        lookup = self._number.__getitem__
        return [np.fromiter(map(lookup, words), dtype=np.int64, count=len(words)) for words in split]

    def scores(self, texts: list[str], batch: int = 1024) -> list[float]:
        """The highest score among all overlapping windows of each text."""
        if not self.network.vocabulary and not self.network.p["ob"].any():
            return [self.network.constant] * len(texts)
        windows = [windows_of(ids)[0] for ids in self._ids([words_of(t) for t in texts])]
        if not windows:
            return []
        rows = np.concatenate(windows)
        out = np.empty(len(rows), dtype=np.float32)
        # Whole windows first: they need no padding.
        order = np.argsort(rows[:, -1] < 0, kind="stable")
        for at in range(0, len(rows), batch):
            part = order[at : at + batch]
            out[part] = self.network.run(self._table, rows[part])
        starts = np.concatenate([[0], np.cumsum([len(w) for w in windows])[:-1]])
        return _sigmoid(np.maximum.reduceat(out.astype(np.float64), starts)).tolist()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, most_chars: int = SAMPLE_CHARS
) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: ``per_label`` rows of each label at most, drawn by a hash of the id."""
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    # The draw moves ids and lengths; texts are looked up for the ids drawn, at most two times per_label.
    sizes = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("_size")).where(F.col("_size") <= most_chars)
    joined = sizes.join(known, F.col("doc_id") == F.col("_id")).select("_id", "_toxic").distinct()
    order = [F.xxhash64(F.col("_id"), F.lit(1)), F.col("_id")]
    parts = [joined.where(F.col("_toxic") == value).orderBy(*order).limit(per_label) for value in (0, 1)]
    drawn = F.broadcast(settle(parts[0].unionByName(parts[1])))
    texts = docs.select("doc_id", text_or_empty().alias("text")).where(F.length("text") <= most_chars)
    rows = texts.join(drawn, F.col("doc_id") == F.col("_id")).select("text", "_toxic").distinct().collect()
    rows.sort(key=lambda r: (zlib.crc32(r["text"].encode("utf-8", "surrogatepass")), r["text"]))
    return [r["text"] for r in rows], [r["_toxic"] for r in rows]


_scorers: dict[int, Scorer] = {}


def _scorer(key: int, sent: Broadcast) -> Scorer:
    """This worker's scorer of a network, kept between tasks."""
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(sent.value)
    return _scorers[key]


def score_texts(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, which replaces a column of that name."""
    docs = docs.drop("score")
    sent = docs.sparkSession.sparkContext.broadcast(network)
    key = zlib.crc32(b"".join(np.ascontiguousarray(v).tobytes() for _, v in sorted(network.p.items())))
    at = docs.columns.index(text)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _scorer(key, sent).scores([t or "" for t in batch.column(at).to_pylist()])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(per_batch(score, text), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, toxic_at: float = TOXIC_AT, seed: int = 0
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    The network learns from labelled rows whose id's crc32 modulo 3 is not 1 (a null id counts as empty
    text; of contradicting labels of one id the higher holds). The score is that of the highest of all
    overlapping windows of the whole text. Null and empty texts have one empty window and get the network's
    answer to it. Without labels every score is 0, with labels of one kind it is their share of label 1.
    Repeated rows get equal scores; an empty table gives none.
    """
    held_out = id_remainder(3) == 1
    network = train(*labelled_sample(docs.where(~held_out), labels, per_label), seed=seed)
    rows = docs.select("doc_id", held_out.alias("held_out"), text_or_empty().alias("text"))
    return score_texts(rows, network).select(
        "doc_id", "held_out", "score", (F.col("score") >= toxic_at).cast("int").alias("predicted")
    )
