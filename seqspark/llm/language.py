"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqspark.llm.common import id_remainder, per_batch, worker_cache

DIMENSIONS = 512
GRAM = 3
UNKNOWN = "und"

# Documents whose counts are bundled at a time, n-grams whose vectors are made at a time and that a worker keeps.
BLOCK = 64
PART = 4_096
MAX_KEPT = 60_000

# Learning rows a least score is taken from, and the share of it that a text must reach.
ENOUGH = 30
MARGIN = 0.5

_BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)], dtype=bool)


def grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct letter n-grams of a text and their counts; None for a text without a letter.

    Letters are lower-cased; any run of other characters, and either end, is one boundary sign.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    signs = np.concatenate([[0], np.where(letter, codes, 0), [0]]).astype(np.int64)
    keep = np.ones(len(signs), dtype=bool)
    keep[1:] = (signs[1:] != 0) | (signs[:-1] != 0)
    signs = signs[keep]
    found = signs[: len(signs) - GRAM + 1].copy()
    for n in range(1, GRAM):
        found = (found << _BITS) | signs[n : len(signs) - GRAM + 1 + n]
    return np.unique(found, return_counts=True)


class Space:
    """Random sign vectors of letters, permuted by place and bound into n-gram vectors."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self._letter: dict[int, np.ndarray] = {}
        # Sorted n-grams, the place of each in the table, and the table, which never moves.
        self._keys = np.zeros(0, dtype=np.int64)
        self._place = np.zeros(0, dtype=np.int64)
        self._table = np.empty((MAX_KEPT, dimensions), dtype=np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self._letter:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions)
            self._letter[code] = (2 * bits - 1).astype(np.int8)
        return self._letter[code]

    def _bind(self, keys: np.ndarray) -> np.ndarray:
        """Product of the letters' vectors, the one n places before the last rotated n times."""
        out = np.ones((len(keys), self.dimensions), dtype=np.int8)
        for n in range(GRAM):
            codes, place = np.unique((keys >> (_BITS * n)) & ((1 << _BITS) - 1), return_inverse=True)
            rolled = np.stack([np.roll(self.letter(int(c)), n) for c in codes])
            out *= rolled[place]
        return out

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct n-grams; those seen before are looked up."""
        new = np.setdiff1d(keys, self._keys, assume_unique=True)
        if len(new):
            if len(self._keys) + len(new) > MAX_KEPT:
                if len(keys) > MAX_KEPT:
                    return self._bind(keys)
                new, self._keys, self._place = keys, self._keys[:0], self._place[:0]
            held = len(self._keys)
            self._table[held : held + len(new)] = self._bind(new)
            merged = np.concatenate([self._keys, new])
            place = np.concatenate([self._place, np.arange(held, held + len(new))])
            order = np.argsort(merged)
            self._keys, self._place = merged[order], place[order]
        return self._table[self._place[np.searchsorted(self._keys, keys)]]

    def total(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the n-grams' vectors, each as often as it is counted: whole numbers, so in any order the same."""
        out = np.zeros(self.dimensions, dtype=np.float64)
        for at in range(0, len(keys), PART):
            out += counts[at : at + PART].astype(np.float64) @ self._bind(keys[at : at + PART]).astype(np.float64)
        return out

    def bundle(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A row per document: the sum of its n-grams' vectors."""
        keys = np.unique(np.concatenate([k for k, _ in counted]))
        out = np.zeros((len(counted), self.dimensions), dtype=np.float32)
        # N-grams in parts, so that long texts in many scripts need no large table at once.
        for at in range(0, len(keys), PART):
            part = keys[at : at + PART]
            counts = np.zeros((len(counted), len(part)), dtype=np.float32)
            for row, (k, n) in enumerate(counted):
                lo, hi = np.searchsorted(k, part[0]), np.searchsorted(k, part[-1], side="right")
                counts[row, np.searchsorted(part, k[lo:hi])] = n[lo:hi]
            out += counts @ self.vectors(part).astype(np.float32)
        return out


def space(dimensions: int, seed: int) -> Space:
    return worker_cache(("space", dimensions, seed), lambda: Space(dimensions, seed))


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows.astype(np.float64), axis=-1, keepdims=True)
    return np.divide(rows, length, out=np.zeros(rows.shape, dtype=np.float64), where=length > 0)


def learn_prototypes(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = 7
) -> dict[str, np.ndarray]:
    """Language prototypes: the bundle of the n-gram vectors of all texts with a non-null language.

    N-grams are counted per language over all texts, so the bundle is exact. What reaches the driver is one
    vector per language.
    """
    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        held: dict[str, list] = {}
        for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = grams(value)
            if found is not None:
                held.setdefault(name, []).append(found)
        if not held:
            return None
        names, vectors = [], []
        for name, counted in sorted(held.items()):
            keys, at = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
            totals = np.bincount(at, weights=np.concatenate([n for _, n in counted])).astype(np.int64)
            names.append(name)
            vectors.append(space(dimensions, seed).total(keys, totals))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([v.tolist() for v in vectors], pa.list_(pa.float64()))], ["lang", "bundle"]
        )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    bundles = rows.mapInArrow(per_batch(count), "lang string, bundle array<double>")
    sums = bundles.select("lang", F.posexplode("bundle")).groupBy("lang", "pos").agg(F.sum("col").alias("total"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "total"))).alias("v")).select("lang", "v.total")
    return {r["lang"]: np.array(r["total"]) for r in found.collect()}


def _scores(
    counted: list, prototypes: dict[str, np.ndarray], dimensions: int, seed: int, labels: list | None = None
) -> tuple[list[str], list[float]]:
    """Best language and cosine of counted n-grams; ``und`` and 0 for None and where nothing was learned.

    With ``labels`` each text is judged by prototypes without itself.
    """
    names = sorted(prototypes)
    found, scores = [UNKNOWN] * len(counted), [0.0] * len(counted)
    if not names:
        return found, scores
    sums = np.stack([prototypes[n] for n in names])
    profile = _unit(sums).T
    rows = [i for i, c in enumerate(counted) if c is not None]
    for block in range(0, len(rows), BLOCK):
        part = rows[block : block + BLOCK]
        bundles = space(dimensions, seed).bundle([counted[i] for i in part])
        unit = _unit(bundles)
        cosine = unit @ profile
        if labels is not None:
            own = np.array([names.index(labels[i]) for i in part])
            cosine[np.arange(len(part)), own] = (unit * _unit(sums[own] - bundles)).sum(axis=1)
        for i, best, value in zip(part, cosine.argmax(axis=1), cosine.max(axis=1), strict=True):
            found[i], scores[i] = names[best], float(min(1.0, max(0.0, value)))
    return found, scores


def predict_languages(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS, seed: int = 7
) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, replacing columns of these names.

    The score is the cosine with the best prototype, between 0 and 1; ties go to the first language in
    order. A null text, a text without a letter, and any text when nothing was learned get ``und`` and 0.
    """
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index(text)

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = [grams(t) if t is not None else None for t in batch.column(at).to_pylist()]
        found, scores = _scores(counted, prototypes, dimensions, seed)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
            [*batch.schema.names, "lang_pred", "score"],
        )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(per_batch(predict, text), schema)


def _size_class(counted: tuple[np.ndarray, np.ndarray]) -> int:
    return len(counted[0]).bit_length()


def learn_floors(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = 7
) -> dict[str, list[float]]:
    """Per predicted language, the score that a text of each size class has to reach.

    Scores grow with the number of distinct n-grams, so sizes are classed by its bits. Every learning row is judged by
    prototypes without itself, as a text not learned from would be. The floor of a class is ``MARGIN`` of the
    least score among longer rows and ``ENOUGH`` rows of this class and the next shorter ones; where there are
    fewer, longer texts cannot tell how low shorter ones score, and the floor is 0.
    """
    def judge(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        counted = [grams(t) for t in batch.column("text").to_pylist()]
        found, scores = _scores(counted, prototypes, dimensions, seed, batch.column("lang").to_pylist())
        held: dict[tuple[str, int], list[float]] = {}
        for name, c, score in zip(found, counted, scores, strict=True):
            if c is not None:
                held.setdefault((name, _size_class(c)), []).append(score)
        if not held:
            return None
        rows = [(name, size, min(v), len(v)) for (name, size), v in held.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int32(), pa.float64(), pa.int64()], strict=True)],
            ["lang", "size", "least", "n"],
        )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    judged = rows.mapInArrow(per_batch(judge), "lang string, size int, least double, n bigint")
    found: dict[str, dict[int, tuple[float, int]]] = {}
    for r in judged.groupBy("lang", "size").agg(F.min("least").alias("least"), F.sum("n").alias("n")).collect():
        found.setdefault(r["lang"], {})[r["size"]] = (r["least"], r["n"])
    floors: dict[str, list[float]] = {}
    for name, sizes in found.items():
        floors[name] = []
        for size in range(max(sizes) + 1):
            least, seen = 1.0, 0
            for other in sorted(sizes, reverse=True):
                if seen >= ENOUGH:
                    break
                least = min(least, sizes[other][0])
                seen += sizes[other][1] if other <= size else 0
            floors[name].append(MARGIN * least if seen >= ENOUGH else 0.0)
    return floors


def identify_languages(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = 7) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    Prototypes are learned from documents whose id's crc32 modulo 4 is not 2 and whose language is not null.
    A null id counts as empty text in that. Repeated rows get equal results; an empty table gives none.
    """
    held_out = id_remainder(4) == 2
    prototypes = learn_prototypes(docs.where(~held_out), dimensions=dimensions, seed=seed)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return predict_languages(rows, prototypes, dimensions=dimensions, seed=seed).select("doc_id", "held_out", "lang_pred", "score")


def drop_unknown_language(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = 7) -> DataFrame:
    """``docs`` without rows in no known language, each row judged by its own text.

    A row goes if its text is null or has no letter, or if its score is below the floor of its predicted
    language and size. Prototypes and floors are learned from the rows ``identify_languages`` learns from;
    where there is no language to learn, every text with a letter stays.
    """
    learning = docs.where(id_remainder(4) != 2)
    prototypes = learn_prototypes(learning, dimensions=dimensions, seed=seed)
    floors = learn_floors(learning, prototypes, dimensions=dimensions, seed=seed) if prototypes else {}
    at = docs.columns.index("text")

    def known(counted: tuple | None, name: str, score: float) -> bool:
        if counted is None:
            return False
        least = floors.get(name)
        return not least or score >= least[min(_size_class(counted), len(least) - 1)]

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = [grams(t) if t is not None else None for t in batch.column(at).to_pylist()]
        found, scores = _scores(counted, prototypes, dimensions, seed)
        return batch.filter(pa.array(list(map(known, counted, found, scores)), pa.bool_()))

    return docs.mapInArrow(per_batch(keep), docs.schema)


__all__ = [
    "DIMENSIONS", "Space", "drop_unknown_language", "grams", "identify_languages", "learn_floors", "learn_prototypes", "predict_languages",
    "space",
]
