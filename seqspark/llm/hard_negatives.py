"""Hard negatives by exact inner products, where segment summaries rule out most rows before they are scored."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqspark.llm.common import broadcast_if_small, join_on, settle

SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 10

# A negative's score in hundredths of its positive's.
LEAST, MOST = 30, 90

# Rows whose summaries a task holds, and rows worth a task of their own while cores are free.
SHARD = 32_768
SMALL_SHARD = 1_024

# Segments a vector is cut into, level by level; each segment falls into whole ones of the next level.
LEVELS = (1, 4, 16)


class Segments:
    """Integer vectors with the mean and the deviation of each of their segments.

    For segments x and y of w components, x . y is w * mean(x) * mean(y) plus the product of what is left of
    them, which is at most dev(x) * dev(y) either way (dev: the length of x - mean(x)). Summed over a
    vector's segments that bounds its score, the closer the shorter the segments are.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        values = vectors.astype(np.float64)
        n, d = values.shape
        self.length = np.sqrt((values**2).sum(axis=1))
        self.levels = []
        for count in LEVELS:
            if count > d:
                break
            edges = np.arange(count) * d // count
            sizes = np.diff(np.r_[edges, d])
            means = np.add.reduceat(values, edges, axis=1) / sizes
            rest = values - np.repeat(means, sizes, axis=1)
            # The root of the size goes into the means, so that a product of two has the size itself.
            self.levels.append((means * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest**2, edges, axis=1))))

    def bounds(self, level: int, rows: np.ndarray, other: Segments, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score that ``rows`` can have with vector ``at`` of ``other``, rounding allowed for."""
        means, deviations = self.levels[level]
        own_means, own_deviations = other.levels[level]
        middle = means[rows] @ own_means[at]
        reach = deviations[rows] @ own_deviations[at] + 1e-9 * self.length[rows] * other.length[at] + 1e-6
        return middle - reach, middle + reach

    def scores(self, rows: np.ndarray, other: Segments, at: int) -> np.ndarray:
        return self.vectors[rows] @ other.vectors[at]


def _kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest value, or minus infinity."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def best_rows(shard: Segments, rows: np.ndarray, asked: Segments, at: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be among the ``k`` best, and their scores."""
    for level in range(len(shard.levels)):
        if len(rows) <= k:
            break
        low, high = shard.bounds(level, rows, asked, at)
        rows = rows[high >= _kth(low, k)]
    return rows, shard.scores(rows, asked, at)


def rows_in_ranges(
    shard: Segments, rows: np.ndarray, asked: Segments, at: int, ranges: list[tuple[int, int]], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be among the ``k`` best within one of the score ranges (both ends in), and their scores."""
    for level in range(len(shard.levels)):
        if not len(rows):
            break
        low, high = shard.bounds(level, rows, asked, at)
        alive = np.zeros(len(rows), dtype=bool)
        for least, most in ranges:
            sure = (low >= least) & (high <= most)
            alive |= (high >= max(least, _kth(low[sure], k))) & (low <= most)
        rows = rows[alive]
    return rows, shard.scores(rows, asked, at)


# --- rows --------------------------------------------------------------------------------------


def usable_rows(table: DataFrame, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """``id, label, v, rid``: quantised vectors of rows that take part; ``rid`` tells repeated rows apart."""
    x = F.col(vector)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    there = x.isNotNull() & F.col(label).isNotNull() & F.col(vec_id).isNotNull()
    rows = table.where(F.coalesce(there & ~odd, F.lit(False))).select(
        F.col(vec_id).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint")).alias("v"),
    )
    counted = rows.groupBy("id", "label", "v").agg(F.count(F.lit(1)).alias("_n"))
    return counted.select("id", "label", "v", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy")).select(
        "id", "label", "v", F.xxhash64("id", "label", "v", "_copy").alias("rid")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of one width; what a shorter one lacks is 0."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class _Shards:
    """Goes through rows sorted by shard, members (``asks`` 0) before those that ask, and hands on what meets.

    Only the members of one shard are held, and those that ask batch by batch.
    """

    def __init__(self, keys: list[str], width: int, answer):
        self._keys, self._width, self._answer = keys, width, answer

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shard = None, [], None
        for batch in batches:
            codes = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in [*self._keys, "asks"]])
            cuts = np.r_[0, np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part, key = batch.slice(a, b - a), tuple(codes[:-1, a].tolist())
                if key != current:
                    current, held, shard = key, [], None
                if codes[-1, a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if shard is None:
                    members = pa.Table.from_batches(held).combine_chunks()
                    shard = members, Segments(_matrix(members.column("v").combine_chunks(), self._width))
                yield from self._answer(*shard, part, Segments(_matrix(part.column("v"), self._width)))


def _batch(columns: dict[str, list[np.ndarray]]) -> pa.RecordBatch | None:
    joined = {name: np.concatenate(parts) for name, parts in columns.items() if parts}
    return pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in joined.items()}) if joined else None


def _find_positives(k: int):
    def answer(members: pa.Table, shard: Segments, asking: pa.RecordBatch, asked: Segments) -> Iterator[pa.RecordBatch]:
        ids, rids = members.column("id").to_numpy(), members.column("rid").to_numpy()
        out: dict[str, list] = {"anchor_id": [], "anchor_rid": [], "positive_id": [], "positive_score": []}
        for at, (own, own_rid) in enumerate(zip(asking.column("id").to_pylist(), asking.column("rid").to_pylist(), strict=True)):
            others = np.flatnonzero((ids != own) | (rids != own_rid))
            rows, scores = best_rows(shard, others, asked, at, k)
            best = np.lexsort((ids[rows], -scores))[:k]
            found = len(best)
            for name, values in zip(out, (np.full(found, own), np.full(found, own_rid), ids[rows[best]], scores[best]), strict=True):
                out[name].append(values)
        batch = _batch(out)
        if batch is not None:
            yield batch

    return answer


def _find_negatives(k: int, least: int, most: int):
    def answer(members: pa.Table, shard: Segments, asking: pa.RecordBatch, asked: Segments) -> Iterator[pa.RecordBatch]:
        ids, labels = members.column("id").to_numpy(), members.column("label").to_numpy()
        out: dict[str, list] = {"anchor_id": [], "anchor_rid": [], "place": [], "negative_id": [], "negative_score": []}
        columns = [asking.column(c).to_pylist() for c in ("id", "rid", "label", "positives")]
        for at, (own, own_rid, label, positives) in enumerate(zip(*columns, strict=True)):
            # least * p <= 100 * s <= most * p, in whole numbers.
            ranges = [(-(-least * p["positive_score"] // 100), most * p["positive_score"] // 100) for p in positives]
            others = np.flatnonzero(labels != label)
            rows, scores = rows_in_ranges(shard, others, asked, at, ranges, k)
            order = np.lexsort((ids[rows], -scores))
            rows, scores = rows[order], scores[order]
            for p, (low, high) in zip(positives, ranges, strict=True):
                inside = np.flatnonzero((scores >= low) & (scores <= high))[:k]
                found = len(inside)
                values = (np.full(found, own), np.full(found, own_rid), np.full(found, p["place"]), ids[rows[inside]], scores[inside])
                for name, v in zip(out, values, strict=True):
                    out[name].append(v)
        batch = _batch(out)
        if batch is not None:
            yield batch

    return answer


def _dealt(rows: DataFrame, asking: DataFrame, keys: list[str]) -> DataFrame:
    """Members and those that ask, a shard's side by side and the members first."""
    both = rows.withColumn("asks", F.lit(0)).unionByName(asking.withColumn("asks", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "asks")


def mine_hard_negatives(
    table: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST, scale: float = SCALE, shard: int = SHARD, small_shard: int = SMALL_SHARD,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor is a row whose id is divisible by ``anchor_every``; its positives are the best other rows of
    its label. For each of them the best rows of other labels are returned whose score is at least ``least``
    and at most ``most`` hundredths of the positive's. Ties go to the smaller id. Everything is exact: the
    summaries only leave out rows that cannot be among the results.

    A row whose id, label or vector is null, or whose vector has a null, NaN or infinite component, takes no
    part. Rows may share an id; each counts, and a repeated anchor is answered as often as it occurs. A
    shorter vector lacks components of 0. Scores must fit 64 bits. A large label falls into shards by hash;
    a task holds the members of one shard while all anchors go past, so rows stay and anchors travel.
    """
    rows = settle(usable_rows(table, vec_id, vector, label, scale))
    total, widest = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, widest or 0)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    anchors = rows.where(F.col("id") % anchor_every == 0)
    hashed = F.xxhash64("rid")

    # Positives: each label on its own.
    size = max(min(shard, -(-total // cores)), small_shard)
    sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
    sizes = broadcast_if_small(settle(sizes))
    members = join_on(rows, sizes, ["label"]).withColumn("part", F.pmod(hashed, F.col("parts")).cast("int")).drop("parts")
    asking = join_on(anchors, sizes, ["label"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    met = _dealt(members, asking, ["label", "part"]).mapInArrow(
        _Shards(["label", "part"], width, _find_positives(positives)),
        "anchor_id bigint, anchor_rid bigint, positive_id bigint, positive_score bigint",
    )
    order = Window.partitionBy("anchor_id", "anchor_rid").orderBy(F.desc("positive_score"), "positive_id")
    first = settle(met.withColumn("place", F.row_number().over(order).cast("bigint")).where(F.col("place") <= positives))

    # Negatives: all shards, for anchors with their positives.
    lists = first.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_rid").alias("rid")).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("positives")
    )
    parts = max(1, -(-total // size))
    members = rows.withColumn("part", F.pmod(hashed, F.lit(parts)).cast("int"))
    asking = anchors.join(lists, ["id", "rid"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = _dealt(members, asking, ["part"]).mapInArrow(
        _Shards(["part"], width, _find_negatives(negatives, least, most)),
        "anchor_id bigint, anchor_rid bigint, place bigint, negative_id bigint, negative_score bigint",
    )
    keys = ["anchor_id", "anchor_rid", "place"]
    order = Window.partitionBy(*keys).orderBy(F.desc("negative_score"), "negative_id")
    best = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.join(first, keys).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def relabelled(table: DataFrame, every: int = RELABEL_EVERY, labels: int = LABELS) -> DataFrame:
    """Every ``every``-th label wrong, by id: the next one."""
    changed = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return table.withColumn("label", changed)


def hard_negatives_sql(embeddings: str = "embeddings") -> str:
    """The rows of ``mine_hard_negatives`` over a relabelled table of vectors of one length with unlike ids."""
    return f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM {embeddings}
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= {POSITIVES}),
n AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  WHERE {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
