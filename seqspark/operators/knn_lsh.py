"""k-nearest-neighbour graph by locality-sensitive hashing, with its recall measured.

Exact pruning weakens in many dimensions, so the work of `knn` nears all blocks against all. Here every round
puts the vectors in the order of their random-projection hashes and compares blocks of consecutive ones: a
round costs one sort and a fixed number of comparisons a row, whatever the table holds. Rounds go on until a
sample of rows, whose true neighbours are known, has found the wanted share of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqspark.operators.knn import distinct_vectors, graph_schema, knn, matrix, rows_of_groups
from seqspark.operators.ordering import with_rank
from seqspark.session import settle

RECALL = 0.9

# Consecutive vectors compared with each other, and rounds hashed and sorted together.
BLOCK = 1024
ROUNDS_AT_ONCE = 4

# Rounds after which the graph is made exactly instead.
MAX_ROUNDS = 64

# Rows whose true neighbours are looked up to measure recall.
PROBES = 256

# Width of a hash bucket in deviations of a projection, and buckets of the fine hash in one of these.
BUCKET = 2.0
FINE = 1 << 16

_PAIRS = "gid bigint, other bigint, distance double"


class Graph(NamedTuple):
    """``edges`` as `knn` returns them, what the probes' recall is at least, rounds, and whether all are exact."""

    edges: DataFrame
    recall: float
    rounds: int
    exact: bool


def _nearest(
    ids: np.ndarray, points: np.ndarray, own: np.ndarray, asked: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest of ``points`` to each of ``asked``, lower id first on ties, as long columns."""
    # Products choose a few more than wanted; these are measured by differences, as the exact graph does.
    about = (points**2).sum(axis=1)[None, :] - 2 * (asked @ points.T)
    wide = min(len(ids), keep + 8)
    chosen = np.argpartition(about, wide - 1, axis=1)[:, :wide]
    distance = np.stack([np.sqrt(((points[c] - p) ** 2).sum(axis=1)) for c, p in zip(chosen, asked, strict=True)])
    order = np.lexsort((ids[chosen], distance), axis=1)[:, : min(keep, wide)]
    others = np.take_along_axis(ids[chosen], order, axis=1)
    return np.repeat(own, order.shape[1]), others.ravel(), np.take_along_axis(distance, order, axis=1).ravel()


def _best(pairs: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` closest others of every vector, each once; one shuffle, by vector."""
    place = F.row_number().over(Window.partitionBy("gid").orderBy("distance", "other"))
    once = pairs.repartition("gid").groupBy("gid", "other").agg(F.min("distance").alias("distance"))
    return once.withColumn("_n", place).where(F.col("_n") <= keep).drop("_n")


def _probe_truth(groups: DataFrame, keep: int, probes: int) -> DataFrame:
    """True neighbours of a sample of bounded size, chosen by hash: the sample meets all vectors in one scan."""
    drawn = groups.orderBy(F.xxhash64("gid"), "gid").limit(probes).select("gid", "vector").collect()
    own = np.array([r["gid"] for r in drawn])
    asked = matrix(pd.Series([r["vector"] for r in drawn]))

    def scan(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"gid": own[:0], "other": own[:0], "distance": np.zeros(0)})
        for frame in frames:
            for at in range(0, len(frame), BLOCK):
                part = frame[at : at + BLOCK]
                found = _nearest(part["gid"].to_numpy(), matrix(part["vector"]), own, asked, keep)
                both = pd.concat([best, pd.DataFrame(dict(zip(best.columns, found, strict=True)))])
                best = both.sort_values(["gid", "distance", "other"]).groupby("gid").head(keep)
        yield best

    return _best(groups.select("gid", "vector").mapInPandas(scan, _PAIRS), keep)


def _least_recall(found: DataFrame, truth: DataFrame) -> float:
    """The probes' mean share of true neighbours found, less two standard errors of it."""
    # The probes' neighbours are a few thousand rows, so the graph stays where it is.
    hits = found.join(F.broadcast(truth), ["gid", "other"], "left_semi").select("gid", "other", F.lit(1).alias("_hit"))
    marked = truth.join(hits, ["gid", "other"], "left")
    shares = marked.groupBy("gid").agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("share"))
    mean, deviation, n = shares.agg(F.avg("share"), F.stddev("share"), F.count(F.lit(1))).first()
    return 1.0 if not n else mean - 2 * (deviation or 0.0) / math.sqrt(n)


def _spread(groups: DataFrame) -> tuple[int, float]:
    """Number of vectors and the mean deviation of a coordinate, for the bucket width."""
    coordinates = groups.select(F.posexplode("vector").alias("d", "v"))
    by_place = coordinates.groupBy("d").agg(F.var_pop("v").alias("s"))
    return groups.count(), math.sqrt(by_place.agg(F.avg("s")).first()[0] or 0.0)


def _round_pairs(groups: DataFrame, first: int, rounds: int, levels: int, deviation: float, keep: int, block: int,
                 seed: int) -> DataFrame:
    """Closest others within the blocks of ``rounds`` orders of all vectors."""
    hashed = groups.select("gid", "vector", array_to_vector("vector").alias("_v"))
    for name, length, tables, own in (
        ("_coarse", BUCKET * deviation, max(1, levels) * rounds, 0), ("_fine", BUCKET * deviation / FINE, rounds, 1)
    ):
        lsh = BucketedRandomProjectionLSH(
            inputCol="_v", outputCol=name, bucketLength=length, numHashTables=tables, seed=seed + 2 * first + own
        )
        hashed = lsh.fit(hashed).transform(hashed)
    # One row per round: its coarse hashes in turn, then the fine one, which orders what shares them all.
    hashes = F.concat(*[
        F.array(F.struct(
            F.lit(r).alias("round"),
            F.transform(F.slice("_coarse", r * max(1, levels) + 1, levels), lambda h: vector_to_array(h)[0]).alias("bucket"),
            vector_to_array(F.col("_fine")[r])[0].alias("fine"),
        )) for r in range(rounds)
    ])
    keyed = hashed.select("gid", "vector", F.explode(hashes).alias("_h")).select("gid", "vector", "_h.*")
    ranked = with_rank(keyed, ["round", "bucket", "fine", "gid"], "_place", first=0)
    blocks = ranked.select("round", F.floor(F.col("_place") / block).alias("_block"), "gid", "vector")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        ids, points = frame["gid"].to_numpy(), matrix(frame["vector"])
        found = _nearest(ids, points, ids, points, keep)
        return pd.DataFrame(dict(zip(("gid", "other", "distance"), found, strict=True)))

    return blocks.groupBy("round", "_block").applyInPandas(compare, _PAIRS)


def _rounds_left(before: float, reached: float, recall: float, rounds: int) -> float:
    """Rounds still needed if each ``rounds`` find the share of the missing that the last ones found.

    What is easy to find is found first, so it is hardly ever less.
    """
    if reached >= recall:
        return 0.0
    if reached <= before or recall >= 1.0:
        return math.inf if reached <= before else 0.0
    return rounds * math.log((1 - recall) / (1 - reached)) / math.log((1 - reached) / (1 - before))


def knn_lsh(
    df: DataFrame, k: int, row_id: str = "row_id", vector: str = "vector", recall: float = RECALL, block: int = BLOCK,
    probes: int = PROBES, max_rounds: int = MAX_ROUNDS, seed: int = 17,
) -> Graph:
    """The graph of `knn` with at least the share ``recall`` of the true neighbours of the probes.

    Every row is indexed and gets ``k`` neighbours wherever there are so many; distances are exact. Copies are
    joined first, as in `knn`. If the rounds allowed do not reach the recall, the graph is the exact one; it is made
    as soon as the gain of the last rounds shows that they will not.
    Vectors are arrays of one length without nulls.
    """
    keep = k + 1
    groups = settle(distinct_vectors(df, keep, row_id, vector))
    count, deviation = _spread(groups)
    if not count:
        return Graph(df.sparkSession.createDataFrame([], graph_schema()), 1.0, 0, True)
    if block < 2 * keep:
        raise ValueError(f"blocks of {block} are too small for {k} neighbours")
    truth = settle(_probe_truth(groups, keep, probes).where("gid <> other").select("gid", "other"))
    # A bucket of all its levels holds about a block.
    levels = max(0, math.ceil(math.log2(count / block)))
    best, done, reached, hopeless = None, 0, 0.0, False
    while reached < recall and done < max_rounds and not hopeless:
        # A single block is compared whole, so one round is all there is to do.
        rounds = 1 if count <= block else min(ROUNDS_AT_ONCE, max_rounds - done)
        pairs = _round_pairs(groups, done, rounds, levels, deviation or 1.0, keep, block, seed)
        best = settle(_best(pairs if best is None else best.unionByName(pairs), keep))
        before, done = reached, done + rounds
        reached = _least_recall(best, truth)
        hopeless = done > rounds and _rounds_left(before, reached, recall, rounds) > max_rounds - done
    if best is None or reached < recall:
        return Graph(knn(df, k, row_id, vector), 1.0, done, True)
    return Graph(rows_of_groups(df, groups, best, k, row_id, vector), reached, done, count <= block)


def graph_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the neighbours in ``exact`` that ``found`` holds, as one row ``(neighbours, found, recall)``.

    A neighbour as near as the last of the exact ones counts, whichever id it has.
    """
    last = exact.groupBy("id").agg(F.max("distance").alias("_last"), F.count(F.lit(1)).alias("_k"))
    near = found.join(last, "id").where(F.col("distance") <= F.col("_last") * (1 + 1e-9))
    hits = near.groupBy("id").agg(F.count(F.lit(1)).alias("_found"))
    both = last.join(hits, "id", "left").agg(
        F.sum("_k").alias("neighbours"), F.sum(F.coalesce("_found", F.lit(0))).alias("found")
    )
    return both.select(
        F.coalesce("neighbours", F.lit(0)).alias("neighbours"),
        F.coalesce("found", F.lit(0)).alias("found"),
        F.when(F.col("neighbours") > 0, F.col("found") / F.col("neighbours")).otherwise(1.0).alias("recall"),
    )
