"""Exact k-nearest-neighbour graph without comparing everything with everything.

Rows are put in the order of the cells of a few pivots and cut into blocks. A row's neighbours in its own block
give an upper bound on the distance of its k-th neighbour, and the triangle inequality then rules out whole blocks.
The others are compared block by block, where they lie. The pruning never loses a neighbour.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqspark.session import settle, ship_package, width

# Neighbours asked for in the graph.
MAX_NEIGHBOURS = 30
MIN_NEIGHBOURS = 2

BLOCK = 2048

# Rows per pivot aimed at, and the most pivots: both sides of a pivot's use are bounded by the latter.
PIVOT_ROWS = 1024
MAX_PIVOTS = 1024

# Vectors of a partition of blocks: fewer are not worth a task, more are not held by one.
MIN_PART = 256
MAX_PART = 16_384

# Vectors asked for at a time inside a block, and pairs measured at a time.
_ASKED = 256
_MEASURED = 1 << 16


def neighbour_count(rows: int) -> int:
    """30, but fewer for a small table, and never below 2."""
    return max(MIN_NEIGHBOURS, min(MAX_NEIGHBOURS, rows - 1))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _distances(point: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(((others - point) ** 2).sum(axis=1))


def distinct_vectors(df: DataFrame, keep: int, row_id: str, vector: str) -> DataFrame:
    """One row per distinct vector: its lowest id and its ``keep`` lowest ids.

    However many copies a vector has, only its lowest ids can ever be among anyone's neighbours.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    lowest = (
        df.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .withColumn("_place", place)
        .where(F.col("_place") <= keep)
    )
    return lowest.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("members")).select(
        F.col("members")[0].alias("gid"), "members", "vector"
    )


def nearest(
    points: np.ndarray, ids: np.ndarray, asked: np.ndarray, limits: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Among the ``points`` within ``limits`` of the ``asked``, the ``keep`` closest and others: row of the asked one,
    id and distance. Where there is no limit yet, the points themselves give one.

    Products leave out what is certainly farther, by more than their rounding; the rest is measured by differences.
    """
    square, own = (points**2).sum(axis=1), (asked**2).sum(axis=1)
    # Squared distances less the asked vector's own square, by one product.
    about = np.c_[asked, np.ones(len(asked))] @ np.c_[-2 * points, square].T
    # An upper estimate of what products of this length may lose, and the rounding of a limit.
    slack = 1e-15 * (points.shape[1] + 8) * (own + square.max(initial=0.0))
    most = limits**2 * (1 + 1e-12) + slack - own
    free = np.flatnonzero(np.isinf(limits))
    if len(free) and len(ids) > keep:
        most[free] = np.partition(about[free], keep - 1, axis=1)[:, keep - 1] + 2 * slack[free]
    row, at = np.divmod(np.flatnonzero(about <= most[:, None]), max(1, len(ids)))
    distance = np.empty(len(row))
    for s in range(0, len(row), _MEASURED):
        e = s + _MEASURED
        distance[s:e] = np.sqrt(((points[at[s:e]] - asked[row[s:e]]) ** 2).sum(axis=1))
    return row, ids[at], distance


def closest_of(
    row: np.ndarray, ids: np.ndarray, distance: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``keep`` of every row by distance, then id."""
    order = np.lexsort((ids, distance, row))
    row, ids, distance = row[order], ids[order], distance[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    kept = place < keep
    return row[kept], ids[kept], distance[kept]


class _Asking:
    """Vectors of a block and the ``keep`` closest ones they have met so far."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, limits: np.ndarray, keep: int):
        self.ids, self.points, self.limits, self.keep = ids, points, limits, keep
        self.found = np.zeros(0, dtype=np.int64), ids[:0], np.zeros(0)

    def meet(self, ids: np.ndarray, points: np.ndarray, centre: np.ndarray, radius: float) -> None:
        # A little slack keeps rounding from ruling out a block that touches the limit.
        near = np.flatnonzero(_distances(centre, self.points) - radius <= self.limits * (1 + 1e-9) + 1e-9 * radius)
        new: list[tuple] = []
        for s in range(0, len(near), _ASKED):
            part = near[s : s + _ASKED]
            row, other, distance = nearest(points, ids, self.points[part], self.limits[part], self.keep)
            new.append(closest_of(part[row], other, distance, self.keep))
        if new:
            self.found = closest_of(*[np.concatenate(c) for c in zip(self.found, *new, strict=True)], self.keep)
            full = np.bincount(self.found[0], minlength=len(self.ids)) == self.keep
            last = np.r_[self.found[0][1:] != self.found[0][:-1], True]
            farthest = np.full(len(self.ids), np.inf)
            farthest[self.found[0][last]] = self.found[2][last]
            self.limits = np.where(full, np.minimum(self.limits, farthest), self.limits)


_BLOCKS = "block bigint, ids binary, vectors binary, limits binary, centre array<double>, radius double, reach double"


def _block_rows(block: int, keep: int):
    """Blocks of consecutive vectors: their centre, radius, and how far each one's neighbours are at most."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        ids, points = frame["gid"].to_numpy(), matrix(frame["vector"])
        centre = points.mean(axis=0)
        if len(ids) < keep:
            limits = np.full(len(ids), np.inf)
        else:
            asking = _Asking(ids, points, np.full(len(ids), np.inf), keep)
            asking.meet(ids, points, centre, np.inf)
            limits = asking.limits
        return pd.DataFrame({
            "block": [int(ids.min())], "ids": [ids.tobytes()], "vectors": [points.tobytes()], "limits": [limits.tobytes()],
            "centre": [centre.tolist()], "radius": [float(_distances(centre, points).max())], "reach": [float(limits.max())],
        })

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for frame in frames:
            held.append(frame)
            rows += len(frame)
            if rows >= block:
                whole = pd.concat(held, ignore_index=True)
                for at in range(0, rows - rows % block, block):
                    yield one(whole[at : at + block])
                held, rows = [whole[rows - rows % block :]], rows % block
        if rows:
            yield one(pd.concat(held, ignore_index=True))

    return run


def _meeting(keep: int):
    """All asking blocks of a task against what is offered to them; their closest vectors once at its end."""

    def numbers(column: pa.Array, i: int, kind: str) -> np.ndarray:
        return np.frombuffer(column[i].as_buffer(), dtype=kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking: dict[int, _Asking] = {}
        for batch in batches:
            get = batch.column
            for i in range(batch.num_rows):
                own, other = numbers(get("ids"), i, "<i8"), numbers(get("at_ids"), i, "<i8")
                name = get("block")[i].as_py()
                if name not in asking:
                    # Copies, as a batch's memory goes back with it.
                    points = numbers(get("vectors"), i, "<f8").reshape(len(own), -1).copy()
                    asking[name] = _Asking(own.copy(), points, numbers(get("limits"), i, "<f8").copy(), keep)
                centre = np.array(get("at_centre")[i].as_py())
                points = numbers(get("at_vectors"), i, "<f8").reshape(len(other), -1)
                asking[name].meet(other, points, centre, get("at_radius")[i].as_py())
        for one in asking.values():
            row, other, distance = one.found
            yield pa.RecordBatch.from_arrays([pa.array(one.ids[row]), pa.array(other), pa.array(distance)], ["gid", "other", "distance"])

    return run


def closest_vectors(located: DataFrame, keep: int, block: int, rows: int) -> DataFrame:
    """``gid, other, distance``: the ``keep`` closest vectors of every one of ``(gid, vector, cell, reach)``, itself included.

    Vectors are moved once, to be put into blocks in the order of their cells. Blocks then meet by a product of
    partitions, which reads the blocks again and shuffles nothing; all that one partition meets is read by one
    task, so only the closest vectors leave it. Pairs of blocks that cannot hold a neighbour are not made.
    """
    spark = located.sparkSession
    ship_package(spark)
    parts = max(1, min(width(spark), -(-rows // MIN_PART)), -(-rows // MAX_PART))
    ordered = located.select("cell", "reach", "gid", "vector").repartitionByRange(parts, "cell", "reach", "gid")
    blocks = settle(
        ordered.sortWithinPartitions("cell", "reach", "gid").select("gid", "vector").mapInPandas(_block_rows(block, keep), _BLOCKS)
    )
    offered = blocks.select(*[F.col(c).alias(f"at_{c}") for c in ("ids", "vectors", "centre", "radius")])
    apart = F.sqrt(F.aggregate(
        F.zip_with("centre", "at_centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x
    ))
    spread = F.col("radius") + F.col("at_radius")
    touching = apart * (1 - 1e-9) - spread * (1 + 1e-9) <= F.col("reach") * (1 + 1e-9) + 1e-12
    asking = blocks.select("block", "ids", "vectors", "limits", "centre", "radius", "reach")
    pairs = asking.hint("shuffle_replicate_nl").join(offered, touching).select(
        "block", "ids", "vectors", "limits", "at_ids", "at_vectors", "at_centre", "at_radius"
    )
    # The parts of a product stand in the order of the asking side: each task gets all parts of one or a few.
    found = pairs.coalesce(parts).mapInArrow(_meeting(keep), "gid bigint, other bigint, distance double")
    place = F.row_number().over(Window.partitionBy("gid").orderBy("distance", "other"))
    return found.withColumn("_n", place).where(F.col("_n") <= keep).drop("_n")


def knn(
    df: DataFrame, k: int, row_id: str = "row_id", vector: str = "vector", pivots: int | None = None, block: int = BLOCK
) -> DataFrame:
    """The ``k`` nearest other rows of every row by Euclidean distance, lower id first on ties:
    ``(id, rank, neighbour, distance)``."""
    keep = k + 1
    groups = settle(distinct_vectors(df, keep, row_id, vector))

    rows = groups.count()
    if pivots is None:
        pivots = max(1, min(MAX_PIVOTS, rows // PIVOT_ROWS))
    # A sample of bounded size goes to the driver, chosen by hash so that it is reproducible.
    drawn = groups.orderBy(F.xxhash64("gid"), "gid").limit(pivots).select("vector").collect()
    if not drawn:
        return df.sparkSession.createDataFrame([], graph_schema())
    centres = matrix(pd.Series([r["vector"] for r in drawn]))

    @F.pandas_udf("cell int, reach double")
    def nearest_pivot(vectors: pd.Series) -> pd.DataFrame:
        points, square = matrix(vectors), (centres**2).sum(axis=1)
        cell = np.concatenate([
            (square - 2 * (points[s : s + _ASKED] @ centres.T)).argmin(axis=1) for s in range(0, len(points), _ASKED)
        ])
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": _distances(points, centres[cell])})

    located = groups.select("gid", "vector", nearest_pivot("vector").alias("_p")).select("gid", "vector", "_p.*")
    return rows_of_groups(df, groups, settle(closest_vectors(located, keep, block, rows)), k, row_id, vector)


def rows_of_groups(
    df: DataFrame, groups: DataFrame, closest: DataFrame, k: int, row_id: str, vector: str
) -> DataFrame:
    """From the ``k + 1`` closest distinct vectors ``(gid, other, distance)`` back to rows.

    A distinct vector has at most (k + 1)^2 candidates.
    """
    expanded = closest.join(groups.select(F.col("gid").alias("other"), "members"), "other").select(
        "gid", F.explode(F.transform("members", lambda m: F.struct(F.col("distance"), m.alias("id")))).alias("_c")
    )
    lists = expanded.groupBy("gid").agg(F.slice(F.array_sort(F.collect_list("_c")), 1, k + 1).alias("_near"))
    everyone = df.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    named = everyone.join(groups.select("gid", "vector"), "vector").select("id", "gid")
    return named.join(lists, "gid").select(
        "id",
        F.posexplode(F.slice(F.filter("_near", lambda c: c["id"] != F.col("id")), 1, k)).alias("_i", "_c"),
    ).select(
        "id", (F.col("_i") + 1).alias("rank"), F.col("_c.id").alias("neighbour"), F.col("_c.distance").alias("distance")
    )


def graph_schema() -> T.StructType:
    return T.StructType.fromDDL("id bigint, rank int, neighbour bigint, distance double")
