"""Neighbours on the plane: blocks of a space-filling curve, compared with the few blocks within their reach.

Points are ordered along a curve that visits the cells of ever finer grids one after another, and cut into
blocks of bounded size. Boxes around blocks are matched by an equi-join on the grid cells they touch, at the
level where a box touches two cells a side at most. Blocks that meet are compared with numpy, one pair at a
time, so neither a task's memory nor the work of a row depends on how many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqspark.session import join_groups, settle

# Locations of a block, and locations in a row that share a box of what they reach.
BLOCK = 512
RUN = 64

# Finest grid on which boxes meet, and bits of a coordinate on the curve.
LEVELS = 20
BITS = 31

# Links a single task may join into components; beyond that many they are contracted in rounds first.
MAX_LINKS = 1_000_000

BOX = ("x0", "x1", "y0", "y1")


def locations(points: DataFrame, row_id: str, x: str, y: str) -> DataFrame:
    """Distinct places ``x, y`` with their number of points ``w`` and lowest ``id``; no place without both numbers."""

    def number(c: str) -> Column:
        # One zero: adding 0 turns the negative one into the other.
        return F.col(c).cast("double") + F.lit(0.0)

    placed = points.select(F.col(row_id).alias("id"), number(x).alias("x"), number(y).alias("y"))
    finite = [~F.isnan(c) & (F.abs(F.col(c)) < float("inf")) for c in ("x", "y")]
    return placed.where(finite[0] & finite[1]).groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("id"))


class Square:
    """The square around all places, halved again and again."""

    def __init__(self, places: DataFrame):
        row = places.agg(*[f(c) for c in ("x", "y") for f in (F.min, F.max)]).first()
        self.x, high_x, self.y, high_y = (0.0 if v is None else v for v in row)
        self.side = max(high_x - self.x, high_y - self.y) or 1.0
        # More than a sum of a coordinate and a distance can be rounded by.
        self.pad = 1e-14 * max(abs(v) for v in (self.x, high_x, self.y, high_y, self.side))

    def curve(self, x: Column, y: Column) -> Column:
        """Place along the curve: the bits of both coordinates in turn."""

        def spread(v: Column, low: float) -> Column:
            share = (v - F.lit(low)) / F.lit(self.side) * F.lit(2.0**BITS)
            out = F.least(F.greatest(share, F.lit(0.0)), F.lit(2.0**BITS - 1)).cast("bigint")
            for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                                (2, 0x3333333333333333), (1, 0x5555555555555555)):
                out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
            return out

        return spread(x, self.x).bitwiseOR(F.shiftleft(spread(y, self.y), 1))

    def touched(self, boxes: DataFrame) -> DataFrame:
        """Every box with each grid cell it touches, from the whole square to the level of its own size (``own``)."""
        size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
        fits = F.floor(F.log2(F.try_divide(F.lit(self.side), size)))
        level = F.when(size <= self.side / 2**LEVELS, LEVELS).when(size >= self.side, 0).otherwise(F.least(fits, F.lit(LEVELS)))
        spread = boxes.withColumn("own", F.greatest(level, F.lit(0)).cast("int")).withColumn("level", F.explode(F.sequence(F.lit(0), "own")))

        def cells(low: str, high: str, start: float) -> Column:
            cell = F.lit(self.side) / F.pow(F.lit(2.0), F.col("level"))
            last = F.pow(F.lit(2.0), F.col("level")) - 1

            def at(c: str) -> Column:
                # Clipped before it is cut to a whole number: a box may be endless.
                return F.floor(F.least(F.greatest((F.col(c) - F.lit(start)) / cell, F.lit(0.0)), last)).cast("bigint")

            return F.explode(F.sequence(at(low), at(high)))

        return spread.withColumn("gx", cells("x0", "x1", self.x)).withColumn("gy", cells("y0", "y1", self.y))


def meeting(square: Square, reaching: DataFrame, reached: DataFrame) -> DataFrame:
    """``a, b, gap``: whose box in ``reaching`` overlaps which box in ``reached``, both ``key`` and a box; not with itself.

    ``gap`` is the distance from the middle of the one box to the other box. The smaller of two boxes is
    looked up at the level of the larger one.
    """
    at = ["level", "gx", "gy", "finds"]
    left = square.touched(reaching).withColumn("finds", (F.col("level") == F.col("own")))
    right = square.touched(reached).withColumn(
        "finds", F.explode(F.when(F.col("level") == F.col("own"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))
    )
    left = left.select(*at, F.col("key").alias("a"), *[F.col(c).alias(f"a_{c}") for c in BOX])
    right = right.select(*at, F.col("key").alias("b"), *[F.col(c).alias(f"b_{c}") for c in BOX])
    overlap = (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("a_y1"))

    def off(axis: str) -> Column:
        # Halves are added, as a sum may be endless on both sides.
        middle = F.col(f"a_{axis}0") / 2 + F.col(f"a_{axis}1") / 2
        return F.greatest(F.col(f"b_{axis}0") - middle, middle - F.col(f"b_{axis}1"), F.lit(0.0))

    met = left.join(right, at).where(overlap & (F.col("a") != F.col("b")))
    gap = F.sqrt(off("x") ** 2 + off("y") ** 2)
    return met.groupBy("a", "b").agg(F.min(F.when(~F.isnan(gap), gap).otherwise(F.lit(0.0))).alias("gap"))


# --- numpy on blocks ---------------------------------------------------------------------------


def _apart(x: np.ndarray, y: np.ndarray, other_x: np.ndarray, other_y: np.ndarray) -> np.ndarray:
    return np.sqrt((x[:, None] - other_x) ** 2 + (y[:, None] - other_y) ** 2)


def _to_box(x: np.ndarray, y: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Distance of points to a box, never too large."""
    x0, x1, y0, y1 = box
    wide = np.maximum(np.maximum(x0 - x, x - x1), 0.0)
    high = np.maximum(np.maximum(y0 - y, y - y1), 0.0)
    return np.sqrt(wide**2 + high**2) * (1 - 1e-12)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _runs(batches: Iterable[pa.RecordBatch], names: list[str], size: int) -> Iterator[list[np.ndarray]]:
    """Sorted rows in runs of ``size``; the last ones hold more than half of it, unless there are no more rows."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([_numbers(batch, n) for n in names])
        rows += batch.num_rows
        if rows >= 2 * size:
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            full = (rows - size) // size * size
            for start in range(0, full, size):
                yield [c[start : start + size] for c in whole]
            held, rows = [[c[full:] for c in whole]], rows - full
    if rows:
        whole = [np.concatenate(c) for c in zip(*held, strict=True)]
        parts = -(-rows // size)
        yield from zip(*[np.array_split(c, parts) for c in whole], strict=True)


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([v.tolist() if isinstance(v, np.ndarray) else v]) for n, v in values.items()})


def _block_id(number: int) -> int:
    context = TaskContext.get()
    return ((context.partitionId() if context else 0) << 32) + number


# --- distance of the k-th neighbour ------------------------------------------------------------


def _repeated(w: np.ndarray, k: int) -> np.ndarray:
    """Which location each of up to ``k + 1`` copies is at: more never count."""
    return np.repeat(np.arange(len(w)), np.minimum(w, k + 1))


def _nearest(distances: np.ndarray, k: int) -> np.ndarray:
    """The ``k + 1`` least distances of each row, a missing one being infinite."""
    lacking = k + 1 - distances.shape[1]
    if lacking > 0:
        distances = np.pad(distances, ((0, 0), (0, lacking)), constant_values=np.inf)
    return np.partition(distances, k, axis=1)[:, : k + 1]


def _first_blocks(k: int, size: int, pad: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (x, y, w, ids) in enumerate(_runs(batches, ["x", "y", "w", "id"], size)):
            copies = _repeated(w, k)
            reach = _nearest(_apart(x, y, x[copies], y[copies]), k).max(axis=1) + pad
            starts = range(0, len(x), RUN)
            spans = [slice(s, s + RUN) for s in starts]
            reaches = [
                {"x0": (x[s] - reach[s]).min(), "x1": (x[s] + reach[s]).max(), "y0": (y[s] - reach[s]).min(), "y1": (y[s] + reach[s]).max()}
                for s in spans
            ]
            yield _row(key=_block_id(number), xs=x, ys=y, ws=w, ids=ids, x0=x.min(), x1=x.max(), y0=y.min(), y1=y.max(),
                       reaches=[{n: float(v) for n, v in r.items()} for r in reaches])

    return run


_PLACES = "xs array<double>, ys array<double>, ws array<bigint>, ids array<bigint>"
_BOX = "x0 double, x1 double, y0 double, y1 double"


def _refine(k: int):
    """Rows of a block's own places, then of the blocks it may reach, the nearest first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best = None, None

        def result() -> pa.RecordBatch:
            x, y, w, ids = own
            return pa.RecordBatch.from_pydict({"x": x, "y": y, "w": w, "id": ids, "core_distance": best.max(axis=1)})

        for batch in batches:
            for i in range(batch.num_rows):
                x, y, w, ids = (np.asarray(batch.column(c)[i].values) for c in ("xs", "ys", "ws", "ids"))
                if batch.column("gap")[i].as_py() < 0:
                    if own is not None:
                        yield result()
                    own = x, y, w, ids
                    copies = _repeated(w, k)
                    best = _nearest(_apart(x, y, x[copies], y[copies]), k)
                    continue
                box = tuple(batch.column(c)[i].as_py() for c in BOX)
                asking = np.flatnonzero(_to_box(own[0], own[1], box) < best.max(axis=1))
                if len(asking):
                    copies = _repeated(w, k)
                    found = _apart(own[0][asking], own[1][asking], x[copies], y[copies])
                    best[asking] = _nearest(np.concatenate([best[asking], found], axis=1), k)
        if own is not None:
            yield result()

    return run


def _gap(one: str, two: str) -> Column:
    """Distance between two boxes."""

    def axis(low: str, high: str) -> Column:
        return F.greatest(F.col(f"{two}{low}") - F.col(f"{one}{high}"), F.col(f"{one}{low}") - F.col(f"{two}{high}"), F.lit(0.0))

    return F.sqrt(axis("x0", "x1") ** 2 + axis("y0", "y1") ** 2)


def _across(one: str, two: str) -> Column:
    """Largest distance between a point of one box and a point of the other."""

    def axis(low: str, high: str) -> Column:
        return F.greatest(F.col(f"{two}{high}") - F.col(f"{one}{low}"), F.col(f"{one}{high}") - F.col(f"{two}{low}"))

    return F.sqrt(axis("x0", "x1") ** 2 + axis("y0", "y1") ** 2)


def _side_by_side(blocks: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Each block of ``a`` (gap -1), followed by the blocks ``b`` it is to be compared with, by their distance."""
    partners = pairs.withColumnRenamed("b", "key").join(blocks, "key").select("a", "gap", "key", *columns)
    own = blocks.select(F.col("key").alias("a"), F.lit(-1.0).alias("gap"), "key", *columns)
    return own.unionByName(partners).repartition("a").sortWithinPartitions("a", "gap", "key")


def core_distances(places: DataFrame, square: Square, k: int, block: int = BLOCK) -> DataFrame:
    """``x, y, w, id, core_distance``: the distance of every place's points to their ``k``-th other point.

    Infinite where there are too few. A block's own points bound it from above; only blocks within that reach
    are compared, from near to far, and the bound falls on the way.
    """
    ordered = places.select("x", "y", "w", "id", square.curve(F.col("x"), F.col("y")).alias("z"))
    ordered = ordered.repartitionByRange("z", "x", "y").sortWithinPartitions("z", "x", "y")
    blocks = settle(ordered.mapInArrow(_first_blocks(k, block, square.pad), f"key bigint, {_PLACES}, {_BOX}, reaches array<struct<{_BOX}>>"))
    reaching = blocks.select("key", F.explode("reaches").alias("r")).select("key", *[F.col(f"r.{c}").alias(c) for c in BOX])
    pairs = meeting(square, reaching, blocks.select("key", *BOX))
    rows = _side_by_side(blocks, pairs, ["xs", "ys", "ws", "ids", *BOX])
    return rows.mapInArrow(_refine(k), "x double, y double, w bigint, id bigint, core_distance double")


# --- places within a distance ------------------------------------------------------------------


def _parts(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Number of the component of each of a few points, links being distances up to ``eps``."""
    near = _apart(x, y, x, y) <= eps
    part = np.full(len(x), -1)
    for start in range(len(x)):
        if part[start] >= 0:
            continue
        front = np.array([start])
        part[start] = start
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (part < 0))
            part[front] = start
    return part


def _linked_blocks(eps: float, size: int):
    """Blocks of whole cells, or of parts of one cell that holds more than a block (``dense``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0

        def emit(columns: list[np.ndarray], dense: bool) -> pa.RecordBatch:
            nonlocal number
            cx, cy, x, y, w, ids = columns
            if dense:
                nodes = np.full(len(ids), ids.min())
            else:
                part = _parts(x, y, eps)
                order = np.lexsort((ids, part))
                first = np.r_[True, np.diff(part[order]) != 0]
                lowest = dict(zip(part[order][first].tolist(), ids[order][first].tolist(), strict=True))
                nodes = np.array([lowest[p] for p in part.tolist()], dtype=np.int64)
            number += 1
            return _row(key=_block_id(number), dense=dense, cx=float(cx[0]), cy=float(cy[0]), xs=x, ys=y, ws=w, ids=ids, nodes=nodes,
                        x0=x.min(), x1=x.max(), y0=y.min(), y1=y.max())

        held: list[list[np.ndarray]] = []  # whole cells that share a block
        rows = 0
        cell: list[list[np.ndarray]] = []  # what has come of the last cell
        in_cell, many = 0, False

        def close() -> Iterator[pa.RecordBatch]:
            """The last cell is complete."""
            nonlocal held, rows, cell, in_cell, many
            if many:
                if in_cell:
                    yield emit([np.concatenate(c) for c in zip(*cell, strict=True)], True)
            else:
                if rows and rows + in_cell > size:
                    yield emit([np.concatenate(c) for c in zip(*held, strict=True)], False)
                    held, rows = [], 0
                held += cell
                rows += in_cell
            cell, in_cell, many = [], 0, False

        last = None
        for batch in batches:
            columns = [_numbers(batch, n) for n in ("cx", "cy", "x", "y", "w", "id")]
            cx, cy = columns[:2]
            cuts = np.r_[0, np.flatnonzero((cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])) + 1, len(cx)].tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                if last != (cx[a], cy[a]):
                    if last is not None:
                        yield from close()
                    last = (cx[a], cy[a])
                cell.append([c[a:b] for c in columns])
                in_cell += b - a
                if in_cell > size:
                    many = True
                    whole = [np.concatenate(c) for c in zip(*cell, strict=True)]
                    full = in_cell // size * size
                    for start in range(0, full, size):
                        yield emit([c[start : start + size] for c in whole], True)
                    cell, in_cell = [[c[full:] for c in whole]], in_cell - full
        if last is not None:
            yield from close()
        if rows:
            yield emit([np.concatenate(c) for c in zip(*held, strict=True)], False)

    return run


def _links(eps: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = y = nodes = None
        for batch in batches:
            for i in range(batch.num_rows):
                other_x, other_y, other = (np.asarray(batch.column(c)[i].values) for c in ("xs", "ys", "nodes"))
                if batch.column("gap")[i].as_py() < 0:
                    x, y, nodes = other_x, other_y, other
                    continue
                box = other_x.min(), other_x.max(), other_y.min(), other_y.max()
                close = np.flatnonzero(_to_box(x, y, box) <= eps)
                one, two = np.nonzero(_apart(x[close], y[close], other_x, other_y) <= eps)
                found = np.unique(np.stack([nodes[close][one], other[two]], axis=1), axis=0)
                found = found[found[:, 0] != found[:, 1]]
                if len(found):
                    yield pa.RecordBatch.from_pydict({"a": found[:, 0], "b": found[:, 1]})

    return run


def linked_places(places: DataFrame, square: Square, eps: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``x, y, w, id, node`` of every place, and links ``a, b`` between nodes.

    Places of a node are joined by steps of at most ``eps``, and nodes are linked where places of theirs are
    that close. All places of a grid cell of diagonal ``eps`` belong together, so a cell of any number of
    places is one node and its blocks are not compared with each other.
    """
    side = eps / 2**0.5 * (1 - 1e-9)
    cx, cy = F.floor(F.col("x") / side).cast("double"), F.floor(F.col("y") / side).cast("double")
    order = ["z", "cx", "cy", "inner", "x", "y"]
    coded = places.select("x", "y", "w", "id", cx.alias("cx"), cy.alias("cy"), square.curve(F.col("x"), F.col("y")).alias("inner"))
    coded = coded.withColumn("z", square.curve((F.col("cx") + 0.5) * side, (F.col("cy") + 0.5) * side))
    built = coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _linked_blocks(eps, block), f"key bigint, dense boolean, cx double, cy double, {_PLACES}, nodes array<bigint>, {_BOX}"
    )
    blocks = settle(built)

    narrow = blocks.select("key", "dense", "cx", "cy", F.col("nodes")[0].alias("node"), *BOX)
    if narrow.where("dense").isEmpty():
        pairs, links = _units_in_reach(square, narrow.select("key", *BOX), eps), None
    else:
        pairs, links = _dense_pairs(square, narrow, eps)
    found = _side_by_side(blocks, pairs, ["xs", "ys", "nodes"]).mapInArrow(_links(eps), "a bigint, b bigint")
    places = blocks.select(F.explode(F.arrays_zip("xs", "ys", "ws", "ids", "nodes")).alias("p")).select(
        F.col("p.xs").alias("x"), F.col("p.ys").alias("y"), F.col("p.ws").alias("w"), F.col("p.ids").alias("id"), F.col("p.nodes").alias("node")
    )
    return places, found if links is None else found.unionByName(links)


def _units_in_reach(square: Square, units: DataFrame, eps: float) -> DataFrame:
    reach = eps + square.pad
    wider = units.select("key", *[(F.col(c) - reach if c.endswith("0") else F.col(c) + reach).alias(c) for c in BOX])
    return meeting(square, wider, units).where("a < b")


def _dense_pairs(square: Square, blocks: DataFrame, eps: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of blocks that must be compared, and links that hold without comparing, where there are dense cells.

    A unit is a block of whole cells, or all blocks of a dense cell.
    """
    cells = blocks.where("dense").groupBy("cx", "cy").agg(
        F.min("key").alias("unit"), F.min("node").alias("top"), *[(F.min if c.endswith("0") else F.max)(c).alias(f"u_{c}") for c in BOX]
    )
    dense = settle(blocks.where("dense").join(cells, ["cx", "cy"]))
    whole = blocks.where("not dense")
    units = whole.select("key", *BOX).unionByName(
        dense.groupBy(F.col("unit").alias("key")).agg(*[F.first(f"u_{c}").alias(c) for c in BOX])
    )
    met = settle(_units_in_reach(square, units, eps))
    inside = dense.where("node <> top").select(F.col("node").alias("a"), F.col("top").alias("b"))

    kinds = dense.select("unit", F.col("key").alias("block"), "node", *BOX)
    members = kinds.unionByName(
        whole.select(F.col("key").alias("unit"), F.col("key").alias("block"), F.lit(None).cast("bigint").alias("node"), *BOX)
    )
    of_cells = kinds.select("unit").distinct()
    has_dense = met.join(of_cells.withColumnRenamed("unit", "a"), "a", "left_semi").unionByName(
        met.join(of_cells.withColumnRenamed("unit", "b"), "b", "left_semi")
    ).select("a", "b").distinct()
    plain = met.join(has_dense, ["a", "b"], "left_anti")

    # Two dense cells: the block nearest to all of the other cell, and the other's block nearest to that one,
    # nearly always lie within reach as a whole. Only for the rest are blocks listed against blocks.
    def side_of(unit: str, name: str) -> DataFrame:
        return members.select(F.col("unit").alias(unit), *[F.col(c).alias(f"{name}{c}") for c in ("block", "node", *BOX)])

    boxed = has_dense.join(units.select(F.col("key").alias("b"), *[F.col(c).alias(f"v_{c}") for c in BOX]), "b")
    first = boxed.join(side_of("a", "a_"), "a").groupBy("a", "b").agg(
        F.min_by(F.struct("a_node", *[f"a_{c}" for c in BOX]), _across("a_", "v_")).alias("n")
    ).select("a", "b", "n.*")
    second = first.join(side_of("b", "b_"), "b").groupBy("a", "b").agg(
        F.min_by(F.struct("a_node", "b_node", _across("a_", "b_").alias("far")), _across("a_", "b_")).alias("n")
    ).select("a", "b", "n.*")
    sure = second.where((F.col("far") <= eps * (1 - 1e-12)) & F.col("a_node").isNotNull() & F.col("b_node").isNotNull())
    sure = settle(sure.select("a", "b", "a_node", "b_node"))
    rest = has_dense.join(sure, ["a", "b"], "left_anti").join(side_of("a", "a_"), "a").join(side_of("b", "b_"), "b")
    rest = rest.withColumn("gap", _gap("a_", "b_")).where(F.col("gap") <= eps)
    rest = rest.select(F.col("a_block").alias("a"), F.col("b_block").alias("b"), "gap")
    links = inside.unionByName(sure.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))
    return plain.unionByName(rest), links


# --- components --------------------------------------------------------------------------------


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of the links with the lowest node of its component."""
    parent: dict[int, int] = {}

    def top(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for batch in batches:
        for a, b in zip(_numbers(batch, "a").tolist(), _numbers(batch, "b").tolist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        yield pa.RecordBatch.from_pydict({"node": list(parent), "component": [top(v) for v in list(parent)]})


def components(links: DataFrame, max_links: int = MAX_LINKS) -> DataFrame:
    """``node, component`` (its lowest node) of every node that has a link ``a, b``.

    Up to ``max_links`` different links are joined by one task. More are contracted first: each node points
    its larger neighbours, then its smaller ones, to the lowest of all, until every component is a star.
    Per-node minima combine before they move, and a node of many links is salted.
    """
    # A link goes from the larger node to the smaller one.
    links = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while links.count() > max_links:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = join_groups(both, lowest, ["a"], "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = settle(larger.where("a <> b").distinct())
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = join_groups(larger, lowest, ["a"], "b")
        hung = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
            lowest.select("a", F.col("m").alias("b"))
        )
        after = settle(hung.distinct())
        same = after.join(links, ["a", "b"], "left_anti").isEmpty() and links.join(after, ["a", "b"], "left_anti").isEmpty()
        links = after
        if same:
            roots = links.select(F.col("b").alias("node")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
    return links.coalesce(1).mapInArrow(_joined, "node bigint, component bigint")
