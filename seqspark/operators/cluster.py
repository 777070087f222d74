"""Feature vectors, a linear embedding, density clustering with noise, and the fallback rules."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.functions.sequence import fold_lower, pieces
from seqspark.operators.kmers import PIECE, kmer_counts
from seqspark.operators.ordering import with_rank
from seqspark.operators.plane import BLOCK, Square, components, core_distances, linked_places, locations
from seqspark.operators.stats import NOISE, quantiles
from seqspark.session import join_groups, settle, ship_package

# Parameters of clustering.
MIN_SEQUENCES = 10
MIN_SAMPLES = 7
MIN_CLUSTER = 5
CLUSTER_SHARE = 7
MAX_GROUPS = 10
EPS_QUANTILE = 0.9


def kmer_vectors(
    df: DataFrame, k: int, dims: int = 1024, row_id: str = "row_id", seq: str = "seq", name: str = "vector"
) -> DataFrame:
    """Sparse k-mer count vectors hashed to ``dims`` columns: ``(row_id, vector)``.

    A narrow transformation: every vector is made from its own row, nothing is shuffled and no vocabulary
    has to be agreed on.
    """
    words = F.transform(
        F.filter(pieces(fold_lower(seq), PIECE, k - 1), lambda t: F.length(t) >= k),
        lambda t: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(PIECE), F.length(t) - (k - 1))), lambda i: F.substring(t, i, F.lit(k))
        ),
    )
    tokens = df.select(row_id, F.flatten(words).alias("_words"))
    return HashingTF(numFeatures=dims, inputCol="_words", outputCol=name).transform(tokens).drop("_words")


def vocabulary_vectors(
    df: DataFrame, k: int, min_rows: int = 2, row_id: str = "row_id", seq: str = "seq"
) -> DataFrame:
    """K-mer counts over the vocabulary of k-mers found in ``min_rows`` rows: ``(row_id, term, n)``.

    ``term`` numbers the vocabulary in k-mer order from 0. A vector's entries stay rows: neither the vocabulary
    nor a vector of its width is ever in one place.
    """
    counts = settle(kmer_counts(df, k, row_id, seq))
    found = counts.groupBy("kmer").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= min_rows)
    terms = with_rank(found.select("kmer"), ["kmer"], "term", first=0)
    # Sorted on both sides: a table's size before its texts were cut into k-mers says nothing about the vocabulary's,
    # and a broadcast planned by it would not fit the driver.
    return counts.join(terms.hint("merge"), "kmer").select(row_id, "term", "n")


def array_vectors(df: DataFrame, column: str, row_id: str = "row_id", name: str = "vector") -> DataFrame:
    """Vectors from an array column."""
    return df.select(row_id, array_to_vector(F.col(column).cast("array<double>")).alias(name))


def pca_embed(vectors: DataFrame, row_id: str = "row_id", vector: str = "vector") -> DataFrame:
    """Two principal components of the centred vectors: ``(row_id, x, y)``.

    The covariance is summed over partitions; the driver sees a matrix of dims x dims only. The largest
    loading of each component is made positive. Without a second direction ``y`` is 0.
    """
    model = PCA(k=2, inputCol=vector, outputCol="_p").fit(vectors)
    loadings = model.pc.toArray()
    signs = [float(np.sign(c[np.abs(c).argmax()]) or 1.0) for c in loadings.T]
    second = 1.0 if model.explainedVariance[1] > 1e-12 else 0.0
    turned = model.transform(vectors).withColumn("_a", vector_to_array("_p")).select(
        row_id,
        (F.col("_a")[0] * signs[0]).alias("_x"),
        (F.col("_a")[1] * signs[1] * second).alias("_y"),
    )
    centre = turned.agg(F.struct(F.avg("_x").alias("x"), F.avg("_y").alias("y"))).scalar()
    return turned.withColumn("_c", centre).select(
        row_id, (F.col("_x") - F.col("_c.x")).alias("x"), (F.col("_y") - F.col("_c.y")).alias("y")
    )


# Bits of a coordinate in the sums that decide on directions, and rows after which a task hands its sums on.
FIXED_BITS = 20
SUMMED_ROWS = 1 << 20


def _labels(values: np.ndarray, splits: list[tuple[int, int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The group of every row after the splits so far.

    A row's projection is summed by itself, so that it does not hang on the rows beside it.
    """
    label = np.zeros(len(values), dtype=np.int64)
    for group, new, middle, direction in splits:
        over = ((values - middle) * direction).sum(axis=1) > 0
        label[(label == group) & over] = new
    return label


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _moments(splits: list, wanted: list[int], unit: float):
    """Per group, as whole numbers: rows, sums (line -1) and cross products (a line per coordinate)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        rows = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for group, table in sums.items():
                yield pa.RecordBatch.from_pydict({
                    "group": pa.array([group] * len(table), pa.int64()), "line": pa.array(range(-1, len(table) - 1), pa.int32()),
                    "sums": pa.array(table.tolist(), pa.list_(pa.int64())),
                })

        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column("_v"))
            label = _labels(values, splits)
            for group in wanted:
                whole = np.rint(values[label == group] / unit).astype(np.int64)
                if len(whole):
                    # Ones in front give the counts and sums along with the products.
                    wide = np.concatenate([np.ones((len(whole), 1), dtype=np.int64), whole], axis=1)
                    sums[group] = sums.get(group, 0) + wide.T @ wide
            rows += batch.num_rows
            if rows >= SUMMED_ROWS:
                yield from emit()
                sums, rows = {}, 0
        yield from emit()

    return run


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one group and number, sorted, added up without end and rounded once."""
    current, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "group": pa.array([current[0]], pa.int64()), "line": pa.array([current[1]], pa.int32()),
            "sums": pa.array([[float(v) for v in total]], pa.list_(pa.float64())),
        })

    for batch in batches:
        for group, line, sums in zip(*[batch.column(c).to_pylist() for c in ("group", "line", "sums")], strict=True):
            if (group, line) != current:
                if total is not None:
                    yield row()
                current, total = (group, line), [0] * len(sums)
            total = [a + b for a, b in zip(total, sums, strict=True)]
    if total is not None:
        yield row()


def hierarchical_cluster(vectors: DataFrame, groups: int, row_id: str = "row_id", vector: str = "vector") -> DataFrame:
    """Up to ``groups`` clusters by repeated splitting: ``(row_id, cluster)``.

    The group with the largest sum of squared distances from its mean is split across the direction in which
    it extends most, at its mean, until there are enough groups or none extends. The side the direction points to
    (its largest loading is positive) gets the next number. Sums and cross products are added as whole numbers
    of ``FIXED_BITS`` bits, so the result does not hang on how the rows are dealt; they give the directions
    only, rows are projected as they are. One job per split; the driver sees matrices of dims x dims.
    """
    ship_package(vectors.sparkSession)
    rows = settle(vectors.select(row_id, vector_to_array(vector).alias("_v")))
    largest = rows.agg(F.max(F.array_max(F.transform("_v", F.abs)))).first()[0] or 1.0
    unit = 2.0 ** (math.frexp(largest)[1] - FIXED_BITS)
    splits: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    spread: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}
    wanted, count = [0], 1
    while True:
        summed = (
            rows.select("_v").mapInArrow(_moments(list(splits), wanted, unit), "group bigint, line int, sums array<bigint>")
            .repartition("group", "line").sortWithinPartitions("group", "line")
            .mapInArrow(_added, "group bigint, line int, sums array<double>")
        )
        lines: dict[int, dict[int, list[float]]] = {}
        for r in summed.collect():
            lines.setdefault(r["group"], {})[r["line"]] = r["sums"]
        for group, own in lines.items():
            table = np.array([own[i] for i in sorted(own)])
            n, total = table[0, 0], table[0, 1:]
            around = table[1:, 1:] - np.outer(total, total) / n
            spread[group] = float(np.trace(around)) * unit**2 if n > 1 else 0.0, total / n * unit, around
        open_groups = [g for g, (size, _, _) in spread.items() if size > 0]
        if count >= groups or not open_groups:
            break
        group = max(open_groups, key=lambda g: (spread[g][0], -g))
        _, middle, around = spread.pop(group)
        direction = np.linalg.eigh(around)[1][:, -1]
        direction = direction * (np.sign(direction[np.abs(direction).argmax()]) or 1.0)
        splits.append((group, count, middle, direction))
        wanted, count = [group, count], count + 1

    @F.pandas_udf("int")
    def label(values: pd.Series) -> pd.Series:
        return pd.Series(_labels(np.stack(values.to_list()), splits).astype("int32")) if len(values) else pd.Series([], dtype="int32")

    return rows.select(row_id, label("_v").alias("cluster"))


def group_count(rows: int) -> int:
    """10 groups, fewer for fewer rows."""
    return min(MAX_GROUPS, rows)


# --- connected components ----------------------------------------------------------------------


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, component)``, a component being its smallest node.

    Every round takes the smallest label among the neighbours and then the label of that label, which
    shortens long chains. Each round is checkpointed; labels only ever fall, so the loop ends.
    """
    links = settle(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settle(nodes.select("node", F.col("node").alias("component")))
    while True:
        heard = (
            links.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("_heard"))
        )
        lowered = labels.join(heard, "node", "left").select(
            "node", F.col("component").alias("_old"), F.least("component", F.coalesce("_heard", "component")).alias("_new")
        )
        # Jump: look up the present label of the new label.
        target = labels.select(F.col("node").alias("_new"), F.col("component").alias("_jump"))
        moved = settle(
            lowered.join(target, "_new").select("node", "_old", F.least("_new", "_jump").alias("component"))
        )
        labels = moved.select("node", "component")
        if moved.where(F.col("_old") != F.col("component")).isEmpty():
            return labels


# --- density clustering ------------------------------------------------------------------------


def density_cluster(
    points: DataFrame, eps: float | None = None, min_samples: int = MIN_SAMPLES, min_cluster_size: int | None = None,
    row_id: str = "row_id", x: str = "x", y: str = "y", block: int = BLOCK,
) -> DataFrame:
    """Clusters of rows joined by mutual reachability of at most ``eps``: ``(row_id, cluster)``.

    A row is core if its ``min_samples``-th neighbour is within ``eps`` (default: the 0.9 quantile of that
    distance); core rows within ``eps`` of each other are linked; components below ``min_cluster_size``
    (default a seventh of the rows, at least 5) and rows that are not core are noise, -1. Clusters are
    numbered by size, then by lowest row. Rows without finite coordinates are noise.

    Equal points are one place with a number. Places are compared block by block along a space-filling
    curve; pairs are never listed, and a dense spot is joined by its grid cells.
    """
    points = settle(points.select(F.col(row_id).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    total = points.count()
    smallest = min_cluster_size or max(MIN_CLUSTER, total // CLUSTER_SHARE)
    places = settle(locations(points, "id", "x", "y"))
    square = Square(places)
    measured = settle(core_distances(places, square, min_samples, block))
    if eps is None:
        known = measured.where(F.col("core_distance") < float("inf")).withColumn("_g", F.lit("all"))
        found = quantiles(known, "core_distance", ["_g"], [EPS_QUANTILE], weight="w").collect()
        eps = found[0]["p0"] if found else 0.0
    core = measured.where(F.col("core_distance") <= eps).select("x", "y", "w", "id")
    if eps > 0:
        placed, links = linked_places(core, square, eps, block)
        grouped = placed.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    else:
        # Only points of one place are within reach of each other.
        grouped = core.withColumn("component", F.col("id"))
    grouped = settle(grouped.select("x", "y", "w", "id", "component"))
    sizes = grouped.groupBy("component").agg(F.sum("w").alias("size"), F.min("id").alias("first"))
    ranked = with_rank(sizes.where(F.col("size") >= smallest), [F.desc("size"), "first"], "cluster", first=0)
    # Skewed sides of these joins are dealt anew by adaptive execution; small ones it broadcasts as measured.
    named = grouped.join(ranked.select("component", "cluster"), "component").select("x", "y", "cluster")
    # Zero has two signs, which are one place.
    at = points.select("id", (F.col("x") + F.lit(0.0)).alias("x"), (F.col("y") + F.lit(0.0)).alias("y"))
    return at.join(named, ["x", "y"], "left").select(
        F.col("id").alias(row_id), F.coalesce("cluster", F.lit(NOISE)).cast("int").alias("cluster")
    )


# --- fallback rules ----------------------------------------------------------------------------


def apply_fallbacks(
    df: DataFrame, k: int, by: Sequence[str], row_id: str = "row_id", seq: str = "seq", cluster: str = "cluster",
    min_sequences: int = MIN_SEQUENCES,
) -> DataFrame:
    """Put all rows of a group in cluster 0 if the group is too small, has fewer than two different
    k-mers, or is all noise."""
    # A sequence has one k-mer only if it has length k or repeats a single letter, so a group has two as
    # soon as one of its sequences has, or two first k-mers differ. No k-mer needs to be listed.
    folded = df.select(*by, cluster, fold_lower(seq).alias("_seq"))
    letter = F.substring("_seq", 1, 1)
    several = (F.length("_seq") > k) & (F.replace(F.col("_seq"), letter, F.lit("")) != "")
    first = F.when(F.length("_seq") >= k, F.substring("_seq", 1, k))
    facts = folded.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max(cluster).alias("_best"),
        F.coalesce(F.bool_or(several) | (F.min(first) != F.max(first)), F.lit(False)).alias("_several"),
    )
    fallen = (F.col("_rows") < min_sequences) | ~F.col("_several") | (F.col("_best") == NOISE)
    return (
        join_groups(df, facts, by, row_id)
        .withColumn(cluster, F.when(fallen, F.lit(0)).otherwise(F.col(cluster)))
        .drop("_rows", "_best", "_several")
    )


def cluster_coordinates(rows: DataFrame, embedding: DataFrame, labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Locus, cluster and embedding coordinates of every row."""
    return rows.join(labels, row_id).join(embedding, row_id)
