import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seqspark.operators import cluster, plane
from seqspark.operators import knn_lsh as hashing
from seqspark.operators.knn import closest_vectors, knn, neighbour_count
from seqspark.operators.knn_lsh import graph_recall, knn_lsh


def _naive_knn(points, k):
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    out = {}
    for i in range(len(points)):
        order = [j for j in np.lexsort((np.arange(len(points)), d[i])) if j != i][:k]
        out[i] = [(j, d[i, j]) for j in order]
    return out


def _points(n, copies, seed, dims=2):
    """Two blobs, background, and a third of all rows being one and the same point."""
    rng = np.random.default_rng(seed)
    p = np.vstack([rng.normal(0, 1, (n // 2, dims)), rng.normal(8, 0.7, (n - n // 2, dims))])
    p[rng.permutation(n)[:copies]] = 3.25
    return np.round(p, 2)


@pytest.mark.parametrize("n,copies,dims,pivots,block", [(150, 50, 2, 5, 16), (80, 0, 6, 7, 2048), (40, 40, 3, 4, 8), (3, 0, 2, None, 8)])
def test_knn_equals_naive(spark, n, copies, dims, pivots, block):
    points = _points(n, copies, 1, dims)
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(n), "vector": [list(map(float, p)) for p in points]}))
    got = {}
    for r in knn(df, 4, pivots=pivots, block=block).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbour"], r["distance"]))
    want = _naive_knn(points, 4)
    for i in range(n):
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert [x for _, x in got[i]] == pytest.approx([x for _, x in want[i]])


def test_knn_moves_each_vector_once(spark):
    points = _points(900, 0, 5, 24)
    rows = [(i, list(map(float, p)), 0, 0.0) for i, p in enumerate(points)]
    located = spark.createDataFrame(rows, "gid bigint, vector array<double>, cell int, reach double")
    found = closest_vectors(located, 6, 64, 900)
    # Blocks meet in a product, which shuffles nothing; only the closest vectors are moved.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = found.orderBy("gid", "distance", "other").toPandas()
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    want = [j for i in range(900) for j in np.lexsort((np.arange(900), d[i]))[:6]]
    assert got["other"].tolist() == want


def test_knn_far_from_the_origin(spark):
    """Products of such coordinates hold no digit of the differences between them."""
    points = _points(300, 20, 6, 5) + 1e8
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(300), "vector": [list(map(float, p)) for p in points]}))
    got = knn(df, 4, block=32).orderBy("id", "rank").toPandas()
    naive = _naive_knn(points, 4)
    assert got["neighbour"].tolist() == [j for i in range(300) for j, _ in naive[i]]


def test_knn_lsh_gives_up_when_rounds_will_not_do(spark):
    points = np.random.default_rng(8).normal(0, 1, (1500, 48))
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(1500), "vector": [list(map(float, p)) for p in points]}))
    graph = knn_lsh(df, 6, block=16, max_rounds=64)
    assert graph.exact and graph.rounds < 32
    assert hashing._rounds_left(0.5, 0.75, 0.9, 4) == pytest.approx(4 * np.log(0.4) / np.log(0.5))


def test_knn_of_nothing(spark):
    assert knn(spark.createDataFrame([], "row_id bigint, vector array<double>"), 3).count() == 0
    assert (neighbour_count(2), neighbour_count(12), neighbour_count(500)) == (2, 11, 30)


@pytest.mark.parametrize("n,copies,dims", [(600, 200, 8), (500, 0, 24)])
def test_knn_lsh_reaches_its_recall(spark, n, copies, dims):
    points = _points(n, copies, 3, dims)
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(n), "vector": [list(map(float, p)) for p in points]}))
    graph = knn_lsh(df, 6, block=64, probes=10_000)
    assert graph.rounds > 1 and not graph.exact and graph.recall >= 0.9
    got = graph.edges.toPandas()
    # Every row has all its neighbours, ranked by exact distances, itself left out.
    assert got.groupby("id").size().tolist() == [6] * n
    assert (got["id"] != got["neighbour"]).all() and not got.duplicated(["id", "neighbour"]).any()
    want = np.sqrt(((points[got["id"]] - points[got["neighbour"]]) ** 2).sum(axis=1))
    assert got["distance"].to_numpy() == pytest.approx(want)
    ranked = got.sort_values(["id", "rank"])
    assert (ranked.groupby("id")["distance"].diff().fillna(0) >= 0).all()
    naive = _naive_knn(points, 6)
    near = [x <= naive[i][-1][1] + 1e-9 for i, x in zip(got["id"], got["distance"], strict=True)]
    assert np.mean(near) >= 0.9
    measured = graph_recall(graph.edges, knn(df, 6)).first()
    assert measured["neighbours"] == 6 * n and measured["recall"] == pytest.approx(np.mean(near))


def test_knn_lsh_falls_back_to_the_exact_graph(spark):
    points = _points(300, 0, 4, 16)
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(300), "vector": [list(map(float, p)) for p in points]}))
    graph = knn_lsh(df, 4, block=16, max_rounds=1, recall=1.0)
    assert graph.exact and graph.recall == 1.0
    got = graph.edges.orderBy("id", "rank").toPandas()
    naive = _naive_knn(points, 4)
    assert got["neighbour"].tolist() == [j for i in range(300) for j, _ in naive[i]]


@pytest.mark.parametrize("n", [0, 1, 2, 30])
def test_knn_lsh_of_small_tables(spark, n):
    rows = [(i, [float(i % 7), 1.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id bigint, vector array<double>")
    got = sorted(map(tuple, knn_lsh(df, 3).edges.collect()))
    assert got == sorted(map(tuple, knn(df, 3).collect()))


def _naive_density(points, eps, samples, smallest):
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    core = np.array([np.sort(np.delete(d[i], i))[samples - 1] <= eps for i in range(len(points))])
    label, found = np.full(len(points), -1), []
    for i in range(len(points)):
        if core[i] and label[i] == -1:
            stack, members = [i], []
            label[i] = len(found)
            while stack:
                j = stack.pop()
                members.append(j)
                for m in np.flatnonzero((d[j] <= eps) & core & (label == -1)):
                    label[m] = label[i]
                    stack.append(m)
            found.append(members)
    kept = sorted([m for m in found if len(m) >= smallest], key=lambda m: (-len(m), min(m)))
    out = np.full(len(points), -1)
    for c, members in enumerate(kept):
        out[members] = c
    return out


@pytest.mark.parametrize("eps,copies,block", [(0.45, 0, 4), (0.9, 60, 2048), (0.25, 20, 3), (0.0, 60, 8)])
def test_density_equals_naive(spark, eps, copies, block):
    points = _points(180, copies, 3)
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(180), "x": points[:, 0], "y": points[:, 1]}))
    got = cluster.density_cluster(df, eps, 4, 5, block=block).orderBy("row_id").toPandas()["cluster"].to_numpy()
    assert got.tolist() == _naive_density(points, eps, 4, 5).tolist()


def test_density_links_cells_that_no_neighbour_list_links(spark):
    """Two tight heaps just within reach of each other: all neighbour lists stay inside the heaps."""
    rng = np.random.default_rng(0)
    heaps = np.vstack([rng.normal(0, 0.01, (40, 2)), rng.normal(0, 0.01, (40, 2)) + [0.95, 0]])
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(80), "x": heaps[:, 0], "y": heaps[:, 1]}))
    near = cluster.density_cluster(df, 1.0, 5, 5, block=7).groupBy("cluster").count().collect()
    assert {r["cluster"]: r["count"] for r in near} == {0: 80}
    far = cluster.density_cluster(df, 0.8, 5, 5).groupBy("cluster").count().collect()
    assert {r["cluster"]: r["count"] for r in far} == {0: 40, 1: 40}


def test_density_equals_naive_in_small_and_large_blocks(spark):
    """Dense spots of more than a block in one cell, next to each other and apart, and points in between."""
    rng = np.random.default_rng(7)
    heaps = [rng.normal(0, 0.05, (120, 2)) + c for c in ([0, 0], [0.9, 0], [1.35, 0.2], [5, 5], [5.8, 5.8], [-3, 2])]
    points = np.vstack([*heaps, rng.uniform(-5, 7, (150, 2)), [[0.5, 0.0]] * 30, [[-0.0, 0.0]] * 3])
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(len(points)), "x": points[:, 0], "y": points[:, 1]}))
    for eps, block in ((0.5, 16), (0.25, 8), (0.5, 512), (2.0, 16)):
        got = cluster.density_cluster(df, eps, 6, 5, block=block).orderBy("row_id").toPandas()["cluster"].to_numpy()
        assert got.tolist() == _naive_density(points, eps, 6, 5).tolist(), (eps, block)
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    eps = np.quantile(np.sort(d, axis=1)[:, 7], 0.9)
    got = cluster.density_cluster(df, block=32).orderBy("row_id").toPandas()["cluster"].to_numpy()
    assert got.tolist() == _naive_density(points, eps, 7, len(points) // 7).tolist()


def test_density_of_odd_points(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, 1.0, 2.0) for i in range(8)] + [(8, None, 1.0), (9, nan, 1.0), (10, 1.0, inf), (11, 50.0, 50.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "row_id bigint, x double, y double")
    got = {r["row_id"]: r["cluster"] for r in cluster.density_cluster(df, 0.5, 3).collect()}
    assert got == {**{i: 0 for i in range(8)}, None: 0, 8: -1, 9: -1, 10: -1, 11: -1}
    assert {r["cluster"] for r in cluster.density_cluster(df, min_samples=30).collect()} == {-1}
    assert cluster.density_cluster(df.limit(0)).count() == 0


@pytest.mark.parametrize("max_links", [1_000, 3])
def test_components_of_links(spark, max_links):
    rng = np.random.default_rng(4)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [tuple(map(int, p)) for p in rng.integers(200, 260, (40, 2))]
    parent = {}

    def top(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in pairs:
        if a != b:
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    links = spark.createDataFrame([(b, a) for a, b in pairs], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in plane.components(links, max_links).collect()}
    assert got == {v: top(v) for v in parent}


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (100, 102)]
    nodes = spark.createDataFrame([(i,) for i in [*range(31), 100, 101, 102, 500]], "node bigint")
    edges = spark.createDataFrame([(b, a) for a, b in chain], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in cluster.connected_components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, 500: 500}


def test_pca_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 10
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(60), "v": [list(map(float, r)) for r in x]}))
    got = cluster.pca_embed(cluster.array_vectors(df, "v")).orderBy("row_id").toPandas()[["x", "y"]].to_numpy()
    centred = x - x.mean(0)
    _, _, vt = np.linalg.svd(centred)
    np.testing.assert_allclose(np.abs(got), np.abs(centred @ vt[:2].T), atol=1e-8)
    flat = df.withColumn("v", F.array(*[F.col("row_id") * float(c) for c in (1, 2, 3)]))
    assert cluster.pca_embed(cluster.array_vectors(flat, "v")).agg(F.max(F.abs("y"))).first()[0] == 0.0


def _naive_splits(points, groups):
    label = np.zeros(len(points), dtype=int)
    for new in range(1, groups):
        size = [((points[label == g] - points[label == g].mean(0)) ** 2).sum() for g in range(new)]
        if max(size) <= 1e-9:
            break
        g = int(np.argmax(size))
        own = points[label == g] - points[label == g].mean(0)
        direction = np.linalg.svd(own)[2][0]
        direction *= np.sign(direction[np.abs(direction).argmax()])
        label[np.flatnonzero(label == g)[own @ direction > 0]] = new
    return label


def test_splitting_equals_numpy(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(0, s, (40, 6)) + rng.normal(0, 9, 6) for s in (0.3, 1, 2, 0.5, 1.5)])
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(200), "v": [list(map(float, p)) for p in points]}))
    for parts in (1, 64):
        vectors = cluster.array_vectors(df.repartition(parts, "row_id"), "v")
        got = cluster.hierarchical_cluster(vectors, 7).orderBy("row_id").toPandas()["cluster"].to_numpy()
        assert got.tolist() == _naive_splits(points, 7).tolist()
    alike = cluster.array_vectors(df.withColumn("v", F.array(F.lit(1.0), F.lit(2.0))), "v")
    assert {r["cluster"] for r in cluster.hierarchical_cluster(alike, 5).collect()} == {0}
    assert cluster.hierarchical_cluster(alike.limit(0), 5).count() == 0


def test_families_separate(spark, data):
    df = spark.read.csv(f"{data}/annotations.csv", header=True, inferSchema=True).select(
        (F.regexp_extract("TE_name", r"(\d+)$", 1).cast("bigint") - 1).alias("row_id"), F.col("Seq").alias("seq")
    )
    vectors = cluster.kmer_vectors(df, 6, 512)
    assert vectors.select(F.aggregate(vector_to_array("vector"), F.lit(0.0), lambda a, b: a + b)).first()[0] in (495.0, 475.0)
    plane = cluster.pca_embed(vectors)
    side = {r["row_id"]: r["x"] > 0 for r in plane.collect()}
    assert len({side[i] for i in range(8)}) == 1 and len({side[i] for i in range(8, 15)}) == 1 and side[0] != side[8]
    labels = {r["row_id"]: r["cluster"] for r in cluster.density_cluster(plane, min_samples=2, min_cluster_size=5).collect()}
    first, second = ({labels[i] for i in rows} - {-1} for rows in (range(8), range(8, 15)))
    assert len(first) == len(second) == 1 and first != second
    groups = {r["row_id"]: r["cluster"] for r in cluster.hierarchical_cluster(vectors, 2).collect()}
    assert len({groups[i] for i in range(8)}) == 1 and {groups[i] for i in range(8, 15)} == {1 - groups[0]}
    assert (cluster.group_count(4), cluster.group_count(99)) == (4, 10)
    table = cluster.cluster_coordinates(df.select("row_id"), plane, cluster.density_cluster(plane, 1.0))
    assert table.columns == ["row_id", "cluster", "x", "y"] and table.count() == 15


def test_fallback_rules(spark):
    rows = [("few", i, "ACGTACGT" + "A" * i, 3) for i in range(9)]
    rows += [("noise", i, "ACGTACGT" + "A" * i, -1) for i in range(12)]
    rows += [("same", i, "AAAAAAA" if i % 2 else "AAAA", 2) for i in range(12)]
    rows += [("one", i, "acgt" if i % 2 else "ACGT", 2) for i in range(12)]
    rows += [("short", i, "AC", 2) for i in range(12)]
    rows += [("fine", i, "ACGT" if i else "ACGA", i % 3 - 1) for i in range(12)]
    rows += [("long", i, "ACGTA" if i == 5 else "ACGT", i % 3 - 1) for i in range(12)]
    df = spark.createDataFrame(rows, "g string, row_id bigint, seq string, cluster int")
    got = {(r["g"], r["row_id"]): r["cluster"] for r in cluster.apply_fallbacks(df, 4, ["g"]).collect()}
    for g, i, _, label in rows:
        assert got[(g, i)] == (label if g in ("fine", "long") else 0), g
