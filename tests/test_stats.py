import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqspark.functions.sequence import cluster_label, coord_label
from seqspark.operators import filters, stats
from seqspark.operators.exact import Limbs
from seqspark.operators.filters import sample_conditions


def _frame(n=6000):
    """One group holds most rows, and a third of its values are equal."""
    rng = np.random.default_rng(4)
    group = np.where(rng.random(n) < 0.7, 0, rng.integers(-1, 4, n))
    value = np.where(rng.random(n) < 0.33, 5.0, np.exp(rng.normal(0, 3, n)))
    return pd.DataFrame({"cluster": group, "v": value})


def test_quantiles_are_exact_under_skew(spark):
    pdf = _frame()
    got = stats.quantiles(spark.createDataFrame(pdf), "v", ["cluster"], [0.0, 0.1, 0.5, 0.97, 1.0]).toPandas()
    want = pdf.groupby("cluster")["v"].quantile([0.0, 0.1, 0.5, 0.97, 1.0]).unstack()
    got = got.set_index("cluster").sort_index()
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=1e-12)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_describe_equals_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = stats.describe(df, ["v"]).first()
    s = pd.Series(values, dtype="float64")
    assert r["n"] == s.count()
    for name, want in [("mean", s.mean()), ("sd", s.std()), ("min", s.min()), ("max", s.max()),
                       ("q1", s.quantile(.25)), ("median", s.quantile(.5)), ("q3", s.quantile(.75))]:
        if np.isnan(want):
            assert r[name] is None
        else:
            assert r[name] == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_null_group_and_missing_values(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (None, 3.0), (1, float("nan")), (1, None), (1, 4.0)], "cluster int, A1_x_r1 double"
    )
    got = {r["cluster"]: r for r in stats.describe(df, ["A1_x_r1"], ["cluster"]).collect()}
    assert (got[None]["n"], got[None]["median"]) == (2, 2.0)
    assert (got[1]["n"], got[1]["median"], got[1]["sd"], got[1]["nonzero"]) == (1, 4.0, None, 1)
    totals = filters.with_total_expr(df, ["A1_x_r1"]).select("total_expr").collect()
    assert [r[0] for r in totals] == [1.0, 3.0, 0.0, 0.0, 4.0]
    assert filters.with_total_expr(df, []).first()["total_expr"] == 0.0


def test_conditions(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 2.0, 4.0, 7.0), (1, 3.0, None, 5.0, 1.0)],
        "cluster int, A1_b_r1 double, A2_b_r2 double, B1_a_r1 double, plain double",
    )
    samples = ["A1_b_r1", "A2_b_r2", "B1_a_r1", "plain"]
    assert sample_conditions(samples) == {"a": ["B1_a_r1"], "b": ["A1_b_r1", "A2_b_r2"]}
    got = {r["condition"]: (r["replicates"], r["mean"], r["median"]) for r in stats.condition_stats(df, samples).collect()}
    assert got == {"a": (1, 4.5, 4.5), "b": (2, 3.0, 3.0)}
    assert stats.condition_stats(df, ["A1_b_r1", "A2_b_r2"]).count() == 0
    means = {(r["cluster"], r["condition"]): r["mean"] for r in stats.condition_by_cluster(df, samples).collect()}
    assert means[(1, "b")] == 3.0


def test_cluster_tables(spark):
    pdf = _frame(500)
    df = spark.createDataFrame(pdf)
    sizes = pdf.groupby("cluster").size().to_dict()
    got = {r["cluster"]: r for r in stats.cluster_comparison(df).collect()}
    assert {c: r["size"] for c, r in got.items()} == sizes
    assert got[0]["noise"] == sizes[-1] and got[0]["n_clusters"] == len(sizes) - 1
    assert sum(r["share_pct"] for r in got.values()) == pytest.approx(100)
    assert {r["cluster"] for r in stats.cluster_sizes(df).where("is_noise").collect()} == {-1}
    plain = df.where("cluster >= 0")
    assert stats.cluster_comparison(plain).first()["noise"] == 0
    featureless = stats.cluster_summary(df.select("cluster", F.lit("ACGG").alias("seq")))
    assert "mean_total_expr" not in featureless.columns
    assert {r["median_gc"] for r in featureless.collect()} == {0.75}


def test_histogram_and_box(spark):
    pdf = _frame(800)
    df = spark.createDataFrame(pdf)
    counts, _ = np.histogram(pdf["v"], bins=30)
    got = {r["bin"]: r["n"] for r in stats.histogram(df, "v").collect()}
    assert got == {i: n for i, n in enumerate(counts) if n}
    flat = stats.histogram(df.select(F.lit(2.0).alias("v")), "v").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 800)]
    for r in stats.box_summary(df, "v").collect():
        own = pdf[pdf["cluster"] == r["cluster"]]["v"]
        q1, q3 = own.quantile(.25), own.quantile(.75)
        inside = own[(own >= q1 - 1.5 * (q3 - q1)) & (own <= q3 + 1.5 * (q3 - q1))]
        assert (r["n"], r["whisker_low"], r["whisker_high"]) == (len(own), inside.min(), inside.max())
        assert r["label"] == ("Noise" if r["cluster"] == -1 else f"C{r['cluster']}")


def test_empty_sequences_are_charted(spark):
    df = spark.createDataFrame([("GC",), ("",), ("AT",), (None,), ("GA",)], "seq string")
    assert [r["n"] for r in stats.histogram(stats.chart_features(df), "gc").orderBy("bin").collect()] == [2, 1, 1]
    assert stats.describe(stats.seq_features(df), ["gc"]).first()["n"] == 3


def test_filters(spark):
    df = spark.createDataFrame(
        [("HAB.9", "x", 1), ("hab19", "HAB", 2), (None, "hab", 3), ("other", "y", 4)], "TE_name string, note string, chr int"
    )
    assert [r["chr"] for r in filters.filter_family(df, "hab.9").collect()] == [1, 2]
    assert [r["chr"] for r in filters.filter_family(df, "hab.9", literal=True).collect()] == [1]
    assert filters.preview_count(df, "hab").first()["matches"] == 3
    names = filters.family_names(df, n=2).collect()
    assert [r["name"] for r in names] == ["HAB.9", "hab19"] and names[0]["distinct_names"] == 3
    r = filters.seq_presence(df, "TE_name").first()
    assert (r["rows"], r["missing"], r["all_present"]) == (4, 1, False)
    with pytest.raises(ValueError, match="start"):
        filters.require_columns(df, ["chr", "start"])
    assert filters.expression_columns(df) == []
    text = spark.createDataFrame([("1",)], "B2_x_r1 string")
    assert filters.expression_columns(text) == ["B2_x_r1"]


def test_labels(spark):
    df = spark.createDataFrame([("c", 1, None), (None, 2, 3)], "a string, b int, c int")
    got = [r[0] for r in df.select(coord_label("a", "b", "c")).collect()]
    assert got == ["c:1-?", "?:2-3"]
    labels = spark.createDataFrame([(-1,), (4,)], "c int").select(cluster_label("c")).collect()
    assert [r[0] for r in labels] == ["Noise", "C4"]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, max_value=1e305, min_value=-1e305), min_size=1, max_size=40))
def test_exact_sums_of_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(Limbs.of(df, "v").sum("v")).first()[0]
    assert got == pytest.approx(math.fsum(values), rel=4e-16, abs=0)


@pytest.mark.parametrize("values", [
    [1e-11, 2e-11, 3e-11], [1e300, 1.0, -1e300], [1e300, 1e-300, 5e-324], [0.1] * 1000, [5e-324] * 3, [0.0, -0.0],
    [2.0**53, 1.0, 1.0, -(2.0**53)], [1e16, 0.3, -1e16, 1e-7], [i / 7 for i in range(-400, 999)], [3.0, 4.0, 2.0**60],
])
def test_exact_sums(spark, values):
    """The right sum, rounded once, and the same bits however rows are spread."""
    found = set()
    for parts in (1, 8, 200):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "i int, v double").repartition(parts, "i")
        found.add(df.agg(Limbs.of(df, "v").sum("v")).first()[0])
    assert found == {math.fsum(values)}


def test_exact_sums_of_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", None), ("b", 1.5), ("b", inf), ("c", inf), ("c", -inf), ("d", nan), ("d", 1.0), ("e", 0.1), ("e", 0.2), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    limbs = Limbs.of(df, "v")
    got = {r["g"]: (r["s"], r["m"]) for r in df.groupBy("g").agg(limbs.sum("v").alias("s"), limbs.mean("v").alias("m")).collect()}
    assert got["a"] == (None, None) and got["b"][0] == inf and got[None] == (2.0, 2.0)
    assert math.isnan(got["c"][0]) and math.isnan(got["d"][0]) and got["e"][0] == math.fsum([0.1, 0.2])
    assert df.limit(0).agg(Limbs.of(df.limit(0), "v").sum("v")).first()[0] is None


def test_gc_shares_do_not_hang_on_partitioning(spark, data):
    df = spark.createDataFrame([(i % 2, "ACG" * (i % 11) + "T" * (i % 17)) for i in range(3000)], "cluster int, seq string")
    found = set()
    for parts in (1, 8, 200):
        spread = df.repartition(parts, "seq")
        summary = stats.cluster_summary(spread).select("cluster", "mean_gc")
        shares = stats.describe(stats.seq_features(spread), ["gc"], ["cluster"]).select("cluster", "mean")
        matrix = stats.expression_matrix(stats.seq_features(spread), ["gc", "length"])
        found.add(str([sorted(map(tuple, t.collect())) for t in (summary, shares, matrix)]))
    assert len(found) == 1


def test_means_do_not_hang_on_partitioning(spark):
    """Sums of tenths and hundredths in any order: the same bits, however the rows are spread."""
    rows = [(i % 3, 0.1 * (i % 7), 0.01 * (i % 13)) for i in range(5000)]
    df = spark.createDataFrame(rows, "cluster int, A1_x_r1 double, A1_y_r2 double")
    found = set()
    for parts in (1, 3, 8, 64):
        spread = df.repartition(parts, "A1_x_r1", "cluster")
        got = stats.condition_by_cluster(spread, ["A1_x_r1", "A1_y_r2"])
        found.add(tuple(sorted(map(tuple, got.collect()))))
    assert len(found) == 1
