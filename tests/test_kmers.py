import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqspark.functions.sequence import fold_case, gc_fraction, pieces, reverse_complement, wrap_lines
from seqspark.operators import kmers, primers
from seqspark.operators.cluster import kmer_vectors, vocabulary_vectors
from seqspark.operators.ordering import first_per_key, running_total, with_rank
from seqspark.session import is_small, join_groups, settle

TEXT = st.text(alphabet="ACGTNacgtné😀\n ", max_size=300)


def _naive(rows, k):
    return {(i, p, s[p:p + k]) for i, s in rows for p in range(len(s) - k + 1)}


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6), st.integers(1, 70))
def test_positions_equal_naive(spark, texts, k):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "row_id bigint, seq string")
    got = {(r["row_id"], r["pos"], r["kmer"]) for r in kmers.positions(df, k, "seq", ["row_id"]).collect()}
    assert got == _naive(rows, k)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5), st.integers(1, 40), st.integers(0, 20))
def test_pieces_and_folding(spark, texts, size, overlap):
    df = spark.createDataFrame([(t,) for t in texts], "seq string")
    out = df.select(
        "seq", pieces("seq", size, overlap).alias("p"), fold_case("seq").alias("u"), gc_fraction("seq").alias("gc"),
        reverse_complement(reverse_complement("seq")).alias("twice"), wrap_lines("seq", size).alias("w"),
    ).collect()
    for r in out:
        s = r["seq"]
        assert r["p"] == [s[i:i + size + overlap] for i in range(0, len(s), size)]
        assert r["u"] == "".join(c.upper() if c.isascii() else c for c in s)
        assert r["twice"] == s
        assert r["w"] == "\n".join(s[i:i + size] for i in range(0, len(s), size))
        assert r["gc"] == ((s.count("G") + s.count("C")) / len(s) if s else None)


def _copies(n, seed=1):
    """A third of the rows are the same sequence."""
    rng = random.Random(seed)
    shared = "".join(rng.choice("ACGT") for _ in range(90))
    rows = [(i, shared if i % 3 == 0 else "".join(rng.choice("acgtN") for _ in range(rng.randint(0, 150)))) for i in range(n)]
    return [(i, s, float(rng.randint(0, 9)), i % 2) for i, s in rows]


def _naive_index(rows, k):
    found = {}
    for i, s, e, _ in sorted(rows):
        s, seen = s.upper(), set()
        for p in range(len(s) - k + 1):
            w = s[p:p + k]
            if "N" in w or w in seen:
                continue
            seen.add(w)
            cov, total, row, pos = found.get(w, (0, 0.0, i, p))
            found[w] = (cov + 1, total + e, row, pos)
    return found


def test_index_and_ranks(spark):
    rows, k = _copies(60), 9
    df = spark.createDataFrame(rows, "row_id bigint, seq string, total_expr double, cluster int")
    index = settle(kmers.kmer_index(kmers.postings(df, k, keep=["total_expr"])))
    want = _naive_index(rows, k)
    got = {r["primer"]: (r["coverage"], r["total_expr"], r["first_row"], r["first_pos"]) for r in index.collect()}
    assert got == want
    by_cov = sorted(want, key=lambda w: (-want[w][0], -want[w][1], want[w][2], want[w][3]))
    by_expr = sorted(want, key=lambda w: (-want[w][1], -want[w][0], want[w][2], want[w][3]))
    ranks = {r["primer"]: (r["rank_by_cov_expr"], r["rank_by_expr_cov"]) for r in primers.rank_kmers(index).collect()}
    assert [w for w, _ in sorted(ranks.items(), key=lambda x: x[1][0])] == by_cov
    assert [w for w, _ in sorted(ranks.items(), key=lambda x: x[1][1])] == by_expr
    assert sorted(r[0] for r in ranks.values()) == list(range(1, len(want) + 1))
    chosen = primers.select_primers(index, 5).orderBy("place").collect()
    assert [r["primer"] for r in chosen] == list(dict.fromkeys(by_cov[:5] + by_expr[:5]))


def test_cluster_index(spark):
    rows, k = _copies(40), 8
    df = spark.createDataFrame(rows, "row_id bigint, seq string, total_expr double, cluster int")
    index = kmers.kmer_index(kmers.postings(df, k, keep=["cluster", "total_expr"]), by=["cluster"])
    top = primers.top_cluster_primers(index, n=3).orderBy("cluster", "rank").collect()
    for c in (0, 1):
        want = _naive_index([r for r in rows if r[3] == c], k)
        order = sorted(want, key=lambda w: (-want[w][0], -want[w][1], want[w][2], want[w][3]))
        assert [r["primer"] for r in top if r["cluster"] == c] == order[:3]


def test_counts_vocabulary_vectors(spark):
    rows, k = [(0, "ACGTACGTAC"), (1, "nnnnACG"), (2, "AC"), (3, "AAAAA")], 4
    df = spark.createDataFrame(rows, "row_id bigint, seq string")
    want = Counter((i, s.lower()[p:p + k]) for i, s in rows for p in range(len(s) - k + 1))
    got = {(r["row_id"], r["kmer"]): r["n"] for r in kmers.kmer_counts(df, k).collect()}
    assert got == want
    words = {w.upper() for _, w in want}
    r = kmers.kmer_vocabulary(df, k).first()
    assert (r["unique_kmers"], r["vocabulary"]) == (len([w for w in words if "N" not in w]), len(words))
    near = kmers.kmer_vocabulary(df, k, approximate=True).first()
    assert near["vocabulary"] == len(words)
    vectors = {r["row_id"]: r["vector"] for r in kmer_vectors(df, k, 1 << 18).collect()}
    for i, _ in rows:
        own = sorted(n for (j, _), n in want.items() if i == j)
        assert sorted(vectors[i].values.tolist()) == [float(n) for n in own]


def test_order_helpers_under_skew(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 5)}", i) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, at bigint")
    ranked = with_rank(df, [F.desc("at")], "r").collect()
    assert all(r["r"] == 3000 - r["at"] for r in ranked)
    staged = df.withColumn("a", F.floor(F.col("at") / 1000)).withColumn("b", F.floor(F.col("at") / 50))
    got = first_per_key(staged, "key", [["a"], ["b"]], ["at"], 30).collect()
    for key in {k for k, _ in rows}:
        assert sorted(r["at"] for r in got if r["key"] == key) == sorted(at for k, at in rows if k == key)[:30]
    wide = df.withColumn("at", F.col("at") * 1000).withColumn("v", F.lit(2))
    totals = running_total(wide, "key", "at", "v", "run").collect()
    for key in {k for k, _ in rows}:
        mine = sorted((r["at"], r["run"]) for r in totals if r["key"] == key)
        assert [r for _, r in mine] == [2 * (i + 1) for i in range(len(mine))]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_group_join_under_skew(spark, limit):
    rows = [(i, None if i % 7 == 0 else i % 2, "x" * 5) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id bigint, g int, seq string")
    table = spark.createDataFrame([(0, "zero", ["a"]), (None, "none", ["b", "c"]), (9, "nine", [])], "g int, name string, l array<string>")
    got = {r["row_id"]: r["name"] for r in join_groups(df, table, ["g"], "row_id", "left", limit).collect()}
    assert got == {i: {0: "zero", None: "none"}.get(g) for i, g, _ in rows}
    inner = join_groups(df, table, ["g"], "row_id", max_bytes=limit)
    assert inner.count() == sum(g != 1 for _, g, _ in rows)


def test_size_is_measured(spark):
    df = settle(spark.createDataFrame([("x" * 1000, [1, 2]), (None, None)], "s string, a array<bigint>"))
    assert is_small(df, 1300) and not is_small(df, 900)
    assert is_small(df.limit(0), 0)


def test_vocabulary_is_never_broadcast(spark):
    """The estimate of a few short texts is small, that of their k-mers would be as small."""
    df = spark.range(20).select(F.col("id").alias("row_id"), F.lit("ACGTTGCAGT" * 3).alias("seq"))
    found = vocabulary_vectors(df, 5)
    plan = found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().sparkPlan().toString()
    # What with_rank broadcasts is one row per partition, keyed by it.
    assert "SortMergeJoin [kmer" in plan and "BroadcastHashJoin [kmer" not in plan
    assert found.groupBy("row_id").agg(F.sum("n").alias("n")).where("n <> 26").count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6), st.integers(1, 20))
def test_binned_positions_equal_naive(spark, texts, k):
    rows = [*enumerate(texts), (90, None), (91, "A" * 9000), (92, "acgtn" * 1700), (93, "é😀" * 2100)]
    df = spark.createDataFrame(rows, "row_id bigint, seq string")
    found = kmers.binned_positions(df, k, keep=["row_id"]).collect()
    assert len(found) == len(want := _naive([(i, s or "") for i, s in rows], k))
    assert {(r["row_id"], r["pos"], r["kmer"]) for r in found} == want
    assert len({(r["kmer"], r["bin"]) for r in found}) == len({r["kmer"] for r in found})
    known = kmers.binned_positions(df, k, keep=["row_id"], without="N").collect()
    assert {(r["row_id"], r["pos"], r["kmer"]) for r in known} == {w for w in want if "N" not in w[2]}
    assert len(known) == sum("N" not in w[2] for w in want)


def test_vocabulary_moves_stretches(spark):
    """Before a k-mer is listed its stretch is moved; no exchange has a row per k-mer."""
    df = spark.range(20).select(F.lit("ACGTTGCAGT" * 3).alias("seq"))
    plan = kmers.kmer_vocabulary(df, 5)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate explode")[:2]
    assert "Exchange hashpartitioning" not in above and "Exchange hashpartitioning(bin" in below
    assert kmers.kmer_vocabulary(df, 5).first()["vocabulary"] == 10


def test_binned_index_equals_index(spark):
    rng = random.Random(5)
    rows = [(i, float(i % 5), "".join(rng.choice("ACGTN") for _ in range(rng.randint(0, 60))) * 2) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id bigint, total_expr double, seq string")
    want = sorted(kmers.kmer_index(kmers.postings(df, 4, keep=["total_expr"])).collect())
    index = kmers.kmer_index(kmers.binned_postings(df, 4, keep=["total_expr"]))
    assert sorted(index.collect()) == want
    # Stretches are moved, k-mers are not.
    assert "Exchange hashpartitioning" not in index._jdf.queryExecution().executedPlan().toString().split("Generate explode")[0]


def test_leading_rows_hold_both_lists(spark):
    rng = random.Random(9)
    rows = [
        (f"w{i:04d}", rng.randint(1, 4), rng.choice([None, float("nan"), float("inf"), -1.0, 0.0, 2.0, 3.0]),
         rng.choice([None, 1, 2, 3]), rng.randint(0, 3)) for i in range(3000)
    ]
    names = "primer string, coverage bigint, total_expr double, first_row bigint, first_pos bigint"
    index = spark.createDataFrame(rows, names).repartition(3)
    trimmed = primers.leading(index, 8)
    assert trimmed.count() <= 3 * 16
    for order in (primers.coverage_order(), primers.expression_order()):
        want = [r["primer"] for r in index.orderBy(*order).limit(8).collect()]
        assert [r["primer"] for r in trimmed.orderBy(*order).limit(8).collect()] == want


def test_selected_primers_make_the_index_once(spark):
    """Before, both lists went back to the k-mers."""
    df = spark.range(30).select(F.col("id").alias("row_id"), F.lit(1.0).alias("total_expr"), F.lit("ACGTTGCAGT" * 3).alias("seq"))
    found = primers.select_primers(kmers.kmer_index(kmers.binned_postings(df, 5, keep=["total_expr"])), 4)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 4
