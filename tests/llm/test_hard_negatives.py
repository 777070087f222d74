"""Hard negatives against scoring every pair in Python."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqspark.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, part string"


def brute(table, every=100, scale=256):
    rows = [
        (i, lab, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, lab in table
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, lab, v) in enumerate(rows):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, l2) for b, (j, l2, w) in enumerate(rows) if b != a)
        for s, p, _ in [x for x in scored if x[2] == lab][:5]:
            fit = [(t, n) for t, n, l2 in scored if l2 != lab and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, p, r, n, -s, -t) for r, (t, n) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, table, **options):
    rows = spark.createDataFrame([(*r, "x") for r in table], SCHEMA)
    return sorted(tuple(r) for r in hn.mine_hard_negatives(rows, **options).collect())


def random_table(seed, n, d, spread=1.0):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(4, d))
    return [(i, (centres[i % 4] + spread * rnd.normal(size=d)).astype(np.float32).tolist(), int(rnd.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("seed,n,d,every", [(1, 600, 64, 20), (2, 400, 7, 10), (3, 300, 1, 10)])
def test_equals_all_pairs(spark, seed, n, d, every):
    table = random_table(seed, n, d)
    want = brute(table, every)
    assert want and mined(spark, table, anchor_every=every) == want
    # Many shards of a label, and of the table.
    assert mined(spark, table, anchor_every=every, shard=40, small_shard=1) == want


def test_odd_rows(spark):
    table = random_table(4, 300, 8, 0.2)
    rnd = random.Random(5)
    nan, inf = float("nan"), float("inf")
    table += [(None, [1.0] * 8, 1), (400, None, 1), (500, [1.0] * 8, None), (600, [1.0, None] * 4, 1), (700, [nan] * 8, 2), (800, [inf] * 8, 3)]
    # Ties, repeated rows and anchors, shared ids, short and empty vectors, zero and negative positive scores.
    table += [(i, [0.5] * 8, i % 3) for i in range(1000, 1060)] + [(900, [0.5] * 8, 0)] * 3 + [(900, [0.25] * 8, 0), (900, [0.5] * 8, 1)]
    table += [(1100, [0.5] * 3, 2), (1200, [], 2), (1300, [0.0] * 8, 77), (1301, [0.0] * 8, 77), (1400, [9.0] * 8, 88), (1401, [-9.0] * 8, 88)]
    rnd.shuffle(table)
    want = brute(table)
    assert {r[0] for r in want} >= {0, 100, 900, 1000, 1100, 1300}
    assert mined(spark, table) == want == mined(spark, table, shard=30, small_shard=1)
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == []


@given(st.lists(st.lists(st.integers(-3000, 3000), min_size=16, max_size=16), min_size=2, max_size=30))
@settings(max_examples=60, deadline=None)
def test_bounds_hold(values):
    both = hn.Segments(np.array(values, dtype=np.int64))
    rows = np.arange(len(values))
    scores = both.scores(rows, both, 0)
    widths = []
    for level in range(len(both.levels)):
        low, high = both.bounds(level, rows, both, 0)
        assert (low <= scores).all() and (scores <= high).all()
        widths.append(high - low)
    # Shorter segments bound at least as closely.
    assert all((b <= a + 1e-3).all() for a, b in zip(widths, widths[1:], strict=False))


def test_most_rows_are_ruled_out():
    """On vectors whose parts differ in level, few rows are scored in full."""
    rnd = np.random.default_rng(6)
    levels = np.repeat(rnd.normal(size=(5000, 16)), 4, axis=1)
    shard = hn.Segments(np.floor(256 * (levels + 0.05 * rnd.normal(size=(5000, 64)))).astype(np.int64))
    rows, _ = hn.best_rows(shard, np.arange(1, 5000), shard, 0, 5)
    assert len(rows) < 500
