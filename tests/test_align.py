import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqspark.operators import align, columns
from seqspark.session import settle

ROW = st.text(alphabet="ACgt-", max_size=12)


def _df(spark, rows):
    return spark.createDataFrame(rows, "grp string, seq_id bigint, seq string")


def _consensus(rows, share, gaps=False):
    width = max((len(s) for _, s in rows), default=0)
    out = ""
    for c in range(width):
        counts = Counter()
        for _, s in sorted(rows):
            if c < len(s) and (gaps or s[c] != "-"):
                counts[s[c].upper()] += 1
        total = sum(counts.values())
        best = max(counts, key=counts.get) if counts else "N"
        out += best if counts and counts[best] / total >= share else "N"
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xyz"), ROW), min_size=1, max_size=14))
def test_consensus_and_profile_equal_naive(spark, drawn):
    rows = [(g, i, s) for i, (g, s) in enumerate(drawn)]
    groups = defaultdict(list)
    for g, i, s in rows:
        groups[g].append((i, s))
    df = _df(spark, rows)
    half = {r["grp"]: r["consensus"] for r in align.consensus(df).collect()}
    raw = {r["grp"]: r for r in align.positional_consensus(df, ["grp"], "seq_id").collect()}
    profile = {r["grp"]: r for r in align.alignment_profile(df).collect()}
    for g, own in groups.items():
        width = max(len(s) for _, s in own)
        p = profile[g]
        assert (p["n"], p["width"]) == (len(own), width)
        if width == 0:
            assert g not in half
            continue
        assert half[g] == _consensus(own, 0.5)
        assert raw[g]["consensus"] == _consensus(own, 0.0, gaps=True)
        assert raw[g]["gap_reduced"] == raw[g]["consensus"].replace("-", "")
        gaps = [sum(c >= len(s) or s[c] == "-" for _, s in own) for c in range(width)]
        assert p["mean_gaps"] == pytest.approx(sum(gaps) / width)
        assert p["columns_without_gaps"] == sum(x == 0 for x in gaps)
        assert p["columns_over_half_gaps"] == sum(x > len(own) / 2 for x in gaps)


def test_wide_rows_and_ties(spark):
    rng = random.Random(1)
    wide = "".join(rng.choice("ACGT") for _ in range(9000))
    got = align.consensus(_df(spark, [("a", 1, wide), ("a", 0, wide[:5000].replace("A", "C"))])).first()["consensus"]
    assert got == _consensus([(1, wide), (0, wide[:5000].replace("A", "C"))], 0.5)
    assert align.consensus(_df(spark, [("a", 5, "T"), ("a", 2, "G")])).first()["consensus"] == "G"


def test_divergent(spark):
    rows = [("g", i, "ACGTACGTAC") for i in range(4)] + [("g", 4, "ACGTTTTTTT"), ("g", 5, "--GTACG---"), ("g", 6, "----------")]
    scored = {r["seq_id"]: r["identity"] for r in align.identity_to_majority(_df(spark, rows)).collect()}
    assert scored[0] == 1.0 and scored[5] == 1.0 and scored[6] == 0.0
    assert scored[4] == 0.5
    assert {r["seq_id"] for r in align.remove_divergent(_df(spark, rows)).collect()} == {0, 1, 2, 3, 5}


def _insertion(carrier, others, n=5):
    return [("g", 0, carrier)] + [("g", i, others) for i in range(1, n)]


def test_insertions(spark):
    def kept(rows, **limits):
        return {r["seq_id"]: r["seq"] for r in align.remove_insertions(_df(spark, rows), **limits).collect()}

    full = kept(_insertion("AAAAAGGGTTTTT", "AAAAA---TTTTT"))
    assert set(full.values()) == {"AAAAATTTTT"}
    flankless = _insertion("-AAAAGGGTTTTT", "AAAAA---TTTTT")
    assert kept(flankless)[0] == "-AAAAGGGTTTTT"
    narrow = _insertion("AAAAAGGTTTTT", "AAAAA--TTTTT")
    assert kept(narrow)[0] == "AAAAAGGTTTTT"
    long = "AAAAA" + "G" * 201 + "TTTTT"
    assert kept(_insertion(long, "AAAAA" + "-" * 201 + "TTTTT"))[0] == long
    common = [("g", i, "AAAAAGGGTTTTT") for i in range(2)] + [("g", i, "AAAAA---TTTTT") for i in range(2, 4)]
    assert kept(common)[0] == "AAAAAGGGTTTTT"
    assert kept(_insertion("AAAAAGGTTTTT", "AAAAA--TTTTT"), min_size=2)[0] == "AAAAATTTTT"


def test_short_and_gap_only(spark):
    rows = [("g", 0, "A" * 49 + "---"), ("g", 1, "A-" * 50), ("h", 2, "----")]
    assert {r["seq_id"] for r in align.remove_short(_df(spark, rows)).collect()} == {1}
    again = align.remove_short(align.remove_short(_df(spark, rows)))
    assert again.count() == 1
    rows = [("g", 0, "A--C-"), ("g", 1, "A-T"), ("h", 2, "--"), ("h", 3, "")]
    once = settle(align.drop_gap_only(_df(spark, rows)))
    assert {r["seq_id"]: r["seq"] for r in once.collect()} == {0: "A-C", 1: "AT", 2: "", 3: ""}
    assert {r["seq_id"]: r["seq"] for r in align.drop_gap_only(once).collect()} == {0: "A-C", 1: "AT", 2: "", 3: ""}


def test_cleaning_log_has_original_columns(spark):
    good = "ACGTACGTAC" * 6
    rows = [("g", i, good[:20] + "----" + "-" + good[20:]) for i in range(4)]
    rows += [("g", 4, good[:20] + "GGGG" + "-" + good[20:]), ("g", 5, "T" * 20 + "-----" + "T" * 60), ("g", 6, good[:20])]
    cleaned, log = align.clean_alignment(_df(spark, rows))
    assert {r["seq_id"]: r["seq"] for r in cleaned.collect()} == {i: good for i in range(5)}
    got = sorted((r["step"], r["kind"], r["id"]) for r in log.collect())
    assert got == [
        ("remove_divergent", "row", 5), ("remove_gap_only", "column", 24), ("remove_insertions", "column", 20),
        ("remove_insertions", "column", 21), ("remove_insertions", "column", 22), ("remove_insertions", "column", 23),
        ("remove_short", "row", 6),
    ]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_anchor(spark, limit):
    rng = random.Random(8)
    base = "".join(rng.choice("ACGT") for _ in range(120))
    rows = [(0, 10, base), (0, 11, base[15:100]), (0, 12, "GG" + base[:60]), (0, 13, "TTTT"), (0, 9, base[:119]), (1, 14, base)]
    df = spark.createDataFrame(rows, "cluster int, row_id bigint, seq string")
    got = {r["row_id"]: r for r in align.anchor_align(df, 12, max_broadcast=limit).collect()}
    assert set(got) == {9, 10, 11, 12, 13}
    assert {r["anchor_id"] for r in got.values()} == {10}
    assert got[11]["aligned"] == "--" + "-" * 15 + base[15:100] + "-" * 20
    assert (got[12]["offset"], got[12]["aligned"]) == (-2, "GG" + base[:60] + "-" * 60)
    assert (got[13]["offset"], got[13]["votes"]) == (0, 0)
    assert got[10]["aligned"] == "--" + base


def test_alignment_keeps_every_base(spark):
    """Members that stand over the anchor on either side, in groups of different widths."""
    rng = random.Random(9)
    rows = []
    for g in range(4):
        base = "".join(rng.choice("ACGT") for _ in range(80))
        for n in range(8):
            a, b = sorted(rng.sample(range(81), 2))
            rows.append((g, 10 * g + n, rng.choice(["", "TTTTT"]) + base[a:b] + rng.choice(["", "GGGGGGG"])))
    df = spark.createDataFrame(rows, "cluster int, row_id bigint, seq string")
    got = align.anchor_align(df, 8).collect()
    assert {r["row_id"]: r["aligned"].replace("-", "") for r in got} == {i: s for _, i, s in rows}
    assert all(len({len(r["aligned"]) for r in got if r["cluster"] == g}) == 1 for g in range(4))


def test_families_align_on_themselves(spark, data):
    df = spark.read.csv(f"{data}/annotations.csv", header=True, inferSchema=True).select(
        (F.regexp_extract("TE_name", r"(\d+)$", 1).cast("bigint") - 1).alias("row_id"), F.col("Seq").alias("seq")
    ).withColumn("cluster", F.when(F.col("row_id") < 8, 0).otherwise(1))
    got = align.anchor_align(df, 12).collect()
    assert len(got) == 15 and {r["offset"] for r in got} == {0}


def test_common_columns_stay_in_one_table(monkeypatch):
    """Few long rows among many short ones make a task hand on their own far columns, not those all rows share."""
    monkeypatch.setattr(columns, "HELD_BYTES", 2_000_000)
    fields = [T.StructField("grp", T.StringType()), *[T.StructField(n, t) for n, t in columns._TABLE]]
    schema = to_arrow_schema(T.StructType(fields))
    texts = ["ACGT" * 50 if i % 10 else "ACGT" * 5000 for i in range(200)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["x"] * 200), pa.array(range(200), pa.int64()), pa.array(texts)], ["grp", "_id", "_text"]
    )
    tables = [t for t in columns._count(["grp"], schema, True)([batch])]
    rows, near = [], []
    for t in tables:
        if t.column("stretch")[0].as_py() == 0:
            rows.append(t.column("rows")[0].as_py())
            near += t.column("counts")[0].as_py()
    assert len(rows) <= 2 and sum(rows) == 200
    assert sum(near) == sum(min(len(t), columns.STRETCH) for t in texts)
    assert sum(sum(t.column("counts")[0].as_py()) for t in tables) == sum(map(len, texts))
