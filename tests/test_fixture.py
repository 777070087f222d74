"""The saved run: 15 copies of two families, compared with its stored results."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seqspark.operators import align, filters, kmers, primers, stats
from seqspark.operators.ordering import with_row_id
from seqspark.session import settle
from seqspark.sources import fasta, tables


@pytest.fixture(scope="module")
def rows(spark, data):
    df = tables.read_annotations(spark, os.path.join(data, "annotations.csv"))
    df = df.withColumnsRenamed({"Seq": "seq", "Cluster": "cluster"})
    numbered = with_row_id(df, [F.regexp_extract("TE_name", r"(\d+)$", 1).cast("int")])
    samples = filters.expression_columns(df.drop("cluster"))
    return settle(filters.with_total_expr(numbered, samples)), samples


@pytest.fixture(scope="module")
def index(rows):
    return settle(kmers.kmer_index(kmers.postings(rows[0], 18, keep=["total_expr"])))


def _sequence(path):
    with open(path) as lines:
        return "".join(line.strip() for line in lines if not line.startswith(">")).upper()


def test_columns_are_found(rows):
    assert rows[1] == ["A1_siCTRL_r1", "A1_siCTRL_r2", "A1_siKD_r1", "A1_siKD_r2"]
    assert list(filters.sample_conditions(rows[1])) == ["siCTRL", "siKD"]


def test_selected_primers(index, data):
    wanted = pd.read_csv(os.path.join(data, "selected_primers.csv"))
    got = primers.select_primers(index).orderBy("place").toPandas()
    assert index.count() == 5768
    assert got["primer"].tolist() == wanted["primer"].tolist()
    assert got["coverage"].tolist() == wanted["coverage"].tolist()
    assert got["strategy"].tolist() == wanted["strategy"].tolist()
    assert got["total_expr"].tolist() == pytest.approx(wanted["total_expr"].tolist(), abs=1e-6)


def test_cluster_primers(rows, data):
    df, _ = rows
    wanted = pd.read_csv(os.path.join(data, "cluster_primers.csv"))
    posted = kmers.postings(df, 18, keep=["cluster", "total_expr"])
    top = settle(primers.top_cluster_primers(kmers.kmer_index(posted, by=["cluster"])))
    got = top.orderBy("rank").toPandas()
    assert got["primer"].tolist() == wanted["primer"].tolist()
    lines = primers.primer_rows(posted, df).join(top.select("primer"), "primer")
    lists = {r["primer"]: r for r in primers.row_lists(lines).collect()}
    assert [lists[p]["rows_covered"] for p in wanted["primer"]] == wanted["rows_covered"].tolist()
    first = df.where("row_id = 8").first()
    label = f"{first['chr']}:{first['start']}-{first['stop']}"
    assert lists[wanted["primer"][0]]["rows_coordinates"].split(",")[0] == label
    table = primers.cluster_rows_covered(top, df, 18).orderBy("rank").toPandas()
    assert table["primer"].tolist() == wanted["primer"].tolist()
    assert table["coverage"].tolist() == wanted["coverage"].tolist()
    assert table["rows_covered"].tolist() == wanted["rows_covered"].tolist()
    covered = primers.rows_covered(top, df, 18).groupBy("primer").count().collect()
    assert {r["primer"]: r["count"] for r in covered} == dict(zip(wanted["primer"], wanted["coverage"]))


def test_statistics(rows, data):
    df, samples = rows
    total = stats.describe(df, ["total_expr"]).first()
    assert round(total["mean"], 2) == 118.93
    assert round(total["median"], 2) == 97.58
    assert round(total["sd"], 2) == 66.13
    length = stats.describe(stats.seq_features(df), ["length", "gc"]).collect()
    by_metric = {r["metric"]: r for r in length}
    assert (by_metric["length"]["n"], by_metric["length"]["q1"], by_metric["length"]["q3"]) == (15, 480.0, 500.0)
    assert round(by_metric["gc"]["median"], 3) == 0.434
    expression = {r["metric"]: r for r in stats.describe(df, samples).collect()}
    first = expression["A1_siCTRL_r1"]
    assert [round(first[c], 2) for c in ("mean", "median", "sd", "min", "max", "q1", "q3")] == [
        34.83, 29.76, 21.40, 7.80, 95.16, 24.00, 41.16]
    assert (first["nonzero"], first["nonzero_pct"]) == (15, 100.0)
    by_condition = {r["condition"]: r for r in stats.condition_stats(df, samples).collect()}
    assert [round(by_condition["siKD"][c], 2) for c in ("mean", "median", "sd")] == [44.46, 34.82, 26.79]
    assert by_condition["siCTRL"]["replicates"] == 2


def test_cluster_summary(rows, data):
    df, samples = rows
    wanted = pd.read_csv(os.path.join(data, "cluster_summary.csv")).iloc[0]
    got = stats.cluster_summary(df, "seq", samples).first()
    for c in wanted.index:
        assert got[c] == pytest.approx(wanted[c]), c
    comparison = stats.cluster_comparison(df).first()
    assert (comparison["share_pct"], comparison["n_clusters"], comparison["noise"]) == (100.0, 1, 0)


def test_fasta_round_trip(rows, spark, data, tmp_path):
    df, _ = rows
    path = str(tmp_path / "out")
    fasta.write_fasta(fasta.to_fasta(df).orderBy("row_id"), path)
    with open(os.path.join(data, "sequences.fa")) as f:
        wanted = f.read()
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    assert "".join(open(os.path.join(path, p)).read() for p in parts) == wanted
    back = fasta.read_records(spark, path).orderBy("seq_id").collect()
    assert [r["seq"] for r in back] == [r["seq"] for r in df.orderBy("row_id").collect()]


@pytest.fixture(scope="module")
def alignment(spark, data):
    return settle(fasta.read_alignment(spark, os.path.join(data, "aligned.fa")).withColumn("grp", F.lit(0)))


def test_profile_and_consensus(alignment, data):
    profile = align.alignment_profile(alignment).first()
    assert (profile["n"], profile["width"], round(profile["mean_gaps"], 2)) == (15, 550, 1.62)
    assert (profile["columns_without_gaps"], profile["columns_over_half_gaps"]) == (430, 50)
    assert align.consensus(alignment).first()["consensus"] == _sequence(os.path.join(data, "consensus.fa"))
    summary = align.consensus_summary(alignment).first()
    assert (summary["size"], summary["consensus_length"], summary["alignment_length"]) == (15, 550, 550)


def test_cleaning(alignment, spark, data):
    cleaned, log = align.clean_alignment(alignment)
    wanted = fasta.read_alignment(spark, os.path.join(data, "cleaned.fa"))
    assert {r["name"]: r["seq"] for r in cleaned.collect()} == {r["name"]: r["seq"] for r in wanted.collect()}
    summary = align.cleaned_summary(cleaned).first()
    assert summary["consensus"] == _sequence(os.path.join(data, "cleaned_consensus.fa"))
    assert (summary["length_no_gaps"], summary["length_with_gaps"]) == (500, 500)
    steps = dict(line.rstrip("\n").split("\t") for line in open(os.path.join(data, "removed.txt")))
    names = {r["seq_id"]: r["name"] for r in alignment.collect()}
    entries = log.collect()
    assert {names[r["id"]] for r in entries if r["step"] == "remove_divergent"} == set(steps["remove_divergent"].split(","))
    columns = sorted(r["id"] for r in entries if r["step"] == "remove_gap_only")
    assert columns == [int(c) for c in steps["remove_gap_only"].split(",")]
    assert len(entries) == 7 + 50
