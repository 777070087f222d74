import os

import pandas as pd
import pytest

from seqspark.plans import family
from seqspark.sources import fasta, tables


def test_whole_analysis(spark, data, tmp_path):
    source = pd.read_csv(os.path.join(data, "annotations.csv"))
    genome = str(tmp_path / "genome.fa")
    with open(genome, "w") as f:
        for i, s in enumerate(source["Seq"]):
            f.write(f">{i}\n{s}\n")
    settings = family.Settings(min_samples=2, min_cluster_size=5, cluster_k=6, dims=256)
    out = str(tmp_path / "out")
    found = family.run(spark, os.path.join(data, "annotations.csv"), "test_te", out, genome, settings)
    for name in found:
        assert os.path.isdir(os.path.join(out, name))

    def read(name):
        return spark.read.parquet(os.path.join(out, name))

    wanted = pd.read_csv(os.path.join(data, "selected_primers.csv"))
    chosen = read("selected_primers").orderBy("place").toPandas()
    assert chosen["primer"].tolist() == wanted["primer"].tolist()
    hits = {r["primer"]: r["genome_hits"] for r in read("primer_hit_summary").collect()}
    for p in wanted["primer"]:
        assert hits[p] >= source["Seq"].str.contains(p).sum() > 0
    covered = {r["primer"]: r for r in read("primer_rows").collect()}
    for p in wanted["primer"]:
        rows = source.index[source["Seq"].str.contains(p)]
        assert covered[p]["rows_covered"] == ",".join(map(str, rows))
    pairs = read("primer_row_hits").groupBy("primer").count().collect()
    assert {r["primer"]: r["count"] for r in pairs} == {p: hits[p] * covered[p]["rows"] for p in wanted["primer"]}
    labels = dict(read("rows").select("row_id", "cluster").collect())
    assert {labels[i] for i in range(8)} & {labels[i] for i in range(8, 15)} <= {-1}
    listed = read("selected_primer_rows").orderBy("place").toPandas()
    assert listed["primer"].tolist() == wanted["primer"].tolist()
    assert listed["coverage"].tolist() == wanted["coverage"].tolist() == listed["rows"].tolist()
    assert listed["rows_covered"].tolist() == [covered[p]["rows_covered"] for p in wanted["primer"]]
    candidates = read("primer_candidates")
    assert candidates.count() == 5768 and candidates.where("rank_by_cov_expr <= 8").join(read("selected_primers"), "primer").count() == 8
    assert read("length_histogram").agg({"n": "sum"}).first()[0] == 15 == read("gc_boxes").agg({"n": "sum"}).first()[0]
    assert read("family_consensus_summary").first()["size"] == 15
    assert read("cluster_consensus").count() >= 2
    records = fasta.read_records(spark, os.path.join(out, "sequences_fasta"))
    assert records.count() == 15


def test_rows_without_sequences(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as f:
        f.write("chr,start,stop,TE_name,strand\nc1,0,30,fam_1,+\nc1,10,40,fam_2,-\nc2,0,9,other,+\nc9,0,9,fam_3,+\n")
    genome = str(tmp_path / "g.fa")
    with open(genome, "w") as f:
        f.write(">c1\n" + "ACGTTGCATT" * 5 + "\n")
    annotations = tables.read_annotations(spark, path)
    with pytest.raises(ValueError, match="genome"):
        family.analyse(annotations, "fam")
    with pytest.raises(ValueError, match="fam_1"):
        family.analyse(annotations, "nothing")
    chunks = fasta.read_fasta(spark, genome, chunk=16, overlap=17)
    found = family.analyse(annotations, "FAM", chunks, family.Settings(k=6, cluster_k=6, dims=64, anchor_k=4))
    rows = {r["row_id"]: r for r in found["rows"].collect()}
    assert [rows[i]["seq"] for i in range(3)] == [("ACGTTGCATT" * 5)[:30], ("ACGTTGCATT" * 5)[10:40], "N" * 100]
    assert {r["cluster"] for r in rows.values()} == {0}
    errors = {r["row_id"]: r["reason"] for r in found["extraction_errors"].collect()}
    assert errors == {2: "unknown contig"}
    assert found["selected_primers"].count() > 0
