import os
import random

import pytest

from seqspark.operators import intervals, sampling, search
from seqspark.session import settle
from seqspark.sources import fasta
from seqspark.sources.genome import chunk_table

CONTIGS = [
    ("chr1", "aaaaaaACGTNNNNacgtTTGCA"), ("chr2", "ACG"), ("chrX", "TTTTTTAAAACGTACGTACGTTTT" * 3), ("scaf_1", ""),
]


def _genome(spark, contigs=CONTIGS, chunk=7, overlap=4):
    rows = [(c, s, i) for i, (c, s) in enumerate(contigs)]
    return chunk_table(spark.createDataFrame(rows, "c string, s string, i bigint"), "c", "s", "i", chunk, overlap)


def _complement(s):
    return s.translate(str.maketrans("ACGTacgt", "TGCAtgca"))[::-1]


def _naive(primer, contigs=CONTIGS):
    hits = []
    for i, (c, s) in enumerate(contigs):
        s, k = s.upper(), len(primer)
        for probe, strand in ((primer, "+"), (_complement(primer), "-")):
            hits += [(primer, c, i, p + 1, p + k, strand) for p in range(len(s) - k + 1) if s[p:p + k] == probe]
    return hits


PRIMERS = ["AAAA", "ACGT", "acgta", "TTGCA", "GGGGG", "CG", "AAAAA"]


@pytest.fixture(scope="module")
def primers(spark):
    return spark.createDataFrame([(p,) for p in PRIMERS], "primer string")


def _rows(df):
    return sorted(tuple(r) for r in df.select("primer", "chrom", "chrom_idx", "start", "stop", "strand").collect())


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_search_equals_naive(spark, primers, limit):
    """Borders, overlaps, palindromes and mixed lengths, broadcast and shuffled."""
    want = sorted(h for p in PRIMERS for h in _naive(p.upper()))
    assert _rows(search.search_primers(primers, _genome(spark), limit)) == want


def test_search_without_primers(spark, primers):
    assert search.search_primers(primers.limit(0), _genome(spark)).count() == 0


def test_overlap_is_required(spark, primers):
    with pytest.raises(ValueError, match="overlap"):
        search.search_primers(primers, _genome(spark, overlap=3))


def test_cap_summary_and_contigs(spark, primers):
    hits = settle(search.search_primers(primers, _genome(spark)))
    capped = settle(search.cap_hits(hits, 3))
    for p in {p.upper() for p in PRIMERS}:
        want = sorted(_naive(p), key=lambda h: (h[2], h[5], h[3]))[:3]
        assert sorted(r for r in _rows(capped) if r[0] == p) == sorted(want)
    summary = {r["primer"]: r for r in search.hit_summary(primers, hits, 3).collect()}
    assert (summary["GGGGG"]["genome_hits"], summary["GGGGG"]["capped"]) == (0, False)
    total = len(_naive("AAAA"))
    assert (summary["AAAA"]["genome_hits"], summary["AAAA"]["capped"]) == (total, True)
    # Exactly as many hits as the limit: nothing is left out.
    exact = {r["primer"]: r["capped"] for r in search.hit_summary(primers, hits, total).collect()}
    assert exact["AAAA"] is False
    estimate = spark.createDataFrame([("GGGGG", 0)], "primer string, estimated_total bigint")
    flagged = {r["primer"]: r for r in search.hit_summary(primers, hits, 3, estimate).collect()}
    assert (flagged["GGGGG"]["estimated"], flagged["GGGGG"]["estimated_total"]) == (True, 0)
    assert flagged["CG"]["estimated"] is False
    running = {(r["primer"], r["chrom"]): (r["hits"], r["running_total"]) for r in search.hits_by_contig(hits).collect()}
    first = len([h for h in _naive("ACGT") if h[1] == "chr1"])
    rest = len([h for h in _naive("ACGT") if h[1] == "chrX"])
    assert running[("ACGT", "chr1")] == (first, first)
    assert running[("ACGT", "chrX")] == (rest, first + rest)
    assert {r["primer"] for r in search.pending(primers, hits).collect()} == {"GGGGG", "acgta"}


def test_hot_contig_capped(spark):
    """Nearly all hits of all primers lie in one long contig."""
    contigs = [("a", "ACGT"), ("b", "A" * 150_000), ("c", "AAAT")]
    genome = _genome(spark, contigs, chunk=4096, overlap=3)
    hits = settle(search.search_primers(spark.createDataFrame([("AAA",)], "primer string"), genome))
    assert hits.count() == 149_998 + 1
    got = _rows(search.cap_hits(hits, 70_000))
    assert got == [("AAA", "b", 1, p, p + 2, "+") for p in range(1, 70_001)]


def test_rows_against_hits(spark, primers):
    hits = settle(search.cap_hits(search.search_primers(primers, _genome(spark)), 50))
    rows = spark.createDataFrame(
        [(0, "chr1", 0, 8, "+"), (1, "chrX", 10, 40, "-"), (2, "zz", 0, 99, "+")],
        "row_id bigint, chr string, start bigint, stop bigint, strand string",
    )
    lines = spark.createDataFrame([("AAAA", 0), ("AAAA", 1), ("CG", 1), ("CG", 2)], "primer string, row_id bigint")
    every = search.primer_row_hits(lines, rows, hits).collect()
    by_primer = {p: _naive(p) for p in ("AAAA", "CG")}
    assert len(every) == 2 * len(by_primer["AAAA"]) + 2 * len(by_primer["CG"])
    assert len({tuple(r) for r in every}) == len(every)
    places = {r["row_id"]: r for r in rows.collect()}
    near = search.primer_row_hits(lines, rows, hits, overlap=True).collect()
    want = sorted(
        (p, i, h[3], h[5]) for p, i in [("AAAA", 0), ("AAAA", 1), ("CG", 1), ("CG", 2)] for h in by_primer[p]
        if h[1] == places[i]["chr"] and places[i]["start"] < h[4] and h[3] <= places[i]["stop"]
    )
    assert sorted((r["primer"], r["seq_row"], r["genome_start"], r["genome_strand"]) for r in near) == want


def test_overlap_join_over_many_bins(spark):
    rng = random.Random(5)
    left = [(i, "c", rng.randint(0, 500), 0) for i in range(60)]
    left = [(i, c, s, s + rng.randint(0, 120)) for i, c, s, _ in left]
    right = [(i, "c", s, s + 7) for i, s in enumerate(range(0, 600, 11))]
    a = spark.createDataFrame(left, "i bigint, c string, ls bigint, le bigint")
    b = spark.createDataFrame(right, "j bigint, c string, rs bigint, re bigint")
    got = [(r["i"], r["j"]) for r in intervals.overlap_join(a, b, ["c"], ("ls", "le"), ("rs", "re"), 16).collect()]
    want = [(x[0], y[0]) for x in left for y in right if x[2] < y[3] and y[2] <= x[3]]
    assert sorted(got) == sorted(want)


def test_extraction_from_a_popular_chunk(spark):
    """Half of all intervals ask for one chunk; lists of any size give the same, and rows may share everything but the id."""
    genome = _genome(spark, overlap=0)
    texts = dict(CONTIGS)
    rng = random.Random(11)
    size = len(texts["chr1"])
    spans = [(0, 3)] * 60 + [tuple(sorted(rng.sample(range(size + 1), 2))) for _ in range(60)]
    ann = spark.createDataFrame([(i, "chr1", a, b) for i, (a, b) in enumerate(spans)], "row_id bigint, chr string, start bigint, stop bigint")
    for per_list in (1, 7, 4096):
        got = {r["row_id"]: r["seq"] for r in intervals.extract_sequences(ann, genome, per_list=per_list).collect()}
        assert got == {i: texts["chr1"].upper()[a:b] for i, (a, b) in enumerate(spans)}


def test_extraction_moves_asked_chunks_only(spark):
    """Text is cut above the join with the keys that are asked for."""
    genome = _genome(spark, overlap=0)
    ann = spark.createDataFrame([(0, "chr1", 2, 5)], "row_id bigint, chr string, start bigint, stop bigint")
    plan = intervals.extract_sequences(ann, genome, drop_failed=True)._jdf.queryExecution().optimizedPlan().toString()
    cut = next(line for line in plan.splitlines() if "AS _text" in line)
    assert plan.index("_lists") and plan.index(cut) < plan.rindex("Join Inner")


def test_extraction(spark):
    genome = _genome(spark, overlap=0)
    cases = [
        ("chr1", 2, 5, None), ("chr1", 0, 23, None), ("chrX", 5, 60, None), ("chr1", 7, 14, None), ("chr1", 6, 8, None),
        ("chr1", -1, 5, "negative coordinate"), ("chr1", 5, 5, "stop not after start"), ("nope", 0, 3, "unknown contig"),
        ("chr2", 0, 4, "stop beyond contig"), ("scaf_1", 0, 1, "stop beyond contig"), ("chr1", None, 3, "missing coordinate"),
    ]
    ann = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "row_id bigint, chr string, start bigint, stop bigint")
    texts = dict(CONTIGS)
    got = {r["row_id"]: r for r in intervals.extract_sequences(ann, genome).collect()}
    for i, (c, a, b, reason) in enumerate(cases):
        assert got[i]["reason"] == reason
        assert got[i]["seq"] == (texts[c].upper()[a:b] if reason is None else "N" * 100)
    assert intervals.extract_sequences(ann, genome, drop_failed=True).count() == 5
    errors = {r["row_id"]: r["message"] for r in intervals.extraction_errors(ann, genome).collect()}
    assert errors[5] == "Row 5: chr1:-1-5 - ValueError: Invalid coordinates: start=-1, stop=5"
    assert errors[6] == "Row 6: chr1:5-5 - ValueError: stop (5) must be > start (5)"
    assert errors[8] == "Row 8: chr2:0-4 - ValueError: Could not extract chr2:0-4 from genome"
    counts = {r["outcome"]: r["rows"] for r in intervals.extraction_counts(intervals.validate_intervals(ann, genome)).collect()}
    assert counts["ok"] == 5 and counts["stop beyond contig"] == 2


def test_sampling(spark, primers):
    genome = _genome(spark)
    assert {r["chrom"] for r in sampling.eligible_contigs(genome).collect()} == {"chr1", "chr2", "chrX"}
    other = _genome(spark, [(f"s{i:02d}", "ACGT" * (i + 1)) for i in range(30)])
    assert [r["chrom"] for r in sampling.eligible_contigs(other).orderBy("chrom_idx").collect()] == [f"s{i:02d}" for i in range(24)]
    chosen = [tuple(r) for r in sampling.sample_contigs(other, 5, 7).collect()]
    assert len(chosen) == 5 and chosen == [tuple(r) for r in sampling.sample_contigs(other, 5, 7).collect()]
    found = {r["primer"]: r for r in sampling.estimate_hits(primers, genome, 5, 1, 1000).collect()}
    length = sum(len(s) for c, s in CONTIGS if c.startswith("chr"))
    hits = len(_naive("CG"))
    assert found["CG"]["sample_hits"] == hits
    assert found["CG"]["estimated_total"] == int(hits * (1000 / length))
    assert found["GGGGG"]["estimated_total"] == 0
    assert found["CG"]["sampling_note"] == "Estimated from 3 chromosomes (seed=1)"


def test_fasta_scan_of_split_files(spark, tmp_path):
    """Contigs that run over many file blocks, several headers per block, repeated names, empty contigs."""
    rng = random.Random(2)
    contigs = [("lead", "ACGT" * 3), ("long", "".join(rng.choice("acgtN") for _ in range(9000))), ("none", "")]
    contigs += [(f"c{i}", "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 200)))) for i in range(40)]
    contigs += [("lead", "TTTT"), ("last", "GATTACA")]
    path = str(tmp_path / "g.fa")
    with open(path, "w") as f:
        f.write("stray text\n")
        for name, s in contigs:
            f.write(f">{name} some words\n")
            width = rng.choice([10, 60, 80])
            for i in range(0, len(s), width):
                f.write(f"  {s[i:i + width]} \n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        got = fasta.read_fasta(spark, path, chunk=50, overlap=9).collect()
        records = fasta.read_records(spark, path).orderBy("seq_id").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    whole = dict(contigs)
    order = {c: i for i, c in reversed(list(enumerate(c for c, _ in contigs)))}
    want = []
    for c, s in whole.items():
        s = s.upper()
        for at in range(0, max(len(s), 1), 50):
            want.append((c, order[c], at, s[at:at + 59], len(s[at:at + 50]), len(s)))
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert [(r["name"], r["seq"]) for r in records] == [(c, s.upper()) for c, s in contigs]


def test_fasta_scan_of_a_folder_in_small_batches(spark, tmp_path):
    """Many files in one task, contigs that go on in the next file, batches that end anywhere; no text is moved."""
    rng = random.Random(5)
    contigs = [(f"c{i}", "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 3, 400])))) for i in range(30)]
    lines = []
    for name, s in contigs:
        lines += [f">{name}", *[s[i:i + 20] for i in range(0, len(s), 20)]]
    for n, at in enumerate(range(0, len(lines), 17)):
        (tmp_path / f"part-{n:03d}.txt").write_text("\n".join(lines[at:at + 17]) + "\n")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
        records = fasta.read_records(spark, str(tmp_path)).orderBy("seq_id").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [(r["name"], r["seq"]) for r in records] == contigs
    plan = fasta.scan_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan


def test_alignment_width_is_checked(spark, tmp_path):
    path = os.path.join(tmp_path, "a.fa")
    with open(path, "w") as f:
        f.write(">a\nAC-T\n>b\nACG\n")
    with pytest.raises(Exception, match="differ in width"):
        fasta.read_alignment(spark, path).collect()


def test_combined_fasta(spark):
    df = spark.createDataFrame([(1, "ACGT" * 25), (-1, "GG")], "cluster int, consensus string")
    got = [r["record"] for r in fasta.combine_fasta(df, "fam").collect()]
    assert got == [">fam_cluster-1_consensus\nGG", ">fam_cluster1_consensus\n" + "ACGT" * 20 + "\n" + "ACGT" * 5]
