"""Estimating genome-wide hits from a few sampled contigs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.operators.intervals import contigs
from seqspark.operators.search import search_primers
from seqspark.functions.sequence import fold_case

# The main chromosomes, what to fall back to without them, sample size, genome size.
MAJOR_CONTIGS = (
    "chr1 chr2 chr3 chr4 chr5 chr6 chr7 chr8 chr9 chr10 chr11 chr12 "
    "chr13 chr14 chr15 chr16 chr17 chr18 chr19 chr20 chr21 chr22 chrX chrY"
).split()
FALLBACK_CONTIGS = 24
SAMPLE_SIZE = 5
GENOME_SIZE = 3_100_000_000


def eligible_contigs(genome: DataFrame) -> DataFrame:
    """The main chromosomes that are there; without any, the first 24 contigs."""
    known = contigs(genome)
    major = known.where(F.col("chrom").isin(MAJOR_CONTIGS))
    some = major.agg(F.count(F.lit(1)) > 0).scalar()
    first = known.orderBy("chrom_idx").limit(FALLBACK_CONTIGS).where(~some)
    return major.unionAll(first)


def sample_contigs(genome: DataFrame, n: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """A seeded sample of the eligible contigs: the ``n`` with the smallest hash of name and seed."""
    draw = F.md5(F.concat(F.col("chrom"), F.lit(f":{seed}")))
    return eligible_contigs(genome).orderBy(draw, "chrom").limit(n)


def estimate_hits(
    primers: DataFrame, genome: DataFrame, n: int = SAMPLE_SIZE, seed: int = 42, genome_size: int = GENOME_SIZE
) -> DataFrame:
    """Hits on the sampled contigs, scaled up to the genome size; uncapped."""
    sample = sample_contigs(genome, n, seed)
    sampled = genome.join(F.broadcast(sample.select("chrom")), "chrom", "left_semi")
    found = search_primers(primers, sampled).groupBy("primer").agg(F.count(F.lit(1)).alias("_hits"))
    size = sample.agg(
        F.struct(F.coalesce(F.sum("chrom_len"), F.lit(0)).alias("bp"), F.count(F.lit(1)).alias("n"))
    ).scalar()
    wanted = primers.select(fold_case("primer").alias("primer")).where(F.col("primer") != "").distinct()
    counted = wanted.join(found, "primer", "left").withColumn("_s", size)
    hits = F.coalesce("_hits", F.lit(0))
    return counted.select(
        "primer",
        hits.alias("sample_hits"),
        F.when(F.col("_s.bp") > 0, F.floor(hits * (F.lit(float(genome_size)) / F.col("_s.bp"))))
        .otherwise(0)
        .cast("bigint")
        .alias("estimated_total"),
        # Fixed value: wording of the note.
        F.concat(
            F.lit("Estimated from "), F.col("_s.n").cast("string"), F.lit(f" chromosomes (seed={seed})")
        ).alias("sampling_note"),
    )
