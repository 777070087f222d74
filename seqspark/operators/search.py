"""Exact search of primers on both strands of a chunked genome, and what is derived from the hits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.functions.sequence import fold_case, reverse_complement
from seqspark.operators import kmers
from seqspark.operators.intervals import overlap_join
from seqspark.operators.kmers import holding_any
from seqspark.operators.ordering import BLOCK, first_per_key, running_total
from seqspark.session import MAX_BROADCAST, broadcast_if_small, settle
from seqspark.sources.genome import require_overlap

# Fixed value: a primer with this many hits counts as non-specific.
MAX_HITS = 10_000

FORWARD = "+"
REVERSE = "-"

SALTS = 16


def both_strands(primers: DataFrame, primer: str = "primer") -> DataFrame:
    """Distinct upper-cased primers as probes: the primer itself and its reverse complement.

    A palindrome is a probe for both strands.
    """
    wanted = primers.select(fold_case(primer).alias("primer")).where(F.col("primer") != "").distinct()
    forward = wanted.select("primer", F.col("primer").alias("probe"), F.lit(FORWARD).alias("strand"))
    reverse = wanted.select("primer", reverse_complement("primer").alias("probe"), F.lit(REVERSE).alias("strand"))
    return forward.unionAll(reverse)


def search_primers(primers: DataFrame, genome: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """All occurrences, overlapping ones included: ``(primer, chrom, chrom_idx, start, stop, strand)``,
    1-based and inclusive.

    One pass over the genome per primer length. The probes are settled and measured, and broadcast only
    up to ``max_broadcast`` bytes; beyond that the same join is shuffled. For a handful of probes, chunks
    without any of them are skipped before their words are listed. Chunks must overlap by at least
    the primer length less one.
    """
    # The length is a column of its own: a filter on length(probe) would be inferred for every k-mer too.
    probes = settle(both_strands(primers).withColumn("k", F.length("probe")))
    lengths = sorted(r["k"] for r in probes.select("k").distinct().collect())
    found = [_search_length(probes, genome, k, max_broadcast) for k in lengths]
    if not found:
        found = [_search_length(probes, genome, 1, max_broadcast)]
    return reduce(DataFrame.unionAll, found)


def _search_length(probes: DataFrame, genome: DataFrame, k: int, max_broadcast: int) -> DataFrame:
    require_overlap(genome, k)
    wanted = probes.where(F.col("k") == k)
    sites = kmers.positions(holding_any(genome, wanted, "probe"), k, "seq", ["chrom", "chrom_idx", "chunk_start", "owned"]).where(
        F.col("pos") < F.col("owned")
    )
    wanted = broadcast_if_small(wanted, max_broadcast)
    start = F.col("chunk_start") + F.col("pos") + 1
    return sites.join(wanted, sites["kmer"] == wanted["probe"]).select(
        "primer", "chrom", "chrom_idx", start.alias("start"), (start + (k - 1)).alias("stop"), "strand"
    )


def pending(primers: DataFrame, searched: DataFrame, primer: str = "primer") -> DataFrame:
    """Primers that have not been searched yet."""
    return primers.join(searched.select(primer).distinct(), primer, "left_anti")


def cap_hits(hits: DataFrame, limit: int = MAX_HITS) -> DataFrame:
    """The first ``limit`` hits of each primer: contig order, ``+`` before ``-``, then position."""
    staged = hits.withColumn("_contigs", F.floor(F.col("chrom_idx") / BLOCK)).withColumn(
        "_stretch", F.floor(F.col("start") / BLOCK)
    )
    levels = [["_contigs"], ["chrom_idx", "strand"], ["_stretch"]]
    kept = first_per_key(staged, "primer", levels, ["chrom_idx", "strand", "start"], limit)
    return kept.drop("_contigs", "_stretch")


def hit_summary(
    primers: DataFrame, hits: DataFrame, limit: int | None = MAX_HITS, estimates: DataFrame | None = None
) -> DataFrame:
    """Hits per primer, primers without any included. ``hits`` are all hits, so counts are exact;
    ``capped`` marks primers of which a listing of ``limit`` hits leaves something out (None: no limit).
    ``estimates`` replaces the total of primers that were only estimated."""
    counted = hits.groupBy("primer").agg(F.count(F.lit(1)).alias("_hits"))
    wanted = primers.select(fold_case("primer").alias("primer")).distinct()
    known = wanted.join(counted, "primer", "left").select(
        "primer", F.coalesce("_hits", F.lit(0)).cast("bigint").alias("genome_hits")
    )
    if estimates is None:
        flagged = known.withColumn("_estimate", F.lit(None).cast("bigint"))
    else:
        flagged = known.join(estimates.select("primer", F.col("estimated_total").alias("_estimate")), "primer", "left")
    return flagged.select(
        "primer",
        "genome_hits",
        F.col("_estimate").isNotNull().alias("estimated"),
        F.coalesce("_estimate", "genome_hits").alias("estimated_total"),
        (F.col("genome_hits") > limit if limit is not None else F.lit(False)).alias("capped"),
    )


def hits_by_contig(hits: DataFrame) -> DataFrame:
    """Hits per primer and contig, with the running total in contig order."""
    counted = hits.groupBy("primer", "chrom", "chrom_idx").agg(F.count(F.lit(1)).alias("hits"))
    return running_total(counted, "primer", "chrom_idx", "hits", "running_total")


def _row_side(lines: DataFrame, rows: DataFrame, row_id: str) -> DataFrame:
    return lines.select("primer", row_id).join(
        rows.select(
            row_id, F.col("chr").alias("row_chr"), F.col("start").alias("row_start"),
            F.col("stop").alias("row_stop"), F.col("strand").alias("row_strand"),
        ),
        row_id,
    ).withColumnRenamed(row_id, "seq_row")


def _hit_side(hits: DataFrame) -> DataFrame:
    return hits.select(
        "primer", F.col("chrom").alias("genome_chr"), F.col("start").alias("genome_start"),
        F.col("stop").alias("genome_stop"), F.col("strand").alias("genome_strand"),
    )


def primer_row_hits(
    lines: DataFrame, rows: DataFrame, hits: DataFrame, row_id: str = "row_id", overlap: bool = False
) -> DataFrame:
    """Rows a primer covers against its genome hits.

    The default applies no position test: every covered row with every hit of its primer. The covered rows
    are salted and the (capped) hits repeated once per salt, so a primer found almost everywhere is
    spread over several tasks. With ``overlap`` a pair also has to overlap on the same contig.
    """
    left, right = _row_side(lines, rows, row_id), _hit_side(hits)
    if overlap:
        located = right.withColumn("row_chr", F.col("genome_chr"))
        return overlap_join(
            left, located, ["primer", "row_chr"], ("row_start", "row_stop"), ("genome_start", "genome_stop")
        )
    salted = left.withColumn("_salt", F.pmod(F.xxhash64("seq_row"), F.lit(SALTS)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, ["primer", "_salt"]).drop("_salt")
