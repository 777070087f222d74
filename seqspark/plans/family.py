"""A whole family analysis: from an annotation table to primers, hits and consensus tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqspark.functions.sequence import fold_case
from seqspark.operators import align, cluster, filters, intervals, kmers, primers, search, stats
from seqspark.operators.exact import Limbs
from seqspark.operators.ordering import with_row_id
from seqspark.session import settle
from seqspark.sources import fasta, tables


@dataclass
class Settings:
    """Parameters of an analysis; the defaults are those of the operators."""

    k: int = 18
    cluster_k: int = 18
    dims: int = 1024
    anchor_k: int = 12
    top_global: int = primers.TOP_GLOBAL
    top_cluster: int = primers.TOP_CLUSTER
    # Hits listed per primer; None lists all. Counts are exact either way.
    max_hits: int | None = None
    min_samples: int = cluster.MIN_SAMPLES
    min_cluster_size: int | None = None
    literal: bool = False
    not_expression: tuple[str, ...] = field(default=filters.NOT_EXPRESSION)


def family_rows(annotations: DataFrame, family: str, genome: DataFrame | None, settings: Settings) -> DataFrame:
    """Rows of the family with a row id in input order and their sequence in ``seq``.

    Where sequences were cut out of the genome, ``reason`` tells why one could not be.
    """
    rows = filters.filter_family(annotations, family, literal=settings.literal)
    rows = with_row_id(rows.withColumn("_input", F.monotonically_increasing_id()), ["_input"]).drop("_input")
    if rows.isEmpty():
        names = [r["name"] for r in filters.family_names(annotations).collect()]
        raise ValueError(f"no rows for family {family!r}; the first names are {names}")
    if "Seq" in rows.columns and filters.seq_presence(rows, "Seq").first()["all_present"]:
        return rows.withColumn("Seq", fold_case("Seq")).withColumnRenamed("Seq", "seq")
    filters.require_columns(rows, ["chr", "start", "stop"])
    if genome is None:
        raise ValueError("rows without sequences need a genome")
    return intervals.extract_sequences(rows.drop("Seq"), genome)


def cluster_rows(rows: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Cluster labels, with the fallback rules applied, and the embedding."""
    plane = settle(cluster.pca_embed(cluster.kmer_vectors(rows, settings.cluster_k, settings.dims)))
    labels = cluster.density_cluster(
        plane, min_samples=settings.min_samples, min_cluster_size=settings.min_cluster_size
    )
    one = rows.select("row_id", "seq", F.lit("all").alias("_all")).join(labels, "row_id")
    return settle(cluster.apply_fallbacks(one, settings.cluster_k, ["_all"]).select("row_id", "cluster")), plane


def analyse(
    annotations: DataFrame, family: str, genome: DataFrame | None = None, settings: Settings | None = None
) -> dict[str, DataFrame]:
    """All result tables by name. What several of them share is checkpointed; the rest stays lazy."""
    settings = settings or Settings()
    samples = filters.expression_columns(annotations, [*settings.not_expression, "row_id", "cluster"])
    found = family_rows(annotations, family, genome, settings)
    rows = settle(filters.with_total_expr(found.drop("cluster", "Cluster", "reason"), samples))
    labels, plane = cluster_rows(rows, settings)
    rows = settle(rows.join(labels, "row_id"))
    for name in ("chr", "start", "stop", "strand"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string" if name in ("chr", "strand") else "bigint"))
    features = stats.seq_features(rows)
    metrics = ["length", "gc", *samples, "total_expr"]
    out = {
        "rows": rows,
        "family_statistics": stats.describe(features, metrics),
        "cluster_statistics": stats.describe(features, metrics, ["cluster"]),
        "cluster_summary": stats.cluster_summary(rows, "seq", samples),
        "cluster_comparison": stats.cluster_comparison(rows),
        "cluster_sizes": stats.cluster_sizes(rows),
        "positional_consensus": align.positional_consensus(rows),
        "cluster_coordinates": cluster.cluster_coordinates(
            rows.select("row_id", "chr", "start", "stop", "strand"), plane, labels
        ),
    }
    charts = stats.chart_features(rows)
    for c in ("length", "gc"):
        out[f"{c}_histogram"] = stats.histogram(charts, c)
        out[f"{c}_boxes"] = stats.box_summary(charts, c)
    if "reason" in found.columns:
        out["extraction_errors"] = intervals.extraction_errors(found.drop("seq", "reason"), genome)
    if len(filters.sample_conditions(samples)) > 1:
        out["cluster_condition_statistics"] = stats.condition_stats(rows, samples, ["cluster"])
        out["condition_statistics"] = stats.condition_stats(rows, samples)
        out["condition_by_cluster"] = stats.condition_by_cluster(rows, samples)
    if samples:
        out["expression_matrix"] = stats.expression_matrix(rows, samples)

    # Settled: the index over all rows and the one per cluster read the same postings.
    posted = kmers.postings(rows, settings.k, keep=["cluster", "total_expr"])
    posted = settle(posted)
    limbs = Limbs.of(rows, "total_expr")
    index = settle(kmers.kmer_index(posted, limbs=limbs))
    by_cluster = kmers.kmer_index(posted, by=["cluster"], limbs=limbs)
    selected = settle(primers.select_primers(index, settings.top_global))
    best = settle(primers.top_cluster_primers(by_cluster, n=settings.top_cluster))
    out |= {
        "primer_candidates": primers.primer_candidates(index, primers.primer_rows(posted, rows)),
        "selected_primers": selected,
        "selected_primer_rows": primers.selected_rows(selected, rows, settings.k),
        "cluster_primer_rows": primers.cluster_rows_covered(best, rows, settings.k),
        "cluster_primers": best,
    }
    wanted = selected.select("primer").unionAll(search.pending(best.select("primer").distinct(), selected))
    covered = settle(primers.rows_covered(settle(wanted), rows, settings.k))
    out["primer_rows"] = primers.row_lists(primers.primer_rows(
        covered.withColumnRenamed("primer", "kmer"), rows
    ))
    if genome is not None:
        hits = settle(search.search_primers(wanted, genome))
        out |= {
            "primer_hits": hits if settings.max_hits is None else search.cap_hits(hits, settings.max_hits),
            "primer_hit_summary": search.hit_summary(wanted, hits, settings.max_hits),
            "primer_hits_by_contig": search.hits_by_contig(hits),
            "primer_row_hits": search.primer_row_hits(covered.join(selected.select("primer"), "primer"), rows, hits),
        }

    out |= _alignments(rows.withColumn("grp", F.lit(family)), "family", settings)
    out |= _alignments(rows.withColumn("grp", F.col("cluster")), "cluster", settings)
    return out


def _alignments(rows: DataFrame, level: str, settings: Settings) -> dict[str, DataFrame]:
    """Alignment, profile, consensus and their cleaned forms for one way of grouping."""
    placed = settle(
        align.anchor_align(rows, settings.anchor_k, ["grp"]).select("grp", F.col("row_id").alias("seq_id"), F.col("aligned").alias("seq"))
    )
    cleaned, removed = align.clean_alignment(placed)
    return {
        f"{level}_alignment": placed,
        f"{level}_alignment_profile": align.alignment_profile(placed),
        f"{level}_consensus": align.consensus(placed),
        f"{level}_consensus_summary": align.consensus_summary(placed),
        f"{level}_cleaned_consensus": align.cleaned_summary(cleaned),
        f"{level}_cleaning_log": removed,
    }


def run(
    spark: SparkSession, annotations: str, family: str, out: str, genome: str | None = None,
    settings: Settings | None = None,
) -> dict[str, DataFrame]:
    """Read the inputs, analyse, and write every table as parquet and the sequences as FASTA below ``out``."""
    settings = settings or Settings()
    chunks = settle(fasta.read_fasta(spark, genome, overlap=settings.k - 1)) if genome else None
    found = analyse(tables.read_annotations(spark, annotations), family, chunks, settings)
    for name, table in found.items():
        tables.write_table(table, f"{out}/{name}")
    fasta.write_fasta(fasta.to_fasta(found["rows"]), f"{out}/sequences_fasta")
    fasta.write_fasta(fasta.combine_fasta(found["cluster_consensus"], family, "grp"), f"{out}/consensus_fasta")
    return found
