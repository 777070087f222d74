"""Queries: k-mers, primers, intervals and genome search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqspark.operators import intervals, kmers, primers, sampling, search
from seqspark.operators.exact import Limbs
from seqspark.plans import inputs as i
from seqspark.plans.registry import query
from seqspark.session import settle

# --- k-mers ------------------------------------------------------------------------------------


def _document_index(spark: SparkSession, sf: str, by: tuple[str, ...] = ()) -> DataFrame:
    docs = i.documents(spark, sf)
    posted = kmers.binned_postings(docs, i.K, keep=[*by, "total_expr"])
    return kmers.kmer_index(posted, by=by, limbs=Limbs.of(docs, "total_expr"))


def _chat_index(spark: SparkSession, sf: str, by: tuple[str, ...] = ()) -> DataFrame:
    chats = i.chats(spark, sf)
    return kmers.kmer_index(kmers.postings(chats, i.K, keep=[*by, "total_expr"]), by=by, limbs=Limbs.of(chats, "total_expr"))


@query("kmer_index", f"""
WITH {i.CHATS_SQL}, {i.index_sql('chats')} SELECT * FROM idx""")
def kmer_index(spark: SparkSession, sf: str) -> DataFrame:
    return _chat_index(spark, sf)


@query("cluster_kmer_index", f"""
WITH {i.CHATS_SQL}, {i.index_sql('chats', 'cluster')} SELECT * FROM idx""")
def cluster_kmer_index(spark: SparkSession, sf: str) -> DataFrame:
    return _chat_index(spark, sf, ("cluster",))


@query("kmer_counts", f"""
WITH {i.CHATS_SQL}, low AS (SELECT row_id, translate(seq, '{i.UPPER}', '{i.LOWER}') AS seq FROM chats),
{i.kmers_sql('low', 'row_id')} SELECT row_id, kmer, count(*) AS n FROM kmers GROUP BY ALL""")
def kmer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.kmer_counts(i.chats(spark, sf), i.K)


@query("kmer_vocabulary", f"""
WITH {i.DOCUMENTS_SQL}, {i.kmers_sql('docs', 'row_id')}
SELECT count(DISTINCT kmer) FILTER (NOT contains(kmer, 'N')) AS unique_kmers, count(DISTINCT kmer) AS vocabulary FROM kmers""")
def kmer_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    docs = i.spread(i.table(spark, sf, "documents"), "doc_id")
    return kmers.kmer_vocabulary(docs, i.K, "text")


# --- primers -----------------------------------------------------------------------------------

_TOP = ["rank", "primer", "coverage", "total_expr"]


@query("top_by_coverage", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs')}
SELECT row_number() OVER (ORDER BY {i.BY_COVERAGE_SQL}) AS rank, primer, coverage, total_expr
FROM idx ORDER BY {i.BY_COVERAGE_SQL} LIMIT 8""")
def top_by_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return primers.top_primers(_document_index(spark, sf), primers.coverage_order()).select(*_TOP)


@query("top_by_expression", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs')}
SELECT row_number() OVER (ORDER BY {i.BY_EXPRESSION_SQL}) AS rank, primer, coverage, total_expr
FROM idx ORDER BY {i.BY_EXPRESSION_SQL} LIMIT 8""")
def top_by_expression(spark: SparkSession, sf: str) -> DataFrame:
    return primers.top_primers(_document_index(spark, sf), primers.expression_order()).select(*_TOP)


@query("selected_primers", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs')}, {i.SELECTED_SQL}
SELECT primer, coverage, total_expr, first_row, first_pos, strategy, row_number() OVER (ORDER BY place) AS place
FROM selected""")
def selected_primers(spark: SparkSession, sf: str) -> DataFrame:
    return primers.select_primers(_document_index(spark, sf))


@query("cluster_top_primers", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs', 'cluster')}
SELECT cluster, rank, primer, coverage, total_expr FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {i.BY_COVERAGE_SQL}) AS rank FROM idx) WHERE rank <= 5""")
def cluster_top_primers(spark: SparkSession, sf: str) -> DataFrame:
    found = primers.top_cluster_primers(_document_index(spark, sf, ("cluster",)))
    return found.select("cluster", *_TOP)


@query("rank_kmers", f"""
WITH {i.CHATS_SQL}, {i.index_sql('chats')}
SELECT primer, coverage, total_expr, row_number() OVER (ORDER BY {i.BY_COVERAGE_SQL}) AS rank_by_cov_expr,
  row_number() OVER (ORDER BY {i.BY_EXPRESSION_SQL}) AS rank_by_expr_cov FROM idx""")
def rank_kmers(spark: SparkSession, sf: str) -> DataFrame:
    return primers.rank_kmers(kmer_index(spark, sf)).select(
        "primer", "coverage", "total_expr", "rank_by_cov_expr", "rank_by_expr_cov"
    )


_LINES_SQL = f"""
WITH {i.CHATS_SQL}, {i.index_sql('chats')},
listed AS (SELECT kmer AS primer, row_id, chr || ':' || start || '-' || stop AS coordinates
  FROM postings JOIN chats USING (row_id))"""


@query("primer_rows", f"{_LINES_SQL} SELECT primer, row_id, coordinates FROM listed")
def primer_rows(spark: SparkSession, sf: str) -> DataFrame:
    chats = i.chats(spark, sf)
    return primers.primer_rows(kmers.postings(chats, i.K), chats).select("primer", "row_id", "coordinates")


@query("primer_row_lists", f"""{_LINES_SQL}
SELECT primer, row_id // 10000 AS part, count(*) AS rows,
  string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) AS rows_covered,
  string_agg(coordinates, ',' ORDER BY row_id) AS rows_coordinates FROM listed GROUP BY ALL""")
def primer_row_lists(spark: SparkSession, sf: str) -> DataFrame:
    return primers.row_lists(primer_rows(spark, sf))


_LISTS_SQL = """count(*) AS rows, string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) AS rows_covered,
  string_agg(coordinates, ',' ORDER BY row_id) AS rows_coordinates"""


@query("primer_candidates", f"""{_LINES_SQL},
lists AS (SELECT primer, row_id // 10000 AS part, {_LISTS_SQL} FROM listed GROUP BY ALL),
ranked AS (SELECT primer, coverage, total_expr, row_number() OVER (ORDER BY {i.BY_COVERAGE_SQL}) AS rank_by_cov_expr,
  row_number() OVER (ORDER BY {i.BY_EXPRESSION_SQL}) AS rank_by_expr_cov FROM idx)
SELECT * FROM ranked JOIN lists USING (primer)""")
def primer_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """All k-mers of conversation turns with scores, both ranks, covered rows and coordinates."""
    chats = settle(i.chats(spark, sf))
    posted = settle(kmers.postings(chats, i.K, keep=["total_expr"]))
    index = kmers.kmer_index(posted, limbs=Limbs.of(chats, "total_expr"))
    return primers.primer_candidates(index, primers.primer_rows(posted, chats))


_DOCUMENT_ROWS_SQL = """labelled AS (SELECT row_id, cluster, chr || ':' || start || '-' || stop AS coordinates FROM docs)"""


@query("selected_primer_rows", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs')}, {i.SELECTED_SQL}, {_DOCUMENT_ROWS_SQL},
lists AS (SELECT kmer AS primer, row_id // 10000 AS part, {_LISTS_SQL}
  FROM postings JOIN selected ON kmer = primer JOIN labelled USING (row_id) GROUP BY ALL)
SELECT s.place, primer, coverage, total_expr, strategy, part, rows, rows_covered, rows_coordinates
FROM (SELECT primer, coverage, total_expr, strategy, row_number() OVER (ORDER BY place) AS place FROM selected) s
JOIN lists USING (primer)""")
def selected_primer_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Selected primers of the documents with the documents they cover."""
    docs = i.documents(spark, sf)
    return primers.selected_rows(settle(primers.select_primers(_document_index(spark, sf))), docs, i.K)


@query("cluster_primer_rows", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs', 'cluster')}, {_DOCUMENT_ROWS_SQL},
best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {i.BY_COVERAGE_SQL}) AS rank FROM idx) WHERE rank <= 5),
lists AS (SELECT p.cluster, kmer AS primer, row_id // 10000 AS part, {_LISTS_SQL}
  FROM postings p JOIN best b ON p.kmer = b.primer AND p.cluster = b.cluster JOIN labelled USING (row_id) GROUP BY ALL)
SELECT b.cluster, rank, b.primer, coverage, total_expr, part, rows, rows_covered, rows_coordinates
FROM best b JOIN lists l ON b.cluster = l.cluster AND b.primer = l.primer""")
def cluster_primer_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The best primers of each language with the documents of that language they cover."""
    best = settle(primers.top_cluster_primers(_document_index(spark, sf, ("cluster",))))
    return primers.cluster_rows_covered(best, i.documents(spark, sf), i.K)


# --- intervals ---------------------------------------------------------------------------------

@query("interval_validity", f"""
WITH {i.INTERVALS_SQL} SELECT row_id, chr, start, stop, reason FROM checked""")
def interval_validity(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.validate_intervals(i.intervals(spark, sf), i.genome(spark, sf)).select(
        "row_id", "chr", "start", "stop", "reason"
    )


@query("extract_sequences", f"""
WITH {i.INTERVALS_SQL} SELECT row_id, reason,
  CASE WHEN reason IS NULL THEN substr(whole, start + 1, stop - start) ELSE repeat('N', 100) END AS seq FROM checked""")
def extract_sequences(spark: SparkSession, sf: str) -> DataFrame:
    found = intervals.extract_sequences(i.intervals(spark, sf), i.genome(spark, sf))
    return found.select("row_id", "reason", "seq")


@query("extraction_errors", f"""
WITH {i.INTERVALS_SQL}
SELECT row_id, reason, 'Row ' || row_id || ': ' || chr || ':' || start || '-' || stop || ' - ValueError: ' ||
  CASE reason WHEN 'negative coordinate' THEN 'Invalid coordinates: start=' || start || ', stop=' || stop
    WHEN 'stop not after start' THEN 'stop (' || stop || ') must be > start (' || start || ')'
    ELSE 'Could not extract ' || chr || ':' || start || '-' || stop || ' from genome' END AS message
FROM checked WHERE reason IS NOT NULL""")
def extraction_errors(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.extraction_errors(i.intervals(spark, sf), i.genome(spark, sf))


@query("extraction_counts", f"""
WITH {i.INTERVALS_SQL} SELECT coalesce(reason, 'ok') AS outcome, count(*) AS rows FROM checked GROUP BY ALL""")
def extraction_counts(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.extraction_counts(intervals.validate_intervals(i.intervals(spark, sf), i.genome(spark, sf)))


# --- genome search -----------------------------------------------------------------------------

_SEARCH_SQL = f"WITH {i.PROBES_SQL}, {i.CONTIG_SQL}, {i.search_sql('probes')}"


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return search.search_primers(i.probes(spark, sf), i.genome(spark, sf))


@query("primer_search", f"{_SEARCH_SQL} SELECT * FROM hits")
def primer_search(spark: SparkSession, sf: str) -> DataFrame:
    """Every 18-mer of the benchmark texts on both strands of every document."""
    return _hits(spark, sf)


@query("capped_hits", f"""{_SEARCH_SQL}
SELECT primer, chrom, chrom_idx, start, stop, strand FROM (
  SELECT *, row_number() OVER (PARTITION BY primer ORDER BY chrom_idx, strand, start) AS r FROM hits) WHERE r <= 1""")
def capped_hits(spark: SparkSession, sf: str) -> DataFrame:
    return search.cap_hits(settle(_hits(spark, sf)), 1)


@query("hit_summary", f"""{_SEARCH_SQL}
SELECT primer, count(chrom) AS genome_hits, false AS estimated, count(chrom) AS estimated_total,
  count(chrom) > 10000 AS capped FROM probes LEFT JOIN hits USING (primer) GROUP BY primer""")
def hit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return search.hit_summary(i.probes(spark, sf), _hits(spark, sf))


@query("hits_by_contig", f"""{_SEARCH_SQL}
SELECT primer, chrom, chrom_idx, count(*) AS hits,
  CAST(sum(count(*)) OVER (PARTITION BY primer ORDER BY chrom_idx) AS BIGINT) AS running_total
FROM hits GROUP BY primer, chrom, chrom_idx""")
def hits_by_contig(spark: SparkSession, sf: str) -> DataFrame:
    return search.hits_by_contig(_hits(spark, sf))


@query("pending_primers", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs')}, {i.SELECTED_SQL}, {i.index_sql('docs', 'cluster').replace('kmers', 'ckmers').replace('postings', 'cpostings').replace('idx', 'cidx')}
SELECT DISTINCT primer FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {i.BY_COVERAGE_SQL}) AS rank FROM cidx) WHERE rank <= 5
  AND primer NOT IN (SELECT primer FROM selected)""")
def pending_primers(spark: SparkSession, sf: str) -> DataFrame:
    """The best primers of each cluster that are not among the globally selected ones."""
    best = primers.top_cluster_primers(_document_index(spark, sf, ("cluster",))).select("primer").distinct()
    return search.pending(best, primers.select_primers(_document_index(spark, sf)))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return i.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("row_id"), F.col("item_id").cast("string").alias("chr"),
        F.lit(0).cast("bigint").alias("start"), F.length("text").cast("bigint").alias("stop"), F.lit("+").alias("strand"),
    )


@query("primer_row_hits", f"""{_SEARCH_SQL}
SELECT primer, b.row_id AS seq_row, CAST(b.row_id AS VARCHAR) AS row_chr, CAST(0 AS BIGINT) AS row_start, length(b.seq) AS row_stop,
  '+' AS row_strand, chrom AS genome_chr, start AS genome_start, stop AS genome_stop, strand AS genome_strand
FROM (SELECT DISTINCT row_id, kmer AS primer FROM probe_kmers) p JOIN items b USING (row_id) JOIN hits USING (primer)""")
def primer_row_hits(spark: SparkSession, sf: str) -> DataFrame:
    lines = i.probes(spark, sf).select("primer", "row_id").distinct()
    return search.primer_row_hits(lines, _items(spark, sf), _hits(spark, sf))


@query("primer_row_overlap", f"""
WITH {i.DOCUMENTS_SQL}, {i.index_sql('docs')}, {i.SELECTED_SQL}, {i.CONTIG_SQL},
{i.search_sql('selected')}
SELECT h.primer, p.row_id AS seq_row, h.chrom AS row_chr, CAST(0 AS BIGINT) AS row_start, d.stop AS row_stop, '+' AS row_strand,
  h.chrom AS genome_chr, h.start AS genome_start, h.stop AS genome_stop, h.strand AS genome_strand
FROM postings p JOIN docs d USING (row_id) JOIN hits h ON h.primer = p.kmer AND h.chrom = d.chr
WHERE d.start < h.stop AND h.start <= d.stop""")
def primer_row_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Selected primers: hits inside the very documents that the primer covers."""
    docs = i.documents(spark, sf)
    chosen = settle(primers.select_primers(_document_index(spark, sf)).select("primer"))
    hits = search.search_primers(chosen, i.genome(spark, sf))
    return search.primer_row_hits(primers.rows_covered(chosen, docs, i.K), docs, hits, overlap=True)


# --- sampling ----------------------------------------------------------------------------------

_ELIGIBLE_SQL = f"""{i.CONTIG_SQL},
eligible AS (SELECT chrom, doc_id, seq, len FROM contig ORDER BY doc_id LIMIT 24),
sampled AS (SELECT chrom, doc_id, seq, len FROM eligible ORDER BY md5(chrom || ':42'), chrom LIMIT 5)"""


@query("eligible_contigs", f"""
WITH {_ELIGIBLE_SQL} SELECT chrom, doc_id AS chrom_idx, len AS chrom_len FROM eligible""")
def eligible_contigs(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.eligible_contigs(i.genome(spark, sf))


@query("sample_contigs", f"""
WITH {_ELIGIBLE_SQL} SELECT chrom, doc_id AS chrom_idx, len AS chrom_len FROM sampled""")
def sample_contigs(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_contigs(i.genome(spark, sf))


@query("estimate_hits", f"""
WITH {_ELIGIBLE_SQL}, words AS (SELECT DISTINCT kmer AS primer FROM ec),
{i.search_sql('words', 'sampled')}
SELECT w.primer, count(h.chrom) AS sample_hits,
  CAST(floor(count(h.chrom) * (3100000000.0::DOUBLE / (SELECT sum(len) FROM sampled))) AS BIGINT) AS estimated_total,
  'Estimated from ' || (SELECT count(*) FROM sampled) || ' chromosomes (seed=42)' AS sampling_note
FROM words w LEFT JOIN hits h USING (primer) GROUP BY w.primer""".replace(
    "words AS", i.kmers_sql("eligible", "doc_id", i.K, "ec").strip() + ",\nwords AS"))
def estimate_hits(spark: SparkSession, sf: str) -> DataFrame:
    """All 18-mers of the eligible contigs, searched on the sampled ones only."""
    genome = i.genome(spark, sf)
    chosen = genome.join(F.broadcast(sampling.eligible_contigs(genome).select("chrom")), "chrom", "left_semi")
    words = kmers.positions(chosen, i.K, "seq").select(F.col("kmer").alias("primer"))
    return sampling.estimate_hits(words, genome)
