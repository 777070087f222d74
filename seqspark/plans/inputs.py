"""The given tables in the roles the operators need, as DataFrames and as SQL of the same meaning.

The SQL is written independently of the operators; the oracle runs it on the parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqspark.operators.filters import with_total_expr
from seqspark.operators.kmers import positions
from seqspark.operators.ordering import with_row_id
from seqspark.functions.sequence import LOWER, UPPER, fold_case
from seqspark.session import width
from seqspark.sources.genome import chunk_table

K = 18
CHUNK = 4096

DOCUMENT_SAMPLES = ["A1_size_r1", "B1_mark_r1", "B2_mark_r2"]
LINE_SAMPLES = ["A1_gross_r1", "B1_qty_r1", "C1_rate_r1", "C2_rate_r2"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table whose files hold fewer splits than there are cores; a large one is left alone."""
    small = df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(width(df.sparkSession), key) if small else df


# --- sequences ---------------------------------------------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as sequences with three expression columns; marks are missing for most rows."""
    marks = table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("B1_mark_r1"), F.col("toxic").alias("B2_mark_r2")
    )
    docs = spread(table(spark, sf, "documents"), "doc_id").join(marks, "doc_id", "left")
    return with_total_expr(docs.withColumn("A1_size_r1", F.col("n_chars")), DOCUMENT_SAMPLES).select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("seq"), F.col("lang").alias("cluster"),
        F.col("source").alias("TE_name"), F.col("doc_id").cast("string").alias("chr"),
        F.lit(0).cast("bigint").alias("start"), F.col("n_chars").alias("stop"), F.lit("+").alias("strand"),
        *DOCUMENT_SAMPLES, "total_expr",
    )


def upper_sql(column: str) -> str:
    return f"translate({column}, '{LOWER}', '{UPPER}')"


DOCUMENTS_SQL = f"""
docs AS (
  SELECT d.doc_id AS row_id, {upper_sql('d.text')} AS seq, d.lang AS cluster, d.source AS te_name,
         CAST(d.doc_id AS VARCHAR) AS chr, 0 AS start, d.n_chars AS stop,
         CAST(COALESCE(d.n_chars, 0) + COALESCE(l.quality, 0) + COALESCE(l.toxic, 0) AS DOUBLE) AS total_expr
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def chats(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as sequences with a dense row id; the role gives the cluster, system is noise."""
    turns = with_row_id(table(spark, sf, "conversations"), ["conv_id", "turn"])
    return turns.select(
        "row_id", F.col("text").alias("seq"), F.col("role").alias("TE_name"),
        F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(-1).alias("cluster"),
        F.col("conv_id").cast("string").alias("chr"), F.col("turn").alias("start"),
        (F.col("turn") + F.length("text")).alias("stop"), F.lit("+").alias("strand"),
        F.length("text").cast("double").alias("total_expr"),
    )


CHATS_SQL = f"""
chats AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id, {upper_sql('text')} AS seq, role AS te_name,
         CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE -1 END AS cluster,
         CAST(conv_id AS VARCHAR) AS chr, turn AS start, turn + length(text) AS stop,
         CAST(length(text) AS DOUBLE) AS total_expr
  FROM conversations)"""


def kmers_sql(source: str, keep: str, k: int = K, name: str = "kmers") -> str:
    """Positions of all k-mers of ``source.seq``; cut into pieces first, as DuckDB's substr scans too."""
    return f"""
{name}_cut AS (SELECT {keep}, seq, unnest(range(0, length(seq), 256)) AS p0 FROM {source}),
{name}_piece AS (SELECT {keep}, p0, substr(seq, p0 + 1, {256 + k - 1}) AS piece FROM {name}_cut),
{name}_at AS (SELECT {keep}, p0, piece, unnest(range(0, least(256, length(piece) - {k - 1}))) AS i FROM {name}_piece
  WHERE length(piece) >= {k}),
{name} AS (SELECT {keep}, p0 + i AS pos, substr(piece, i + 1, {k}) AS kmer FROM {name}_at)"""


def index_sql(source: str, by: str = "", k: int = K) -> str:
    """`postings` and `idx`: the k-mer index of ``source`` with ``row_id``, ``total_expr``, ``by``."""
    also = f"{by}, " if by else ""
    return f"""{kmers_sql(source, f'{also}row_id, total_expr', k)},
postings AS (SELECT {also}row_id, total_expr, kmer, min(pos) AS pos FROM kmers
  WHERE NOT contains(kmer, 'N') GROUP BY ALL),
idx AS (SELECT {also}kmer AS primer, count(*) AS coverage, fsum(total_expr) AS total_expr,
  min(row_id) AS first_row, arg_min(pos, row_id) AS first_pos FROM postings GROUP BY ALL)"""


BY_COVERAGE_SQL = "coverage DESC, total_expr DESC, first_row, first_pos, primer"
BY_EXPRESSION_SQL = "total_expr DESC, coverage DESC, first_row, first_pos, primer"

SELECTED_SQL = f"""
top_cov AS (SELECT *, row_number() OVER (ORDER BY {BY_COVERAGE_SQL}) AS rank FROM idx ORDER BY {BY_COVERAGE_SQL} LIMIT 8),
top_expr AS (SELECT *, row_number() OVER (ORDER BY {BY_EXPRESSION_SQL}) AS rank FROM idx ORDER BY {BY_EXPRESSION_SQL} LIMIT 8),
selected AS (SELECT primer, coverage, total_expr, first_row, first_pos,
    CASE WHEN min(place) <= 8 THEN 'cov_then_expr' ELSE 'expr_then_cov' END AS strategy, min(place) AS place
  FROM (SELECT primer, coverage, total_expr, first_row, first_pos, rank AS place FROM top_cov
        UNION ALL SELECT primer, coverage, total_expr, first_row, first_pos, rank + 8 FROM top_expr)
  GROUP BY ALL)"""


# --- genome, intervals, probes -----------------------------------------------------------------


def genome(spark: SparkSession, sf: str, chunk: int = CHUNK, overlap: int = K - 1) -> DataFrame:
    """Every document is a contig."""
    return chunk_table(spread(table(spark, sf, "documents"), "doc_id"), "doc_id", "text", "doc_id", chunk, overlap)


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Events as intervals on documents; some are negative, empty, off the end, or on no known contig."""
    start = (F.floor(F.col("value") * 20) - 5).cast("bigint")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"),
        (F.col("user_id") * 10).cast("string").alias("chr"),
        start.alias("start"),
        (start + F.col("event_id") % 97).alias("stop"),
    )


INTERVALS_SQL = f"""
ann AS (
  SELECT event_id AS row_id, CAST(user_id * 10 AS VARCHAR) AS chr, CAST(floor(value * 20) - 5 AS BIGINT) AS start,
         CAST(floor(value * 20) - 5 AS BIGINT) + event_id % 97 AS stop FROM events),
contig AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, doc_id, {upper_sql('text')} AS seq, length(text) AS len FROM documents),
checked AS (
  SELECT a.*, c.seq AS whole,
    CASE WHEN start IS NULL OR stop IS NULL THEN 'missing coordinate'
         WHEN start < 0 OR stop < 0 THEN 'negative coordinate'
         WHEN stop <= start THEN 'stop not after start'
         WHEN c.len IS NULL THEN 'unknown contig'
         WHEN stop > c.len THEN 'stop beyond contig' END AS reason
  FROM ann a LEFT JOIN contig c ON a.chr = c.chrom)"""


def probes(spark: SparkSession, sf: str) -> DataFrame:
    """All 18-mers of the benchmark texts, with their rows: ``(row_id, primer, pos)``."""
    items = spread(table(spark, sf, "benchmark"), "item_id").select(
        F.col("item_id").alias("row_id"), fold_case("text").alias("seq")
    )
    return positions(items, K, "seq", ["row_id"]).select("row_id", F.col("kmer").alias("primer"), "pos")


PROBES_SQL = f"""
items AS (SELECT item_id AS row_id, {upper_sql('text')} AS seq FROM benchmark),
{kmers_sql('items', 'row_id', K, 'probe_kmers').strip()},
probes AS (SELECT DISTINCT kmer AS primer FROM probe_kmers)"""


def search_sql(primers: str, contigs: str = "contig") -> str:
    """`hits` of the primers on the contigs ``(chrom, doc_id, seq)``."""
    return f"""{kmers_sql(contigs, 'chrom, doc_id', K, 'sites')},
strands AS (SELECT DISTINCT primer, primer AS probe, '+' AS strand FROM {primers}
  UNION ALL SELECT DISTINCT primer, reverse(translate(primer, 'ACGTacgt', 'TGCAtgca')), '-' FROM {primers}),
hits AS (SELECT primer, chrom, doc_id AS chrom_idx, pos + 1 AS start, pos + {K} AS stop, strand
  FROM sites JOIN strands ON kmer = probe)"""


CONTIG_SQL = f"""
contig AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, doc_id, {upper_sql('text')} AS seq, length(text) AS len FROM documents)"""


# --- expression --------------------------------------------------------------------------------


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as rows with four expression columns; flag N is noise."""
    return spread(table(spark, sf, "lineitem"), "l_orderkey").select(
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).otherwise(-1).alias("cluster"),
        F.col("l_extendedprice").alias("A1_gross_r1"), F.col("l_quantity").alias("B1_qty_r1"),
        F.col("l_discount").alias("C1_rate_r1"), F.col("l_tax").alias("C2_rate_r2"),
    )


LINES_SQL = """
lines AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE -1 END AS cluster,
         l_extendedprice AS A1_gross_r1, l_quantity AS B1_qty_r1, l_discount AS C1_rate_r1, l_tax AS C2_rate_r2
  FROM lineitem)"""


# --- alignments --------------------------------------------------------------------------------


def aligned_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as ragged alignment rows: everything that is no letter is a gap."""
    return spread(table(spark, sf, "documents"), "doc_id").select(
        F.col("lang").alias("grp"), F.col("doc_id").alias("seq_id"),
        F.regexp_replace(fold_case("text"), "(?s)[^A-Z]", "-").alias("seq"),
    )


def aligned_chats(spark: SparkSession, sf: str) -> DataFrame:
    """Whole conversation turns as ragged alignment rows, grouped by role."""
    return chats(spark, sf).select(
        F.col("TE_name").alias("grp"), F.col("row_id").alias("seq_id"),
        F.regexp_replace(fold_case("seq"), "(?s)[^A-Z]", "-").alias("seq"),
    )


ALIGNED_DOCUMENTS_SQL = f"""
aln AS (SELECT lang AS grp, doc_id AS seq_id, regexp_replace({upper_sql('text')}, '[^A-Z]', '-', 'g') AS seq
  FROM documents)"""

ALIGNED_CHATS_SQL = f"""{CHATS_SQL},
aln AS (SELECT te_name AS grp, row_id AS seq_id, regexp_replace(seq, '[^A-Z]', '-', 'g') AS seq FROM chats)"""


def cells_sql(source: str = "aln", name: str = "cell", gaps: bool = False) -> str:
    """Cells of alignment rows ``(grp, seq_id, seq)``."""
    return f"""
{name}_all AS (SELECT grp, seq_id, unnest(string_split(seq, '')) AS base,
    unnest(range(0, length(seq))) AS col FROM {source} WHERE length(seq) > 0),
{name} AS (SELECT grp, seq_id, col, base FROM {name}_all {'' if gaps else "WHERE base <> '-'"})"""


def sizes_sql(source: str = "aln", name: str = "size") -> str:
    return f"""
{name} AS (SELECT grp, count(*) AS n, max(length(seq)) AS width FROM {source} GROUP BY grp),
{name}_axis AS (SELECT grp, n, unnest(range(0, width)) AS col FROM {name})"""


def consensus_sql(share: float, cell: str = "cell", size: str = "size", name: str = "cons") -> str:
    """`<name>_col` per column and `<name>` per group."""
    return f"""
{name}_cnt AS (SELECT grp, col, base, count(*) AS n, min(seq_id) AS f FROM {cell} GROUP BY ALL),
{name}_best AS (SELECT grp, col, base, n, sum(n) OVER (PARTITION BY grp, col) AS total,
    row_number() OVER (PARTITION BY grp, col ORDER BY n DESC, f) AS r FROM {name}_cnt),
{name}_col AS (SELECT a.grp, a.col, CASE WHEN b.n >= b.total * {share} THEN b.base ELSE 'N' END AS base
  FROM {size}_axis a LEFT JOIN {name}_best b ON a.grp = b.grp AND a.col = b.col AND b.r = 1),
{name} AS (SELECT grp, string_agg(base, '' ORDER BY col) AS consensus FROM {name}_col GROUP BY grp)"""
