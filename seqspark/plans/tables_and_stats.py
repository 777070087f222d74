"""Queries: sources, filters, features and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqspark.functions.sequence import reverse_complement as reversed_strand
from seqspark.operators import filters, stats
from seqspark.operators.exact import Limbs
from seqspark.operators.ordering import with_row_id
from seqspark.plans import inputs as i
from seqspark.plans.registry import query
from seqspark.session import scratch_path
from seqspark.sources import fasta, tables


def _round(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources -----------------------------------------------------------------------------------

_LETTERS = "regexp_replace(text, '[^A-Za-z]', '', 'g')"


def _letters(spark: SparkSession, sf: str) -> DataFrame:
    return i.spread(i.table(spark, sf, "documents"), "doc_id").select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("TE_name"), F.col("lang").alias("cluster"),
        F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"),
    )


@query("fasta_records", f"""
SELECT row_id, '>row' || row_id || '|' || substr(te_name, 1, 50) || '|cluster' || cluster
   || CASE WHEN length(seq) > 0 THEN chr(10) ELSE '' END
   || regexp_replace(regexp_replace(seq, '(.{{80}})', '\\1' || chr(10), 'g'), '\\n$', '') AS record
FROM (SELECT doc_id AS row_id, source AS te_name, lang AS cluster, {i.upper_sql(_LETTERS)} AS seq FROM documents)""")
def fasta_records(spark: SparkSession, sf: str) -> DataFrame:
    return fasta.to_fasta(_letters(spark, sf))


@query("fasta_scan", f"""
WITH t AS (SELECT 'row' || doc_id || '|' || source || '|cluster' || lang AS chrom,
    row_number() OVER (ORDER BY doc_id) - 1 AS chrom_idx, {i.upper_sql(_LETTERS)} AS seq FROM documents),
c AS (SELECT *, unnest(range(0, greatest(length(seq), 1), 1000)) AS chunk_start FROM t)
SELECT chrom, chrom_idx, chunk_start, substr(seq, chunk_start + 1, 1017) AS seq,
   CAST(least(1000, length(seq) - chunk_start) AS INTEGER) AS owned, length(seq) AS chrom_len FROM c""")
def fasta_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Write all documents as FASTA in id order and scan the files back into chunks."""
    path = scratch_path(spark, "fasta")
    fasta.write_fasta(fasta.to_fasta(_letters(spark, sf)).orderBy("row_id"), path)
    return fasta.read_fasta(spark, path, chunk=1000, overlap=17)


_ANNOTATED = T.StructType([
    T.StructField("row_id", T.LongType()), T.StructField("chr", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("stop", T.LongType()), T.StructField("TE_name", T.StringType()), T.StructField("A1_price_r1", T.DoubleType()),
])


@query("annotation_csv", """
SELECT p_partkey AS row_id, 'chr' || p_size AS chr, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS start,
  p_size + length(p_name) AS stop, p_name || ', "' || p_type || '"' AS TE_name, p_retailprice AS A1_price_r1,
  p_partkey % 7 = 0 AS rejected FROM part""")
def annotation_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Parts written as an annotation CSV, every seventh with a start that is no number, and read back by a schema."""
    part = i.table(spark, sf, "part")
    size = F.col("p_size").cast("string")
    written = part.select(
        F.col("p_partkey").alias("row_id"), F.concat(F.lit("chr"), size).alias("chr"),
        F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("about "), size)).otherwise(size).alias("start"),
        (F.col("p_size") + F.length("p_name")).alias("stop"),
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias("TE_name"), F.col("p_retailprice").alias("A1_price_r1"),
    )
    path = scratch_path(spark, "annotations")
    tables.write_csv(written, path)
    found = tables.read_checked(spark, path, _ANNOTATED)
    return found.select(*_ANNOTATED.names, F.col(tables.REJECTED).isNotNull().alias("rejected"))


@query("aligned_fasta", f"""
WITH {i.ALIGNED_CHATS_SQL}, w AS (SELECT max(length(seq)) AS width FROM aln)
SELECT seq_id, 'row' || seq_id || '|' || grp || '|cluster' || grp AS name, rpad(seq, CAST(width AS INTEGER), '-') AS seq FROM aln, w""")
def aligned_fasta(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as an alignment of one width, written as FASTA in id order and read back."""
    rows = i.aligned_chats(spark, sf)
    width = rows.agg(F.max(F.length("seq"))).scalar()
    padded = rows.select("seq_id", "grp", F.rpad("seq", width, F.lit("-")).alias("seq"))
    path = scratch_path(spark, "aligned-fasta")
    fasta.write_fasta(fasta.to_fasta(padded, "seq_id", "grp", "grp").orderBy("seq_id"), path)
    return fasta.read_alignment(spark, path)


@query("expression_columns", """
SELECT metric, round(total, 2) AS total FROM (
  SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS metric,
    unnest([sum(l_orderkey), sum(l_partkey), sum(l_suppkey), sum(l_linenumber), fsum(l_quantity), fsum(l_extendedprice),
      fsum(l_discount), fsum(l_tax)]) AS total FROM lineitem)""")
def expression_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of line items that count as expression, found by type, with their totals."""
    rows = i.table(spark, sf, "lineitem")
    names = filters.expression_columns(rows)
    limbs = Limbs.of(rows, *names)
    totals = rows.agg(*[limbs.sum(c).alias(c) for c in names])
    return _round(totals.unpivot([], names, "metric", "total"), ["total"], 2)


# --- filters and projections -------------------------------------------------------------------

@query("family_filter", """
SELECT p_partkey, p_name, p_type FROM part WHERE regexp_matches(p_name, 'wid|RING', 'i')""")
def family_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_family(i.table(spark, sf, "part"), "wid|RING", "p_name").select("p_partkey", "p_name", "p_type")


@query("family_filter_literal", """
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), lower('Red W'))""")
def family_filter_literal(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_family(i.table(spark, sf, "part"), "Red W", "p_name", literal=True).select("p_partkey", "p_name")


@query("family_names", """
SELECT name, (SELECT count(DISTINCT p_name) FROM part) AS distinct_names
FROM (SELECT DISTINCT p_name AS name FROM part WHERE p_name IS NOT NULL ORDER BY name LIMIT 20)""")
def family_names(spark: SparkSession, sf: str) -> DataFrame:
    return filters.family_names(i.table(spark, sf, "part"), "p_name")


@query("preview_count", """
SELECT count(*) AS matches FROM part
WHERE regexp_matches(concat_ws(',', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice), 'bolt|promo', 'i')""")
def preview_count(spark: SparkSession, sf: str) -> DataFrame:
    return filters.preview_count(i.table(spark, sf, "part"), "bolt|promo")


@query("seq_presence", """
SELECT count(*) AS rows, count(*) - count(l.quality) AS missing, count(*) = count(l.quality) AS all_present
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def seq_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Presence test on the column of marks, which is there for some documents only."""
    return filters.seq_presence(i.documents(spark, sf), "B1_mark_r1")


@query("seq_features", f"""
WITH {i.DOCUMENTS_SQL}
SELECT row_id, length(seq) AS length,
  round((length(seq) - length(translate(seq, 'GC', ''))) / nullif(length(seq), 0), 6) AS gc FROM docs""")
def seq_features(spark: SparkSession, sf: str) -> DataFrame:
    docs = i.documents(spark, sf).withColumn("seq", i.fold_case("seq"))
    return _round(stats.seq_features(docs).select("row_id", "length", "gc"), ["gc"], 6)


@query("reverse_complement", """
SELECT doc_id AS row_id, reverse(translate(text, 'ACGTacgt', 'TGCAtgca')) AS rc FROM documents""")
def reverse_complement(spark: SparkSession, sf: str) -> DataFrame:
    return i.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), reversed_strand("text").alias("rc"))


@query("row_ids", """
SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id FROM conversations""")
def row_ids(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_id(i.table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id", "turn"])


@query("total_expr", f"""
WITH {i.DOCUMENTS_SQL} SELECT row_id, total_expr FROM docs""")
def total_expr(spark: SparkSession, sf: str) -> DataFrame:
    return i.documents(spark, sf).select("row_id", "total_expr")


# --- statistics --------------------------------------------------------------------------------

def _describe_sql(value: str, source: str, by: str = "") -> str:
    also = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""
SELECT {also}count({value}) AS n, round(avg({value}), 4) AS mean, round(stddev_samp({value}), 4) AS sd,
  round(min({value}), 4) AS min, round(max({value}), 4) AS max,
  round(quantile_cont({value}, 0.25), 4) AS q1, round(quantile_cont({value}, 0.5), 4) AS median,
  round(quantile_cont({value}, 0.75), 4) AS q3 FROM {source}{group}"""


_STATS = ["mean", "sd", "min", "max", "q1", "median", "q3"]

_FEATURES_SQL = f"""
WITH {i.DOCUMENTS_SQL},
feat AS (SELECT *, CAST(length(seq) AS DOUBLE) AS length,
  (length(seq) - length(translate(seq, 'GC', ''))) / nullif(length(seq), 0) AS gc FROM docs)"""


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return stats.seq_features(i.documents(spark, sf).withColumn("seq", i.fold_case("seq")))


def _one_metric(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    return _round(stats.describe(_features(spark, sf), [metric]).select("n", *_STATS), _STATS)


@query("length_stats", _FEATURES_SQL + _describe_sql("length", "feat"))
def length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _one_metric(spark, sf, "length")


@query("gc_stats", _FEATURES_SQL + _describe_sql("gc", "feat"))
def gc_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _one_metric(spark, sf, "gc")


_LINES_LONG_SQL = f"""
WITH {i.LINES_SQL},
long AS (SELECT cluster, unnest(['A1_gross_r1', 'B1_qty_r1', 'C1_rate_r1', 'C2_rate_r2']) AS metric,
  unnest([A1_gross_r1, B1_qty_r1, C1_rate_r1, C2_rate_r2]) AS value FROM lines)"""


@query("expression_stats", f"""{_LINES_LONG_SQL}
SELECT metric, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd,
  min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 4) AS q1,
  round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3,
  count(*) FILTER (value > 0) AS nonzero, round(count(*) FILTER (value > 0) * 100.0 / count(*), 4) AS nonzero_pct
FROM long GROUP BY metric""")
def expression_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = stats.describe(i.lines(spark, sf), i.LINE_SAMPLES)
    return _round(found, ["mean", "sd", "q1", "median", "q3", "nonzero_pct"])


_TOTAL_SQL = "A1_gross_r1 + B1_qty_r1 + C1_rate_r1 + C2_rate_r2"


@query("total_expr_stats", f"""
WITH {i.LINES_SQL}, t AS (SELECT {_TOTAL_SQL} AS v FROM lines)
SELECT round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 4) AS median, round(stddev_samp(v), 4) AS sd,
  round(min(v), 4) AS min, round(max(v), 4) AS max FROM t""")
def total_expr_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.with_total_expr(i.lines(spark, sf), i.LINE_SAMPLES)
    names = ["mean", "median", "sd", "min", "max"]
    return _round(stats.describe(rows, ["total_expr"]).select(*names), names)


@query("expr_by_condition", f"""
WITH {i.LINES_SQL},
t AS (SELECT unnest(['gross', 'qty', 'rate']) AS condition, unnest([1, 1, 2]) AS replicates,
  unnest([A1_gross_r1, B1_qty_r1, C1_rate_r1 + C2_rate_r2]) AS v FROM lines)
SELECT condition, replicates, CAST(round(CAST(fsum(v) / count(v) AS DECIMAL(28, 8)), 4) AS DOUBLE) AS mean, round(quantile_cont(v, 0.5), 4) AS median,
  round(stddev_samp(v), 4) AS sd FROM t GROUP BY ALL""")
def expr_by_condition(spark: SparkSession, sf: str) -> DataFrame:
    return _round(stats.condition_stats(i.lines(spark, sf), i.LINE_SAMPLES), ["mean", "median", "sd"])


_CHAT_FEATURES_SQL = f"""{i.CHATS_SQL},
shape AS (SELECT cluster, CAST(length(seq) AS DOUBLE) AS length,
  (length(seq) - length(translate(seq, 'GC', ''))) / nullif(length(seq), 0) AS gc FROM chats)"""


def _chat_features(spark: SparkSession, sf: str) -> DataFrame:
    return i.chats(spark, sf).withColumn("seq", i.fold_case("seq"))


@query("cluster_stats", f"""{_LINES_LONG_SQL}, {_CHAT_FEATURES_SQL},
both_long AS (SELECT * FROM long
  UNION ALL SELECT cluster, 'total_expr', {_TOTAL_SQL} FROM lines
  UNION ALL SELECT cluster, 'length', length FROM shape UNION ALL SELECT cluster, 'gc', gc FROM shape)
SELECT cluster, metric, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd,
  min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 4) AS q1,
  round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3,
  count(*) FILTER (value > 0) AS nonzero, round(count(*) FILTER (value > 0) * 100.0 / count(*), 4) AS nonzero_pct
FROM both_long GROUP BY cluster, metric""")
def cluster_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Samples and totals of line items, length and gc of conversation turns, per cluster with noise."""
    lines = filters.with_total_expr(i.lines(spark, sf), i.LINE_SAMPLES)
    found = stats.describe(lines, [*i.LINE_SAMPLES, "total_expr"], ["cluster"])
    shape = stats.describe(stats.seq_features(_chat_features(spark, sf)), ["length", "gc"], ["cluster"])
    return _round(found.unionByName(shape), ["mean", "sd", "q1", "median", "q3", "nonzero_pct"])


@query("cluster_condition_stats", f"""
WITH {i.LINES_SQL},
t AS (SELECT cluster, unnest(['gross', 'qty', 'rate']) AS condition, unnest([1, 1, 2]) AS replicates,
  unnest([A1_gross_r1, B1_qty_r1, C1_rate_r1 + C2_rate_r2]) AS v FROM lines)
SELECT cluster, condition, replicates, CAST(round(CAST(fsum(v) / count(v) AS DECIMAL(28, 8)), 4) AS DOUBLE) AS mean,
  round(quantile_cont(v, 0.5), 4) AS median, round(stddev_samp(v), 4) AS sd FROM t GROUP BY ALL""")
def cluster_condition_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the condition sums per cluster with noise."""
    found = stats.condition_stats(i.lines(spark, sf), i.LINE_SAMPLES, ["cluster"])
    return _round(found, ["mean", "median", "sd"])


@query("cluster_summary", f"""{_FEATURES_SQL}
SELECT cluster, count(*) AS size, round(avg(length), 4) AS mean_length, round(quantile_cont(length, 0.5), 4) AS median_length,
  round(avg(gc), 4) AS mean_gc, round(quantile_cont(gc, 0.5), 4) AS median_gc,
  round(avg(total_expr), 4) AS mean_total_expr, round(quantile_cont(total_expr, 0.5), 4) AS median_total_expr,
  round(sum(total_expr), 4) AS sum_total_expr FROM feat GROUP BY cluster""")
def cluster_summary(spark: SparkSession, sf: str) -> DataFrame:
    docs = i.documents(spark, sf).withColumn("seq", i.fold_case("seq"))
    found = stats.cluster_summary(docs, "seq", i.DOCUMENT_SAMPLES)
    return _round(found, [c for c in found.columns if c not in ("cluster", "size")])


@query("cluster_comparison", f"""
WITH {i.LINES_SQL}, s AS (SELECT cluster, count(*) AS size FROM lines GROUP BY cluster)
SELECT cluster, size, round(size * 100.0 / (SELECT sum(size) FROM s), 4) AS share_pct,
  CAST((SELECT sum(size) FROM s) AS BIGINT) AS total, (SELECT count(*) FROM s WHERE cluster <> -1) AS n_clusters,
  CAST((SELECT coalesce(sum(size), 0) FROM s WHERE cluster = -1) AS BIGINT) AS noise FROM s""")
def cluster_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return _round(stats.cluster_comparison(i.lines(spark, sf)), ["share_pct"])


@query("cluster_sizes", f"""
WITH {i.LINES_SQL} SELECT cluster, count(*) AS size, cluster = -1 AS is_noise FROM lines GROUP BY cluster""")
def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return stats.cluster_sizes(i.lines(spark, sf))


@query("expression_matrix", f"""
WITH {i.LINES_SQL} SELECT cluster, round(avg(A1_gross_r1), 4) AS A1_gross_r1, round(avg(B1_qty_r1), 4) AS B1_qty_r1,
  round(avg(C1_rate_r1), 4) AS C1_rate_r1, round(avg(C2_rate_r2), 4) AS C2_rate_r2 FROM lines GROUP BY cluster""")
def expression_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _round(stats.expression_matrix(i.lines(spark, sf), i.LINE_SAMPLES), i.LINE_SAMPLES)


@query("condition_by_cluster", f"""
WITH {i.LINES_SQL},
t AS (SELECT cluster, unnest(['gross', 'qty', 'rate']) AS condition,
  unnest([A1_gross_r1, B1_qty_r1, C1_rate_r1 + C2_rate_r2]) AS v FROM lines)
SELECT cluster, condition, CAST(round(CAST(fsum(v) / count(v) AS DECIMAL(28, 8)), 4) AS DOUBLE) AS mean FROM t GROUP BY ALL""")
def condition_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return _round(stats.condition_by_cluster(i.lines(spark, sf), i.LINE_SAMPLES), ["mean"])


@query("histogram", f"""
WITH {i.DOCUMENTS_SQL},
feat AS (SELECT CAST(length(seq) AS DOUBLE) AS length,
  CASE WHEN seq = '' THEN 0 ELSE (length(seq) - length(translate(seq, 'GC', ''))) / length(seq) END AS gc FROM docs),
v AS (SELECT unnest(['length', 'gc']) AS metric, unnest([length, gc]) AS v FROM feat),
e AS (SELECT metric, min(v) AS lo, max(v) AS hi FROM v GROUP BY metric),
b AS (SELECT v.metric, lo, hi, least(29, floor((v - lo) / ((hi - lo) / 30))) AS bin FROM v JOIN e USING (metric) WHERE v IS NOT NULL)
SELECT metric, CAST(bin AS INTEGER) AS bin, round(lo + bin * ((hi - lo) / 30), 4) AS bin_start,
  round(lo + (bin + 1) * ((hi - lo) / 30), 4) AS bin_stop, count(*) AS n FROM b GROUP BY ALL""")
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths and gc shares of all documents, empty ones included."""
    docs = stats.chart_features(i.documents(spark, sf).withColumn("seq", i.fold_case("seq")))
    both = [stats.histogram(docs, c).select(F.lit(c).alias("metric"), "*") for c in ("length", "gc")]
    return _round(both[0].unionByName(both[1]), ["bin_start", "bin_stop"])


@query("box_summary", f"""
WITH {i.LINES_SQL}, {_CHAT_FEATURES_SQL},
v AS (SELECT 'A1_gross_r1' AS metric, cluster, A1_gross_r1 AS v FROM lines
  UNION ALL SELECT 'length', cluster, length FROM shape
  UNION ALL SELECT 'gc', cluster, CASE WHEN length = 0 THEN 0 ELSE gc END FROM shape),
q AS (SELECT metric, cluster, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM v GROUP BY ALL)
SELECT q.metric, q.cluster, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(v) FILTER (v >= q1 - (q3 - q1) * 1.5), 6) AS whisker_low,
  round(max(v) FILTER (v <= q3 + (q3 - q1) * 1.5), 6) AS whisker_high,
  CASE WHEN q.cluster = -1 THEN 'Noise' ELSE 'C' || q.cluster END AS label
FROM v JOIN q ON v.metric = q.metric AND v.cluster = q.cluster GROUP BY ALL""")
def box_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of a sample of line items, and of length and gc of conversation turns."""
    shape = stats.chart_features(_chat_features(spark, sf))
    boxes = [(i.lines(spark, sf), "A1_gross_r1"), (shape, "length"), (shape, "gc")]
    found = [stats.box_summary(rows, c).select(F.lit(c).alias("metric"), "*") for rows, c in boxes]
    both = found[0].unionByName(found[1]).unionByName(found[2])
    return _round(_round(both, ["q1", "median", "q3"]), ["whisker_low", "whisker_high"], 6)
