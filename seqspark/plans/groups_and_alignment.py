"""Queries: embedding, clustering, alignment and consensus."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqspark.operators import align, cluster
from seqspark.operators.knn import knn, neighbour_count
from seqspark.operators.knn_lsh import RECALL, graph_recall, knn_lsh
from seqspark.plans import inputs as i
from seqspark.plans.registry import query
from seqspark.session import settle
from seqspark.sources.fasta import combine_fasta

# --- embedding and clustering ------------------------------------------------------------------


@query("kmer_vectors", f"""
SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id,
  CAST(greatest(length(text) - {i.K - 1}, 0) AS DOUBLE) AS kmers FROM conversations""")
def kmer_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed k-mer counts; the SQL can only tell what each vector must add up to."""
    vectors = cluster.kmer_vectors(i.chats(spark, sf), i.K)
    total = F.aggregate(vector_to_array("vector"), F.lit(0.0), lambda a, b: a + b)
    return vectors.select("row_id", total.alias("kmers"))


@query("vocabulary_vectors", f"""
WITH {i.CHATS_SQL}, low AS (SELECT row_id, translate(seq, '{i.UPPER}', '{i.LOWER}') AS seq FROM chats),
{i.kmers_sql('low', 'row_id')},
n AS (SELECT row_id, kmer, count(*) AS n FROM kmers GROUP BY ALL),
terms AS (SELECT kmer, row_number() OVER (ORDER BY kmer) - 1 AS term FROM n GROUP BY kmer HAVING count(*) >= 2)
SELECT row_id, term, n FROM n JOIN terms USING (kmer)""")
def vocabulary_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """K-mer vectors of conversation turns over the k-mers that two turns share."""
    return cluster.vocabulary_vectors(i.chats(spark, sf), i.K)


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return i.spread(i.table(spark, sf, "embeddings"), "vec_id").select(F.col("vec_id").alias("row_id"), "embedding", "label")


def _plane(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.pca_embed(cluster.array_vectors(_embeddings(spark, sf), "embedding"))


def _leading_sql(matrix: str, name: str, squarings: int = 16) -> str:
    """`<name>`: the leading direction of a symmetric matrix ``(i, j, s)`` by squaring it again and again."""
    return f"""
{name}_pow(n, i, j, s) AS (SELECT 0, i, j, s / max(abs(s)) OVER () FROM {matrix}
  UNION ALL SELECT n, i, j, s / max(abs(s)) OVER () FROM (
    SELECT a.n + 1 AS n, a.i, b.j, sum(a.s * b.s) AS s FROM {name}_pow a JOIN {name}_pow b ON a.j = b.i
    WHERE a.n < {squarings} GROUP BY ALL)),
{name}_top AS (SELECT i, s FROM {name}_pow WHERE n = {squarings}
  AND j = (SELECT i FROM {name}_pow WHERE n = {squarings} AND i = j ORDER BY s DESC, i LIMIT 1)),
{name} AS (SELECT i, s / sqrt(sum(s * s) OVER ()) * (SELECT sign(s) FROM {name}_top ORDER BY abs(s) DESC, i LIMIT 1) AS v
  FROM {name}_top)"""


# `plane`: all coordinates of the embeddings turned onto two principal components.
_PLANE_SQL = f"""
e AS (SELECT vec_id AS row_id, unnest(range(len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT row_id, d, v - avg(v) OVER (PARTITION BY d) AS v FROM e),
cov AS (SELECT a.d AS i, b.d AS j, sum(a.v * b.v) AS s FROM c a JOIN c b ON a.row_id = b.row_id GROUP BY ALL),
{_leading_sql('cov', 'first')},
rest AS (SELECT cov.i, cov.j,
    s - (SELECT sum(x.v * cov.s * y.v) FROM cov JOIN first x ON cov.i = x.i JOIN first y ON cov.j = y.i) * p.v * q.v AS s
  FROM cov JOIN first p ON cov.i = p.i JOIN first q ON cov.j = q.i),
{_leading_sql('rest', 'second')},
plane AS (SELECT row_id, sum(c.v * first.v) AS x, sum(c.v * second.v) AS y
  FROM c JOIN first ON c.d = first.i JOIN second ON c.d = second.i GROUP BY row_id)"""

# `found`: density clusters of `plane`, by comparing all rows with all.
_DENSITY_SQL = """
d AS (SELECT a.row_id AS id, b.row_id AS other, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist
  FROM plane a JOIN plane b ON a.row_id <> b.row_id),
core AS (SELECT id, dist FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, other) AS r FROM d) WHERE r = 7),
near AS (SELECT quantile_cont(dist, 0.9) AS eps FROM core),
dense AS (SELECT id FROM core, near WHERE dist <= eps),
edge AS (SELECT id, other FROM d, near WHERE dist <= eps AND id IN (SELECT id FROM dense) AND other IN (SELECT id FROM dense)),
reach(id, comp) AS (SELECT id, id FROM dense
  UNION SELECT e.other, r.comp FROM reach r JOIN edge e ON r.id = e.id WHERE r.comp < e.other),
comp AS (SELECT id, min(comp) AS comp FROM reach GROUP BY id),
kept AS (SELECT comp, row_number() OVER (ORDER BY count(*) DESC, comp) - 1 AS cluster FROM comp GROUP BY comp
  HAVING count(*) >= greatest(5, (SELECT count(*) FROM plane) // 7)),
found AS (SELECT p.row_id, CAST(coalesce(k.cluster, -1) AS INTEGER) AS cluster
  FROM plane p LEFT JOIN comp ON p.row_id = comp.id LEFT JOIN kept k ON comp.comp = k.comp)"""


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Six digits, and one zero instead of two."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


@query("pca_embed", f"WITH RECURSIVE {_PLANE_SQL} SELECT row_id, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM plane")
def pca_embed(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_plane(spark, sf), ["x", "y"])


@query("knn_graph", """
WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT a.id, b.id AS neighbour, list_distance(a.e, b.e) AS distance FROM v a JOIN v b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM d)
SELECT id, CAST(rank AS INTEGER) AS rank, neighbour, round(distance, 4) AS distance FROM r
WHERE rank <= greatest(2, least(30, (SELECT count(*) FROM v) - 1))""")
def knn_graph(spark: SparkSession, sf: str) -> DataFrame:
    rows = _embeddings(spark, sf)
    graph = knn(rows, neighbour_count(rows.count()), "row_id", "embedding")
    return graph.withColumn("distance", F.round("distance", 4))


# Small blocks, so that the given tables need several rounds.
_LSH_BLOCK = 256


@query("knn_graph_lsh")
def knn_graph_lsh(spark: SparkSession, sf: str) -> DataFrame:
    """The neighbour graph by hashing: which neighbours are missed hangs on the hashes, so there is no SQL."""
    rows = _embeddings(spark, sf)
    graph = knn_lsh(rows, neighbour_count(rows.count()), "row_id", "embedding", block=_LSH_BLOCK).edges
    return graph.withColumn("distance", F.round("distance", 4))


@query("knn_recall", """
WITH n AS (SELECT count(*) AS n FROM embeddings)
SELECT CAST(n * least(n - 1, greatest(2, least(30, n - 1))) AS BIGINT) AS neighbours, true AS reached FROM n""")
def knn_recall(spark: SparkSession, sf: str) -> DataFrame:
    """The hashed graph against the exact one over all rows: neighbours there are, and whether enough were found."""
    rows = _embeddings(spark, sf)
    count = rows.count()
    k = neighbour_count(count)
    hashed = knn_lsh(rows, k, "row_id", "embedding", block=_LSH_BLOCK)
    if hashed.exact and count > _LSH_BLOCK:
        # Hashing gave up and made the exact graph: there is no second one to make.
        edges = exact = settle(hashed.edges)
    else:
        edges, exact = hashed.edges, knn(rows, k, "row_id", "embedding")
    measured = graph_recall(edges, exact)
    return measured.select("neighbours", (F.col("recall") >= RECALL).alias("reached"))


@query("density_cluster", f"WITH RECURSIVE {_PLANE_SQL}, {_DENSITY_SQL} SELECT row_id, cluster FROM found")
def density_cluster(spark: SparkSession, sf: str) -> DataFrame:
    """Density clusters on the plane of all embedding coordinates."""
    return cluster.density_cluster(_plane(spark, sf))


@query("cluster_coordinates", f"""WITH RECURSIVE {_PLANE_SQL}, {_DENSITY_SQL}
SELECT p.row_id, CAST(d.doc_id AS VARCHAR) AS chr, CASE WHEN d.doc_id IS NOT NULL THEN 0 END AS start, d.n_chars AS stop,
  CASE WHEN d.doc_id IS NOT NULL THEN '+' END AS strand, f.cluster, round(x, 6) + 0.0 AS pca_x, round(y, 6) + 0.0 AS pca_y
FROM plane p JOIN found f ON p.row_id = f.row_id LEFT JOIN documents d ON p.row_id = d.doc_id""")
def cluster_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """Locus, cluster and plane coordinates; an embedding's locus is the document of its id."""
    plane = settle(_plane(spark, sf))
    loci = i.documents(spark, sf).select("row_id", "chr", "start", "stop", "strand")
    rows = _embeddings(spark, sf).select("row_id").join(loci, "row_id", "left")
    table = cluster.cluster_coordinates(rows, plane, cluster.density_cluster(plane))
    return _rounded(table.withColumnsRenamed({"x": "pca_x", "y": "pca_y"}), ["pca_x", "pca_y"])


@query("hierarchical_cluster")
def hierarchical_cluster(spark: SparkSession, sf: str) -> DataFrame:
    rows = _embeddings(spark, sf)
    vectors = cluster.array_vectors(rows, "embedding")
    return cluster.hierarchical_cluster(vectors, cluster.group_count(rows.count()))


@query("cluster_fallback", f"""
WITH t AS (SELECT d.doc_id AS row_id, source, lang, {i.upper_sql('text')} AS seq, coalesce(quality, -1) AS label
  FROM documents d LEFT JOIN labels l USING (doc_id)),
{i.kmers_sql('t', 'source, lang')},
w AS (SELECT source, lang, count(DISTINCT kmer) AS words FROM kmers GROUP BY ALL),
f AS (SELECT source, lang, count(*) AS n, max(label) AS best FROM t GROUP BY ALL)
SELECT row_id, source, lang, CASE WHEN n < 10 OR coalesce(words, 0) < 2 OR best = -1 THEN 0 ELSE label END AS cluster
FROM t JOIN f USING (source, lang) LEFT JOIN w USING (source, lang)""")
def cluster_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Document marks as labels (none is noise), with the fallback rules applied per source and language."""
    marks = i.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = i.spread(i.table(spark, sf, "documents"), "doc_id").join(marks, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), "source", "lang", F.col("text").alias("seq"),
        F.coalesce("label", F.lit(-1)).alias("cluster"),
    )
    return cluster.apply_fallbacks(docs, i.K, ["source", "lang"]).select("row_id", "source", "lang", "cluster")


# --- profiles and consensus --------------------------------------------------------------------

_DOCUMENT_CELLS = f"WITH {i.ALIGNED_DOCUMENTS_SQL}, {i.cells_sql()}, {i.sizes_sql()}"
_CHAT_CELLS = f"WITH {i.ALIGNED_CHATS_SQL}, {i.cells_sql()}, {i.sizes_sql()}"


@query("alignment_profile", f"""{_DOCUMENT_CELLS},
occ AS (SELECT a.grp, a.col, a.n, count(c.base) AS o FROM size_axis a LEFT JOIN cell c ON a.grp = c.grp AND a.col = c.col
  GROUP BY ALL)
SELECT s.grp, s.n, s.width, round(avg(o.n - o.o), 4) AS mean_gaps, count(*) FILTER (o.o = o.n) AS columns_without_gaps,
  count(*) FILTER (o.n - o.o > o.n / 2) AS columns_over_half_gaps
FROM size s JOIN occ o ON s.grp = o.grp GROUP BY ALL""")
def alignment_profile(spark: SparkSession, sf: str) -> DataFrame:
    found = align.alignment_profile(i.aligned_documents(spark, sf))
    return found.withColumn("mean_gaps", F.round("mean_gaps", 4))


@query("consensus", f"""{_DOCUMENT_CELLS}, {i.consensus_sql(0.5)} SELECT grp, consensus FROM cons""")
def consensus(spark: SparkSession, sf: str) -> DataFrame:
    return align.consensus(i.aligned_documents(spark, sf))


@query("positional_consensus", f"""
WITH raw AS (SELECT lang AS grp, doc_id AS seq_id, {i.upper_sql('text')} AS seq FROM documents),
{i.cells_sql('raw', gaps=True)}, {i.sizes_sql('raw')}, {i.consensus_sql(0.0)}
SELECT grp AS cluster, consensus, replace(consensus, '-', '') AS gap_reduced FROM cons""")
def positional_consensus(spark: SparkSession, sf: str) -> DataFrame:
    docs = i.spread(i.table(spark, sf, "documents"), "doc_id").select(
        F.col("lang").alias("cluster"), F.col("doc_id").alias("row_id"), F.col("text").alias("seq")
    )
    return align.positional_consensus(docs)


@query("consensus_summary", f"""{_CHAT_CELLS}, {i.consensus_sql(0.5)}
SELECT s.grp, s.n AS size, length(replace(c.consensus, '-', '')) AS consensus_length, s.width AS alignment_length
FROM size s JOIN cons c USING (grp)""")
def consensus_summary(spark: SparkSession, sf: str) -> DataFrame:
    return align.consensus_summary(i.aligned_chats(spark, sf))


# --- placing and cleaning ----------------------------------------------------------------------


@query("anchor_align", f"""
WITH {i.CHATS_SQL},
a AS (SELECT cluster, row_id AS anchor_id, seq AS anchor, length(seq) AS width FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY length(seq) DESC, row_id) AS r,
    count(*) OVER (PARTITION BY cluster) AS n FROM chats) WHERE r = 1 AND n > 1),
{i.kmers_sql('chats', 'cluster, row_id', 12)},
u AS (SELECT cluster, row_id, kmer, min(pos) AS pos FROM kmers WHERE NOT contains(kmer, 'N')
  GROUP BY ALL HAVING count(*) = 1),
v AS (SELECT u.row_id, m.pos - u.pos AS off, count(*) AS votes FROM u JOIN a ON a.cluster = u.cluster
  JOIN u m ON m.row_id = a.anchor_id AND m.kmer = u.kmer GROUP BY ALL),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY votes DESC, abs(off), off) AS r FROM v) WHERE r = 1),
p AS (SELECT c.cluster, c.row_id, a.anchor_id, c.seq, coalesce(w.off, 0) AS off, coalesce(w.votes, 0) AS votes
  FROM chats c JOIN a USING (cluster) LEFT JOIN w USING (row_id)),
x AS (SELECT cluster, min(off) AS lo, max(off + length(seq)) AS hi FROM p GROUP BY cluster)
SELECT cluster, row_id, anchor_id, off AS "offset", votes,
  repeat('-', off - lo) || seq || repeat('-', hi - off - length(seq)) AS aligned
FROM p JOIN x USING (cluster)""")
def anchor_align(spark: SparkSession, sf: str) -> DataFrame:
    return align.anchor_align(i.chats(spark, sf), 12)


_MIN_IDENTITY = 0.12


def _divergent_sql(source: str, cell: str, size: str, share: float, name: str) -> str:
    return f"""{i.consensus_sql(0.0, cell, size, name + '_maj')},
{name}_hit AS (SELECT c.grp, c.seq_id, count(*) FILTER (c.base = m.base) AS hit, count(*) AS n
  FROM {cell} c JOIN {name}_maj_col m ON c.grp = m.grp AND c.col = m.col GROUP BY ALL),
{name} AS (SELECT s.grp, s.seq_id, s.seq FROM {source} s JOIN {name}_hit h ON s.seq_id = h.seq_id
  WHERE h.hit / h.n >= {share})"""


@query("remove_divergent", f"""{_CHAT_CELLS}, {_divergent_sql('aln', 'cell', 'size', _MIN_IDENTITY, 'd1')}
SELECT grp, seq_id, seq FROM d1""")
def remove_divergent(spark: SparkSession, sf: str) -> DataFrame:
    return align.remove_divergent(settle(i.aligned_chats(spark, sf)), _MIN_IDENTITY)


def _occupied_sql(cell: str, size: str, name: str) -> str:
    return f"""{name}_occ AS (SELECT a.grp, a.col, a.n, count(c.base) AS o FROM {size}_axis a
  LEFT JOIN {cell} c ON a.grp = c.grp AND a.col = c.col GROUP BY ALL)"""


def _insertions_sql(cell: str, size: str, name: str) -> str:
    """`<name>_ins`: columns of insertions."""
    return f"""{_occupied_sql(cell, size, name)},
{name}_isl AS (SELECT grp, col, col - row_number() OVER (PARTITION BY grp ORDER BY col) AS isl FROM {name}_occ WHERE o < n * 0.5),
{name}_run AS (SELECT grp, min(col) AS lo, max(col) AS hi FROM {name}_isl GROUP BY grp, isl HAVING count(*) BETWEEN 3 AND 200),
{name}_car AS (SELECT r.grp, r.lo, r.hi, c.seq_id, count(*) FILTER (c.col < r.lo) AS l, count(*) FILTER (c.col > r.hi) AS h,
  count(*) FILTER (c.col BETWEEN r.lo AND r.hi) AS m FROM {name}_run r JOIN {cell} c ON r.grp = c.grp GROUP BY ALL),
{name}_ins AS (SELECT DISTINCT grp, unnest(range(lo, hi + 1)) AS col FROM {name}_car WHERE m > 0 AND l >= 5 AND h >= 5)"""


def _cut_sql(source: str, dropped: str, name: str) -> str:
    """Rows of ``source`` without the dropped columns; ragged to the right like the input."""
    return f"""{i.cells_sql(source, name + '_c', gaps=True)},
{name} AS (SELECT s.grp, s.seq_id, coalesce(t.seq, '') AS seq FROM {source} s LEFT JOIN (
  SELECT c.seq_id, string_agg(base, '' ORDER BY c.col) AS seq FROM {name}_c c
  LEFT JOIN {dropped} d ON c.grp = d.grp AND c.col = d.col WHERE d.col IS NULL GROUP BY c.seq_id) t ON s.seq_id = t.seq_id)"""


@query("remove_insertions", f"""{_CHAT_CELLS}, {_insertions_sql('cell', 'size', 'x')}, {_cut_sql('aln', 'x_ins', 'x_out')}
SELECT grp, seq_id, seq FROM x_out""")
def remove_insertions(spark: SparkSession, sf: str) -> DataFrame:
    return align.remove_insertions(settle(i.aligned_chats(spark, sf)))


@query("remove_short", f"""WITH {i.ALIGNED_CHATS_SQL}
SELECT grp, seq_id, seq FROM aln WHERE length(replace(seq, '-', '')) >= 50""")
def remove_short(spark: SparkSession, sf: str) -> DataFrame:
    return align.remove_short(i.aligned_chats(spark, sf))


@query("drop_gap_only", f"""{_CHAT_CELLS}, {_occupied_sql('cell', 'size', 'x')},
x_empty AS (SELECT grp, col FROM x_occ WHERE o = 0), {_cut_sql('aln', 'x_empty', 'x_out')}
SELECT grp, seq_id, seq FROM x_out""")
def drop_gap_only(spark: SparkSession, sf: str) -> DataFrame:
    return align.drop_gap_only(settle(i.aligned_chats(spark, sf)))


def _empty_sql(source: str, name: str) -> str:
    """`<name>`: rows of ``source`` without gap-only columns."""
    return f"""{i.cells_sql(source, name + '_k')}, {i.sizes_sql(source, name + '_s')},
{_occupied_sql(name + '_k', name + '_s', name)},
{name}_e AS (SELECT grp, col FROM {name}_occ WHERE o = 0), {_cut_sql(source, name + '_e', name)}"""


_CLEANED_SQL = f"""{_CHAT_CELLS}, {_divergent_sql('aln', 'cell', 'size', _MIN_IDENTITY, 'd1')},
{_empty_sql('d1', 'e1')},
{i.cells_sql('e1', 'ik')}, {i.sizes_sql('e1', 'isz')}, {_insertions_sql('ik', 'isz', 'iy')}, {_cut_sql('e1', 'iy_ins', 'i1')},
{_empty_sql('i1', 'e2')},
s1 AS (SELECT grp, seq_id, seq FROM e2 WHERE length(replace(seq, '-', '')) >= 50),
{_empty_sql('s1', 'e3')}"""


@query("cleaned_consensus", f"""{_CLEANED_SQL},
{i.cells_sql('e3', 'fk')}, {i.sizes_sql('e3', 'fs')}, {i.consensus_sql(0.5, 'fk', 'fs', 'fin')}
SELECT grp, consensus, length(replace(consensus, '-', '')) AS length_no_gaps, length(consensus) AS length_with_gaps FROM fin""")
def cleaned_consensus(spark: SparkSession, sf: str) -> DataFrame:
    cleaned, _ = align.clean_alignment(i.aligned_chats(spark, sf), min_identity=_MIN_IDENTITY)
    return align.cleaned_summary(cleaned)


@query("cleaning_log", f"""{_CLEANED_SQL},
left1 AS (SELECT a.grp, a.col AS original, row_number() OVER (PARTITION BY a.grp ORDER BY a.col) - 1 AS col
  FROM e1_s_axis a LEFT JOIN e1_e x ON a.grp = x.grp AND a.col = x.col WHERE x.col IS NULL),
left2 AS (SELECT k.grp, k.original, row_number() OVER (PARTITION BY k.grp ORDER BY k.original) - 1 AS col
  FROM left1 k LEFT JOIN iy_ins x ON k.grp = x.grp AND k.col = x.col WHERE x.col IS NULL),
lg AS (SELECT 'remove_divergent' AS step, grp, 'row' AS kind, seq_id AS id FROM aln WHERE seq_id NOT IN (SELECT seq_id FROM d1)
  UNION ALL SELECT 'remove_short', grp, 'row', seq_id FROM e2 WHERE seq_id NOT IN (SELECT seq_id FROM s1)
  UNION ALL SELECT 'remove_gap_only', grp, 'column', col FROM e1_e
  UNION ALL SELECT 'remove_insertions', x.grp, 'column', original FROM iy_ins x JOIN left1 USING (grp, col)
  UNION ALL SELECT 'remove_gap_only', x.grp, 'column', original FROM e3_e x JOIN left2 USING (grp, col))
SELECT step, grp, kind, id FROM lg""")
def cleaning_log(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns removed by the cleaning, columns by their first numbers."""
    _, log = align.clean_alignment(i.aligned_chats(spark, sf), min_identity=_MIN_IDENTITY)
    return log.select("step", "grp", "kind", "id")


@query("consensus_fasta", f"""{_CHAT_CELLS}, {i.consensus_sql(0.5)}
SELECT grp, '>chats_cluster' || grp || '_consensus' || chr(10)
   || regexp_replace(regexp_replace(consensus, '(.{{80}})', '\\1' || chr(10), 'g'), '\\n$', '') AS record FROM cons""")
def consensus_fasta(spark: SparkSession, sf: str) -> DataFrame:
    """The consensus of every role as a FASTA record."""
    return combine_fasta(align.consensus(i.aligned_chats(spark, sf)), "chats", "grp")
