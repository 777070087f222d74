"""Ranking k-mers as primers, choosing the best ones, and listing the rows they cover."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqspark.functions.sequence import coord_label, fold_case
from seqspark.operators.kmers import holding_any, positions
from seqspark.operators.ordering import with_rank
from seqspark.session import MAX_BROADCAST, broadcast_if_small, join_on, settle

# How many primers are kept overall and per cluster.
TOP_GLOBAL = 8
TOP_CLUSTER = 5

# Labels of the two strategies.
COVERAGE_FIRST = "cov_then_expr"
EXPRESSION_FIRST = "expr_then_cov"


def _ties() -> list[Column]:
    """Equal scores keep the order of first occurrence."""
    return [F.asc("first_row"), F.asc("first_pos"), F.asc("primer")]


def coverage_order() -> list[Column]:
    return [F.desc("coverage"), F.desc("total_expr"), *_ties()]


def expression_order() -> list[Column]:
    return [F.desc("total_expr"), F.desc("coverage"), *_ties()]


def rank_kmers(index: DataFrame) -> DataFrame:
    """Both global ranks of every k-mer."""
    ranked = with_rank(index, coverage_order(), "rank_by_cov_expr")
    return with_rank(ranked, expression_order(), "rank_by_expr_cov")


def top_primers(index: DataFrame, order: list[Column], n: int = TOP_GLOBAL) -> DataFrame:
    """The best ``n`` primers with their rank (``limit`` after a sort: a per-partition top-n)."""
    best = index.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_cluster_primers(index: DataFrame, cluster: str = "cluster", n: int = TOP_CLUSTER) -> DataFrame:
    """The best ``n`` primers of each cluster, noise included.

    Spark trims every cluster to ``n`` rows per partition before the shuffle (WindowGroupLimit).
    """
    place = F.row_number().over(Window.partitionBy(cluster).orderBy(*coverage_order()))
    return index.withColumn("rank", place).where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint"))


def leading(index: DataFrame, n: int = TOP_GLOBAL) -> DataFrame:
    """Rows of the index among which the best ``n`` of either order are: the best of every batch, in one pass.

    Both lists read the index, and every k-mer would be put together twice for them.
    """
    scores = ["primer", "coverage", "total_expr", "first_row", "first_pos"]

    def trim(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows <= 2 * n:
                yield batch
                continue
            total = batch.column("total_expr")
            # Spark's order of doubles: NaN above all numbers, NULL below; a NULL row comes first.
            nan = pc.fill_null(pc.is_nan(total), False)
            keys = pa.table({
                "known": pc.cast(pc.is_valid(total), pa.int8()), "nan": pc.cast(nan, pa.int8()),
                "total": pc.if_else(nan, 0.0, pc.fill_null(total, 0.0)), "coverage": batch.column("coverage"),
                "row_known": pc.cast(pc.is_valid(batch.column("first_row")), pa.int8()),
                "first_row": pc.fill_null(batch.column("first_row"), 0), "first_pos": pc.fill_null(batch.column("first_pos"), 0),
                "primer": batch.column("primer"),
            })
            summed = [(c, "descending") for c in ("known", "nan", "total")]
            ties = [(c, "ascending") for c in ("row_known", "first_row", "first_pos", "primer")]
            most = [("coverage", "descending")]
            best = [pc.select_k_unstable(keys, n, sort_keys=order).to_pylist() for order in (most + summed + ties, summed + most + ties)]
            yield batch.take(pa.array(sorted({i for found in best for i in found}), pa.int64()))

    return index.select(*scores).mapInArrow(trim, index.select(*scores).schema)


def select_primers(index: DataFrame, n: int = TOP_GLOBAL) -> DataFrame:
    """Union of the two top lists, each primer once, in list order, with its strategy and scores."""
    index = settle(leading(index, n))
    first = top_primers(index, coverage_order(), n).withColumn("_list", F.lit(0))
    second = top_primers(index, expression_order(), n).withColumn("_list", F.lit(1))
    both = first.unionByName(second)
    # At most 2n rows from here on.
    chosen = both.groupBy("primer", "coverage", "total_expr", "first_row", "first_pos").agg(
        F.min(F.col("_list") * n + F.col("rank")).alias("_place")
    )
    return chosen.select(
        "primer",
        "coverage",
        "total_expr",
        "first_row",
        "first_pos",
        F.when(F.col("_place") <= n, F.lit(COVERAGE_FIRST)).otherwise(F.lit(EXPRESSION_FIRST)).alias("strategy"),
        F.row_number().over(Window.orderBy("_place")).cast("bigint").alias("place"),
    )


def primer_rows(
    posted: DataFrame, rows: DataFrame, row_id: str = "row_id",
    chrom: str = "chr", start: str = "start", stop: str = "stop",
) -> DataFrame:
    """One line per primer and covered row, with the row's coordinate label.

    Long on purpose: a primer found in a third of all rows is many lines here, not one giant list.
    """
    labelled = rows.select(row_id, coord_label(chrom, start, stop).alias("coordinates"))
    return posted.select(F.col("kmer").alias("primer"), row_id).join(labelled, row_id)


def rows_covered(
    chosen: DataFrame, rows: DataFrame, k: int, row_id: str = "row_id", seq: str = "seq", max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """The rows that hold each chosen primer: ``(primer, row_id)``.

    For a few primers this beats filtering the postings: their k-mers are dropped as they come out of the
    text. Pass a settled table of primers; it is broadcast up to ``max_broadcast`` bytes.
    """
    names = chosen.select("primer").distinct()
    wanted = broadcast_if_small(names, max_broadcast)
    folded = rows.select(row_id, fold_case(seq).alias("_seq"))
    found = positions(holding_any(folded, names, "primer", "_seq"), k, "_seq", [row_id])
    return found.join(wanted, found["kmer"] == wanted["primer"]).select("primer", row_id).distinct()


def row_lists(
    lines: DataFrame, row_id: str = "row_id", span: int = 10_000, keys: Sequence[str] = ("primer",)
) -> DataFrame:
    """Comma-joined row ids and coordinates per primer, one list per stretch of ``span`` row ids.

    A list holds at most ``span`` entries; ``part`` gives the order of a primer's lists.
    """
    listed = lines.groupBy(*keys, F.floor(F.col(row_id) / span).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array_sort(F.collect_list(F.struct(row_id, "coordinates"))).alias("_list"),
    )
    return listed.select(
        *keys,
        "part",
        "rows",
        F.array_join(F.transform("_list", lambda e: e[row_id].cast("string")), ",").alias("rows_covered"),
        F.array_join(F.transform("_list", lambda e: e["coordinates"]), ",").alias("rows_coordinates"),
    )


_SCORES = ["coverage", "total_expr"]
_RANKS = ["rank_by_cov_expr", "rank_by_expr_cov"]
_LISTS = ["part", "rows", "rows_covered", "rows_coordinates"]


def primer_candidates(index: DataFrame, lines: DataFrame, row_id: str = "row_id", span: int = 10_000) -> DataFrame:
    """Every k-mer with its scores, both ranks, and the rows it covers with their coordinates.

    ``lines`` are covered rows (``primer_rows``). A primer has a line per stretch of ``span`` row ids, so that no
    list grows with the table; a frequent primer's lists are made in as many tasks as it has stretches.
    """
    ranked = rank_kmers(index)
    return ranked.join(row_lists(lines, row_id, span), "primer").select("primer", *_SCORES, *_RANKS, *_LISTS)


def selected_rows(
    selected: DataFrame, rows: DataFrame, k: int, row_id: str = "row_id", seq: str = "seq",
    chrom: str = "chr", start: str = "start", stop: str = "stop", span: int = 10_000,
) -> DataFrame:
    """The selected primers (settled) with scores, strategy, covered rows and their coordinates."""
    covered = rows_covered(selected, rows, k, row_id, seq).withColumnRenamed("primer", "kmer")
    lists = row_lists(primer_rows(covered, rows, row_id, chrom, start, stop), row_id, span)
    return selected.join(lists, "primer").select("place", "primer", *_SCORES, "strategy", *_LISTS)


def cluster_rows_covered(
    best: DataFrame, rows: DataFrame, k: int, row_id: str = "row_id", seq: str = "seq", cluster: str = "cluster",
    chrom: str = "chr", start: str = "start", stop: str = "stop", span: int = 10_000,
) -> DataFrame:
    """The best primers of each cluster (settled) with the rows they cover within it."""
    covered = rows_covered(best, rows, k, row_id, seq).withColumnRenamed("primer", "kmer")
    placed = primer_rows(covered, rows, row_id, chrom, start, stop).join(rows.select(row_id, cluster), row_id)
    lists = row_lists(placed, row_id, span, (cluster, "primer"))
    return join_on(best, lists, [cluster, "primer"]).select(cluster, "rank", "primer", *_SCORES, *_LISTS)
