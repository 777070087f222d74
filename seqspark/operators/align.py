"""Alignments as rows of equal-axis strings: placing, profiles, consensus and cleaning.

A row that is shorter than its group is gapped to the right. Cells are never listed: characters are counted
in place (``columns.py``), and columns are removed by cutting strings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqspark.functions.sequence import GAP, fold_case, ungapped_length, without_gaps
from seqspark.operators.columns import column_rows, counted_columns, joined_text, sizes_of
from seqspark.operators.kmers import UNKNOWN, by_row, positions
from seqspark.session import MAX_BROADCAST, broadcast_if_small, join_groups, join_on, settle

# Thresholds of the consensus and of the three cleaning steps.
CONSENSUS_SHARE = 0.5
MIN_IDENTITY = 0.65
INSERTION_MIN = 3
INSERTION_MAX = 200
INSERTION_FLANK = 5
INSERTION_SHARE = 0.5
MIN_LENGTH = 50

# Columns listed at a time.
_PIECE = 4096


def group_sizes(rows: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """Rows and width of each alignment."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("seq")).cast("bigint").alias("width")
    )


def axis(rows: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """Every column number of every alignment."""
    sized = group_sizes(rows, by).where(F.col("width") > 0)
    # In two steps, so that no array grows with the width.
    last = F.col("width") - 1
    parts = sized.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(_PIECE).cast("bigint"))))
    return parts.select(*by, "n", F.explode(F.sequence("_from", F.least(F.col("_from") + (_PIECE - 1), last))).alias("col"))


def consensus_columns(
    rows: DataFrame, share: float = CONSENSUS_SHARE, by: Sequence[str] = ("grp",),
    row_id: str = "seq_id", gaps: bool = False,
) -> DataFrame:
    """The consensus base of each column.

    The most frequent base if it has at least ``share`` of the non-gap bases, otherwise ``N``; equal
    counts go to the base seen first in row order. Bases are counted before anything is shuffled.
    """
    return column_rows(counted_columns(rows, share, by, row_id, gaps), by)


def consensus(
    rows: DataFrame, share: float = CONSENSUS_SHARE, by: Sequence[str] = ("grp",), row_id: str = "seq_id"
) -> DataFrame:
    """Threshold consensus string of each group."""
    return joined_text(counted_columns(rows, share, by, row_id), by)


def positional_consensus(
    df: DataFrame, by: Sequence[str] = ("cluster",), row_id: str = "row_id", seq: str = "seq"
) -> DataFrame:
    """Most frequent character per raw position without a threshold, and the same without gaps."""
    rows = df.select(*by, row_id, F.col(seq).alias("seq"))
    text = joined_text(counted_columns(rows, 0.0, by, row_id, gaps=True), by)
    return text.withColumn("gap_reduced", without_gaps("consensus"))


def alignment_profile(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    """Rows, width, mean gaps per column, columns without gaps, columns with more than half gaps."""
    counted = settle(counted_columns(rows, 0.0, by, row_id))
    sizes = sizes_of(counted, by)
    joined = join_on(counted.select(*by, "totals"), sizes, by)
    per_stretch = joined.select(
        *by, "n", F.col("width"),
        F.aggregate("totals", F.lit(0).cast("bigint"), lambda a, t: a + t).alias("_cells"),
        F.size(F.filter("totals", lambda t: t == F.col("n"))).alias("_full"),
        F.size(F.filter("totals", lambda t: F.col("n") - t > F.col("n") / 2)).alias("_few"),
    )
    summed = per_stretch.groupBy(*by, "n", "width").agg(*[F.sum(c).alias(c) for c in ("_cells", "_full", "_few")])
    return summed.select(
        *by, "n", "width",
        F.when(F.col("width") > 0, F.col("n") - F.col("_cells") / F.col("width")).alias("mean_gaps"),
        F.col("_full").alias("columns_without_gaps"),
        F.col("_few").alias("columns_over_half_gaps"),
    )


def consensus_summary(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    """Size, consensus length without gaps and alignment length of each group."""
    counted = settle(counted_columns(rows, CONSENSUS_SHARE, by, row_id))
    return join_on(sizes_of(counted, by), joined_text(counted, by), by, "left").select(
        *by, F.col("n").alias("size"),
        F.coalesce(ungapped_length("consensus"), F.lit(0)).cast("bigint").alias("consensus_length"),
        F.col("width").alias("alignment_length"),
    )


# --- placing unaligned sequences ---------------------------------------------------------------


def _single_kmers(df: DataFrame, k: int, by: Sequence[str], row_id: str) -> DataFrame:
    """K-mers that occur once in their sequence."""
    found = positions(df, k, "seq", [*by, row_id]).where(~F.contains("kmer", F.lit(UNKNOWN)))
    return found.groupBy(*by, row_id, "kmer").agg(F.count(F.lit(1)).alias("_c"), F.min("pos").alias("pos")).where(
        F.col("_c") == 1
    )


def anchor_align(
    df: DataFrame, k: int, by: Sequence[str] = ("cluster",), row_id: str = "row_id", seq: str = "seq",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """Place every sequence of a group on the axis of the group's longest sequence (lowest id on ties).

    K-mers occurring once in a sequence and once in the anchor vote for an offset; most votes win, then
    the smallest shift, then the smaller offset. No gaps are opened inside a sequence, and what stands over
    the anchor's ends widens the axis of the group: every base is kept. Without a shared k-mer the offset is 0. Groups of one are left out. Only anchors are compared with members, never
    members with each other.
    """
    folded = df.select(*by, row_id, fold_case(seq).alias("seq"))
    # Two rounds of plain numbers; taking the longest row in one would sort the texts by group.
    sizes = group_sizes(folded, by).where(F.col("n") > 1)
    longest = join_groups(folded, sizes, by, row_id, max_bytes=max_broadcast).where(F.length("seq") == F.col("width"))
    chosen = longest.groupBy(*by, "width").agg(F.min(row_id).alias("anchor_id"))
    sized = settle(chosen.select(*by, "anchor_id", "width"))
    anchors = folded.withColumnRenamed(row_id, "anchor_id").join(
        broadcast_if_small(sized.select("anchor_id"), max_broadcast), "anchor_id", "left_semi"
    )
    marks = settle(
        _single_kmers(by_row(anchors, "anchor_id"), k, by, "anchor_id").select(
            *by, "kmer", F.col("pos").alias("_anchor_pos")
        )
    )
    members = by_row(folded, row_id)
    votes = (
        join_on(_single_kmers(members, k, by, row_id), broadcast_if_small(marks, max_broadcast), [*by, "kmer"])
        .groupBy(row_id, (F.col("_anchor_pos") - F.col("pos")).alias("offset"))
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    best = Window.partitionBy(row_id).orderBy(F.desc("votes"), F.abs("offset"), "offset")
    won = votes.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == 1).drop("_r")
    placed = settle(join_groups(folded.join(won, row_id, "left"), sized.select(*by, "anchor_id"), by, row_id, max_bytes=max_broadcast).select(
        *by, row_id, "anchor_id", "seq",
        F.coalesce("offset", F.lit(0)).alias("offset"),
        F.coalesce("votes", F.lit(0)).alias("votes"),
    ))
    # The axis of a group runs from the first place any member takes to the last, so that nothing is cut.
    axis = placed.groupBy(*by).agg(
        F.min("offset").alias("_from"), F.max(F.col("offset") + F.length("seq")).alias("_to")
    )
    pad = (F.col("offset") - F.col("_from")).cast("int")
    return join_groups(placed, axis, by, row_id, max_bytes=max_broadcast).select(
        *by, row_id, "anchor_id", "offset", "votes",
        F.rpad(F.concat(F.repeat(F.lit(GAP), pad), F.col("seq")), (F.col("_to") - F.col("_from")).cast("int"), F.lit(GAP)).alias("aligned"),
    )


# --- cleaning ----------------------------------------------------------------------------------


def identity_to_majority(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    """Rows with ``identity``: share of their non-gap columns that equal the majority base."""
    major = joined_text(counted_columns(rows, 0.0, by, row_id), by, "_major")
    joined = join_groups(rows, major, by, row_id, "left")
    folded = fold_case("seq")
    pairs = F.zip_with(
        F.split(folded, ""),
        F.split(F.substring(F.col("_major"), F.lit(1), F.length("seq")), ""),
        lambda a, b: (a != GAP) & (a == b),
    )
    occupied = ungapped_length("seq")
    share = F.when(occupied > 0, F.size(F.filter(pairs, lambda hit: hit)) / occupied).otherwise(F.lit(0.0))
    return joined.withColumn("identity", share).drop("_major")


def remove_divergent(
    rows: DataFrame, threshold: float = MIN_IDENTITY, by: Sequence[str] = ("grp",), row_id: str = "seq_id"
) -> DataFrame:
    """Drop rows that agree too little with the majority of their group."""
    return identity_to_majority(rows, by, row_id).where(F.col("identity") >= threshold).drop("identity")


def remove_short(rows: DataFrame, threshold: int = MIN_LENGTH) -> DataFrame:
    """Drop rows with fewer non-gap bases than the threshold."""
    return rows.where(ungapped_length("seq") >= threshold)


def occupancy(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    """Occupied cells of every column, empty columns included, with the number of rows."""
    counted = settle(counted_columns(rows, 0.0, by, row_id))
    columns = column_rows(counted, by).select(*by, "col", F.col("total").alias("occupied"))
    return join_on(columns, sizes_of(counted, by).select(*by, "n"), by).select(*by, "n", "col", "occupied")


def gap_only_columns(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    return occupancy(rows, by, row_id).where(F.col("occupied") == 0).select(*by, "col")


def _runs(columns: DataFrame, by: Sequence[str], at: str = "col") -> DataFrame:
    """Consecutive columns as ``(start, span, size)``: where they are, and how many there are."""
    number = F.row_number().over(Window.partitionBy(*by).orderBy("col"))
    return (
        columns.withColumn("_island", F.col("col") - number)
        .groupBy(*by, "_island")
        .agg(
            F.min(at).cast("int").alias("start"), (F.max(at) - F.min(at) + 1).cast("int").alias("span"),
            F.count(F.lit(1)).cast("int").alias("size"),
        )
        .drop("_island")
    )


def without_columns(
    rows: DataFrame, dropped: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id"
) -> DataFrame:
    """Cut columns out of every row. The rows themselves are only joined with their group's kept runs."""
    keys = [*by, "col"]
    kept = axis(rows, by).select(*keys).join(dropped.select(*keys), keys, "left_anti")
    runs = _runs(kept, by).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("_runs"))
    joined = join_groups(rows, runs, by, row_id, "left")
    text = F.array_join(F.transform("_runs", lambda r: F.substring(F.col("seq"), r["start"] + 1, r["size"])), "")
    return joined.withColumn("seq", F.coalesce(text, F.lit(""))).drop("_runs")


def drop_gap_only(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    """Remove columns without any base; the others move up."""
    return without_columns(rows, gap_only_columns(rows, by, row_id), by, row_id)


def insertion_columns(
    rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id",
    min_size: int = INSERTION_MIN, max_size: int = INSERTION_MAX,
    min_flank: int = INSERTION_FLANK, share: float = INSERTION_SHARE, occupied: DataFrame | None = None,
) -> DataFrame:
    """Columns of insertions: runs of thinly occupied columns, of bounded width, carried by a row that
    has bases enough on both sides of the run. ``occupied`` is the occupancy of the columns that count, numbered
    one by one in ``col``, with their place in the rows (``at``); what lies between two of them holds no base."""
    columns = occupancy(rows, by, row_id).withColumn("at", F.col("col")) if occupied is None else occupied
    thin = columns.where(F.col("occupied") < F.col("n") * share).select(*by, "col", "at")
    runs = _runs(thin, by, "at").where(F.col("size").between(min_size, max_size))
    listed = runs.groupBy(*by).agg(F.collect_list(F.struct("start", "span")).alias("_runs"))

    def bases(start: Column, size: Column) -> Column:
        return ungapped_length(F.substring(F.col("seq"), start, size))

    carried = join_groups(rows, listed, by, row_id).select(
        *by,
        F.explode(
            F.filter(
                "_runs",
                lambda r: (bases(r["start"] + 1, r["span"]) > 0)
                & (bases(F.lit(1), r["start"]) >= min_flank)
                & (bases(r["start"] + r["span"] + 1, F.length("seq")) >= min_flank),
            )
        ).alias("_run"),
    )
    found = carried.select(*by, "_run.start", "_run.span").distinct()
    return found.select(
        *by,
        F.explode(F.sequence(F.col("start").cast("bigint"), (F.col("start") + F.col("span") - 1).cast("bigint"))).alias("col"),
    )


def remove_insertions(rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id", **limits) -> DataFrame:
    """Cut insertions out of every row."""
    return without_columns(rows, insertion_columns(rows, by, row_id, **limits), by, row_id)


def clean_alignment(
    rows: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id",
    min_identity: float = MIN_IDENTITY, min_length: int = MIN_LENGTH, **limits,
) -> tuple[DataFrame, DataFrame]:
    """Divergent rows, insertions and short rows removed in this order, gap-only columns after each.

    Returns the cleaned rows and a log ``(step, by, kind, id)`` with row ids and original column numbers.
    Rows are checkpointed where rows have gone; columns are lists of numbers until then.
    """
    log: list[DataFrame] = []
    rows = settle(rows)
    columns = axis(rows, by).select(*by, "col")
    keys = [*by, "col"]

    def note(step: str, kind: str, removed: DataFrame, ident: str) -> None:
        log.append(removed.select(F.lit(step).alias("step"), *by, F.lit(kind).alias("kind"), F.col(ident).alias("id")))

    def drop_rows(step: str, kept: DataFrame) -> DataFrame:
        kept = settle(kept)
        note(step, "row", rows.join(kept.select(row_id), row_id, "left_anti"), row_id)
        return kept

    def renumbered(kept: DataFrame, order: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(order)).cast("bigint") - 1
        return kept.withColumn("col", place)

    rows = drop_rows("remove_divergent", remove_divergent(rows, min_identity, by, row_id))
    # Counted once for two steps: cutting columns leaves the others as occupied as they were, and a gap-only
    # column more or less in a row's text changes no count of bases. So both steps are one cut, and no column
    # can be empty again before the next rows go.
    occupied = occupancy(rows, by, row_id).withColumn("at", F.col("col"))
    empty = occupied.where("occupied = 0").select(*keys)
    filled = renumbered(occupied.where("occupied > 0"), "at")
    inserted = settle(insertion_columns(rows, by, row_id, occupied=filled, **limits).join(empty, keys, "left_anti"))
    note("remove_gap_only", "column", empty, "col")
    note("remove_insertions", "column", inserted, "col")
    gone = empty.unionByName(inserted)
    kept = columns.join(gone, keys, "left_anti").withColumn("_original", F.col("col"))
    columns = settle(renumbered(kept, "_original"))
    rows = settle(without_columns(rows, gone, by, row_id))
    rows = drop_rows("remove_short", remove_short(rows, min_length))
    empty = settle(gap_only_columns(rows, by, row_id))
    note("remove_gap_only", "column", columns.join(empty, keys, "left_semi"), "_original")
    rows = settle(without_columns(rows, empty, by, row_id))
    removed = log[0]
    for entry in log[1:]:
        removed = removed.unionByName(entry)
    return rows, removed


def cleaned_summary(cleaned: DataFrame, by: Sequence[str] = ("grp",), row_id: str = "seq_id") -> DataFrame:
    """Consensus of each cleaned alignment with its lengths."""
    return consensus(cleaned, CONSENSUS_SHARE, by, row_id).select(
        *by, "consensus",
        ungapped_length("consensus").cast("bigint").alias("length_no_gaps"),
        F.length("consensus").cast("bigint").alias("length_with_gaps"),
    )
