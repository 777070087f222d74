"""Interval checks, extraction of sequences from a chunked genome, and interval overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.session import broadcast_if_small, settle
from seqspark.sources.genome import chunk_size

# What a row gets when its sequence cannot be cut out.
FAILED_SEQUENCE = "N" * 100

OVERLAP_BIN = 16384

# Intervals of a list that meets a copy of its chunk, on average.
LIST = 4096


def contigs(genome: DataFrame) -> DataFrame:
    """One row per contig of a chunk table: every contig has exactly one chunk starting at 0."""
    return genome.where(F.col("chunk_start") == 0).select("chrom", "chrom_idx", "chrom_len")


def validate_intervals(
    ann: DataFrame, genome: DataFrame, chrom: str = "chr", start: str = "start", stop: str = "stop"
) -> DataFrame:
    """Add ``reason``: NULL for an interval inside a known contig, else why it cannot be cut out.

    Coordinates are 0-based and half-open.
    """
    known = contigs(genome).select(F.col("chrom").alias("_chrom"), F.col("chrom_len").alias("_len"))
    a, b = F.col(start), F.col(stop)
    reason = (
        F.when(a.isNull() | b.isNull(), F.lit("missing coordinate"))
        .when((a < 0) | (b < 0), F.lit("negative coordinate"))
        .when(b <= a, F.lit("stop not after start"))
        .when(F.col("_len").isNull(), F.lit("unknown contig"))
        .when(b > F.col("_len"), F.lit("stop beyond contig"))
    )
    return ann.join(known, ann[chrom] == F.col("_chrom"), "left").withColumn("reason", reason).drop("_chrom", "_len")


def extract_sequences(
    ann: DataFrame, genome: DataFrame, row_id: str = "row_id",
    chrom: str = "chr", start: str = "start", stop: str = "stop",
    name: str = "seq", drop_failed: bool = False, per_list: int = LIST,
) -> DataFrame:
    """Cut ``[start, stop)`` out of the genome for every row, with ``reason`` as for validation.

    Only chunks that an interval asks for are moved or cut: the distinct keys asked for go to the genome first.
    A chunk then meets its intervals as lists of bounded size, a much asked chunk one list after another in
    tasks of their own. An interval inside one chunk needs nothing more; only longer ones are put together
    again, each list holding the pieces of one interval. Failed rows get the fixed placeholder, or go with
    ``drop_failed``.
    """
    chunk = chunk_size(genome)
    # Settled: the keys asked for, the lists and the failed rows all come from it.
    checked = settle(validate_intervals(ann, genome, chrom, start, stop))
    good = checked.where(F.col("reason").isNull())
    bad = checked.where(F.col("reason").isNotNull()).withColumn(name, F.lit(FAILED_SEQUENCE))
    low, high = F.floor(F.col(start) / chunk), F.floor((F.col(stop) - 1) / chunk)
    asking = good.select(
        F.struct(*checked.columns).alias("_row"), F.col(row_id).alias("_id"), F.col(chrom).alias("_chrom"),
        (low < high).alias("_long"), F.explode(F.sequence(low, high)).alias("_chunk"),
    )
    at = ["_chrom", "_chunk"]
    wanted = settle(asking.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / per_list).cast("int").alias("_lists")))
    wanted = broadcast_if_small(wanted)
    salt = F.pmod(F.xxhash64("_id"), F.col("_lists")).cast("int")
    lists = asking.join(wanted, at).groupBy(*at, salt.alias("_list")).agg(F.collect_list(F.struct("_row", "_long")).alias("_rows"))
    found = genome.select(
        F.col("chrom").alias("_chrom"), F.floor(F.col("chunk_start") / chunk).alias("_chunk"), F.col("chunk_start").alias("_at"), "seq", "owned"
    ).join(wanted, at)
    copies = found.select(
        *at, "_at", F.substring(F.col("seq"), F.lit(1), F.col("owned")).alias("_text"),
        F.explode(F.sequence(F.lit(0), F.col("_lists") - 1)).alias("_list"),
    )
    met = lists.join(copies, [*at, "_list"]).select("_at", "_text", F.explode("_rows").alias("_r")).select(
        "_at", "_text", "_r._long", "_r._row.*"
    )
    piece = F.substring(
        F.col("_text"),
        (F.greatest(F.col(start), F.col("_at")) - F.col("_at") + 1).cast("int"),
        (F.least(F.col(stop), F.col("_at") + chunk) - F.greatest(F.col(start), F.col("_at"))).cast("int"),
    )
    inside = met.where(~F.col("_long")).withColumn(name, piece).select(*checked.columns, name)
    pieces = met.where("_long").select(row_id, F.struct("_at", piece.alias("text")).alias("_piece"))
    joined = pieces.groupBy(row_id).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_piece")), lambda p: p["text"]), "").alias(name)
    )
    whole = inside.unionByName(good.where(low < high).join(joined, row_id).select(*checked.columns, name))
    return whole if drop_failed else whole.unionByName(bad)


def extraction_errors(
    ann: DataFrame, genome: DataFrame, row_id: str = "row_id",
    chrom: str = "chr", start: str = "start", stop: str = "stop",
) -> DataFrame:
    """A message for every row whose sequence cannot be cut out."""
    where = F.format_string("%s:%d-%d", F.col(chrom).cast("string"), start, stop)
    # Wording of the messages.
    message = (
        F.when(
            F.col("reason") == "negative coordinate",
            F.format_string("Invalid coordinates: start=%d, stop=%d", start, stop),
        )
        .when(
            F.col("reason") == "stop not after start",
            F.format_string("stop (%d) must be > start (%d)", stop, start),
        )
        .when(F.col("reason") == "missing coordinate", F.lit("missing coordinate"))
        .otherwise(F.concat(F.lit("Could not extract "), where, F.lit(" from genome")))
    )
    failed = validate_intervals(ann, genome, chrom, start, stop).where(F.col("reason").isNotNull())
    return failed.select(
        row_id,
        "reason",
        F.concat(
            F.lit("Row "), F.col(row_id).cast("string"), F.lit(": "), where, F.lit(" - ValueError: "), message
        ).alias("message"),
    )


def extraction_counts(checked: DataFrame) -> DataFrame:
    """Rows per outcome of the interval check (``ok`` where there is no reason)."""
    return checked.groupBy(F.coalesce("reason", F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


def overlap_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ends: tuple[str, str], right_ends: tuple[str, str],
    size: int = OVERLAP_BIN,
) -> DataFrame:
    """Pairs with equal keys whose intervals overlap: ``left.start < right.stop`` and
    ``right.start <= left.stop``.

    Both sides are listed once per bin they touch and meet in an equi-join. A pair sharing several bins
    is taken only in the first of them, so no distinct is needed.
    """
    (ls, le), (rs, re) = left_ends, right_ends
    binned_left = left.withColumn(
        "_bin", F.explode(F.sequence(F.floor(F.col(ls) / size), F.floor(F.greatest(F.col(le), F.col(ls)) / size)))
    )
    binned_right = right.withColumn(
        "_bin", F.explode(F.sequence(F.floor(F.col(rs) / size), F.floor(F.greatest(F.col(re), F.col(rs)) / size)))
    )
    first_shared = F.greatest(F.floor(F.col(ls) / size), F.floor(F.col(rs) / size))
    return (
        binned_left.join(binned_right, [*keys, "_bin"])
        .where((F.col(ls) < F.col(re)) & (F.col(rs) <= F.col(le)) & (F.col("_bin") == first_shared))
        .drop("_bin")
    )
