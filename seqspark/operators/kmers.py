"""K-mer tables: positions, postings, the inverted index, counts and vocabulary."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqspark.functions.sequence import fold_case, fold_lower, pieces
from seqspark.operators.exact import Limbs
from seqspark.session import ship_package, width

# Characters per piece when k-mers are exploded: `substring` walks from the start of its string,
# so pieces have to be short.
PIECE = 32

# Up to this many words, texts are tested for them before their k-mers are listed.
FEW_WORDS = 64

UNKNOWN = "N"

# Characters of a text that are cut into stretches at once, and k-mers one task is to meet.
SPAN = 4096
TASK_KMERS = 1 << 20

# Spans numpy cuts at a time, and bits of a bin.
SLICE = 256
BIN_BITS = 24


def positions(df: DataFrame, k: int, seq: str = "seq", keep: Sequence[str] = ()) -> DataFrame:
    """Every k-mer of every sequence: ``keep`` columns, 0-based ``pos``, ``kmer``."""
    cut = df.select(*keep, F.posexplode(pieces(seq, PIECE, k - 1)).alias("_piece", "_text"))
    # A piece is never NULL; saying so spares a second `substring` per k-mer in joins on it.
    cut = cut.withColumn("_text", F.coalesce("_text", F.lit("")))
    starts = F.sequence(F.lit(0), F.least(F.lit(PIECE), F.length("_text") - (k - 1)) - 1)
    spread = cut.where(F.length("_text") >= k).select("*", F.explode(starts).alias("_i"))
    return spread.select(
        *keep,
        (F.col("_piece").cast("bigint") * PIECE + F.col("_i")).alias("pos"),
        F.substring(F.col("_text"), F.col("_i") + 1, F.lit(k)).alias("kmer"),
    )


def holding_any(df: DataFrame, words: DataFrame, word: str, seq: str = "seq") -> DataFrame:
    """Drop texts that hold none of a few words; with more words than a few, keep them all.

    A substring test costs a fraction of listing k-mers. At most ``FEW_WORDS`` + 1 words reach the driver.
    """
    listed = [r[0] for r in words.select(word).distinct().limit(FEW_WORDS + 1).collect()]
    if not 0 < len(listed) <= FEW_WORDS:
        return df
    # Named once in the lambda: spelled out, the text's own expression would be repeated for every word.
    return df.where(
        F.exists(F.array(seq), lambda text: reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in listed]))
    )


def by_row(df: DataFrame, row_id: str) -> DataFrame:
    """Spread sequences over the cluster by row id.

    This moves the text once. Afterwards every aggregation keyed by row and k-mer finds its rows in
    place, and the far larger k-mer table is never shuffled for it.
    """
    return df.repartition(width(df.sparkSession), row_id)


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts in a row as numbers, and where each text begins, the end included."""
    listed = texts.to_pylist()
    whole = "".join(listed)
    sizes = np.fromiter(map(len, listed), np.int64, len(listed))
    codes = np.frombuffer(whole.encode("ascii"), np.uint8) if whole.isascii() else np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum(sizes)])


def _least_words(codes: np.ndarray, k: int) -> np.ndarray:
    """For every k-mer the least hash of the shorter words in it: equal k-mers have equal ones."""
    short = (k + 1) // 2
    wide = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = np.zeros(len(codes) - short + 1, dtype=np.uint64)
        for i in range(short):
            mixed = mixed * np.uint64(0x100000001B3) + wide[i : len(codes) - short + 1 + i]
        for turn, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            mixed = (mixed ^ (mixed >> np.uint64(turn))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(32)
    # Minima of ever longer windows, the last two of them overlapping.
    window, have = k - short + 1, 1
    while have < window:
        step = min(have, window - have)
        mixed = np.minimum(mixed[:-step], mixed[step:])
        have += step
    return mixed


def _gathered(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings of ``size`` characters from ``begin`` on."""
    ends = np.cumsum(size)
    taken = codes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)]
    if codes.dtype == np.uint8:
        data = taken.tobytes()
    else:
        width_of = 1 + (taken >= 0x80).astype(np.int64) + (taken >= 0x800) + (taken >= 0x10000)
        ends = np.concatenate([[0], np.cumsum(width_of)])[ends]
        data = taken.tobytes().decode("utf-32-le").encode()
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)).cast(pa.string())


def _stretches(
    k: int, keep: Sequence[str], without: str | None
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of up to ``PIECE`` k-mers in a row that have the same least word, as one text each.

    K-mers holding the letter ``without`` are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A few at a time: numpy holds some 100 bytes a character.
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            codes, bounds = _codes(batch.column("_text"))
            if len(codes) < k:
                continue
            least = _least_words(codes, k)
            sizes = np.diff(bounds)
            row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - (k - 1), 0))
            counts = np.maximum(sizes - (k - 1), 0)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = bounds[row] + inside
            if without is not None:
                held = np.concatenate([[0], np.cumsum(codes == ord(without))])
                free = np.flatnonzero(held[at + k] == held[at])
                row, inside, at = row[free], inside[free], at[free]
            least = least[at]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])
            starts = np.flatnonzero(new)
            since = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
            starts = np.flatnonzero(since % PIECE == 0)
            size = np.diff(np.append(starts, len(row))) + (k - 1)
            own = pa.array(row[starts])
            piece = batch.column("_piece").to_numpy(zero_copy_only=False).astype(np.int64)
            columns = {c: batch.column(c).take(own) for c in keep}
            # Least hashes are small numbers; their low bits are as good as any.
            columns["bin"] = pa.array((least[starts] & np.uint64((1 << BIN_BITS) - 1)).astype(np.int64))
            columns["_first"] = pa.array(piece[row[starts]] * SPAN + inside[starts])
            columns["_text"] = _gathered(codes, at[starts], size)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def task_count(df: DataFrame, seq: str = "seq") -> int:
    """So many tasks that one meets about ``TASK_KMERS`` k-mers however large the table is; texts are measured."""
    total = df.agg(F.sum(F.octet_length(seq).cast("bigint"))).first()[0] or 0
    return max(width(df.sparkSession), -(-total // TASK_KMERS))


def binned_positions(
    df: DataFrame, k: int, seq: str = "seq", keep: Sequence[str] = (), without: str | None = None, tasks: int | None = None
) -> DataFrame:
    """`positions`, less k-mers holding the letter ``without``, in which all places of a k-mer meet in one task, told by its ``bin``.

    The bin of a k-mer is the least hash of the words of half its length in it, so several k-mers in a row share
    one. Such a stretch is moved as one text, a few bytes a k-mer, and cut where it arrives: what is grouped by
    bin and k-mer afterwards is never shuffled. ``tasks`` share the bins (default: `task_count`).
    """
    ship_package(df.sparkSession)
    # A piece is never NULL, as in `positions`.
    cut = df.select(*keep, F.posexplode(pieces(seq, SPAN, k - 1)).alias("_piece", "_text")).withColumn(
        "_text", F.coalesce("_text", F.lit(""))
    )
    fields = [f for f in cut.schema.fields if f.name in keep]
    schema = T.StructType([
        *fields, T.StructField("bin", T.LongType()), T.StructField("_first", T.LongType()), T.StructField("_text", T.StringType())
    ])
    moved = cut.mapInArrow(_stretches(k, [f.name for f in fields], without), schema).repartition(
        tasks or task_count(df, seq), "bin"
    )
    moved = moved.withColumn("_text", F.coalesce("_text", F.lit("")))
    spread = moved.select("*", F.explode(F.sequence(F.lit(0), F.length("_text") - k)).alias("_i"))
    return spread.select(
        *keep, "bin", (F.col("_first") + F.col("_i")).alias("pos"),
        F.substring(F.col("_text"), F.col("_i") + 1, F.lit(k)).alias("kmer"),
    )


def binned_postings(
    df: DataFrame, k: int, row_id: str = "row_id", seq: str = "seq", keep: Sequence[str] = ()
) -> DataFrame:
    """`postings` with the ``bin`` of each k-mer; `kmer_index` puts them together without moving them again."""
    folded = df.select(row_id, *keep, fold_case(seq).alias("_seq"))
    found = binned_positions(folded, k, "_seq", [row_id, *keep], UNKNOWN, task_count(df, seq))
    return found.groupBy("bin", row_id, *keep, "kmer").agg(F.min("pos").alias("pos"))


def postings(
    df: DataFrame, k: int, row_id: str = "row_id", seq: str = "seq", keep: Sequence[str] = ()
) -> DataFrame:
    """Distinct (row, k-mer) with the first position; k-mers holding an ``N`` are left out."""
    folded = by_row(df, row_id).select(row_id, *keep, fold_case(seq).alias("_seq"))
    found = positions(folded, k, "_seq", [row_id, *keep]).where(~F.contains("kmer", F.lit(UNKNOWN)))
    return found.groupBy(row_id, *keep, "kmer").agg(F.min("pos").alias("pos"))


def kmer_index(
    posted: DataFrame, row_id: str = "row_id", weight: str = "total_expr", by: Sequence[str] = (), limbs: Limbs | None = None
) -> DataFrame:
    """Per k-mer (and group): rows covered, their summed weight, and the first occurrence.

    All four aggregates have fixed-width buffers, so both halves are hash aggregates and a frequent
    k-mer is combined before the shuffle. Weights are added exactly, as whole numbers: rankings must not hang
    on the order of a floating-point sum, nor on digits cut off. ``limbs`` says how; taken from the table of
    rows (``Limbs.of(rows, weight)``) it spares a pass over the postings. Binned postings stay in their bins.
    """
    limbs = limbs or Limbs.of(posted, weight)
    bins = [c for c in posted.columns if c == "bin"]
    return posted.groupBy(*bins, *by, F.col("kmer").alias("primer")).agg(
        F.count(F.lit(1)).alias("coverage"),
        limbs.sum(weight).alias("total_expr"),
        F.min(row_id).alias("first_row"),
        F.min_by("pos", row_id).alias("first_pos"),
    ).drop(*bins)


def kmer_counts(df: DataFrame, k: int, row_id: str = "row_id", seq: str = "seq") -> DataFrame:
    """How often each k-mer occurs in each row; lower-cased, repeats counted, ``N`` kept."""
    folded = by_row(df, row_id).select(row_id, fold_lower(seq).alias("_seq"))
    return positions(folded, k, "_seq", [row_id]).groupBy(row_id, "kmer").agg(F.count(F.lit(1)).alias("n"))


def kmer_vocabulary(
    df: DataFrame, k: int, seq: str = "seq", by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Number of different k-mers (per group), without and with those holding an ``N``."""
    folded = df.select(*by, fold_case(seq).alias("_seq"))
    known = F.when(~F.contains("kmer", F.lit(UNKNOWN)), F.col("kmer"))
    if approximate:
        found = positions(folded, k, "_seq", by)
        return found.groupBy(*by).agg(
            F.approx_count_distinct(known).alias("unique_kmers"),
            F.approx_count_distinct("kmer").alias("vocabulary"),
        )
    distinct = binned_positions(folded, k, "_seq", by, tasks=task_count(df, seq)).groupBy("bin", *by, "kmer").agg(F.count(F.lit(1)).alias("n"))
    return distinct.groupBy(*by).agg(
        F.count(known).alias("unique_kmers"), F.count(F.lit(1)).alias("vocabulary")
    )
