"""FASTA: a splittable scan into chunks or records, and the sink."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqspark.functions.sequence import fold_case, wrap_lines
from seqspark.session import broadcast_if_small, settle
from seqspark.sources.genome import CHUNK, noted

LINE = 80
NAME_LENGTH = 50
BLANKS = " \t\r\n"

_BLOCK = ["_file", "_block"]


# Lines as they are numbered inside their file block: characters and headers so far, and the characters that
# came before the last header.
_NUMBERED = (
    "_file string, _block bigint, _head boolean, name string, text string, _run bigint, _heads bigint, _head_run bigint"
)


def _number_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines where they are read: a task reads its file blocks one after another, each from its start."""
    at, run, heads, last = None, 0, 0, -1
    for batch in batches:
        file, block, head, _, text = batch.columns
        # A task reads few blocks; a batch is cut where the next one begins.
        change = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        cuts = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        is_head = head.to_numpy(zero_copy_only=False)
        size = pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        runs, counts, lasts = (np.empty(batch.num_rows, dtype=np.int64) for _ in range(3))
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            here = (file[a].as_py(), block[a].as_py())
            if here != at:
                at, run, heads, last = here, 0, 0, -1
            runs[a:b] = run + np.cumsum(size[a:b])
            counts[a:b] = heads + np.cumsum(is_head[a:b])
            # Characters never become fewer, so the last header is the one that has the most before it.
            lasts[a:b] = np.maximum(np.maximum.accumulate(np.where(is_head[a:b], runs[a:b], -1)), last)
            run, heads, last = runs[b - 1], counts[b - 1], lasts[b - 1]
        added = [pa.array(runs), pa.array(counts), pa.array(lasts, mask=lasts < 0)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "_run", "_heads", "_head_run"])


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines, numbered within their file block by the task that reads it; no text is moved."""
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    head = F.startswith("value", F.lit(">"))
    marked = raw.select(
        *_BLOCK,
        head.alias("_head"),
        F.when(head, F.split(F.btrim(F.substring("value", 2, 1 << 30), F.lit(BLANKS)), r"\s+")[0]).alias("name"),
        F.when(~head, fold_case(F.btrim(F.col("value"), F.lit(BLANKS)))).alias("text"),
    )
    return marked.mapInArrow(_number_lines, _NUMBERED)


def _lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Sequence lines with their contig number and offset in the contig, and the headers.

    Files may be split anywhere. What a block inherits from the blocks before it (header and offset) comes from
    a table with one row per block.
    """
    # Read three times below, so the files are scanned once and the result is kept.
    local = settle(scan_lines(spark, path))
    # One row per file block from here to `inherited`.
    blocks = local.groupBy(*_BLOCK).agg(
        F.max("_heads").alias("_n"), F.max("_run").alias("_size"), F.max("_head_run").alias("_last")
    )
    earlier = Window.orderBy(*_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        *_BLOCK, "_last",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_heads_before"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_size_before"),
    )
    inherited = placed.select(
        *_BLOCK, "_heads_before", "_size_before",
        F.max(F.col("_size_before") + F.col("_last")).over(earlier).alias("_inherited"),
    )
    known = local.join(broadcast_if_small(settle(inherited)), _BLOCK).withColumn(
        "contig_no", F.col("_heads_before") + F.col("_heads")
    )
    begin = F.greatest(F.col("_inherited"), F.col("_size_before") + F.col("_head_run"))
    lines = known.where(~F.col("_head") & (F.col("contig_no") > 0) & (F.length("text") > 0)).select(
        "contig_no",
        (F.col("_size_before") + F.col("_run") - F.length("text") - begin).alias("offset"),
        "text",
    )
    headers = known.where("_head").select("contig_no", "name")
    return lines, headers


def _chunks(lines: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunks put together from the lines that reach into them; each holds at most one chunk of text."""
    first = F.floor(F.greatest(F.col("offset") - overlap, F.lit(0)) / chunk)
    last = F.floor((F.col("offset") + F.length("text") - 1) / chunk)
    spread = lines.withColumn("_chunk", F.explode(F.sequence(first, last)))
    begin = F.col("_chunk") * chunk
    low = F.greatest(F.col("offset"), begin)

    def up_to(size: int) -> Column:
        return F.least(F.col("offset") + F.length("text"), begin + size) - low

    clipped = spread.select(
        "contig_no",
        begin.alias("chunk_start"),
        F.struct(
            low.alias("at"),
            F.substring(
                F.col("text"), (low - F.col("offset") + 1).cast("int"), up_to(chunk + overlap).cast("int")
            ).alias("text"),
        ).alias("_piece"),
        F.greatest(up_to(chunk), F.lit(0)).alias("_own"),
    )
    return clipped.groupBy("contig_no", "chunk_start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_piece")), lambda p: p["text"]), "").alias("seq"),
        F.sum("_own").cast("int").alias("owned"),
    )


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK, overlap: int = 0) -> DataFrame:
    """A FASTA file or folder as a chunk table; see `chunk_table` for the columns.

    The name is the first token of the header. Text before the first header is ignored. A name that
    comes again keeps its first place and its last sequence.
    """
    lines, headers = _lines(spark, path)
    chunks = _chunks(lines, chunk, overlap)
    lengths = lines.groupBy("contig_no").agg(F.max(F.col("offset") + F.length("text")).alias("chrom_len"))
    named = headers.groupBy(F.col("name").alias("chrom")).agg(
        F.max("contig_no").alias("contig_no"), (F.min("contig_no") - 1).alias("chrom_idx")
    )
    contigs = named.join(lengths, "contig_no", "left").withColumn("chrom_len", F.coalesce("chrom_len", F.lit(0)))
    return contigs.join(chunks, "contig_no", "left").select(
        "chrom",
        "chrom_idx",
        F.coalesce("chunk_start", F.lit(0)).alias("chunk_start"),
        noted(F.coalesce("seq", F.lit("")), chunk, overlap),
        F.coalesce("owned", F.lit(0)).alias("owned"),
        "chrom_len",
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A FASTA file of many shorter records: ``(seq_id, name, seq)``, ids in file order from 0."""
    lines, headers = _lines(spark, path)
    chunks = _chunks(lines, CHUNK, 0)
    whole = chunks.groupBy("contig_no").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("chunk_start", "seq"))), lambda c: c["seq"]), ""
        ).alias("seq")
    )
    return headers.join(whole, "contig_no", "left").select(
        (F.col("contig_no") - 1).alias("seq_id"), "name", F.coalesce("seq", F.lit("")).alias("seq")
    )


def read_alignment(spark: SparkSession, path: str) -> DataFrame:
    """An aligned FASTA file as rows ``(seq_id, name, seq)``; all rows must have the same width."""
    records = read_records(spark, path)
    widest = records.agg(F.max(F.length("seq"))).scalar()
    return records.withColumn(
        "seq",
        F.when(F.length("seq") == widest, F.col("seq")).otherwise(
            F.raise_error(F.concat(F.lit("alignment rows differ in width: "), F.col("name")))
        ),
    )


def _record(header: Column, seq: Column) -> Column:
    return F.when(F.length(seq) > 0, F.concat(header, F.lit("\n"), wrap_lines(seq, LINE))).otherwise(header)


def to_fasta(
    df: DataFrame, row_id: str = "row_id", name: str = "TE_name", cluster: str = "cluster", seq: str = "seq"
) -> DataFrame:
    """One FASTA record per row in column ``record``: ``>row<id>|<name>|cluster<c>`` and wrapped lines."""
    header = F.concat(
        F.lit(">row"), F.col(row_id).cast("string"),
        F.lit("|"), F.coalesce(F.substring(F.col(name), 1, NAME_LENGTH), F.lit("")),
        F.lit("|cluster"), F.coalesce(F.col(cluster).cast("string"), F.lit("")),
    )
    return df.select(row_id, _record(header, fold_case(F.btrim(F.col(seq), F.lit(BLANKS)))).alias("record"))


def combine_fasta(df: DataFrame, family: str, cluster: str = "cluster", seq: str = "consensus") -> DataFrame:
    """The consensus of every cluster as a record, in cluster order."""
    header = F.concat(F.lit(f">{family}_cluster"), F.col(cluster).cast("string"), F.lit("_consensus"))
    return df.orderBy(cluster).select(cluster, _record(header, F.col(seq)).alias("record"))


def write_fasta(records: DataFrame, path: str) -> None:
    """Write the ``record`` column; the part files follow the order of the partitions."""
    records.select("record").write.text(path)
