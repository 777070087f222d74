"""The chunk table: contigs cut into chunks that overlap, so that no string grows with a contig."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqspark.functions.sequence import fold_case, pieces

CHUNK = 16384


def noted(seq: Column, chunk: int, overlap: int) -> Column:
    """The chunk column, carrying its chunk size and overlap as column metadata."""
    return seq.alias("seq", metadata={"chunk": chunk, "overlap": overlap})


def chunk_size(genome: DataFrame) -> int:
    return genome.schema["seq"].metadata["chunk"]


def require_overlap(genome: DataFrame, k: int) -> None:
    """Fail if a word of length ``k`` could hide between two chunks."""
    overlap = genome.schema["seq"].metadata.get("overlap", 0)
    if overlap < k - 1:
        raise ValueError(f"genome chunks overlap by {overlap} characters, words of {k} need {k - 1}")


def chunk_table(
    df: DataFrame, chrom: str, seq: str, order: str, chunk: int = CHUNK, overlap: int = 0
) -> DataFrame:
    """Chunks of a table holding one whole contig per row.

    ``(chrom, chrom_idx, chunk_start, seq, owned, chrom_len)``: a chunk owns its first ``owned``
    characters; up to ``overlap`` more from the next chunk follow them. An empty contig has one empty chunk.
    """
    text = fold_case(seq)
    cut = F.when(F.length(seq) > 0, pieces(text, chunk, overlap)).otherwise(F.array(F.lit("")))
    length = F.length(seq).cast("bigint")
    chunks = df.select(
        F.col(chrom).cast("string").alias("chrom"),
        F.col(order).cast("bigint").alias("chrom_idx"),
        length.alias("chrom_len"),
        F.posexplode(cut).alias("_i", "seq"),
    )
    start = F.col("_i").cast("bigint") * chunk
    return chunks.select(
        "chrom",
        "chrom_idx",
        start.alias("chunk_start"),
        noted(F.col("seq"), chunk, overlap),
        F.least(F.lit(chunk), F.col("chrom_len") - start).cast("int").alias("owned"),
        "chrom_len",
    )
