"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.llm.common import broadcast_if_small, drop_repeated_rows, per_batch, settle, text_or_empty, without

# A chunk ends where the rolling hash has MASK_BITS zero bits, between these sizes in bytes.
MASK_BITS = 12
MIN_CHUNK = 2_048
MAX_CHUNK = 65_536

# Parts a group's documents are spread over in the last join.
SALTS = 16

# Bytes the rolling hash looks back over.
WINDOW = 32

_GEAR = np.random.default_rng(20240607).integers(0, 2**32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the last ``WINDOW`` bytes at every position, by doubling the span it covers."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:
        shifted = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += shifted
        span *= 2
    return h


def cut_points(data: np.ndarray, mask_bits: int = MASK_BITS, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks; they depend on nearby content only, so equal passages are cut alike."""
    n = len(data)
    ends: list[int] = []
    if n > least:
        marks = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - mask_bits) == 0) + 1
        begin = 0
        while n - begin > least:
            at = int(np.searchsorted(marks, begin + least))
            end = int(marks[at]) if at < len(marks) else n
            end = min(end, begin + most, n)
            ends.append(end)
            begin = end
        if begin == n:
            return ends
    ends.append(n)
    return ends


def _chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        data = bytes(text.as_buffer())
        whole, begin = hashlib.sha256(data).digest(), 0
        for seq, end in enumerate(cut_points(np.frombuffer(data, dtype=np.uint8))):
            chunk = data[begin:end]
            rows.append((name, whole, seq, hashlib.blake2b(chunk, digest_size=16).digest(), chunk))
            begin = end
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    names = ["doc_id", "whole", "seq", "digest", "bytes"]
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def find_copies(docs: DataFrame, normalise: Callable | None = None) -> DataFrame:
    """Which documents have the same text: ``doc_id, keep_id, group_size, kept, text_sha256``, a row for each.

    Texts are cut where their content says so. Chunks move once, equal ones combined before; chunks with the
    same digest are compared byte by byte, and each distinct one gets an identifier (the digest and a number
    among those that share it). Documents are then compared by their ordered identifiers alone.

    ``normalise`` maps the text column before; without it texts are equal when identical. A null text counts
    as empty, and empty texts are copies of each other. Of a group the row with the largest id stays; null
    ids are smaller than all others. Of repeated rows with that id one is kept. Column names of ``docs``
    cannot clash, as only two are read. An empty table gives no rows.
    """
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (normalise(text) if normalise else text).alias("text"))
    chunks = rows.mapInArrow(per_batch(_chunks), "doc_id bigint, whole binary, seq int, digest binary, bytes binary")
    # The only move of text: digests that stand for more than one content, found by comparing the bytes.
    contents = chunks.groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("_n"))
    clashes = contents.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    clashes = broadcast_if_small(settle(clashes.select(F.col("digest").alias("_clash"))))
    # Such a chunk is identified by its content, any other by the digest, now known to be its own.
    chunk_id = F.when(F.col("_clash").isNull(), F.col("digest")).otherwise(F.concat("digest", "bytes"))
    listed = chunks.join(clashes, F.col("digest") == F.col("_clash"), "left").select(
        "doc_id", "whole", "seq", chunk_id.alias("chunk_id")
    )
    recipes = settle(
        listed.groupBy("doc_id", "whole")
        .agg(
            F.sort_array(F.collect_set(F.struct("seq", "chunk_id"))).alias("recipe"),
            F.sum((F.col("seq") == 0).cast("bigint")).alias("n"),
        )
        .withColumn("recipe", F.col("recipe.chunk_id"))
    )
    groups = (
        recipes.groupBy("recipe")
        .agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .where("group_size > 1")
    )
    joined = _with_groups(recipes, groups)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    occurrence = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.lower(F.hex("whole")).alias("text_sha256"), occurrence.alias("_occurrence"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_occurrence") == 1)).alias("kept"), "text_sha256",
    )


def _with_groups(recipes: DataFrame, groups: DataFrame) -> DataFrame:
    """Joins documents with the group of their recipe; a group's documents are spread over ``SALTS`` parts."""
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = recipes.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["recipe", "_salt"], "left")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without exact copies, one row of each group staying, in its columns."""
    found = find_copies(docs).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return drop_repeated_rows(without(docs, found.select("doc_id", F.unhex("text_sha256").alias("_digest"))))
