"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqspark.session import broadcast_if_small, join_groups, join_on, scratch_path, settle

# Texts a Python function takes up at a time, in characters.
BATCH_CHARS = 4_000_000


# What this worker process keeps between batches, by operator and parameters: one entry at most.
_kept: dict[tuple, object] = {}


def worker_cache(key: tuple, make: Callable[[], object]):
    """What this worker keeps under ``key``, made if it is not there.

    Python workers are used again by later stages, so what another operator kept is let go first: a worker never
    holds more than the largest of these caches, however many operators it has run.
    """
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Nothing is kept from here on: what follows in this worker needs none of it."""
    if _kept:
        _kept.clear()
        _give_back()


def _give_back() -> None:
    """Free memory goes back to the system, where the C library can be asked to; else it waits for its next use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs inside hands batches of about ``size`` bytes to Python workers."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    """The text; empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``n``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def slices(batch: pa.RecordBatch, column: str = "text", chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts hold about ``chars`` bytes, at least one row each."""
    sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)]
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text", chars: int = BATCH_CHARS):
    """A ``mapInArrow`` function that applies ``function`` to slices of bounded text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, chars):
                result = function(part)
                if result is not None and result.num_rows:
                    yield result

    return run


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str], at_least: int) -> Iterator[pa.Table]:
    """Rows sorted by ``keys`` in tables of whole groups, of ``at_least`` rows each unless it is the last."""
    import numpy as np

    def cut(table: pa.Table) -> list[int]:
        begins = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            column = table.column(k).to_numpy()
            begins[1:] |= column[1:] != column[:-1]
        cuts = [0]
        for start in np.flatnonzero(begins).tolist():
            if start - cuts[-1] >= at_least:
                cuts.append(start)
        return cuts

    held: list[pa.RecordBatch] = []
    rows = waiting = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        # A group longer than this is looked through again only when it has doubled.
        if rows < max(at_least, waiting):
            continue
        table = pa.Table.from_batches(held)
        cuts = cut(table)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a).combine_chunks()
        # The last part may go on in the next batch.
        rest = table.slice(cuts[-1]).combine_chunks()
        held, rows = rest.to_batches(), rest.num_rows
        waiting = 2 * rows if rows >= at_least else 0
    if rows:
        table = pa.Table.from_batches(held)
        cuts = cut(table)
        for a, b in zip(cuts, [*cuts[1:], table.num_rows], strict=True):
            yield table.slice(a, b - a).combine_chunks()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder as Parquet and read again: compressed, and cheap to read in part."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_digest(column: str = "text") -> Column:
    """sha256 of the text as bytes; a null text counts as empty."""
    return F.unhex(F.sha2(text_or_empty(column).cast("binary"), 256))


def without(df: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key and text are not in ``gone``, a table of the key and ``_digest``; null keys are equal.

    ``gone`` is settled and broadcast only if measured small.
    """
    gone = broadcast_if_small(settle(gone.select(F.col(key).alias("_gone"), F.col("_digest").alias("_gone_digest")).distinct()))
    same = F.col(key).eqNullSafe(F.col("_gone")) & (text_digest() == F.col("_gone_digest"))
    return df.join(gone, same, "left_anti")


def drop_repeated_rows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each (key, text), a null text being empty. Only rows that occur more than once are moved."""
    own = df.groupBy(F.col(key).alias("_again"), text_digest(text).alias("_again_digest"))
    again = own.agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_again", "_again_digest")
    again = broadcast_if_small(settle(again))
    same = F.col(key).eqNullSafe(F.col("_again")) & (text_digest(text) == F.col("_again_digest"))
    once = df.join(again, same, "left_anti")
    repeated = df.join(again, same, "left_semi").withColumn("_again_digest", text_digest(text))
    return once.unionByName(repeated.dropDuplicates([key, "_again_digest"]).drop("_again_digest"))


__all__ = [
    "BATCH_CHARS", "arrow_batches", "broadcast_if_small", "drop_repeated_rows", "id_remainder", "join_groups", "join_on", "let_go", "per_batch",
    "read_table", "settle", "slices", "stored", "text_digest", "text_or_empty", "whole_groups", "without",
    "worker_cache",
]
