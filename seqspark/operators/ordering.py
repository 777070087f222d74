"""Global order without a single-task sort: ranks, running totals and first-n selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqspark.session import settle

# monotonically_increasing_id keeps the partition number above the low 33 bits.
_LOCAL_BITS = 33

BLOCK = 65536


def with_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank", first: int = 1) -> DataFrame:
    """Number all rows in a total order.

    Rows are range-partitioned and sorted, numbered inside their partition, and shifted by the sizes of
    the partitions before. The sorted table is checkpointed because the sizes and the rows are read from
    it separately and have to agree. What is broadcast is one row per partition.
    """
    ordered = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local + F.lit(first))
        .drop("_at", "_part", "_offset")
    )


def with_row_id(df: DataFrame, order: Sequence[Column | str], name: str = "row_id") -> DataFrame:
    """Dense 0-based row id in the given total order."""
    return with_rank(df, order, name, first=0)


def running_total(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Running sum of ``value`` per ``key`` along the integer column ``order``.

    Summed per block of order values first, so that a key holding most rows is still spread over one
    window group per block. The input is read twice and therefore checkpointed.
    """
    blocked = settle(df.withColumn("_block", F.floor(F.col(order) / BLOCK)))
    totals = blocked.groupBy(key, "_block").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(offsets, [key, "_block"])
        .withColumn(name, F.col("_before") + F.sum(value).over(inside))
        .drop("_block", "_before")
    )


def first_per_key(
    df: DataFrame, key: str, levels: Sequence[Sequence[str]], order: Sequence[str], n: int
) -> DataFrame:
    """The first ``n`` rows of every key in ``order``.

    ``levels`` are columns that cut the order into ever smaller stretches. Only stretches that begin
    before row ``n`` survive each level, judged from counts alone, so the final numbering of a key sees
    about ``n`` rows plus one finest stretch, however many rows the key has.
    """
    finest = df.groupBy(key, *[c for level in levels for c in level]).agg(F.count(F.lit(1)).alias("_n"))
    kept: DataFrame | None = None
    cols: list[str] = []
    for level in levels:
        outer = [key, *cols]
        cols = [*cols, *level]
        sizes = finest.groupBy(key, *cols).agg(F.sum("_n").alias("_n"))
        if kept is not None:
            sizes = sizes.join(kept, outer, "left_semi")
        before = Window.partitionBy(key).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
        kept = (
            sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .where(F.col("_before") < n)
            .select(key, *cols)
        )
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    survivors = df.join(kept, [key, *cols], "left_semi")
    return survivors.withColumn("_number", number).where(F.col("_number") <= n).drop("_number")
