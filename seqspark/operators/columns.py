"""Characters of alignments counted column by column, without a row for any cell.

A task adds the rows it reads to tables of counts, one for each group and stretch of columns, and hands on
what is not 0 as arrays. Tables of one stretch are added up where they meet. So what moves grows with the
columns and the tasks, and neither with the cells nor with the rows of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqspark.functions.sequence import GAP, fold_case
from seqspark.session import ship_package

# Columns of a stretch.
STRETCH = 1024

# Bytes of counts a task holds before it hands them on.
HELD_BYTES = 96 * 1024 * 1024

# Tables of one stretch are added up in this many places first if there are many more of them.
SALTS = 32

UNKNOWN = "N"
_NEVER = np.iinfo(np.int64).max


class _Alphabet:
    """Numbers the characters as they turn up."""

    def __init__(self):
        self.place = np.full(0x110000, -1, dtype=np.int32)
        self.codes: list[int] = []

    def places(self, codes: np.ndarray) -> np.ndarray:
        found = self.place[codes]
        if (found < 0).any():
            for c in np.unique(codes[found < 0]).tolist():
                self.place[c] = len(self.codes)
                self.codes.append(c)
            found = self.place[codes]
        return found


class _Table:
    """Counts of a stretch by column and character, and the lowest row with each; rows and columns seen."""

    def __init__(self, room: int):
        self.counts = np.zeros((STRETCH, room), dtype=np.int64)
        self.first = np.full((STRETCH, room), _NEVER, dtype=np.int64)
        # Rows that count in ``rows`` only do so in stretch 0; ``seen`` counts all that were added.
        self.rows = self.width = self.seen = 0

    @property
    def bytes(self) -> int:
        return 2 * self.counts.nbytes

    def fit(self, characters: int) -> None:
        room = self.counts.shape[1]
        if characters > room:
            more = max(characters, 2 * room) - room
            self.counts = np.pad(self.counts, ((0, 0), (0, more)))
            self.first = np.pad(self.first, ((0, 0), (0, more)), constant_values=_NEVER)

    def add(self, columns: np.ndarray, places: np.ndarray, counts: np.ndarray | int, first: np.ndarray | int) -> None:
        """Each pair of a column and a place at most once."""
        at = columns * self.counts.shape[1] + places
        flat_counts, flat_first = self.counts.reshape(-1), self.first.reshape(-1)
        flat_counts[at] += counts
        flat_first[at] = np.minimum(flat_first[at], first)


_TABLE = [
    ("stretch", T.IntegerType()), ("rows", T.LongType()), ("width", T.IntegerType()), ("columns", T.ArrayType(T.IntegerType())),
    ("characters", T.ArrayType(T.IntegerType())), ("counts", T.ArrayType(T.LongType())), ("firsts", T.ArrayType(T.LongType())),
]
_COUNTED = [
    ("stretch", T.IntegerType()), ("rows", T.LongType()), ("width", T.IntegerType()),
    ("totals", T.ArrayType(T.LongType())), ("tops", T.ArrayType(T.LongType())), ("text", T.StringType()),
]


def _schema(rows: DataFrame, by: Sequence[str], fields: list) -> T.StructType:
    return T.StructType([*[rows.schema[c] for c in by], *[T.StructField(n, t) for n, t in fields]])


def _emit(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _written(key: tuple, stretch: int, table: _Table, alphabet: _Alphabet) -> tuple:
    flat = table.counts.reshape(-1)
    at = np.flatnonzero(flat)
    room = table.counts.shape[1]
    codes = np.array(alphabet.codes, dtype=np.int32)
    characters = codes[at % room] if len(at) else np.zeros(0, dtype=np.int32)
    return (*key, stretch, table.rows, table.width, (at // room).astype(np.int32), characters, flat[at], table.first.reshape(-1)[at])


def _count(by: list[str], schema: pa.Schema, gaps: bool):
    """Tables of the rows ``by, _id, _text`` of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = _Alphabet()
        held: dict[tuple, _Table] = {}
        used = 0

        def table(key: tuple, stretch: int) -> _Table:
            nonlocal used
            if (key, stretch) not in held:
                held[key, stretch] = _Table(max(8, len(alphabet.codes)))
                used += held[key, stretch].bytes
            return held[key, stretch]

        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in by], strict=True)) if by else [()] * batch.num_rows
            for i, (key, ident) in enumerate(zip(keys, batch.column("_id").to_pylist(), strict=True)):
                text = batch.column("_text")[i].as_py() or ""
                table(key, 0).rows += 1
                for start in range(0, len(text), STRETCH):
                    codes = np.frombuffer(text[start : start + STRETCH].encode("utf-32-le"), dtype="<u4")
                    into = table(key, start // STRETCH)
                    into.width = max(into.width, len(codes))
                    into.seen += 1
                    columns = np.arange(len(codes)) if gaps else np.flatnonzero(codes != ord(GAP))
                    places = alphabet.places(codes[columns])
                    used -= into.bytes
                    into.fit(len(alphabet.codes))
                    used += into.bytes
                    into.add(columns, places, 1, ident)
                if used > HELD_BYTES:
                    # Those that few rows have reached go: what many rows share is added up here for longer.
                    for at in sorted(held, key=lambda at: held[at].seen)[: max(1, len(held) // 2)]:
                        gone = held.pop(at)
                        used -= gone.bytes
                        yield _emit(schema, [_written(*at, gone, alphabet)])
        for (k, s), t in held.items():
            yield _emit(schema, [_written(k, s, t, alphabet)])

    return run


def _add_up(by: list[str], schema: pa.Schema, finish):
    """Tables sorted by group and stretch, those of one stretch added up; ``finish`` makes a row of the sum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = _Alphabet()
        current, total = None, None
        for batch in batches:
            groups = list(zip(*[batch.column(c).to_pylist() for c in [*by, "stretch"]], strict=True))
            for i, group in enumerate(groups):
                if group != current:
                    if total is not None:
                        yield _emit(schema, [finish(current[:-1], current[-1], total, alphabet)])
                    current, total = group, _Table(max(8, len(alphabet.codes)))
                columns, characters, counts, firsts = (
                    np.asarray(batch.column(c)[i].values) for c in ("columns", "characters", "counts", "firsts")
                )
                places = alphabet.places(characters)
                total.fit(len(alphabet.codes))
                total.add(columns.astype(np.int64), places, counts, firsts)
                total.rows += batch.column("rows")[i].as_py()
                total.width = max(total.width, batch.column("width")[i].as_py())
        if total is not None:
            yield _emit(schema, [finish(current[:-1], current[-1], total, alphabet)])

    return run


def _chosen(share: float):
    def finish(key: tuple, stretch: int, table: _Table, alphabet: _Alphabet) -> tuple:
        counts, first = table.counts[: table.width], table.first[: table.width]
        totals, tops = counts.sum(axis=1), counts.max(axis=1)
        # Of equally frequent characters the one whose first row is the lowest.
        best = np.where(counts == tops[:, None], first, _NEVER).argmin(axis=1)
        codes = np.array([*alphabet.codes, ord(UNKNOWN)], dtype="<u4")
        sure = (totals > 0) & (tops >= totals * share)
        text = codes[np.where(sure, best, len(codes) - 1)]
        return (*key, stretch, table.rows, table.width, totals, tops, text.tobytes().decode("utf-32-le"))

    return finish


def counted_columns(
    rows: DataFrame, share: float, by: Sequence[str] = ("grp",), row_id: str = "seq_id", gaps: bool = False, salts: int = SALTS
) -> DataFrame:
    """``by, stretch, rows, width, totals, tops, text``: a row per group and stretch of columns.

    ``totals`` counts the characters of each column (gaps only when asked for), ``tops`` the most frequent
    one, and ``text`` has that one where it reaches ``share`` of the total, else ``N``; equal counts go to
    the character seen first in row order. ``rows`` is the group's number of rows in its stretch 0, which
    every group has, and 0 in others. Row ids are whole numbers.
    """
    ship_package(rows.sparkSession)
    by = list(by)
    narrow = rows.select(*by, F.col(row_id).cast("bigint").alias("_id"), fold_case("seq").alias("_text"))
    tables = _schema(rows, by, _TABLE)
    partial = narrow.mapInArrow(_count(by, to_arrow_schema(tables), gaps), tables)
    keys = [*by, "stretch"]
    if narrow.rdd.getNumPartitions() > 4 * salts:
        salted = partial.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        near = salted.repartition(*keys, "_salt").sortWithinPartitions(*keys, "_salt").select(*keys, *[n for n, _ in _TABLE[1:]])
        partial = near.mapInArrow(_add_up(by, to_arrow_schema(tables), _written), tables)
    result = _schema(rows, by, _COUNTED)
    together = partial.repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(_add_up(by, to_arrow_schema(result), _chosen(share)), result)


def joined_text(counted: DataFrame, by: Sequence[str] = ("grp",), name: str = "consensus") -> DataFrame:
    """One string per group that has columns."""
    parts = F.array_sort(F.collect_list(F.struct("stretch", "text")))
    return counted.where("width > 0").groupBy(*by).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias(name))


def sizes_of(counted: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """``by, n, width`` of each group."""
    reach: Column = F.when(F.col("width") > 0, F.col("stretch").cast("bigint") * STRETCH + F.col("width")).otherwise(0)
    return counted.groupBy(*by).agg(F.sum("rows").alias("n"), F.max(reach).cast("bigint").alias("width"))


def column_rows(counted: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """``by, col, total, top, base``: a row per column."""
    each = F.posexplode(F.arrays_zip("totals", "tops", F.split("text", "").alias("bases"))).alias("_i", "_c")
    return counted.where("width > 0").select(*by, "stretch", each).select(
        *by, (F.col("stretch").cast("bigint") * STRETCH + F.col("_i")).alias("col"),
        F.col("_c.totals").alias("total"), F.col("_c.tops").alias("top"), F.col("_c.bases").alias("base"),
    )
