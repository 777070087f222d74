"""Token ids in files of fixed-width bit-packed blocks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqspark.llm.common import slices, text_or_empty
from seqspark.llm.tokens import DEFAULT_VOCABULARY, encoder

END_ID = 2

# A block ends with the document that brings it to so many ids.
BLOCK_IDS = 65_536

_BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary()),
])
_BLOCK_DDL = ("part int, block int, first bigint, n_ids bigint, width int, doc_ids array<bigint>, offsets array<bigint>, "
              "payload binary")


# Widths that are numbers of the machine.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def id_width(vocabulary_size: int) -> int:
    """The fewest bits that hold every id below ``vocabulary_size``."""
    return max(1, (int(vocabulary_size) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive ``width``-bit numbers, lowest bit first, padded to whole 64-bit words and one more."""
    words = np.zeros((len(ids) * width + 63) // 64 + 1, dtype="<u8")
    if width in _WHOLE:
        # Numbers of whole bytes lie side by side as they are.
        words.view(_WHOLE[width])[: len(ids)] = ids
        return words.tobytes()
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    if len(ids):
        at = np.arange(len(ids), dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # Numbers that start in one word are neighbours; their bits do not overlap, so adding joins them.
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[starts]] = np.add.reduceat(ids << shift, starts)
        over = shift + np.uint64(width) > np.uint64(64)
        words[word[over] + 1] |= ids[over] >> (np.uint64(64) - shift[over])
    return words.astype("<u8").tobytes()


def unpack(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive) of a packed block, read without touching the others."""
    if width in _WHOLE:
        return np.frombuffer(payload, dtype=_WHOLE[width])[start:stop].astype(np.uint32)
    words = np.frombuffer(payload, dtype="<u8")
    at = np.arange(start, stop, dtype=np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = words[word] >> shift
    # A shift by 64 is undefined, so the upper part is moved in two steps.
    high = (words[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
    return ((low | high) & np.uint64((1 << width) - 1)).astype(np.uint32)


def _blocks(vocabulary: str, end_id: int, block_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        tokenizer = encoder(vocabulary)
        width = id_width(max(tokenizer.size, end_id + 1))
        end = struct.pack("<I", end_id)
        first, block, names, texts, held = 0, 0, [], [], 0

        def row():
            nonlocal first, block, names, texts, held
            offsets = np.cumsum([0, *[len(t) // 4 for t in texts]])
            payload = pack(np.frombuffer(b"".join(texts), dtype="<u4"), width)
            values = [part, block, first, int(offsets[-1]), width, names, offsets.tolist(), payload]
            first, block, names, texts, held = first + int(offsets[-1]), block + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)

        for batch in batches:
            for piece in slices(batch):
                encoded = tokenizer.encode(piece.column("text").to_pylist())
                for name, ids in zip(piece.column("doc_id").to_pylist(), encoded, strict=True):
                    names.append(name)
                    texts.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= block_ids:
                        yield row()
        if names:
            yield row()

    return run


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Write the ids of every whole text, ``end_id`` after each, in ascending ``doc_id`` order.

    The files are Parquet; a row is a block of whole documents: its ids packed into the fewest bits the
    vocabulary needs, the ids before it in its file part, and where each document begins in it. An id has a
    known bit position, so any range can be unpacked alone. A long document is a block of its own.

    A null text is an empty one (only the end id). Null ids come first; equal ids are ordered by a hash of
    the text, and repeated rows are written as often as they occur. An empty table gives files without rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    order = ["doc_id", "_tie"]
    (
        rows.withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_blocks(vocabulary, end_id, block_ids), _BLOCK_DDL)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def _documents(with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                offsets = value["offsets"]
                ids = unpack(value["payload"], value["width"], 0, offsets[-1]).astype("<u4")
                cuts = [ids[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
                before = value["base"] + value["first"]
                columns = {
                    "doc_id": pa.array(value["doc_ids"], pa.int64()),
                    "start": pa.array([before + a for a in offsets[:-1]], pa.int64()),
                    "n_tokens": pa.array([len(c) for c in cuts], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([c.tolist() for c in cuts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``."""
    blocks = spark.read.parquet(path)
    # One row per file part: the ids in all parts before it.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    columns = ["base", "first", "width", "doc_ids", "offsets", "payload"]
    return blocks.join(F.broadcast(bases), "part").select(*columns).mapInArrow(_documents(with_ids), schema)


def read_id_range(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the whole corpus; only the blocks that hold them are read."""
    blocks = spark.read.parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))
    at = F.col("base") + F.col("first")
    rows = (
        blocks.join(F.broadcast(bases), "part").withColumn("at", at)
        .where((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))
        .orderBy("at").select("at", "n_ids", "width", "payload").toLocalIterator()
    )
    cuts = [unpack(bytes(r.payload), r.width, max(0, start - r["at"]), min(r.n_ids, stop - r["at"])) for r in rows]
    return np.concatenate(cuts) if cuts else np.zeros(0, dtype=np.uint32)
