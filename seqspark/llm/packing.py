"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.llm.common import BATCH_CHARS, arrow_batches, let_go, per_batch, settle, text_or_empty
from seqspark.llm.token_files import END_ID
from seqspark.llm.tokens import DEFAULT_VOCABULARY, MAX_KEPT, encoder

CAPACITY = 1024

# Pieces on an island, on average; islands are drawn by hash, so none grows with the corpus.
ISLAND = 16_384

POPULATION = 5
GENERATIONS = 6

# Distinct well-filled bins an island sends to the next one.
ELITE = 512

# Rounds in which elite patterns go to the next island and it breeds on.
MIGRATIONS = 2

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- the algorithm on one island -----------------------------------------------------------------
#
# A solution is a list of bins, a bin a list of item numbers; ``sizes`` gives each item's size.


def best_fit(bins: list[list[int]], items: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Put ``items``, in the order given, each into the fullest bin that still takes it, or a new one."""
    room: dict[int, list[int]] = {}
    mask = 0
    for b, members in enumerate(bins):
        left = capacity - sum([sizes[i] for i in members])
        if left:
            room.setdefault(left, []).append(b)
            mask |= 1 << left
    for item in items:
        size = sizes[item]
        fitting = mask >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            holders = room[left]
            b = holders.pop()
            if not holders:
                mask &= ~(1 << left)
            bins[b].append(item)
        else:
            b, left = len(bins), capacity
            bins.append([item])
        left -= size
        if left:
            holders = room.setdefault(left, [])
            holders.append(b)
            mask |= 1 << left
    return bins


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> float:
    """Mean squared fill: fewer bins score higher, and of equally many those with fuller bins."""
    if not bins:
        return 1.0
    return sum((sum([sizes[i] for i in b]) / capacity) ** 2 for b in bins) / len(bins)


def crossover(
    receiver: list[list[int]], donor: list[list[int]], sizes: list[int], capacity: int, share: float, rng: random.Random
) -> list[list[int]]:
    """Inject the donor's fullest bins; bins that now hold an item twice go, their other items are put back."""
    fills = [sum([sizes[i] for i in b]) for b in donor]
    full = [b for b, f in zip(donor, fills, strict=True) if f >= capacity]
    rest = sorted((f + rng.random(), n) for n, f in enumerate(fills) if f < capacity)
    count = max(1, int(len(donor) * share))
    rng.shuffle(full)
    injected = full[:count] + [donor[n] for _, n in reversed(rest[max(0, len(rest) - max(0, count - len(full))):])]
    return inject(receiver, injected, sizes, capacity)


def inject(receiver: list[list[int]], injected: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in receiver:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced.extend(i for i in b if i not in taken)
    displaced.sort(key=sizes.__getitem__, reverse=True)
    return best_fit(kept + [list(b) for b in injected], displaced, sizes, capacity)


def from_patterns(patterns: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins with the size patterns of migrants, built from this island's items as often as they allow."""
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        by_size.setdefault(s, []).append(i)
    bins = []
    for pattern in patterns:
        need = Counter(pattern)
        times = min(len(by_size.get(s, ())) // n for s, n in need.items())
        for _ in range(times):
            bins.append([by_size[s].pop() for s, n in need.items() for _ in range(n)])
    return bins


def _start(sizes: list[int], capacity: int, rng: random.Random, noise: float) -> list[list[int]]:
    """Best fit in falling order of size, the order blurred by ``noise``."""
    keys = [s * (1 + noise * rng.random()) for s in sizes]
    return best_fit([], sorted(range(len(sizes)), key=keys.__getitem__, reverse=True), sizes, capacity)


def evolve(
    sizes: list[int], capacity: int, seed: int, seeded: list[list[list[int]]] = (), population: int = POPULATION,
    generations: int = GENERATIONS,
) -> list[list[int]]:
    """The best solution after some generations; ``seeded`` solutions join the first one."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    people = [list(s) for s in seeded]
    for n in range(max(0, population - len(people))):
        people.append(_start(sizes, capacity, rng, 0.0 if n == 0 else 0.15 * n))
    ranked = sorted(((fitness(p, sizes, capacity), n) for n, p in enumerate(people)), reverse=True)
    scored = [(f, people[n]) for f, n in ranked]
    for _ in range(generations):
        if len(scored[0][1]) <= least or len(scored) < 2:
            break
        receiver = scored[min(rng.randrange(len(scored)), rng.randrange(len(scored)))][1]
        donor = scored[rng.randrange(len(scored))][1]
        child = crossover(receiver, donor, sizes, capacity, rng.uniform(0.2, 0.6), rng)
        scored.append((fitness(child, sizes, capacity), child))
        scored.sort(key=lambda x: -x[0])
        scored = scored[:population]
    return scored[0][1]


def elite_patterns(bins: list[list[int]], sizes: list[int], capacity: int, most: int = ELITE) -> list[list[int]]:
    """Distinct size patterns of the fullest bins, the most frequent first."""
    found = Counter(tuple(sorted([sizes[i] for i in b], reverse=True)) for b in bins)
    order = sorted(found.items(), key=lambda x: (-sum(x[0]), -x[1], x[0]))
    return [list(p) for p, _ in order[:most]]


# --- on Spark --------------------------------------------------------------------------------------


def cut_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, kept: int = MAX_KEPT) -> DataFrame:
    """Pieces of at most ``capacity`` ids, the first of a longer document holding what is left over."""
    end = struct.pack("<I", end_id)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        encoded = encoder(vocabulary, kept).encode(batch.column("text").to_pylist())
        for name, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
            data = ids + end
            n = len(data) // 4
            begin, stop, piece = 0, n % capacity or min(n, capacity), 0
            while begin < n:
                rows.append((name, piece, begin, stop - begin, zlib.crc32(data[4 * begin : 4 * stop])))
                begin, stop, piece = stop, stop + capacity, piece + 1
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    # Fewer parts are kept where less memory is left, so less text is taken up at a time, too.
    return rows.mapInArrow(per_batch(cut, chars=BATCH_CHARS * kept // MAX_KEPT), _PIECES)


def _bins_of(frame: pd.DataFrame) -> list[list[int]]:
    """Solution of a frame with a ``bin`` per row, in row numbers."""
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(frame["bin"].tolist()):
        bins.setdefault(b, []).append(i)
    return list(bins.values())


def _placed(frame: pd.DataFrame, bins: list[list[int]], group: int) -> pd.DataFrame:
    order = [i for b in bins for i in b]
    lengths = frame["length"].to_numpy()
    number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    fills = np.array([sum(lengths[i] for i in b) for b in bins])
    offset = np.concatenate([np.cumsum([0, *lengths[b[:-1]]]) for b in bins]) if bins else np.zeros(0)
    result = frame.iloc[order][["item", "length", "island"]].reset_index(drop=True)
    result["bin"] = (group << 32) + number
    result["fill"] = fills[number] if len(bins) else []
    result["offset"] = offset.astype("int64")
    return result


_PLACED = "item bigint, length bigint, island bigint, bin bigint, fill bigint, offset bigint"


def pack_items(items: DataFrame, capacity: int = CAPACITY, island: int = ISLAND, seed: int = 0) -> DataFrame:
    """Bins for settled ``(item, length)`` rows, lengths from 1 to ``capacity``: ``item, bin, offset``.

    Every island (a hash share of the items) runs the genetic algorithm; the patterns of its elite bins
    migrate to the next island, whose next run starts from its own best solution and one built from the
    migrants. Bins left badly filled are dealt to groups of about ``island`` pieces, opened and packed once more.
    """
    count = items.count()
    islands = max(1, -(-count // island))
    on = items.select(
        "item", "length", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(islands)).cast("bigint").alias("island")
    )

    def first_run(frame: pd.DataFrame) -> pd.DataFrame:
        let_go()
        frame = frame.sort_values("item", ignore_index=True)
        here = int(frame["island"].iloc[0])
        return _placed(frame, evolve(frame["length"].tolist(), capacity, seed * 7919 + here), here)

    best = settle(on.groupBy("island").applyInPandas(first_run, _PLACED))

    def patterns(frame: pd.DataFrame) -> pd.DataFrame:
        bins = _bins_of(frame)
        sizes = frame["length"].tolist()
        target = (int(frame["island"].iloc[0]) + 1) % islands
        return pd.DataFrame({"island": target, "pattern": elite_patterns(bins, sizes, capacity)})

    def next_run(frame: pd.DataFrame, arrived: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame({k: pd.Series(dtype="int64") for k in ("item", "length", "island", "bin", "fill", "offset")})
        frame = frame.sort_values("item", ignore_index=True)
        here, sizes, own = int(frame["island"].iloc[0]), frame["length"].tolist(), _bins_of(frame)
        built = from_patterns([[int(s) for s in p] for p in arrived["pattern"]], sizes, capacity)
        guided = inject(own, built, sizes, capacity)
        return _placed(frame, evolve(sizes, capacity, seed * 104729 + here, [own, guided]), here)

    for _ in range(MIGRATIONS):
        migrants = best.groupBy("island").applyInPandas(patterns, "island bigint, pattern array<bigint>")
        best = settle(best.groupBy("island").cogroup(migrants.groupBy("island")).applyInPandas(next_run, _PLACED))
    if islands == 1:
        return best.select("item", "bin", "offset")
    # Bins short of full by more than one part in 64 are opened and packed with those of other islands.
    loose = F.col("fill") < capacity - capacity // 64
    groups = max(1, -(-best.where(loose).count() // island))

    def last_run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", ignore_index=True)
        here = islands + int(frame["island"].iloc[0])
        packed = evolve(frame["length"].tolist(), capacity, seed * 1299709 + here)
        return _placed(frame, min([_bins_of(frame), packed], key=len), here)

    # A bin goes to one group whole.
    group = F.pmod(F.xxhash64("bin", F.lit(seed)), F.lit(groups)).cast("bigint")
    again = best.where(loose).withColumn("island", group).groupBy("island").applyInPandas(last_run, _PLACED)
    return best.where(~loose).unionByName(again).select("item", "bin", "offset")


def pack_documents(
    docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY,
    island: int = ISLAND, seed: int = 0, kept: int = MAX_KEPT,
) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` ids.

    Returns per piece ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Only documents longer
    than ``capacity`` are cut. Full pieces are sequences of their own. Null texts are empty and take one id;
    null ids and repeated rows are packed like any other row, a repeated row once per occurrence. An empty
    table gives no rows. ``kept`` bounds the parts of texts whose ids a worker holds, and changes no result.
    """
    # Settled: the item numbers below have to stay the same wherever the pieces are read again.
    with arrow_batches(docs.sparkSession, 2 * BATCH_CHARS * kept // MAX_KEPT):
        pieces = settle(cut_pieces(docs, vocabulary, end_id, capacity, kept))
    pieces = pieces.withColumn("item", F.monotonically_increasing_id())
    part = pieces.where(F.col("length") < capacity)
    packed = pack_items(part.select("item", "length"), capacity, island, seed)
    full = pieces.where(F.col("length") >= capacity).select(
        *[c.strip().split(" ")[0] for c in _PIECES.split(",")],
        (F.col("item") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    rest = part.join(packed, "item").select(
        *[c.strip().split(" ")[0] for c in _PIECES.split(",")], (F.col("bin") * 2 + 1).alias("sequence_id"), "offset"
    )
    return full.unionByName(rest)
