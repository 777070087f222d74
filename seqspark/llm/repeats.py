"""Removal of long repeated byte strings with run-length Burrows-Wheeler indexes.

Two equal strings of LENGTH bytes choose the same anchor in them: the least of their k-gram hashes. So all
places that can match meet under an anchor, with the bytes around it that such a string can reach (its
context). Contexts that are equal as a whole are repeats without further comparison; of the others one copy
each goes into the index of their anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.llm.common import broadcast_if_small, join_on, per_batch, stored, text_or_empty, whole_groups
from seqspark.session import is_small

LENGTH = 400
GRAM = 64

# Different contexts of one anchor that are indexed together; more are split by longer strings around it.
GROUP = 1_500

# Starts of strings that are judged together in groups that stay larger.
CELL = 13

# Contexts a task indexes at a time, in whole groups.
AT_ONCE = 1_000

_BASE = 0x9E3779B97F4A7C15
_OTHER_BASE = 0xD6E8FEB86659FD93
_WORD = (1 << 64) - 1


# --- hashes and anchors ------------------------------------------------------------------------------


def gram_hashes(data: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """A hash of every ``size`` bytes in a row, from running sums; arithmetic is modulo 2**64."""
    n = len(data)
    up = np.full(n, base, dtype=np.uint64)
    up[0] = 1
    up = np.cumprod(up, dtype=np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), dtype=np.uint64)
    down[0] = 1
    down = np.cumprod(down, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    found = (sums[size:] - sums[:-size]) * down[: n - size + 1]
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return found ^ (found >> np.uint64(29))


def anchors_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that are the first least one of some ``length`` bytes in a row."""
    if len(data) < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    best, at, span = hashes, np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        left = best[: len(best) - step] <= best[step:]
        at = np.where(left, at[: len(at) - step], at[step:])
        best = hashes[at]
        span += step
    places = np.unique(at)
    return places, hashes[places]


def _anchor_rows(length: int, gram: int):
    reach = length - gram

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
        out: list[list] = [[], [], [], [], []]
        for doc_id, key, text in zip(ids, keys, batch.column("text"), strict=True):
            data = bytes(text.as_buffer())
            places, hashes = anchors_of(np.frombuffer(data, dtype=np.uint8), length, gram)
            n = len(places)
            if not n:
                continue
            out[0] += [doc_id] * n
            out[1] += [key] * n
            out[2] += places.tolist()
            out[3] += hashes.view(np.int64).tolist()
            # The context's digest holds its shape too: where the anchor stands in it.
            out[4] += [
                hashlib.blake2b(data[max(0, p - reach) : p + length], digest_size=14).digest() + min(p, reach).to_bytes(2, "little")
                for p in places.tolist()
            ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        if not out[0]:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc_id", "key", "pos", "anchor", "context"]
        )

    return rows


# --- the index -----------------------------------------------------------------------------------------


def suffix_array(symbols: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Places sorted by group, then by what follows. Symbol 0 ends a segment, each end smaller than the next.

    By doubling; a round sorts only places that still share their rank.
    """
    n = len(symbols)
    first = 6
    key = np.zeros(n, dtype=np.int64)
    ended = np.zeros(n, dtype=bool)
    for k in range(first):
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(0, n - k)] = symbols[k:]
        key = key * 257 + np.where(ended, 0, ahead)
        ended |= ahead == 0
    _, key = np.unique(key, return_inverse=True)
    key = group * (int(key.max()) + 1) + key
    # A place whose segment ends within the key is told apart by its position: ends are all different.
    key = key * (n + 1) + np.where(ended, np.arange(n) + 1, 0)
    order = np.argsort(key, kind="stable")
    new = np.r_[True, np.diff(key[order]) != 0]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = head
    span = first
    while True:
        tied = ~new | np.r_[~new[1:], False]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        places = order[at]
        follow = rank[np.minimum(places + span, n - 1)]
        key = rank[places] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        order[at] = places[by]
        key = key[by]
        # Inside a tied run, a new rank begins where the key changes.
        new[at] = np.r_[True, np.diff(key) != 0]
        head = np.maximum.accumulate(np.where(new[at], at, 0))
        rank[order[at]] = head
        span *= 2


def common_lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, left: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``a`` and ``b`` share before a segment of either ends."""
    n = len(symbols)
    data = np.zeros(n + 8, dtype=np.uint8)
    data[:n] = np.where(symbols > 0, symbols - 1, 0)
    words = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        words |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    limit = np.minimum(left[a], left[b])
    shared = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        x = words[a[live] + shared[live]] ^ words[b[live] + shared[live]]
        same = np.full(len(live), 8, dtype=np.int64)
        differs = x != 0
        low = x[differs] & (~x[differs] + np.uint64(1))
        same[differs] = (np.log2(low.astype(np.float64)).astype(np.int64)) >> 3
        shared[live] += same
        live = live[~differs & (shared[live] < limit[live])]
    return np.minimum(shared, limit)


def covered_by_repeats(segments: list[bytes], groups: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each segment, the bytes covered by a string of ``length`` that also starts elsewhere in its group.

    The segments of a group are indexed by their Burrows-Wheeler transform, kept as runs of equal symbols.
    Matching lengths need to be compared only at the ends of runs: inside a run, the longest match of a place
    with its neighbour in sorted order is one less than that of the place before it. Streamed from the
    samples, a match of at least ``length`` covers all it spans.
    """
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    symbols = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    inside = np.arange(len(symbols)) - starts[owner]
    body = inside < sizes[owner]
    symbols[body] = np.frombuffer(b"".join(segments), dtype=np.uint8).astype(np.int64) + 1
    left = sizes[owner] - inside
    group = np.unique(np.asarray(groups), return_inverse=True)[1][owner]

    order = suffix_array(symbols, group)
    transform = np.where(inside[order] > 0, symbols[order - 1], 0)
    # Between neighbours of one group in different runs; a segment's first place is a run of its own.
    cut = np.flatnonzero((transform[1:] != transform[:-1]) | (transform[1:] == 0))
    cut = cut[group[order[cut]] == group[order[cut + 1]]]
    upper, lower = order[cut], order[cut + 1]
    match = common_lengths(symbols, upper, lower, left)
    enough = match >= length
    edges = np.zeros(len(symbols) + 1, dtype=np.int64)
    for ends in (upper[enough], lower[enough]):
        np.add.at(edges, ends, 1)
        np.add.at(edges, ends + match[enough], -1)
    covered = np.cumsum(edges)[:-1] > 0
    return [covered[s : s + n] for s, n in zip(starts, sizes, strict=True)]


def spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    change = np.diff(np.r_[0, covered.astype(np.int8), 0])
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _index_groups(length: int):
    """Marks repeats in rows sorted by group; overlapping contexts of a document become one segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["group"], AT_ONCE):
            _, which, n = np.unique(table.column("group").to_numpy(), return_inverse=True, return_counts=True)
            table = table.filter(pa.array(n[which] > 1))
            if not table.num_rows:
                continue
            group, begin = table.column("group").to_numpy(), table.column("begin").to_numpy()
            ids, keys = table.column("doc_id").to_pylist(), table.column("key").to_pylist()
            texts = table.column("bytes").to_pylist()
            order = sorted(range(len(texts)), key=lambda i: (group[i], ids[i] is None, ids[i] or 0, keys[i], begin[i]))
            segments: list[bytearray] = []
            source: list[tuple] = []
            for i in order:
                where = (int(group[i]), ids[i], keys[i])
                if source and source[-1][:3] == where and begin[i] <= source[-1][3] + len(segments[-1]):
                    have = source[-1][3] + len(segments[-1]) - int(begin[i])
                    segments[-1] += texts[i][have:]
                else:
                    segments.append(bytearray(texts[i]))
                    source.append((*where, int(begin[i])))
            out: list[tuple] = []
            found = covered_by_repeats([bytes(s) for s in segments], [s[0] for s in source], length)
            for (_, doc_id, key, at), covered in zip(source, found, strict=True):
                out += [(doc_id, key, at + int(b), at + int(e)) for b, e in zip(*spans(covered), strict=True)]
            if out:
                yield _marks(out)

    return run


def _marks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "key", "begin", "end"])


_MARKS = "doc_id bigint, key bigint, begin int, end int"


def _two_hashes(data: np.ndarray, starts: np.ndarray, size: int) -> list[pa.Array]:
    """Both hashes of the ``size`` bytes at each start; the sums run over all of ``data`` once."""
    return [pa.array(gram_hashes(data, size, base)[starts].view(np.int64)) for base in (_BASE, _OTHER_BASE)]


def _side_starts(row: dict, length: int, gram: int) -> tuple[int, int]:
    """First and last start, counted from the anchor, of the strings a context of a large group gives.

    A context that is grouped by what stands before its anchor gives the strings that begin there or earlier,
    one grouped by what follows the others. A text's begin and end cut both off.
    """
    reach, half = length - gram, (length - gram) // 2
    first, last = (-reach, -half) if row["side"] == 1 else (-half, 0)
    return max(first, row["begin"] - row["pos"]), min(last, row["begin"] + len(row["bytes"]) - length - row["pos"])


_CELLS = "w bigint, v bigint, ew bigint, ev bigint, doc_id bigint, key bigint, pos int, side int, at int, n int, core int"


def _cell_rows(length: int, gram: int, cell: int):
    """Starts of a context in cells of ``cell``, the same ones around every anchor.

    All strings of a cell hold its core (``w, v``) and are held by its span (``ew, ev``): if the core is
    found once only, so is each string, and if the span is found elsewhere, so is each.
    """
    core, span, reach = length - cell + 1, length + cell - 1, length - gram

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out, places, held = [], [], 0
        for row in batch.select(["doc_id", "key", "pos", "side", "begin", "bytes"]).to_pylist():
            low, high = _side_starts(row, length, gram)
            shift, end = row["pos"] - row["begin"], row["begin"] + len(row["bytes"])
            # Cells lie at whole multiples from the farthest start, whatever a text's ends cut off.
            for c in range((low + reach) // cell * cell - reach, high + 1, cell):
                a, b = max(c, low), min(c + cell - 1, high)
                whole = c + shift >= 0 and row["pos"] + c + span <= end
                at = row["pos"] + c + cell - 1
                out.append((row["doc_id"], row["key"], row["pos"], row["side"], row["pos"] + a, b - a + 1, at))
                places.append((held + shift + c + cell - 1, held + shift + c if whole else -1))
            held += len(row["bytes"])
        if not out:
            return None
        # A blank tail lets every span be taken; those that are not whole are null.
        data = np.frombuffer(b"".join(batch.column("bytes").to_pylist()) + bytes(span), dtype=np.uint8)
        inner, outer = (np.array(x, dtype=np.int64) for x in zip(*places, strict=True))
        gone = outer < 0
        spans_ = [pa.array(h.to_numpy(), mask=gone) for h in _two_hashes(data, np.maximum(outer, 0), span)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*_two_hashes(data, inner, core), *spans_, *columns],
            ["w", "v", "ew", "ev", "doc_id", "key", "pos", "side", "at", "n", "core"],
        )

    return rows


def _window_rows(length: int):
    """Strings of ``length`` in the cells of a context that its cores and spans leave open."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out, starts, held = [], [], 0
        for row in batch.select(["doc_id", "key", "pos", "begin", "bytes", "cells"]).to_pylist():
            for found in row["cells"]:
                for at in range(found["at"], found["at"] + found["n"]):
                    out.append((row["doc_id"], row["key"], row["pos"], at))
                    starts.append(held + at - row["begin"])
            held += len(row["bytes"])
        if not out:
            return None
        data = np.frombuffer(b"".join(batch.column("bytes").to_pylist()), dtype=np.uint8)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*_two_hashes(data, np.array(starts, dtype=np.int64), length), *columns], ["w", "v", "doc_id", "key", "pos", "at"]
        )

    return rows


def _found_elsewhere(rows: DataFrame, w: str, v: str, at: str) -> DataFrame:
    """Hashes ``_w, _v`` that stand at two places or more; small as a rule, and broadcast if measured so."""
    place = F.xxhash64("doc_id", "key", at)
    found = rows.groupBy(F.col(w).alias("_w"), F.col(v).alias("_v")).agg(F.min(place).alias("_lo"), F.max(place).alias("_hi"))
    return broadcast_if_small(stored(found.where("_lo <> _hi").select("_w", "_v"), "found-elsewhere"))


def _context_rows(length: int, gram: int, limit: int):
    """Bytes of the chosen contexts; those of large groups once under each longer string beside the anchor."""
    reach = length - gram
    half = reach // 2

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for row in batch.to_pylist():
            data = row["text"].encode("utf-8", "surrogatepass")
            for wanted in row["wanted"]:
                p, n = wanted["pos"], len(data)
                begin, end = max(0, p - reach), min(n, p + length)
                if wanted["m"] <= limit:
                    names = [(0, wanted["anchor"])]
                else:
                    sides = [(p - half, p + gram), (p, p + gram + half)]
                    names = [
                        (side, int.from_bytes(hashlib.blake2b(data[b:e] + bytes([side]), digest_size=8).digest(), "little", signed=True))
                        for side, (b, e) in enumerate(sides, 1) if b >= 0 and e <= n
                    ]
                out += [(name, row["doc_id"], row["key"], p, side, begin, data[begin:end]) for side, name in names]
        if not out:
            return None
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        columns = list(zip(*out, strict=True))
        names = ["group", "doc_id", "key", "pos", "side", "begin", "bytes"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return rows


def _with_sides(large: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts with strings, ``first, end`` of all bytes those reach and a ``digest`` of these and where they lie.

    A text's begin and end cut strings off; contexts of one group and digest hold the same ones.
    """
    reach, half = length - gram, (length - gram) // 2
    before = F.col("side") == 1
    first = F.greatest("begin", F.col("pos") - F.when(before, reach).otherwise(half))
    end = F.least(F.col("begin") + F.octet_length("bytes"), F.col("pos") + F.when(before, length - half).otherwise(length))
    rows = large.withColumn("first", first.cast("int")).withColumn("end", end.cast("int")).where(F.col("end") - F.col("first") >= length)
    taken = F.substring("bytes", F.col("first") - F.col("begin") + 1, F.col("end") - F.col("first"))
    where = F.encode((F.col("pos") - F.col("first")).cast("string"), "UTF-8")
    return rows.withColumn("digest", F.unhex(F.md5(F.concat(where, F.encode(F.lit(":"), "UTF-8"), taken))))


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, cell: int = CELL) -> DataFrame:
    """Covered byte ranges ``doc_id, key, begin, end`` (they may overlap) of settled ``(doc_id, key, text)`` rows."""
    reach = length - gram
    places = stored(
        docs.mapInArrow(per_batch(_anchor_rows(length, gram)), "doc_id bigint, key bigint, pos int, anchor bigint, context binary"),
        "anchors",
    )
    often = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor")
    shared = stored(places.join(often, "anchor", "left_semi"), "shared-anchors")
    contexts = shared.groupBy("anchor", "context").agg(
        # The places of one row, whichever it is: all three come from it.
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("doc_id", "key", "pos")]
    )
    contexts = stored(contexts, "contexts")

    # A context is never shorter than LENGTH; one found twice or more is covered as a whole at every place.
    twice = contexts.where("n > 1").select("anchor", "context")
    begin = F.greatest(F.col("pos") - reach, F.lit(0))
    whole = shared.join(twice, ["anchor", "context"]).select("doc_id", "key", begin.alias("begin"), (F.col("pos") + length).alias("end"))

    # One copy of each different context, where an anchor has several.
    several = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    wanted = contexts.join(several, "anchor").select("doc_id", "key", F.struct("anchor", "pos", "m").alias("w"))
    wanted = stored(wanted.groupBy("doc_id", "key").agg(F.collect_list("w").alias("wanted")), "wanted")
    chosen = join_on(docs, broadcast_if_small(wanted), ["doc_id", "key"]).select("doc_id", "key", "text", "wanted")
    texts = stored(
        chosen.mapInArrow(
            per_batch(_context_rows(length, gram, group)), "group bigint, doc_id bigint, key bigint, pos int, side int, begin int, bytes binary"
        ),
        "context-texts",
    )
    # The names of large groups are few: the texts stay where they are.
    sizes = texts.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    names = broadcast_if_small(stored(sizes.where(F.col("_n") > group).select("group"), "large-groups"))
    small = texts.join(names, "group", "left_anti")
    indexed = small.repartition("group").sortWithinPartitions("group").mapInArrow(_index_groups(length), _MARKS)

    # Groups that stay large share a long string everywhere. Where all bytes that a context's strings reach are found
    # elsewhere, all of them repeat, and one such context stands for the others.
    large = _with_sides(texts.join(names, "group", "left_semi"), length, gram)
    sides = stored(large.drop("bytes"), "sides")
    alike = sides.groupBy("group", "digest").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("doc_id", "key", "pos", "side")).alias("_one")
    )
    alike = stored(alike.where("_n > 1"), "sides-alike")
    by_sides = sides.join(broadcast_if_small(alike.select("group", "digest")), ["group", "digest"], "left_semi").select(
        "doc_id", "key", F.col("first").alias("begin"), F.col("end")
    )
    # The others' strings of the full length are counted, cell by cell first, and one by one only where a cell holds
    # the end of a repeat.
    covered = alike.select(F.col("group").alias("_group"), F.col("digest").alias("_digest"), "_one")
    covered = F.broadcast(covered) if is_small(alike.select("group", "digest", "_one.*")) else covered
    place = F.struct("doc_id", "key", "pos", "side")
    large = large.join(covered, (F.col("group") == F.col("_group")) & (F.col("digest") == F.col("_digest")), "left").where(
        F.col("_group").isNull() | place.eqNullSafe(F.col("_one"))
    ).select(*texts.columns)
    cells = stored(large.mapInArrow(per_batch(_cell_rows(length, gram, cell), "bytes"), _CELLS), "cells")
    cores = _found_elsewhere(cells, "w", "v", "core")
    inside = stored(cells.join(cores, (F.col("w") == F.col("_w")) & (F.col("v") == F.col("_v")), "left_semi"), "open-cells")
    whole_cells = _found_elsewhere(inside.where("ew IS NOT NULL").withColumn("_span", F.col("core") - cell + 1), "ew", "ev", "_span")
    same_span = (F.col("ew") == F.col("_w")) & (F.col("ev") == F.col("_v"))
    repeated_cells = stored(inside.join(whole_cells, same_span, "left_semi"), "repeated-cells")
    open_cells = stored(inside.join(whole_cells, same_span, "left_anti"), "cells-of-ends")
    by_cells = repeated_cells.select(
        "doc_id", "key", F.col("at").alias("begin"), (F.col("at") + F.col("n") - 1 + length).alias("end")
    )
    # A string of an open cell may stand in a repeated one too: one of each is taken along.
    place = ["doc_id", "key", "pos", "at", "n"]
    one = repeated_cells.groupBy("w", "v", "ew", "ev", "side").agg(F.min(F.struct(*place)).alias("_one"))
    one = one.join(open_cells.select("w", "v").distinct(), ["w", "v"], "left_semi").select("_one.*", "side")
    left = open_cells.select(*place, "side").unionByName(one).groupBy("doc_id", "key", "pos", "side").agg(
        F.collect_list(F.struct("at", "n")).alias("cells")
    )
    left = broadcast_if_small(stored(left, "cells-left"))
    windows = join_on(large, left, ["doc_id", "key", "pos", "side"]).mapInArrow(
        per_batch(_window_rows(length), "bytes"), "w bigint, v bigint, doc_id bigint, key bigint, pos int, at int"
    )
    windows = stored(windows, "windows")
    repeated = _found_elsewhere(windows, "w", "v", "at")
    counted_windows = windows.join(repeated, (F.col("w") == F.col("_w")) & (F.col("v") == F.col("_v")), "left_semi")
    # At most length - gram + 1 strings of a context; those in a row are one range.
    by_context = counted_windows.groupBy("doc_id", "key", "pos").agg(
        F.collect_set("at").alias("_at"), F.min("at").alias("_lo"), F.max("at").alias("_hi")
    )
    single = F.array(F.struct(F.col("_lo").alias("a"), F.col("_hi").alias("b")))
    each = F.transform("_at", lambda a: F.struct(a.alias("a"), a.alias("b")))
    ranges = F.when(F.size("_at") == F.col("_hi") - F.col("_lo") + 1, single).otherwise(each)
    counted = by_context.select("doc_id", "key", F.explode(ranges).alias("_r")).select(
        "doc_id", "key", F.col("_r.a").alias("begin"), (F.col("_r.b") + length).cast("int").alias("end")
    )
    return whole.unionByName(indexed).unionByName(by_sides).unionByName(by_cells).unionByName(counted)


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The marks of each document without those that touch others: one for each run of covered bytes."""
    marks = batch.column("marks")
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(marks).to_numpy())
    begin, end = (marks.flatten().field(c).to_numpy().astype(np.int64) for c in ("begin", "end"))
    order = np.lexsort((begin, row))
    row, begin, end = row[order], begin[order], end[order]
    # A document's places lie behind those of all before it, so that no mark reaches the next one.
    apart = row * (int(end.max()) + 1)
    reached = np.maximum.accumulate(end + apart)
    first = np.flatnonzero(np.r_[True, (begin + apart)[1:] > reached[:-1]] | np.r_[True, row[1:] != row[:-1]])
    last = np.r_[first[1:], len(row)] - 1
    spans_ = pa.StructArray.from_arrays(
        [pa.array(begin[first], pa.int32()), pa.array(reached[last] - apart[last], pa.int32())], ["begin", "end"]
    )
    offsets = np.r_[0, np.cumsum(np.bincount(row[first], minlength=batch.num_rows))]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans_)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), lists], ["doc_id", "key", "marks"])


def _each_merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _merged(batch)


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
    out: list[tuple] = []
    for doc_id, text, marks in zip(ids, texts, batch.column("marks").to_pylist(), strict=True):
        data = bytes(text.as_buffer())
        n = len(data)
        if marks:
            edges = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edges, [m["begin"] for m in marks], 1)
            np.add.at(edges, [min(n, m["end"]) for m in marks], -1)
            covered = np.cumsum(edges)[:-1] > 0
            kept = np.frombuffer(data, dtype=np.uint8)[~covered].tobytes()
            out.append((doc_id, n, n - len(kept), len(spans(covered)[0]), hashlib.sha256(kept).hexdigest(), kept))
        else:
            out.append((doc_id, n, 0, 0, hashlib.sha256(data).hexdigest(), data))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, with_kept: bool = False) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts anywhere else.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, the ``kept`` bytes, which
    may cut a character in two. Strings never cross documents; overlapping ones count, in one document as
    between two; all are judged on the input.

    A null text is empty and stays. Null ids are ids like others. Repeated rows are documents of their own
    and so repeat each other. Texts shorter than ``length`` never change. Other columns are not read. An
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    # Rows of one id are told apart by their text.
    rows = rows.withColumn("key", F.xxhash64("text"))
    marks = find_repeats(rows, length, gram, group)
    by_document = marks.groupBy("doc_id", "key").agg(F.collect_list(F.struct("begin", "end")).alias("marks")).mapInArrow(
        _each_merged, "doc_id bigint, key bigint, marks array<struct<begin: int, end: int>>"
    )
    by_document = broadcast_if_small(stored(by_document, "marks"))
    joined = join_on(rows, by_document, ["doc_id", "key"], "left").select("doc_id", "text", "marks")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])]
    return joined.mapInArrow(
        per_batch(_removed), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    ).select(*columns)
