"""Jaccard self-join of word n-gram sets by chosen paths.

Every set is embedded as the POSITIONS least hashes of its n-grams, so that two sets agree in about their
Jaccard similarity of the positions. A path is a sequence of sampled (position, value) tokens; a set follows
it while it holds the tokens, and sets that share a path meet in its bucket. Runs with other samples are
repeated until a pair at the threshold meets with the probability wanted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqspark.llm.common import (
    broadcast_if_small, drop_repeated_rows, join_groups, per_batch, settle, stored, text_or_empty, whole_groups, without,
    worker_cache,
)
from seqspark.operators.cluster import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999

POSITIONS = 128

# A token is chosen with probability 1 / (EXPECTED * POSITIONS): paths of pairs above EXPECTED multiply.
EXPECTED = 0.65
DEPTH = 2

# Agreement a pair needs to be kept for the exact test; over four deviations below the threshold.
NEAR = 0.65

# Sets a bucket is brute-forced up to, depth at which all larger ones are cut into blocks, and rows of a block.
BUCKET = 256
MAX_DEPTH = 5
BLOCK = 1_024

# Sets of other labels a set of a large bucket is compared with, on average, before longer paths split the bucket:
# near copies share them as well and are not split, however deep.
OTHERS = 1_024

# Part of the pairs that may be missed at DEPTH; the rest is shared by the depths of split buckets.
FIRST_SHARE = 0.7

# Members and n-grams of a candidate group that one task compares exactly; larger groups are cut into blocks.
MEMBERS = 1_024
GRAMS = 1_000_000

_MULTIPLIERS = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = np.random.default_rng(6).integers(0, 2**63, POSITIONS, dtype=np.uint64)

# Hashes of words a worker keeps.
MAX_KEPT = 150_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(text: str) -> list[str]:
    """Lower-cased words, cut at white space."""
    return text.lower().split()


def shingles_of(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams. A shorter text has one of all its words, an empty one none."""
    import xxhash

    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = worker_cache(("words",), dict)
    if len(known) > MAX_KEPT:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    found = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        found = _mix(found * _MULTIPLIERS[k] + hashes[k : len(words) - size + 1 + k])
    return np.unique(found)


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """The embedding: 16 bits of the least hash at each position."""
    least = np.full(POSITIONS, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512, None] ^ _SEEDS
        part *= np.uint64(0x9E3779B97F4A7C15)
        part ^= part >> np.uint64(32)
        part *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(8)).astype(np.uint16)


def chance_of_miss(runs: int, threshold: float, depth: int = DEPTH, expected: float = EXPECTED) -> float:
    """Chance that a pair at the threshold shares no path in ``runs``, over all numbers of agreeing positions.

    A pair that agrees in less than ``NEAR`` of them is lost whatever it shares.
    """
    total = 0.0
    for agreeing in range(POSITIONS + 1):
        share, miss = agreeing / POSITIONS, 0.0
        for _ in range(depth):
            miss = math.exp(-(share / expected) * (1 - miss))
        weight = math.comb(POSITIONS, agreeing) * threshold**agreeing * (1 - threshold) ** (POSITIONS - agreeing)
        total += weight * (miss**runs if share >= NEAR else 1.0)
    return total


def runs_for(recall: float, threshold: float, depth: int = DEPTH, expected: float = EXPECTED) -> int:
    """Runs after which a pair at the threshold shared a path with probability ``recall``."""
    if chance_of_miss(10_000, threshold, depth, expected) > 1 - recall:
        raise ValueError(f"sketches of {POSITIONS} positions cannot reach a recall of {recall} at {threshold}")
    runs = 1
    while chance_of_miss(runs, threshold, depth, expected) > 1 - recall:
        runs += 1
    return runs


def runs_by_depth(recall: float, threshold: float) -> dict[int, int]:
    """Runs at each depth that buckets are split to, so that the misses of all depths stay within ``recall``.

    Only hot buckets go deeper, so the first depth may use up most of what may be missed.
    """
    lost = chance_of_miss(10_000, threshold)
    free = 1 - recall - lost
    share = (1 - FIRST_SHARE) / (MAX_DEPTH - DEPTH)
    return {d: runs_for(1 - lost - free * (FIRST_SHARE if d == DEPTH else share), threshold, d) for d in range(DEPTH, MAX_DEPTH + 1)}


def next_paths(owner: np.ndarray, path: np.ndarray, sketches: np.ndarray, expected: float = EXPECTED) -> tuple[np.ndarray, np.ndarray]:
    """Extends each path by every token of its set that the path's own hash samples: owners and new paths."""
    token = sketches.astype(np.uint64) | (np.arange(POSITIONS, dtype=np.uint64) << np.uint64(16))
    bound = np.uint64(int(2**64 / (expected * POSITIONS)))
    owners, paths = [], []
    for at in range(0, len(owner), 8192):
        part = owner[at : at + 8192]
        mixed = _mix(path[at : at + 8192, None] + token[part] * np.uint64(0x9E3779B97F4A7C15))
        row, position = np.nonzero(mixed < bound)
        owners.append(part[row])
        paths.append(_mix(mixed[row, position] ^ np.uint64(0xA0761D6478BD642F)))
    if not owners:
        return owner, path
    return np.concatenate(owners), np.concatenate(paths)


# --- rows of the stages ------------------------------------------------------------------------------------


def _sets(size: int, texts: bool):
    """Shingle sets of a batch; with ``texts`` also the sha256 of each text, otherwise empty bytes."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, counts, sketches = [], [], []
        whole = [hashlib.sha256(t.as_buffer()).digest() if texts else b"" for t in batch.column("text")]
        for text in batch.column("text").to_pylist():
            found = shingles_of(text, size)
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            counts.append(len(found))
            sketches.append(sketch_of(found).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(whole, pa.binary()), pa.array(digests, pa.binary()), pa.array(counts, pa.int32()), pa.array(sketches, pa.binary())],
            ["doc_id", "whole", "digest", "n_shingles", "sketch"],
        )

    return rows


def _first_paths(runs: range, depth: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS)
            ids = batch.column("cid").to_numpy()
            for r in runs:
                owner = np.arange(len(ids))
                path = np.full(len(ids), _mix(np.array([r + 1], dtype=np.uint64))[0])
                for _ in range(depth):
                    owner, path = next_paths(owner, path, sketches)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids[owner])], ["path", "cid"])

    return run


def _longer_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS)
        owner, path = next_paths(np.arange(batch.num_rows), batch.column("path").to_numpy().view(np.uint64), sketches)
        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(batch.column("cid").to_numpy()[owner])], ["path", "cid"])


def forest(pairs: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """Least member of each member's connected group."""
    root = list(range(size))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in zip(pairs[0].tolist(), pairs[1].tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(size)], dtype=np.int64)


def _agreeing(a: np.ndarray, b: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sketch rows that agree in ``near`` of the positions."""
    found = [np.zeros((2, 0), dtype=np.int64)]
    for at in range(0, len(a), 64):
        same = (a[at : at + 64, None, :] == b[None, :, :]).sum(axis=2)
        i, j = np.nonzero(same >= near * POSITIONS)
        found.append(np.stack([i + at, j]))
    return tuple(np.concatenate(found, axis=1))


def _near_pairs(near: float):
    """Brute force inside buckets, rows sorted by bucket: links that keep what is similar connected.

    All buckets of a task share one forest, so a task writes fewer links than it has members, however many
    buckets a group meets in.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def find(i: int) -> int:
            while above.get(i, i) != i:
                above[i] = above.get(above[i], above[i])
                i = above[i]
            return i

        for table in whole_groups(batches, ["bucket", "part"], 4096):
            bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
            cid, side = table.column("cid").to_numpy(), table.column("side").to_numpy()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS)
            order = np.lexsort((cid, side, part, bucket))
            bucket, part, cid, side, sketches = bucket[order], part[order], cid[order], side[order], sketches[order]
            starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])
            a, b = [], []
            for s, e in zip(starts, np.r_[starts[1:], len(cid)], strict=True):
                here = sketches[s:e]
                middle = int(np.searchsorted(side[s:e], 1))
                if middle in (0, e - s):
                    i, j = _agreeing(here, here, near)
                    i, j = i[i < j], j[i < j]
                else:
                    i, j = _agreeing(here[:middle], here[middle:], near)
                    j = j + middle
                root = forest((i, j), e - s)
                moved = np.flatnonzero(root != np.arange(e - s))
                for x, y in zip(cid[s:e][root[moved]].tolist(), cid[s:e][moved].tolist(), strict=True):
                    x, y = find(x), find(y)
                    if x != y:
                        above[max(x, y)] = min(x, y)
                        a.append(min(x, y))
                        b.append(max(x, y))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _brute_force(rows: DataFrame, near: float) -> DataFrame:
    """Links within ``(bucket, part, side, cid, sketch)`` rows."""
    return rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_near_pairs(near), "a bigint, b bigint")


def candidate_links(classes: DataFrame, threshold: float, recall: float, near: float = NEAR) -> DataFrame:
    """Links ``a, b`` that connect all classes sharing a path and agreeing in ``near`` of the positions."""
    sketches = classes.select("cid", "sketch")
    runs = runs_by_depth(recall, threshold)
    paths = classes.where("n_shingles > 0").select("cid", "sketch").mapInArrow(
        _first_paths(range(runs[DEPTH]), DEPTH), "path bigint, cid bigint"
    )
    links: DataFrame | None = None
    for depth in range(DEPTH, MAX_DEPTH + 1):
        paths = stored(paths.distinct(), "paths")
        counts = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("pivot")).where("n > 1")
        met = stored(paths.join(counts, "path"), "met")
        # Small buckets: the same members met in several runs are compared once.
        members = (
            met.where(F.col("n") <= BUCKET).groupBy("path").agg(F.sort_array(F.collect_list("cid")).alias("members"))
            .select("members").distinct()
        )
        listed = members.select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("cid")).distinct()
        found = _brute_force(
            listed.join(sketches, "cid").select("bucket", F.lit(0).alias("part"), F.lit(0).alias("side"), "cid", "sketch"), near
        )
        # Large ones: what is near the first member is linked to it in one pass.
        large = met.where(F.col("n") > BUCKET)
        pivots = sketches.select(F.col("cid").alias("pivot"), F.col("sketch").alias("_pivot"))
        starred = (
            large.select("pivot", "cid").where("pivot <> cid").distinct().join(sketches, "cid").join(pivots, "pivot")
            .mapInArrow(_near_pivot(near), "a bigint, b bigint")
        )
        new = stored(found.unionByName(starred).distinct(), "links")
        links = new if links is None else links.unionByName(new)
        if large.isEmpty():
            return links
        # A large bucket that is connected by now needs no more. One whose sets have few others of another label is
        # compared in blocks, which is linear; any other is split by longer paths.
        nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
        labels = connected_components(nodes, links)
        named = large.join(labels, large["cid"] == labels["node"], "left").select(
            "path", "cid", F.coalesce("component", "cid").alias("label")
        )
        named = stored(named, "labelled")
        by_label = named.groupBy("path", "label").agg(F.count(F.lit(1)).cast("double").alias("_n"))
        mixed = by_label.groupBy("path").agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("_n")).alias("_same")).where(
            "_n * _n > _same"
        )
        pairs = (F.col("_n") * F.col("_n") - F.col("_same")) / 2
        ends = F.lit(True) if depth == MAX_DEPTH else pairs <= OTHERS * F.col("_n")
        open_ = stored(named.join(mixed.select("path", ends.alias("ends")), "path"), "open")
        some = {row["ends"] for row in open_.select("ends").distinct().collect()}
        if True in some:
            # Written, as the links are read more than once.
            links = links.unionByName(stored(_blocks(open_.where("ends").drop("ends"), sketches, near).distinct(), "links"))
        if False not in some:
            return links
        open_ = open_.where("NOT ends")
        paths = open_.select("path", "cid").join(sketches, "cid").select("path", "cid", "sketch").mapInArrow(
            _longer_paths, "path bigint, cid bigint"
        )
        # Longer paths are shared less often: members of open buckets are drawn in more runs.
        more = range(runs[depth], runs[depth + 1])
        if more:
            hot = open_.select("cid").distinct().join(sketches, "cid").select("cid", "sketch")
            paths = paths.unionByName(hot.mapInArrow(_first_paths(more, depth + 1), "path bigint, cid bigint"))
    return links


def _near_pivot(near: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS)
            other = np.frombuffer(b"".join(batch.column("_pivot").to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS)
            keep = pa.array((one == other).sum(axis=1) >= near * POSITIONS)
            yield pa.RecordBatch.from_arrays([batch.column("pivot").filter(keep), batch.column("cid").filter(keep)], ["a", "b"])

    return run


def _blocks(rows: DataFrame, sketches: DataFrame, near: float) -> DataFrame:
    """The exact way for buckets no path splits: blocks of one label are paired with those of others only.

    Members are blocked by label, so that a large connected group is not compared with itself. Labels of fewer
    members than a block share blocks, which are also compared with themselves.
    """
    sizes = rows.groupBy("path", "label").agg(F.count(F.lit(1)).alias("_n"))
    small = F.col("_n") < BLOCK
    shared = sizes.where(small).groupBy("path").agg(F.ceil(F.sum("_n") / BLOCK).alias("_shared"))
    sizes = sizes.join(broadcast_if_small(settle(shared)), "path", "left")
    # Labels are not negative, so a negative number can name shared blocks.
    named = F.when(small, -1 - F.pmod(F.xxhash64("label"), F.col("_shared"))).otherwise(F.col("label"))
    split = F.when(small, 0).otherwise(F.pmod(F.xxhash64("cid"), F.ceil(F.col("_n") / BLOCK)))
    blocked = rows.join(sizes.withColumn("group", named), ["path", "label"]).withColumn("block", F.xxhash64("group", split))
    blocked = stored(blocked.select("path", "group", "cid", "block"), "blocked")
    blocks = blocked.select("path", "group", "block").distinct()
    other = blocks.select("path", F.col("group").alias("_group"), F.col("block").alias("_block"))
    pairs = blocks.join(other, "path").where("group < _group or (group = _group and group < 0)").select("path", "block", "_block")
    part = F.xxhash64("block", "_block")
    sides = [
        blocked.join(
            pairs.where("block <> _block" if side else "true").select("path", F.col(own).alias("block"), part.alias("part")),
            ["path", "block"],
        ).select(F.col("path").alias("bucket"), "part", F.lit(side).alias("side"), "cid")
        for side, own in enumerate(("block", "_block"))
    ]
    return _brute_force(sides[0].unionByName(sides[1]).join(sketches, "cid").select("bucket", "part", "side", "cid", "sketch"), near)


# --- exact comparison ----------------------------------------------------------------------------------------


def similar_pairs(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets with a Jaccard similarity of ``threshold``; with two sides, only pairs across.

    Tokens in the same sets count as one with their number as weight, tokens in a single set not at all.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate(sets)
    rows = np.repeat(np.arange(n), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], rows[order]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.r_[starts, len(tokens)])
    column = np.repeat(np.arange(len(starts)), counts)
    shared = (counts > 1)[column]
    rows, column = rows[shared], column[shared]
    common = np.zeros((n, n), dtype=np.float64)
    if len(rows):
        first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
        names = _mix(np.arange(1, n + 1, dtype=np.uint64)), _mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(1 << 32))
        signature = np.stack([np.add.reduceat(x[rows], first) for x in names], axis=1)
        _, chosen, weight = np.unique(signature, axis=0, return_index=True, return_counts=True)
        lengths = np.diff(np.r_[first, len(rows)])
        for at in range(0, len(chosen), 2048):
            part = chosen[at : at + 2048]
            held = np.zeros((n, len(part)), dtype=np.float32)
            take = np.concatenate([np.arange(first[c], first[c] + lengths[c]) for c in part])
            held[rows[take], np.repeat(np.arange(len(part)), lengths[part])] = 1
            common += (held * weight[at : at + 2048].astype(np.float32)) @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    similar = (common >= threshold * union - 1e-9) & (union > 0)
    if side.any() and not side.all():
        similar &= (side[:, None] == 0) & (side[None, :] == 1)
    else:
        similar = np.triu(similar, 1)
    return np.nonzero(similar)


def _exact(threshold: float):
    """Links of each class and the least class it is connected with, in groups sorted by their key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["label", "part"], 512):
            label, part = table.column("label").to_numpy(), table.column("part").to_numpy()
            cid, side, copies = (table.column(c).to_numpy() for c in ("cid", "side", "copies"))
            sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
            order = np.lexsort((cid, part, label))
            starts = np.flatnonzero(np.r_[True, (label[order][1:] != label[order][:-1]) | (part[order][1:] != part[order][:-1])])
            out = []
            for s, e in zip(starts, np.r_[starts[1:], len(order)], strict=True):
                at = order[s:e]
                at = at[np.r_[True, cid[at][1:] != cid[at][:-1]]]
                i, j = similar_pairs([sets[k] for k in at], side[at], threshold)
                links = np.bincount(i, weights=copies[at][j], minlength=len(at)) + np.bincount(j, weights=copies[at][i], minlength=len(at))
                out.append(np.stack([cid[at], links.astype(np.int64), cid[at][forest((i, j), len(at))], label[at]]))
            found = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["cid", "links", "root", "label"])

    return run


def _shingle_rows(size: int):
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles_of(t, size) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
            pa.array([s.tobytes() for s in sets], pa.binary()),
        ], ["digest", "shingles"])

    return rows


def exact_links(rows: DataFrame, classes: DataFrame, links: DataFrame, threshold: float, size: int) -> DataFrame:
    """``cid, links, component`` of classes that have a candidate, all pairs in a candidate group compared.

    A group too large for a task is cut into blocks and every pair of blocks compared in one.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = connected_components(nodes, links)
    grouped = classes.join(labels, classes["cid"] == labels["node"]).select(
        "cid", "digest", "rep", "copies", "n_shingles", F.col("component").alias("label")
    )
    grouped = stored(grouped, "grouped")
    sizes = grouped.groupBy("label").agg(F.count(F.lit(1)).alias("_n"), F.sum("n_shingles").alias("_grams"))
    blocks = F.greatest(F.ceil(F.col("_n") / MEMBERS), F.ceil(F.col("_grams") / GRAMS)).cast("int")
    sizes = stored(sizes.select("label", blocks.alias("blocks")), "sizes")
    placed = grouped.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # Block pair (i, j) with i <= j; a class is on the first side where its block is i.
    partner = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = partner.withColumn("part", F.least("own", "with") * F.col("blocks") + F.greatest("own", "with")).withColumn(
        "side", (F.col("own") > F.col("with")).cast("int")
    )
    wanted = broadcast_if_small(settle(grouped.select(F.col("rep").alias("doc_id")).distinct()))
    chosen = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = chosen.select("text").mapInArrow(per_batch(_shingle_rows(size)), "digest binary, shingles binary")
    sets = sets.join(grouped.select("digest"), "digest", "left_semi").dropDuplicates(["digest"])
    compared = pair.select("label", "part", "side", "cid", "copies", "digest").join(sets, "digest").drop("digest")
    found = stored(
        compared.repartition("label", "part").sortWithinPartitions("label", "part")
        .mapInArrow(_exact(threshold), "cid bigint, links bigint, root bigint, label bigint"),
        "exact",
    )
    totals = found.groupBy("cid").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    # Within one task the root is final; across blocks the roots are connected once more.
    cut = sizes.where("blocks > 1").select("label")
    edges = found.join(cut, "label", "left_semi").where("root <> cid").select(F.col("root").alias("a"), F.col("cid").alias("b"))
    edges = stored(edges.distinct(), "roots")
    if edges.isEmpty():
        return totals.select("cid", "links", F.col("root").alias("component"))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    joined = connected_components(nodes, edges).select(F.col("node").alias("cid"), "component")
    return totals.join(joined, "cid", "left").select("cid", "links", F.coalesce("component", "root").alias("component"))


def ngram_join(
    docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL
) -> DataFrame:
    """Near-duplicate classes: ``doc_id, class_id, n_links, n_shingles, kept``, a row per document.

    Two documents are linked if the Jaccard similarity of their sets of ``size`` lower-cased words in a row
    reaches ``threshold``. ``n_links`` counts all documents linked to one, copies included, and ``class_id``
    is the least id that is connected with it by links. ``kept`` marks the document that bears its class's id.
    Candidates are found with the probability ``recall`` or more and then compared exactly.

    A text of fewer words has one n-gram of all its words. A null text or one without words has no n-gram and
    no link. Rows of one id count as one document each in ``n_links`` and share a class only if they are
    similar; null ids are larger than all others in the choice of a class id. Other columns are not read. An
    empty table gives no rows.
    """
    return _joined(docs, threshold, size, recall, False).select("doc_id", "class_id", "n_links", "n_shingles", "kept")


def _joined(docs: DataFrame, threshold: float, size: int, recall: float, texts: bool) -> DataFrame:
    """Rows of ``ngram_join``; with ``texts`` also each text's ``_digest``, and ``_stays`` on one text of a class."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    sets = stored(
        rows.mapInArrow(per_batch(_sets(size, texts)), "doc_id bigint, whole binary, digest binary, n_shingles int, sketch binary"), "sets"
    )
    # Documents with equal sets are one class.
    classes = sets.where("n_shingles > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "whole")).alias("least"),
        F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
    ).withColumn("rep", F.col("least.doc_id"))
    # Written with the number, which then cannot change.
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = exact_links(rows, classes, candidate_links(classes, threshold, recall), threshold, size)
    named = classes.select("cid", "digest", "least", "copies").join(found, "cid", "left").select(
        "digest", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cid").alias("component")
    )
    named = stored(named.where("copies > 1 or links > 0"), "named")
    first = named.groupBy("component").agg(F.min("least").alias("first"))
    table = named.join(first, "component").select(
        "digest", F.col("first.doc_id").alias("class_id"), F.col("first.whole").alias("_first"),
        (F.col("links") + F.col("copies") - 1).alias("_links"),
    )
    joined = join_groups(sets.select("doc_id", "whole", "digest", "n_shingles"), table, ["digest"], "doc_id", "left")
    alone = F.col("_links").isNull()
    class_id = F.when(alone, F.col("doc_id")).otherwise(F.col("class_id"))
    kept = F.col("doc_id").eqNullSafe(class_id)
    return joined.select(
        "doc_id", class_id.alias("class_id"), F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), "n_shingles",
        kept.alias("kept"), F.col("whole").alias("_digest"), (alone | (kept & (F.col("whole") == F.col("_first")))).alias("_stays"),
    )


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each class of near copies, in its columns."""
    found = _joined(docs, threshold, size, recall, True)
    return drop_repeated_rows(without(docs, found.where(~F.col("_stays"))))


__all__ = ["chance_of_miss", "drop_near_copies", "ngram_join", "runs_by_depth", "runs_for", "shingles_of", "similar_pairs", "sketch_of"]
