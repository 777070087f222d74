"""Exact and near copies, and repeated strings, against brute force."""

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqspark.llm import chunk_dedup, ngram_join, repeats


# --- chunks ---


@given(st.binary(max_size=4000), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_cut_points_cover_the_text(data, bits):
    ends = chunk_dedup.cut_points(np.frombuffer(data * 3, dtype=np.uint8), bits, 16, 256)
    assert ends[-1] == 3 * len(data) and all(0 < b - a <= 256 for a, b in zip([0, *ends], ends, strict=False) if len(data))


def test_cut_points_follow_content():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300_000).astype(np.uint8)
    a = set(chunk_dedup.cut_points(data))
    b = {e - 100 for e in chunk_dedup.cut_points(np.r_[rng.integers(0, 256, 100).astype(np.uint8), data])}
    assert len(a & b) > 0.9 * len(a)


def expected_copies(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(-1 if doc_id is None else doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids)
        for n, i in enumerate(sorted(ids, reverse=True)):
            out.append((i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_copies(docs_of, odd_rows):
    found = chunk_dedup.find_copies(docs_of(odd_rows)).collect()
    got = sorted((-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], *r[2:]) for r in found)
    assert got == expected_copies(odd_rows)


def test_copies_empty_and_clashing(docs_of):
    assert chunk_dedup.find_copies(docs_of([])).count() == 0
    docs = docs_of([(1, "a"), (2, "a")])
    for name in ("keep_id", "kept", "seq", "recipe"):
        docs = docs.withColumn(name, docs["doc_id"])
    assert {(r.doc_id, r.keep_id, r.kept) for r in chunk_dedup.find_copies(docs).collect()} == {(1, 2, False), (2, 2, True)}
    assert chunk_dedup.drop_copies(docs).columns == docs.columns


def test_drop_copies_keeps_one_row(docs_of, odd_rows):
    kept = chunk_dedup.drop_copies(docs_of(odd_rows)).collect()
    assert len(kept) == len({t or "" for _, t in odd_rows}) + 0 + sum(i is None for i, _ in odd_rows) * 0
    assert len({r.text or "" for r in kept}) == len(kept)


def test_drop_copies_judges_rows(docs_of):
    """A shared id keeps its unique text, and a copy without an id goes."""
    rows = [(4, "copy"), (4, "a clean unique text"), (9, "copy"), (None, "copy"), (None, "twice"), (None, "twice"), (5, None), (5, "")]
    kept = sorted((str(r.doc_id), r.text or "") for r in chunk_dedup.drop_copies(docs_of(rows)).collect())
    assert kept == [("4", "a clean unique text"), ("5", ""), ("9", "copy"), ("None", "twice")]


# --- near copies ---


def brute_links(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        n = min(5, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        union = len(sets[a] | sets[b])
        if union and len(sets[a] & sets[b]) / union >= threshold:
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    return links, [find(i) for i in range(len(rows))]


def check_join(found, rows):
    links, roots = brute_links(rows)
    least = defaultdict(list)
    for i, r in enumerate(roots):
        if rows[i][0] is not None:
            least[r].append(rows[i][0])
    want = sorted((str(rows[i][0]), str(min(least[roots[i]], default=None)), links[i]) for i in range(len(rows)))
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in found) == want


def test_join_odd_rows(docs_of, odd_rows):
    check_join(ngram_join.ngram_join(docs_of(odd_rows)).collect(), odd_rows)


def test_join_table(small):
    check_join(ngram_join.ngram_join(small).collect(), [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()])


def test_join_large_groups(docs_of, monkeypatch):
    """Near copies of a few texts, with limits so small that buckets are split and groups cut into blocks."""
    rng = np.random.default_rng(2)
    rows = []
    for base in range(4):
        words = [f"w{base}x{i}" for i in range(120)]
        for n in range(30):
            changed = list(words)
            for at in rng.integers(0, 120, rng.integers(0, 4)):
                changed[at] = f"new{rng.integers(10**6)}"
            rows.append((base * 100 + n, " ".join(changed)))
    for name, value in (("BUCKET", 4), ("MEMBERS", 16), ("BLOCK", 8)):
        monkeypatch.setattr(ngram_join, name, value)
    check_join(ngram_join.ngram_join(docs_of(rows)).collect(), rows)


def test_join_empty_and_stage(docs_of):
    assert ngram_join.ngram_join(docs_of([])).count() == 0
    text = " ".join(f"t{i}" for i in range(60))
    docs = docs_of([(1, text), (2, text + " end"), (3, "something else entirely, a clean text of its own")])
    docs = docs.withColumn("kept", docs["doc_id"]).withColumn("class_id", docs["doc_id"])
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_near_stage_judges_rows(docs_of):
    """One row of each class stays, also where ids are shared or missing; a unique text of a shared id stays."""
    near, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "tu")
    unique = "a clean unique text of its own"
    rows = [(4, near), (7, near + " end"), (7, unique), (None, near + " stop"), (None, other), (None, other + " end"), (None, "!"), (8, unique + " x"), (8, unique.upper() + " X")]
    kept = [(r.doc_id, r.text) for r in ngram_join.drop_near_copies(docs_of(rows)).collect()]
    assert len(kept) == 5 and {(4, near), (7, unique), (None, "!")} <= set(kept)
    assert sum(i is None and t.startswith("u0") for i, t in kept) == 1 and sum(i == 8 for i, _ in kept) == 1


def test_runs_reach_recall():
    assert ngram_join.runs_for(0.9999, 0.8) > ngram_join.runs_for(0.99, 0.8) > 1


def test_recall_holds_at_every_depth():
    """All that may be missed at the depths together, averaged over sketch agreement, is within the recall."""
    runs = ngram_join.runs_by_depth(ngram_join.RECALL, 0.8)
    assert set(runs) == set(range(ngram_join.DEPTH, ngram_join.MAX_DEPTH + 1))
    lost = ngram_join.chance_of_miss(10**6, 0.8)
    assert lost + sum(ngram_join.chance_of_miss(n, 0.8, d) - lost for d, n in runs.items()) <= 1 - ngram_join.RECALL


def test_hot_buckets_draw_more_runs(docs_of, monkeypatch):
    """Where buckets are split down to blocks, links of different texts are found as by brute force."""
    rng = np.random.default_rng(9)
    shared, rows = [f"s{i}" for i in range(100)], []
    for base in range(20):
        words = [*shared, *(f"w{base}x{i}" for i in range(45))]
        rows += [(base * 10 + n, " ".join([*words, *(f"e{base}y{n}z{i}" for i in range(int(rng.integers(0, 12))))])) for n in range(3)]
    for name, value in (("BUCKET", 3), ("MAX_DEPTH", 3), ("MEMBERS", 16), ("BLOCK", 8)):
        monkeypatch.setattr(ngram_join, name, value)
    check_join(ngram_join.ngram_join(docs_of(rows)).collect(), rows)


@pytest.mark.parametrize("others", [0, 64])
def test_near_copies_are_not_split(docs_of, monkeypatch, others):
    """A large bucket of near copies with a few other texts in it is compared at once; split ones give the same links."""
    rng = np.random.default_rng(11)
    words, rows = [f"w{i}" for i in range(100)], []
    for n in range(60):
        changed = list(words)
        for at in rng.integers(0, 100, rng.integers(0, 3) if n % 6 else 9):
            changed[at] = f"new{rng.integers(10**6)}"
        rows.append((n, " ".join(changed)))
    written = []
    stored = ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: (written.append(name), stored(df, name))[1])
    monkeypatch.setattr(ngram_join, "BUCKET", 4)
    monkeypatch.setattr(ngram_join, "OTHERS", others, raising=False)
    check_join(ngram_join.ngram_join(docs_of(rows)).collect(), rows)
    assert "blocked" in written and (written.count("paths") == 1) == (others > 0)


# --- repeats ---


def brute_repeats(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, data, strict=True):
        covered = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~covered])
        out.append((str(doc_id), len(b), int(covered.sum()), len(repeats.spans(covered)[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6), st.integers(2, 12))
@settings(max_examples=200, deadline=None)
def test_index_against_brute_force(texts, length):
    segments = [t.encode() for t in texts]
    seen = Counter(b[i : i + length] for b in segments for i in range(len(b) - length + 1))
    for b, covered in zip(segments, repeats.covered_by_repeats(segments, [0] * len(segments), length), strict=True):
        want = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                want[i : i + length] = True
        assert (covered == want).all()


@given(st.binary(min_size=40, max_size=200))
@settings(max_examples=50, deadline=None)
def test_every_window_has_an_anchor(data):
    places, _ = repeats.anchors_of(np.frombuffer(data, dtype=np.uint8), 20, 5)
    assert all(((places >= i) & (places <= i + 15)).any() for i in range(len(data) - 19))


@pytest.mark.parametrize("group", [2, 1500])
def test_repeats_table(small, group):
    """With groups of two at most, nearly all goes through the counting of strings in large groups."""
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    found = repeats.remove_repeats(small, length=80, gram=16, group=group).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == brute_repeats(rows, 80)


def test_repeats_odd_rows(docs_of):
    line = "all work and no play makes a dull day. "
    rows = [(1, None), (2, ""), (3, line * 40), (4, "x" + line * 12), (4, "x" + line * 12), (None, "y" * 900), (5, "short"), (6, "é" * 300)]
    docs = docs_of(rows)
    docs = docs.withColumn("key", docs["doc_id"]).withColumn("kept", docs["doc_id"])
    found = repeats.remove_repeats(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == brute_repeats(rows, 400)
    assert repeats.remove_repeats(docs_of([])).count() == 0


def test_repeats_of_one_passage(docs_of, monkeypatch):
    """A passage of many documents: equal surroundings are told by one row, and marks that touch are one."""
    rng = np.random.default_rng(4)
    passage = "".join(rng.choice(list("abcdefgh"), 300))
    rows = [(n, "".join(rng.choice(list("ijklmnop"), 100)) + passage + "".join(rng.choice(list("qrstuvwx"), 100))) for n in range(40)]
    rows += [(n, passage + "".join(rng.choice(list("qrstuvwx"), 50 + n))) for n in range(40, 60)]
    written, stored = {}, repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, name: written.setdefault(name, stored(df, name)) if name != "found-elsewhere" else stored(df, name))
    found = repeats.remove_repeats(docs_of(rows), length=80, gram=16, group=2).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == brute_repeats(rows, 80)
    assert {len(r.marks) for r in written["marks"].collect()} == {1}
    assert written["cells"].count() < 2 * written["context-texts"].count()
