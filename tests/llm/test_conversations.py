"""Conversation repair against enumerating edits, a plain recursion over suffixes, and a rewritten damage."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from seqspark.llm import conversations as conv

SCHEMA = "conv_id bigint, turn bigint, role string, text string, gaps string"
GAPS = ["", "u", "a", "ua", "au"]


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def enumerated(rows):
    """Least (cost, audit) over every way to edit every row, with up to two inserted turns in each gap."""
    faults, best = faults_of(rows), None
    for edits in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, edits, strict=True)):
            continue
        for gaps in itertools.product(GAPS, repeat=len(rows) + 1):
            audit, initials, cost = "I" * len(gaps[0]), gaps[0], 3 * sum(map(len, gaps))
            for (role, _), fault, e, gap in zip(rows, faults, edits, gaps[1:], strict=True):
                cost += {"D": 4, "K": 0, "R": 3}[e[0]] + (3 if fault == "truncated" and e != "D" else 0)
                initials += {"D": "", "K": role[:1] or "?", "R": e[-1]}[e[0]] + gap
                audit += e[0] + "I" * len(gap)
            if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_suffixes(rows):
    """The same by recursion: the least (cost, letters) of what follows each row and ending, and the repaired turns."""
    faults = faults_of(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def least(i, end, inserts=0):
        found = [(0, "")] if i == len(rows) and end in ("", "a") else []
        if inserts < 3:
            c, a = least(i, after[end], inserts + 1)
            found.append((c + 3, "I" + a))
        if i < len(rows):
            c, a = least(i + 1, end)
            found.append((c + 4, "D" + a))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                own = rows[i][0][:1]
                if own == after[end] or (own == "s" and end == ""):
                    c, a = least(i + 1, own)
                    found.append((c + more, "K" + a))
                c, a = least(i + 1, after[end])
                found.append((c + 3 + more, "R" + a))
        return min(found, default=(10**9, ""))

    for i in range(len(rows), -1, -1):
        least(i, "")
    cost, audit = least(0, "")
    out, end, at = [], "", 0
    full = {"u": "user", "a": "assistant"}
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        end = role[:1] if edit == "K" else after[end]
        out.append((role if edit == "K" else full[end], text))
    return cost, audit, out


def damaged(table):
    """(conv_id, turn, role, text) rows after damage, per conversation in order; written apart from the operator."""
    groups = {}
    for c, turn, role, text in table:
        held = groups.setdefault(c, [])
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        held += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2]))) for c, rows in groups.items()}


def reports(table):
    out = []
    for c, held in damaged(table).items():
        rows = [(r, t) for _, r, t in held]
        cost, audit, repaired = by_suffixes(tuple(rows))
        faults, turns = faults_of(rows), [t for t, _, _ in held if t is not None]
        illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(rows))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.append((c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


def random_rows(rnd, n):
    return tuple((rnd.choice(["user", "assistant", "system", "tool", ""]), rnd.choice(["a.", "b", " ", "c!", "d?", "e"])) for _ in range(n))


def codes_of(rows):
    names = ["", "blank", "duplicate", "truncated"]
    kinds = {"s": 0, "u": 1, "a": 2}
    return bytes(4 * kinds.get(r[:1], 3) + names.index(f) for (r, _), f in zip(rows, faults_of(rows), strict=True))


def test_recursion_equals_enumeration():
    rnd = random.Random(1)
    for n in (0, 1, 1, 2, 2, 2, 2, 3, 3, 3):
        rows = random_rows(rnd, n)
        assert by_suffixes(rows)[:2] == enumerated(rows)


def test_auction_equals_recursion():
    rnd = random.Random(2)
    for n in [*range(12)] * 40 + [15, 16, 17, 31, 32, 33, 150, 193]:
        rows = random_rows(rnd, n)
        assert conv.Auction(codes_of(rows)).edits() == by_suffixes(rows)[:2], rows


@pytest.mark.parametrize("code", [4 * 1, 4 * 3 + 3, 4 * 2 + 1, 0])
def test_long_runs_of_one_code(code):
    """Prices stay bounded by a stretch's cost, so the work grows with the rows."""
    cost, audit = conv.Auction(bytes([code]) * 4000).edits()
    assert len(audit.replace("I", "")) == 4000 and cost > 0


def test_odd_conversations(spark):
    rnd = random.Random(3)
    table = [(c, t, *random_rows(rnd, 1)[0]) for c in range(120) for t in range(rnd.randrange(1, 9))]
    table += [(None, 1, "user", "x."), (None, None, "assistant", "y."), (500, None, None, None), (500, 2, "user", None), (500, 2, None, "q.")]
    table += [(501, 1, "user", "same."), (501, 1, "user", "same."), (501, 1, "user", "other."), (501, 3, "assistant", "z.")]
    table += [(502, i, ["user", "assistant"][i % 2], "long " * 20_000 + ".") for i in range(150)]
    table += [(503, t, "user", "\t\n \x0b") for t in range(4)] + [(504, 2**40, "system", "é。"), (504, -5, "user", "ok?\r\n")]
    rows = spark.createDataFrame([(*r, "x") for r in table], SCHEMA)
    found = conv.repair_report(conv.damage(rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == reports(table)
    turns = conv.repaired_turns(conv.damage(rows)).where("conv_id = 502").orderBy("place").collect()
    want = by_suffixes(tuple((r, t) for _, r, t in damaged(table)[502]))[2]
    assert [(r.role, r.text) for r in turns] == want and [r.place for r in turns] == list(range(1, len(want) + 1))
    empty = conv.damage(rows.limit(0))
    assert conv.repair_report(empty).count() == 0 and conv.repaired_turns(empty).count() == 0


def test_dropped_conversation(spark):
    c = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = conv.repair_report(conv.damage(spark.createDataFrame([(c, 0, "user", "x.", "")], SCHEMA))).collect()
    assert [tuple(r) for r in found] == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_given_conversations(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    table = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    found = conv.repair_report(conv.damage(rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == reports(table)
