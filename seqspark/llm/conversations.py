"""Repair of conversations whose turns are blank, repeated, cut off or out of order, by an auction for shortest paths.

A conversation's rows in order and what may be done to each of them form a lattice: node (i, state) is reached
when i rows are consumed and the repaired turns end in ``state``; its arcs are edits with whole-number costs.
The cheapest edits are a shortest path from (0, empty) to the end.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqspark.session import ship_package

# Costs of edits, and what a kept or re-roled turn that is cut off costs besides.
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3

# Blanks, and signs that end a turn.
BLANKS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")

# What the repaired turns end in: nothing yet, system, user, assistant. The next written turn and its role.
EMPTY, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}

# A row's code: 4 * kind of role (s, u, a, any other) + fault.
FINE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
ABSENT = -1

# Rows after which prices are made exact for all states; a longer conversation is taken in such stretches.
STRETCH = 16

# Conversations of the same codes need the same edits; a worker keeps this many, of a few stretches at most.
KEPT = 50_000
KEPT_ROWS = 4 * STRETCH


# --- the auction -------------------------------------------------------------------------------


def _arcs(code: int | None) -> list[list[tuple[str, int, int, int]]]:
    """Per state the arcs at a row of this code, or behind the last row: (edit, cost, rows consumed, state)."""
    found = []
    for state in range(4):
        arcs = []
        if code is not None:
            arcs.append(("D", DELETE, 1, state))
        arcs.append(("I", INSERT, 0, NEXT[state]))
        if code is not None and code % 4 not in (BLANK, DUPLICATE):
            extra = CUT_OFF if code % 4 == TRUNCATED else 0
            becomes = code // 4 + 1
            if (becomes == SYSTEM and state == EMPTY) or (becomes in ROLES and NEXT[state] == becomes):
                arcs.append(("K", extra, 1, becomes))
            arcs.append(("R", REROLE + extra, 1, NEXT[state]))
        found.append(arcs)
    return found


# Arcs are in the order of their letters.
ARCS = [_arcs(code) for code in range(16)]
LAST_ARCS = _arcs(None)


class Auction:
    """Prices of the nodes of one conversation's lattice: never above the cost that is left, and exact where marked.

    A path starts at a node. While its end can be left at its price, it is extended by the arc that attains
    it; else the price rises to the cheapest arc's and the path loses its end. When the path reaches a node
    of exact price, every price on it is exact. Prices only rise, whole numbers at a time.
    """

    def __init__(self, codes: bytes):
        self.codes, self.n = codes, len(codes)
        self.end = 4 * (self.n + 1)
        self.price = array("q", bytes(8 * (self.end + 1)))
        self.exact = bytearray(self.end + 1)
        self.exact[self.end] = 1

    def start_prices(self, first: int, last: int) -> None:
        """Prices of rows ``first`` to ``last`` (exclusive) that no arc contradicts, given those of row ``last``.

        They are the least of these and what each row must cost at least. So however long the conversation,
        a price has to rise by no more than what a stretch costs.
        """
        least = min(self.price[4 * last : 4 * last + 4])
        for i in range(last - 1, first - 1, -1):
            fault = self.codes[i] % 4
            least += DELETE if fault in (BLANK, DUPLICATE) else min(CUT_OFF, DELETE) if fault == TRUNCATED else 0
            for state in range(4):
                self.price[4 * i + state] = least

    def arcs(self, node: int) -> Iterator[tuple[str, int, int]]:
        row, state = divmod(node, 4)
        if row < self.n:
            for edit, cost, step, after in ARCS[self.codes[row]][state]:
                yield edit, cost, 4 * (row + step) + after
        else:
            if state in (EMPTY, ASSISTANT):
                yield "", 0, self.end
            for edit, cost, _, after in LAST_ARCS[state]:
                yield edit, cost, 4 * row + after

    def converge(self, origin: int) -> None:
        """Make the price of ``origin`` exact."""
        path, price, exact = [origin], self.price, self.exact
        while not exact[path[-1]]:
            here = path[-1]
            best, to = min((cost + price[node], node) for _, cost, node in self.arcs(here))
            if price[here] < best:
                price[here] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            exact[node] = 1

    def edits(self) -> tuple[int, str]:
        """The least cost, and of the cheapest edits the least string of their initials."""
        # From the back, so that a path never runs through more than one stretch.
        last = self.n
        for row in range(max(self.n - 1, 0) // STRETCH * STRETCH, -1, -STRETCH):
            self.start_prices(row, last)
            for state in range(4) if row else (EMPTY,):
                self.converge(4 * row + state)
            last = row
        node, letters = EMPTY, []
        while node != self.end:
            for edit, cost, to in self.arcs(node):
                if cost + self.price[to] == self.price[node]:
                    # An arc can be tight only because the price behind it is still too low.
                    self.converge(to)
                    if cost + self.price[to] == self.price[node]:
                        letters.append(edit)
                        node = to
                        break
        return self.price[EMPTY], "".join(letters)


@lru_cache(maxsize=KEPT)
def _known_edits(codes: bytes) -> tuple[int, str]:
    return Auction(codes).edits()


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a conversation's codes."""
    return _known_edits(codes) if len(codes) <= KEPT_ROWS else Auction(codes).edits()


# --- rows --------------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with one row in four damaged, by the remainder of a checksum of ``conv_id:turn`` by 20.

    0 drops the row, 1 empties its text, 2 takes the sentence ends out, 3 repeats it, 4 makes its role user.
    Returns ``conv_id, turn, role, text, copies``; dropped rows have 0 copies. Null values are one space, but
    a null conversation or turn stays null besides.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    draw = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(draw == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, "".join(SENTENCE_ENDS), "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )


# Order of a conversation's rows; rows of one turn go by role and a digest of their text.
ORDER = ["turn", "role", "digest", "copy"]


def _in_order() -> list[Column]:
    return [F.asc_nulls_first("turn"), *[F.asc(c) for c in ORDER[1:]]]


def _copied(rows: DataFrame) -> DataFrame:
    """A row per copy, and one of copy 0 where there is none, so that no conversation gets lost."""
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int"))).otherwise(F.array(F.lit(0)))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return rows.select("conv_id", "turn", "role", "text", digest.alias("digest"), F.explode(numbers).alias("copy"))


def _coded(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, copy, code``: no text."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    looks = F.when(stripped == "", BLANK).when(~F.substring(stripped, -1, 1).isin(*SENTENCE_ENDS), TRUNCATED).otherwise(FINE)
    narrow = rows.select("conv_id", "turn", "role", "digest", "copy", kind.alias("kind"), looks.alias("looks"))
    # Only rows that are there count as seen.
    seen = Window.partitionBy("conv_id", "role", "digest", F.col("copy") > 0).orderBy(*_in_order())
    again = F.row_number().over(seen) > 1
    fault = F.when((F.col("looks") != BLANK) & again, DUPLICATE).otherwise(F.col("looks"))
    code = F.when(F.col("copy") > 0, F.col("kind") * 4 + fault).otherwise(ABSENT)
    return narrow.select("conv_id", "turn", "role", "digest", "copy", code.cast("int").alias("code"))


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _judge(kind: pa.DataType):
    """Per conversation, from its codes in order (one byte a row is held): the report and the audit."""
    schema = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in _REPORT], ("audit", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, codes, turns, first = None, None, 0, None
        last = None

        def report() -> tuple:
            cost, audit = cheapest_edits(bytes(codes))
            faults = [c % 4 for c in codes]
            illegal = sum((a // 4, b // 4) not in _LEGAL for a, b in zip(codes, codes[1:], strict=False))
            gaps = 0 if first is None else last - first + 1 - turns
            return (current, gaps, *[faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)], illegal, cost, audit)

        for batch in batches:
            done = []
            for conv, turn, code in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "code")], strict=True):
                if codes is None or conv != current:
                    if codes is not None:
                        done.append(report())
                    current, codes, turns, first, last = conv, bytearray(), 0, None, None
                if code == ABSENT:
                    continue
                codes.append(code)
                if turn is not None and turn != last:
                    first = turn if first is None else first
                    last, turns = turn, turns + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
        if codes is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(report(), schema, strict=True)], schema=schema)

    return run


def _apply(kind: pa.DataType):
    """A conversation's audit comes first, then its rows in order, of which one batch is held at a time."""
    fields = [("conv_id", kind), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    schema = pa.schema([*fields, *[(c, pa.int64()) for c in _REPORT], ("audit", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, EMPTY, 0
        out: list[tuple] = []

        def write(edit: str, role: str, text: str, becomes: int) -> None:
            nonlocal state, place
            state, place = becomes, place + 1
            out.append((conv, place, edit, role, text, *[None] * (len(_REPORT) + 1)))

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                write("I", ROLES[NEXT[state]], "", NEXT[state])
                at += 1

        columns = ["conv_id", "role", "text", *_REPORT, "audit"]
        for batch in batches:
            for name, role, text, *report, edits in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if edits is not None:
                    insert()
                    conv, audit, at, state, place = name, edits, 0, EMPTY, 0
                    out.append((conv, 0, None, None, None, *report, edits))
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit == "K":
                    write("K", role, text, SYSTEM if role[:1] == "s" else NEXT[state])
                elif edit == "R":
                    write("R", ROLES[NEXT[state]], text, NEXT[state])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out.clear()
        insert()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _repaired(rows: DataFrame) -> DataFrame:
    """Per conversation a header (``place`` 0, with the report), then its repaired turns in order.

    Codes are moved without texts first; the texts then move once, to where the edits of their conversation are.
    """
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = _arrow_type(rows)
    copied = _copied(rows)
    judged = _coded(copied).repartition("conv_id").sortWithinPartitions("conv_id", *_in_order()).select("conv_id", "turn", "code")
    numbers = ", ".join(f"{c} bigint" for c in _REPORT)
    audits = judged.mapInArrow(_judge(arrow), f"conv_id {kind}, {numbers}, audit string")
    texts = copied.where("copy > 0").withColumns({c: F.lit(None).cast("bigint") for c in _REPORT}).withColumn("audit", F.lit(None).cast("string"))
    both = texts.unionByName(audits, allowMissingColumns=True)
    together = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_in_order())
    return together.select("conv_id", "role", "text", *_REPORT, "audit").mapInArrow(
        _apply(arrow), f"conv_id {kind}, place bigint, edit string, role string, text string, {numbers}, audit string"
    )


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text``: the turns of repaired conversations, from place 1 on.

    ``rows`` holds ``conv_id, turn, role, text, copies`` (``damage`` makes them; 1 copy is a row as it is);
    other columns are ignored. Conversations may lack an id or turns; rows are taken by turn, nulls first,
    then role and a digest of the text. Roles and texts are compared as they are; a role without a first
    letter s, u or a fits nowhere, an empty one included.
    """
    return _repaired(rows).where("place > 0").select("conv_id", "place", "edit", "role", "text")


def _hashes(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in _REPORT], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header, running = None, None
        columns = ["conv_id", "place", "role", "text", *_REPORT, "audit"]
        for batch in batches:
            done = []
            for conv, place, role, text, *report in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if place == 0:
                    if header is not None:
                        done.append((*header, running.hexdigest()))
                    header, running = (conv, *report), hashlib.sha256()
                else:
                    running.update((("\n" if place > 1 else "") + role + ":" + text).encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
        if header is not None:
            last = (*header, running.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, schema, strict=True)], schema=schema)

    return run


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, faults, cost and audit of the repair, hash of the repaired turns.

    ``gaps`` counts turn numbers missing between the least and the largest. Each row's first fault counts:
    blank, duplicate (role and text seen earlier), truncated (no sentence end). ``illegal`` counts neighbours
    whose roles' initials are not su, ua or au. ``audit`` has an initial per edit, D(elete), I(nsert), K(eep),
    R(erole), cheapest first, then the ASCII-least. A conversation without rows has zeros, an empty audit and
    the hash of nothing. Of a conversation a task holds a few bytes a row, and texts only batch by batch.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} bigint" for c in _REPORT)
    # A conversation's turns follow its header in the same partition, so nothing has to move.
    return _repaired(rows).mapInArrow(_hashes(_arrow_type(rows)), f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string")
