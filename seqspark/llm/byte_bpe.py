"""Byte-level BPE by rank files: overlapping chunks, stitched where their pre-token boundaries meet."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqspark.llm.common import join_groups, per_batch, slices, stored, text_digest, text_or_empty
from seqspark.llm.tokens import vocabulary_path
from seqspark.session import ship_package

RANKS = "byte_bpe_multi_50k.tiktoken"

# Characters of a chunk, and of the next chunk that a window reads beyond its own.
CHUNK = 16_384
OVERLAP = 256

# A match of the pattern never looks further than this many characters beyond the character it ends with.
LOOK = 3

# Bytes that stand for all characters of a kind beyond ASCII: letters, numbers, white space, anything else.
_LETTER, _NUMBER, _SPACE, _OTHER = 0xE9, 0xB2, 0xA0, 0xA4


def token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class PreTokens:
    """Ends of the pre-tokens of a text, with the library's own idea of letters, numbers and white space.

    Python's expressions know newer letters than the library does. So the library is asked once for the kind
    of every character; a text then becomes one byte a character, on which the pattern is matched.
    """

    def __init__(self, pattern: str):
        import tiktoken

        codes = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")
        everything = codes.tobytes().decode("utf-32-le")
        one_byte = {bytes([i]): i for i in range(256)}
        self._kind = np.full(0x110000, _OTHER, dtype=np.uint8)
        for wanted, sign in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
            matcher = tiktoken.Encoding("kind", pat_str=wanted, mergeable_ranks=one_byte, special_tokens={})
            found = bytes(matcher.encode_ordinary(everything)).decode()
            self._kind[np.frombuffer(found.encode("utf-32-le"), dtype="<u4")] = sign
        letters = "A-Za-z" + chr(_LETTER)
        numbers = "0-9" + chr(_NUMBER)
        blanks = "\\t-\\r " + chr(_SPACE)
        self._kind[:128] = np.arange(128)
        own = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{numbers}]")
        own = own.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        own = own.replace(r"\S", f"[^{blanks}]").replace(r"\s", f"[{blanks}]")
        self._pattern = re.compile(own.encode("latin-1"))

        self._blank = np.zeros(256, dtype=bool)
        self._blank[[*range(9, 14), 32, _SPACE]] = True

    def _kinds(self, text: str) -> np.ndarray:
        return self._kind[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]

    def _ends(self, kinds: np.ndarray) -> np.ndarray:
        return np.cumsum([len(p) for p in self._pattern.findall(kinds.tobytes())], dtype=np.int64)

    def ends(self, text: str) -> np.ndarray:
        """Where each pre-token ends, in characters; every character belongs to one."""
        return self._ends(self._kinds(text))

    def cuts(self, text: str) -> np.ndarray:
        """The ends at which a text can be cut so that its left part has the same pre-tokens when it is alone.

        White space before something else is not such a place: at the end of a text the pattern takes more of it.
        """
        kinds = self._kinds(text)
        ends = self._ends(kinds)
        inner = ends[ends < len(kinds)]
        blank = self._blank[kinds]
        return np.r_[inner[~(blank[inner - 1] & ~blank[inner])], ends[len(inner):]]


class RankFile:
    """The library's encoder for a rank file, and the bytes of every id."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._names = [str(i) for i in range(len(self._bytes))]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(text), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The ids' bytes one after another, which need not be text where ids are cut anywhere."""
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))

    def names(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return ",".join(map(self._names.__getitem__, ids.tolist())).encode()


@lru_cache(maxsize=2)
def pre_tokens(pattern: str) -> PreTokens:
    return PreTokens(pattern)


@lru_cache(maxsize=2)
def rank_file(name: str) -> RankFile:
    return RankFile(vocabulary_path(name), token_pattern())


# --- windows of long texts ---------------------------------------------------------------------

_WINDOW = "digest binary, chunk int, stop int, last boolean, text string"


def _cut(chunk: int, overlap: int):
    """Windows of long texts: chunk ``i`` and ``overlap`` characters of the next."""

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for digest, text in zip(part.column("digest").to_pylist(), part.column("text").to_pylist(), strict=True):
            n = -(-len(text) // chunk)
            rows += [(digest, i, i + 1, i + 1 == n, text[i * chunk : (i + 1) * chunk + overlap]) for i in range(n)]
        names = ["digest", "chunk", "stop", "last", "text"]
        types = [pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return per_batch(cut)


def _scan(chunk: int, overlap: int):
    """Cuts a window's own scan finds where it meets its neighbours, as places in the whole text.

    ``head``: from the window's start to the end of the previous window. ``tail``: from the next window's
    start on, as far as no further text can change them.
    """

    def scan(part: pa.RecordBatch) -> pa.RecordBatch:
        find = pre_tokens(token_pattern()).cuts
        heads, tails = [], []
        for begin, stop, last, text in zip(*[part.column(c).to_pylist() for c in ("chunk", "stop", "last", "text")], strict=True):
            start = begin * chunk
            ends = np.r_[0, find(text)] + start
            heads.append(ends[ends <= start + overlap].tolist())
            sure = ends[(ends >= stop * chunk) & (ends + LOOK <= start + len(text))]
            tails.append([] if last else sure.tolist())
        places = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(heads, places), pa.array(tails, places)], names=[*part.schema.names, "head", "tail"]
        )

    return per_batch(scan)


def _scanned(windows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    found = windows.mapInArrow(_scan(chunk, overlap), f"{_WINDOW}, head array<bigint>, tail array<bigint>")
    return stored(found, "bpe-windows")


def _meetings(windows: DataFrame) -> DataFrame:
    """Per window, without its text, the first boundary it shares with the next one (``meet``)."""
    order = Window.partitionBy("digest").orderBy("chunk")
    following = F.lead("head").over(order)
    edges = windows.select("digest", "chunk", "stop", "last", "head", "tail")
    return edges.withColumn("meet", F.array_min(F.array_intersect("tail", following))).select(
        "digest", "chunk", "stop", "last", "meet"
    )


def stitched_pieces(texts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``digest, piece, text``: texts (``digest``, ``text``) cut where pre-tokens end, about ``chunk`` characters each.

    What the pattern matches at a place depends on the text from there on only. So once two scans have a
    boundary in common, all that follow are the same, and the first scan's are those of the whole text. Where
    a window and the next have none in common (a pre-token longer than the overlap), both become one window
    and are scanned again, until every seam has one.
    """
    windows = texts.select("digest", "text").mapInArrow(_cut(chunk, overlap), _WINDOW).dropDuplicates(["digest", "chunk"])
    windows = _scanned(windows, chunk, overlap)
    while True:
        seams = _meetings(windows)
        open_seam = ~F.col("last") & F.col("meet").isNull()
        if seams.where(open_seam).isEmpty():
            break
        order = Window.partitionBy("digest").orderBy("chunk")
        # A run begins after every seam that holds.
        closed = F.coalesce(F.lag((~open_seam).cast("int")).over(order), F.lit(1))
        runs = seams.withColumn("closed", closed).withColumn("run", F.sum("closed").over(order))
        sizes = runs.withColumn("of_run", F.count(F.lit(1)).over(Window.partitionBy("digest", "run")))
        torn = sizes.where("of_run > 1").select("digest", "chunk", "run")
        base = windows.select("digest", "chunk", "stop", "last", "text")
        joined = (
            base.join(torn, ["digest", "chunk"]).groupBy("digest", "run")
            .agg(F.array_sort(F.collect_list(F.struct("chunk", "stop", "last", "text"))).alias("parts"))
        )
        # Every part but the last without what it read beyond its own chunks.
        texts_of = F.transform(
            "parts", lambda w, i: F.when(i == F.size("parts") - 1, w["text"]).otherwise(
                F.substring(w["text"], F.lit(1), (w["stop"] - w["chunk"]) * chunk)
            )
        )
        ends = F.element_at("parts", -1)
        merged = joined.select(
            "digest", F.col("parts")[0]["chunk"].alias("chunk"), ends["stop"].alias("stop"), ends["last"].alias("last"),
            F.array_join(texts_of, "").alias("text"),
        )
        whole = windows.join(torn.select("digest", "chunk"), ["digest", "chunk"], "left_anti")
        windows = stored(whole.unionByName(_scanned(merged, chunk, overlap)), "bpe-windows")
    order = Window.partitionBy("digest").orderBy("chunk")
    cuts = seams.select("digest", "chunk", F.coalesce(F.lag("meet").over(order), F.lit(0)).alias("begin"), F.col("meet").alias("end"))
    placed = windows.select("digest", "chunk", "text").join(cuts, ["digest", "chunk"])
    start = F.col("begin") - F.col("chunk") * F.lit(chunk)
    long = F.coalesce(F.col("end") - F.col("begin"), F.length("text").cast("bigint"))
    return placed.select(
        "digest", F.col("chunk").alias("piece"), F.substring("text", (start + 1).cast("int"), long.cast("int")).alias("text")
    )


# --- encoding ----------------------------------------------------------------------------------


def _encode(ranks: str):
    def encode(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = rank_file(ranks)
        ids = [encoder.encode(t).tobytes() for t in part.column("text").to_pylist()]
        at = part.schema.get_field_index("text")
        return part.set_column(at, "ids", pa.array(ids, pa.binary()))

    return per_batch(encode)


def _split_by_length(docs: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    is_long = F.length("text") > chunk
    return rows.where(~is_long), rows.where(is_long).withColumn("digest", text_digest())


def _long_ids(long: DataFrame, ranks: str, chunk: int, overlap: int) -> DataFrame:
    """``digest, piece, ids`` of each distinct long text."""
    return stitched_pieces(long, chunk, overlap).mapInArrow(_encode(ranks), "digest binary, piece int, ids binary")


def encode_documents(docs: DataFrame, ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, digest, piece, ids``: ids (little-endian unsigned 32-bit) of every text, in pieces.

    The pieces of a text, by ``piece``, hold one after another what the library gives for the whole text.
    A text of at most ``chunk`` characters is one piece and stays where it is; longer ones are cut into
    overlapping windows, which are dealt over the tasks. A null text is an empty one, with one empty piece;
    rows may share an id or have none, and repeated rows are returned as often as they occur.
    """
    ship_package(docs.sparkSession)
    short, long = _split_by_length(docs, chunk)
    whole = short.select("doc_id", text_digest().alias("digest"), F.lit(0).alias("piece"), "text").mapInArrow(
        _encode(ranks), "doc_id bigint, digest binary, piece int, ids binary"
    )
    pieces = long.select("doc_id", "digest").join(_long_ids(long, ranks, chunk, overlap), "digest")
    return whole.unionByName(pieces.select("doc_id", "digest", "piece", "ids"))


def _decode(ranks: str):
    def decode(part: pa.RecordBatch) -> pa.RecordBatch:
        table = rank_file(ranks)
        found = [table.decode(np.frombuffer(v or b"", dtype="<u4")) for v in part.column("ids").to_pylist()]
        return part.set_column(part.schema.get_field_index("ids"), "bytes", pa.array(found, pa.binary()))

    return per_batch(decode, "ids")


def decode_documents(pieces: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, digest, piece, bytes`` of what ``encode_documents`` returned; no row moves.

    Pieces end where pre-tokens end, so each is whole UTF-8 by itself. Null ids are empty.
    """
    return pieces.select("doc_id", "digest", "piece", "ids").mapInArrow(
        _decode(ranks), "doc_id bigint, digest binary, piece int, bytes binary"
    )


# --- digests -----------------------------------------------------------------------------------


class _Digest:
    """Running hashes of the ids of one text and of what they decode to."""

    def __init__(self, table: RankFile):
        self._table = table
        self._count, self._ids, self._bytes = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray) -> None:
        if len(ids):
            self._ids.update((b"," if self._count else b"") + self._table.names(ids))
            self._bytes.update(self._table.decode(ids))
            self._count += len(ids)

    def row(self) -> tuple[int, str, str]:
        return self._count, self._ids.hexdigest(), self._bytes.hexdigest()


def _digest_short(ranks: str):
    def digest(part: pa.RecordBatch) -> pa.RecordBatch:
        table = rank_file(ranks)
        rows = []
        for text in part.column("text").to_pylist():
            running = _Digest(table)
            running.add(table.encode(text))
            rows.append(running.row())
        counts, ids, decoded = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return per_batch(digest)


def _digest_long(ranks: str):
    """One row per text from its pieces in order, of which only one is held at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank_file(ranks)
        current, running = None, None
        names = ["digest", "n_tokens", "ids_sha256", "decoded_sha256"]
        types = [pa.binary(), pa.int64(), pa.string(), pa.string()]

        def out(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            rows = []
            for part in slices(batch, "ids"):
                for digest, ids in zip(part.column("digest").to_pylist(), part.column("ids").to_pylist(), strict=True):
                    if digest != current:
                        if running:
                            rows.append((current, *running.row()))
                        current, running = digest, _Digest(table)
                    running.add(np.frombuffer(ids, dtype="<u4"))
            if rows:
                yield out(rows)
        if running:
            yield out([(current, *running.row())])

    return run


def digest_tokens(docs: DataFrame, ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the bytes these ids decode to.
    Each long text is encoded once however many rows hold it. A null text is an empty one.
    """
    ship_package(docs.sparkSession)
    short, long = _split_by_length(docs, chunk)
    result = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    near = short.mapInArrow(_digest_short(ranks), f"doc_id bigint, {result}")
    pieces = _long_ids(long, ranks, chunk, overlap).repartition("digest").sortWithinPartitions("digest", "piece")
    digests = pieces.mapInArrow(_digest_long(ranks), f"digest binary, {result}")
    far = join_groups(long.select("doc_id", "digest"), digests, ["digest"], "doc_id").drop("digest")
    return near.unionByName(far)
