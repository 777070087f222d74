"""Ids of whole texts by a public tokenizer file, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import json
import re
import string
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from seqspark.llm.common import worker_cache

# Vocabulary files, by name, as the package public_tokenizers holds them.
DEFAULT_VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """The place of a vocabulary file on this machine; a path is returned as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


# Parts of texts whose ids a worker keeps; beyond it they are learned anew.
MAX_KEPT = 400_000

# New parts that go to the library as one text.
JOINED = 64

# Signs that make one piece behind a word; an apostrophe may begin a contraction.
_SIGNS = string.punctuation.replace("'", "")

# Characters that libraries disagree on whether they are white space.
_ODD = re.compile(r"[\x1c-\x1f\x85\u180e]")


def _numbers(lists: list[list[int]]) -> np.ndarray:
    """All numbers of the lists, one list behind the other."""
    return np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=sum(map(len, lists)))


class Encoder:
    """Encodes texts as ``encode(text, add_special_tokens=False)`` does, added tokens of the file included.

    Byte-level pair encoding treats the pieces its pattern cuts one by one. A space between two characters
    that are no white space always starts a piece, so texts are cut there in Arrow, each distinct part is encoded
    once, and the ids of all parts are gathered with numpy. Texts with other white space beside a space are cut
    by the pattern itself, and texts that hold an added token go to the library whole.
    """

    def __init__(self, path: str, kept: int = MAX_KEPT):
        import public_tokenizers
        import regex

        self._kept = kept
        self._whole = Tokenizer.from_file(path)
        with open(path) as file:
            spec = json.load(file)
        self._added = [t["content"] for t in spec.get("added_tokens") or []]
        before = spec.get("pre_tokenizer") or {}
        self._cut = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
        self._pattern = regex.compile(public_tokenizers.PATTERN)
        self._piece = Tokenizer(self._whole.model)
        self._piece.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The same without added tokens, and for bytes written as the vocabulary writes them.
        self._plain = Tokenizer(self._whole.model)
        self._plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self._bare = Tokenizer(self._whole.model)
        # Printable bytes are written as themselves, the others as what follows them, in order.
        signs = sorted(pre_tokenizers.ByteLevel.alphabet())
        plain = {ord(c) for c in signs if ord(c) < 256}
        rest = [c for c in signs if ord(c) >= 256]
        self._written = dict(zip([b for b in range(256) if b not in plain], rest, strict=True))
        self._space = self._written[32]
        self._joins = not any(map(self._crosses, self._whole.get_vocab()))
        # Ids whose bytes begin with a space.
        self._spaced = np.zeros(self.size, dtype=bool)
        self._spaced[[i for token, i in self._whole.get_vocab().items() if token[:1] == self._space]] = True
        self._pieces: dict[str, bytes] = {}
        self._forget()

    def _crosses(self, token: str) -> bool:
        """Whether a token could hold the end of a word of letters and the space behind it."""
        if self._space not in token[1:]:
            return False
        byte = {sign: b for b, sign in self._written.items()}
        for at in range(1, len(token)):
            if token[at] == self._space and token[at - 1] != self._space:
                before = bytes(byte.get(c, ord(c) & 255) for c in token[:at].lstrip(self._space)).decode("utf-8", "ignore")
                if not before or before.isalpha():
                    return True
        return False

    def _forget(self) -> None:
        # A part has a row; its ids stand in ``_ids`` between two of ``_ends``. A part that begins a text is kept with
        # a space behind it, any other stands for itself after a space. ``_odd`` marks parts that cannot be cut out.
        self._row: dict[str, int] = {}
        self._ids, self._ends = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self._odd = np.zeros(0, dtype=bool)

    @property
    def size(self) -> int:
        return self._whole.get_vocab_size(with_added_tokens=True)

    def _spaced_ids(self, parts: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts, each after a space, one part behind the other, and how many each has."""
        words = words and self._joins
        if words:
            parts = [p if p.isascii() else p.encode().decode("latin-1").translate(self._written) for p in parts]
        space, tokenizer = (self._space, self._bare) if words else (" ", self._plain)
        joined = [space + space.join(parts[at : at + JOINED]) for at in range(0, len(parts), JOINED)]
        ids = _numbers([e.ids for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        # Only the first id of a part begins with a space.
        starts = np.flatnonzero(self._spaced[ids])
        return ids, np.diff(np.r_[starts, len(ids)])

    def _add(self, names: list[str], ids: np.ndarray, lengths: np.ndarray, odd: list[bool] | None = None) -> None:
        if len(lengths) != len(names):
            raise ValueError("the vocabulary joins or splits parts at a space")
        self._row.update(zip(names, range(len(self._row), len(self._row) + len(names)), strict=True))
        self._ends = np.r_[self._ends, len(self._ids) + np.cumsum(lengths, dtype=np.int64)]
        self._ids = np.concatenate([self._ids, ids])
        self._odd = np.r_[self._odd, np.zeros(len(names), dtype=bool) if odd is None else np.array(odd, dtype=bool)]

    def _gathered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows, one behind the other, and where each ends, after a 0."""
        found = pa.LargeListArray.from_arrays(pa.array(self._ends), pa.array(self._ids)).take(pa.array(rows))
        ends = found.offsets.to_numpy()
        return found.flatten().to_numpy(), ends - ends[0]

    def _learn(self, parts: list[str]) -> None:
        """Give rows to new parts; a word and the signs behind it are looked up apart."""
        words, ended, others, first, odd = [], [], [], [], []
        for part in parts:
            if part.isalpha():
                words.append(part)
            elif part[-1:] == " ":
                first.append(part)
            else:
                word = part.rstrip(_SIGNS)
                if word.isalpha():
                    ended.append((part, word, part[len(word) :] + " "))
                elif not part or part[0].isspace() or part[-1].isspace() or _ODD.search(part):
                    odd.append(part)
                else:
                    others.append(part)
        words = list({*words, *[w for _, w, _ in ended if w not in self._row]})
        first = list({*first, *[s for _, _, s in ended if s not in self._row]})
        self._add(words, *self._spaced_ids(words, True))
        self._add(others, *self._spaced_ids(others, False))
        found = [e.ids for e in self._plain.encode_batch_fast([f[:-1] for f in first], add_special_tokens=False)]
        strange = [f[-2:-1].isspace() or _ODD.search(f) is not None for f in first]
        self._add(first, _numbers(found), np.array([len(f) for f in found], dtype=np.int64), strange)
        self._add(odd, self._ids[:0], np.zeros(len(odd), dtype=np.int64), [True] * len(odd))
        if ended:
            row = self._row
            ids, ends = self._gathered(np.array([[row[word], row[sign]] for _, word, sign in ended], dtype=np.int64).ravel())
            self._add([part for part, _, _ in ended], ids, np.diff(ends[::2]))

    def _rows_of(self, parts: list[str]) -> np.ndarray:
        new = [p for p in parts if p not in self._row]
        if new:
            self._learn(new)
        return np.fromiter(map(self._row.__getitem__, parts), dtype=np.int64, count=len(parts))

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        found = [e.ids for e in self._piece.encode_batch_fast(pieces, add_special_tokens=False)]
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]

    def _by_library(self, text: str) -> bytes:
        ids = self._whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _by_pattern(self, text: str) -> bytes:
        if _ODD.search(text):
            return self._by_library(text)
        pieces = self._pattern.findall(text)
        new = list(set(pieces).difference(self._pieces))
        if len(self._pieces) + len(new) > self._kept:
            self._pieces, new = {}, list(set(pieces))
        if new:
            self._pieces.update(zip(new, self._encode_pieces(new), strict=True))
        return b"".join([self._pieces[p] for p in pieces])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        if not self._cut:
            found = [e.ids for e in self._whole.encode_batch_fast(texts, add_special_tokens=False)]
            return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]
        if len(self._row) > self._kept:
            self._forget()
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        cuts = split.offsets.to_numpy().astype(np.int64)
        parts = split.flatten().dictionary_encode()
        heads = parts.take(pa.array(cuts[:-1])).cast(pa.large_string()).dictionary_encode()
        # Parts that only begin texts are learned as others are, which is of no harm.
        rows = self._rows_of(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        rows[cuts[:-1]] = self._rows_of([h + " " for h in heads.dictionary.to_pylist()])[heads.indices.to_numpy()]
        odd = np.logical_or.reduceat(self._odd[rows], cuts[:-1])
        ids, ends = self._gathered(rows)
        data = ids.astype("<u4", copy=False).tobytes()
        at = (4 * ends[cuts]).tolist()
        out = []
        for n, text in enumerate(texts):
            if any(a in text for a in self._added):
                out.append(self._by_library(text))
            elif odd[n]:
                out.append(self._by_pattern(text))
            else:
                out.append(data[at[n] : at[n + 1]])
        return out


def encoder(name: str = DEFAULT_VOCABULARY, kept: int = MAX_KEPT) -> Encoder:
    """The encoder of this worker process, kept between tasks until another operator needs the room."""
    return worker_cache(("encoder", name, kept), lambda: Encoder(vocabulary_path(name), kept))
