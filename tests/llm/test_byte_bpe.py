"""Byte-level BPE in overlapping chunks against the library on whole texts."""

import base64
import hashlib
import random

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from seqspark.llm import byte_bpe

PARTS = ["a", "é", "word", "Don't", "'s", " ", "  ", "\n", " \n", "\t", "12", "²", "!", "...", " ", "　", "<|endoftext|>", "日本", "\x1c",
         "\x85", "😀", "_", "\r\n", "I'LL", " 's", "\0", "'", "'l", "'ll", "՘", "₏", "\U00011f50", "٣"]


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path(byte_bpe.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    joined = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def odd_texts(n, most, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(most))) for _ in range(n)]


def test_boundaries_are_those_of_the_library(library):
    """Texts cut at all boundaries and encoded apart give the ids of the whole."""
    find = byte_bpe.pre_tokens(public_tokenizers.PATTERN).ends
    for text in odd_texts(3000, 12):
        ends = find(text).tolist()
        assert (ends[-1] if ends else 0) == len(text)
        parts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        assert [i for p in parts for i in library._core_bpe.encode_single_piece(p.encode())] == library.encode_ordinary(text), repr(text)
        ends = find(text).tolist() if not text else byte_bpe.pre_tokens(public_tokenizers.PATTERN).cuts(text).tolist()
        parts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("chunk,overlap", [(16, 8), (40, 12)])
def test_stitched_chunks_equal_whole_texts(docs_of, library, chunk, overlap):
    long = ["x" * 500, " " * 333 + "y", "a" * 90 + " '" + "l" * 70, "!" * 200 + "w " * 30, ("ab " * 5 + "z" * 60) * 4, "'ll" * 100, " \n" * 150 + "end"]
    texts = [*odd_texts(150, 120, 3), *long]
    rows = [*enumerate(texts), (3, texts[-1]), (3, texts[-1]), (None, texts[-1]), (None, None), (7, "")]
    docs = docs_of(rows).withColumnRenamed("lang", "digest").withColumnRenamed("source", "chunk")
    found = byte_bpe.digest_tokens(docs, chunk=chunk, overlap=overlap).collect()
    want = [(i, *digests(library, t)) for i, t in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    pieces = byte_bpe.encode_documents(docs, chunk=chunk, overlap=overlap)
    decoded = byte_bpe.decode_documents(pieces).groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_list(F.struct("piece", "bytes"))).alias("parts")
    ).where("doc_id > 8 and doc_id < 150").collect()
    assert len(decoded) == 141
    for r in decoded:
        assert b"".join(bytes(p["bytes"]) for p in r.parts).decode() == texts[r.doc_id]
        assert len(texts[r.doc_id]) <= 3 * chunk or len(r.parts) > 1


def test_given_texts(spark, docs_of, small, odd_rows, library):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()] + odd_rows
    found = byte_bpe.digest_tokens(small.unionByName(docs_of(odd_rows))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((i, *digests(library, t))) for i, t in rows)
    assert byte_bpe.digest_tokens(docs_of([])).count() == 0
