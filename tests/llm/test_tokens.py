"""Token ids, bit packing and sequences: round trips."""

import random
import struct
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seqspark.llm import packing, token_files
from seqspark.llm.tokens import Encoder, encoder, vocabulary_path

PARTS = ["a", "é", "word", "Don't", "'s", " ", "  ", "\n", " \n", "\t", "12", "²", "!", "...", "\u00a0", "\u3000", "<|endoftext|>", "日本", "\x1c",
         "\x85", "😀", "_", "\r\n", "I'LL", " 's", "\0"]


def plain(text):
    return encoder()._whole.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(9))) for _ in range(4000)]
    for text, ids in zip(texts, encoder().encode(texts), strict=True):
        assert ids == struct.pack(f"<{len(ids) // 4}I", *plain(text)), repr(text)


def test_words_and_signs_equal_library():
    rnd = random.Random(3)
    words = ["à", "là", "\u0420", "caf\u00e9", "naïve", "日本語", "don't", "x", "word", "Wörter", "a_b", "9", "ß", "\u00a0"]
    tails = ["", "", "", ".", "&&&", "...", "'", "_", "!\"", ".\nThe", "'s", "\u00a0", "$$$,", "—"]
    texts = [" ".join(rnd.choice(words) + rnd.choice(tails) for _ in range(rnd.randrange(1, 300))) for _ in range(400)]
    texts += ["", " ", "  a", "a ", "\u00a0", "x" * 100_000, "é " * 50_000, "&&& &&&", "&&&", "'s 's"]
    for batch in (texts, texts[::-1], texts[:1]):
        for text, ids in zip(batch, encoder().encode(batch), strict=True):
            assert ids == struct.pack(f"<{len(ids) // 4}I", *plain(text)), repr(text[:200])
    assert encoder().encode([]) == []


def test_encoder_keeps_what_it_is_told():
    small = Encoder(vocabulary_path(), kept=50)
    for at in range(0, 2000, 40):
        texts = [f"word{i} and {i}" for i in range(at, at + 40)]
        assert [struct.pack(f"<{len(plain(t))}I", *plain(t)) for t in texts] == small.encode(texts)
        # At most what it keeps and what one batch adds: 40 words, 40 numbers, 40 first parts, two more words.
        assert len(small._row) <= 50 + 130


def test_added_tokens_equal_a_fresh_tokenizer():
    fresh = Tokenizer.from_file(vocabulary_path())
    rnd = random.Random(2)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\x1c y", " <|endoftext|", "<|endoftext|>\n a"]
    texts += ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(9))) for _ in range(4000)]
    found = [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in encoder().encode(texts)]
    assert found[0] == [64, 220, 50256, 275]
    for text, ids in zip(texts, found, strict=True):
        assert ids == fresh.encode(text, add_special_tokens=False).ids, repr(text)


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300), st.data())
@settings(max_examples=200, deadline=None)
def test_packing_round_trip(width, values, data):
    ids = np.array([v % (1 << width) for v in values], dtype=np.uint32)
    payload = token_files.pack(ids, width)
    assert (token_files.unpack(payload, width, 0, len(ids)) == ids).all()
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert (token_files.unpack(payload, width, a, b) == ids[a:b]).all()


def test_width():
    assert [token_files.id_width(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_files(spark, docs_of, odd_rows, tmp_path):
    rows = [(1000 - i if r[0] is None else r[0], r[1]) for i, r in enumerate(odd_rows)]
    path = f"file://{tmp_path}/ids"
    token_files.write_token_files(docs_of(rows).withColumnRenamed("lang", "block"), path, block_ids=100)
    found = sorted(token_files.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(r[0] for r in rows)
    at, everything = 0, []
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == token_files.END_ID
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        at += r.n_tokens
        everything += r.ids
    assert sorted(tuple(r.ids[:-1]) for r in found) == sorted(tuple(plain(t)) for _, t in rows)
    assert token_files.read_id_range(spark, path, 3, 200).tolist() == everything[3:200]
    token_files.write_token_files(docs_of([(None, "x"), (1, "x")]), path + "2")
    assert [r.doc_id for r in sorted(token_files.read_token_files(spark, path + "2").collect(), key=lambda r: r.start)] == [None, 1]
    token_files.write_token_files(docs_of([]), path + "3")
    assert token_files.read_token_files(spark, path + "3").count() == 0


@given(st.lists(st.integers(1, 64), min_size=1, max_size=200), st.integers(0, 9))
@settings(max_examples=60, deadline=None)
def test_evolved_bins_are_a_packing(sizes, seed):
    bins = packing.evolve(sizes, 64, seed)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 64 for b in bins)
    assert len(bins) <= len(packing.best_fit([], sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True), sizes, 64))


def test_crossover_keeps_every_item():
    rng = random.Random(3)
    sizes = [rng.randint(1, 64) for _ in range(300)]
    a, b = (packing._start(sizes, 64, rng, n) for n in (0.0, 0.5))
    child = packing.crossover(a, b, sizes, 64, 0.4, rng)
    assert sorted(i for x in child for i in x) == list(range(300)) and all(sum(sizes[i] for i in x) <= 64 for x in child)
    built = packing.from_patterns(packing.elite_patterns(a, sizes, 64), sizes, 64)
    assert len({i for x in built for i in x}) == sum(map(len, built)) > 0


def check_packed(found, rows, capacity):
    by_doc, bins = {}, {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append(r)
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    for doc_id, text in rows:
        by_doc.setdefault(doc_id, []).append([*plain(text), token_files.END_ID])
    want = []
    for doc_id, texts in by_doc.items():
        for ids in texts:
            first = len(ids) % capacity or min(len(ids), capacity)
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            want += [(str(doc_id), n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    return len(bins)


def test_packed_documents(docs_of, odd_rows, small):
    check_packed(packing.pack_documents(docs_of(odd_rows).withColumnRenamed("lang", "item")).collect(), odd_rows, 1024)
    assert packing.pack_documents(docs_of([])).count() == 0
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    found = packing.pack_documents(small).collect()
    bound = -(-sum(r.length for r in found) // 1024)
    assert check_packed(found, rows, 1024) <= bound + 2


def test_islands(spark):
    rng = random.Random(5)
    sizes = [rng.randint(1, 1023) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item bigint, length bigint")
    found = packing.pack_items(items, island=500).collect()
    fills = {}
    for r in found:
        fills.setdefault(r.bin, []).append(sizes[r.item])
    assert sorted(r.item for r in found) == list(range(3000)) and all(sum(f) <= 1024 for f in fills.values())
    assert len(fills) <= 1.03 * sum(sizes) / 1024
