import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from lakeloom.llm import bpe as module
from lakeloom.llm.bpe import Bpe, bpe_decode, bpe_encode, class_exceptions, load_ranks
from lakeloom.llm.queries import QUERIES

from .cases import awkward, empty, frame

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = [
    "a", "b", "'", "s", "'ll", "'r", "e", " ", "  ", "\n", "\t", "\r\n", "1", "23", "!", "é", "中", "　", "\x1c",
    "՘", "࢏", "the ", "ing", "😀", "́", "<|endoftext|>",
]


def library(path):
    ranks = load_ranks(path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def numbers(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


@pytest.mark.parametrize("path", [RANKS, MULTI])
@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 50])
def test_joins_at_any_cut(monkeypatch, path, leaf):
    monkeypatch.setattr(module, "LEAF_CHARS", leaf)
    bpe, theirs, rnd = Bpe(load_ranks(path), public_tokenizers.PATTERN, class_exceptions()), library(path), random.Random(leaf)
    for _ in range(400):
        text = "".join(rnd.choice(SIGNS) for _ in range(rnd.randint(1, 150)))
        ids = numbers(bpe.tree(text).ids())
        assert ids == theirs.encode_ordinary(text)
        assert bpe.decode(tuple(ids)) == text.encode()


def test_merges_by_halves_are_the_plain_merges():
    bpe, rnd = Bpe(load_ranks(RANKS), public_tokenizers.PATTERN, {}), random.Random(9)
    for _ in range(2_000):
        data = bytes(rnd.choice(b"abxthe n\xc3\xa9") for _ in range(rnd.randint(1, 90)))
        assert bpe.merge(data) == bpe.plain(data) == bpe.plain_long(data)


def test_every_token_that_merges_reach_encodes_to_itself():
    bpe = Bpe(load_ranks(RANKS), public_tokenizers.PATTERN, {})
    assert all(bpe.plain(token) == (rank,) for token, rank in list(bpe.ranks.items())[::7])


def test_classes_are_those_of_the_library():
    bpe, theirs = Bpe(load_ranks(RANKS), public_tokenizers.PATTERN, class_exceptions()), library(RANKS)
    points = [c for c in [*range(0x3000), *sorted(class_exceptions())[::50], *range(0x10900, 0x11000)] if c not in range(0xD800, 0xE000)]
    text = "".join(f"a{chr(c)}b{chr(c)} 1{chr(c)}" for c in points)
    assert numbers(bpe.tree(text).ids()) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("text", ["x" * 30_000, "ab" * 20_000, "\n" * 9_000, " " * 9_001, "'s" * 9_000, "é" * 9_000 + "the" * 5_000])
def test_long_runs(text):
    bpe = Bpe(load_ranks(RANKS), public_tokenizers.PATTERN, class_exceptions())
    assert numbers(bpe.tree(text).ids()) == library(RANKS).encode_ordinary(text)


@pytest.mark.parametrize("part_chars", [1 << 20, 500, 37])
def test_documents(spark, part_chars):
    rows = awkward()
    encoded = bpe_encode(frame(spark), RANKS, public_tokenizers.PATTERN, part_chars)
    got = bpe_decode(encoded, RANKS).collect()
    theirs = library(RANKS)
    want = sorted((repr(r[0]), theirs.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows)
    assert sorted((repr(r.doc_id), numbers(r.ids), bytes(r.decoded)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_parts_of_one_long_text(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choice(SIGNS) for _ in range(60_000)) + "y" * 30_000
    docs = spark.createDataFrame([(1, text), (1, text), (2, "short")], "doc_id long, text string")
    got = bpe_encode(docs, RANKS, public_tokenizers.PATTERN, part_chars=1_000).collect()
    want = library(RANKS).encode_ordinary(text)
    assert [numbers(r.ids) == want for r in got if r.doc_id == 1] == [True, True]


def test_empty_table(spark):
    assert bpe_decode(bpe_encode(empty(spark), RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    theirs = library(RANKS)
    rows = QUERIES["op12_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode_ordinary(texts[r.doc_id])
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
