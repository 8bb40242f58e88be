import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeloom.llm.align import Aligner, align_tokenizers, bitmaps, members, pair_counts, pair_documents, pair_index
from lakeloom.llm.queries import QUERIES
from lakeloom.llm.tokens import load_spec

from .cases import awkward, empty, frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def shown():
    """Bytes of the characters of a byte-level vocabulary."""
    bs = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    cs = bs[:]
    for b in range(256):
        if b not in bs:
            bs.append(b)
            cs.append(256 + len(cs) - 188)
    return dict(zip(map(chr, cs), bs, strict=True))


@pytest.fixture(scope="module")
def plain():
    a, b, code = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), shown()
    a.encode_special_tokens = True

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def one(text):
        """Tokens of A, of B, the groups as text, the links."""
        if not text:
            return 0, 0, "", []
        ours, theirs = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        x = [bytes(code[c] for c in a.id_to_token(i)) for i in ours]
        y = [b_bytes(i) for i in theirs]
        if not b"".join(x) == b"".join(y) == (" " + text).encode():
            return 0, 0, "", []
        ex, ey = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
        i = j = i0 = j0 = 0
        groups, links = [], []
        while i < len(ex) and j < len(ey):
            links.append((ours[i], theirs[j]))
            p, q = ex[i], ey[j]
            if p == q:
                groups.append(f"{','.join(map(str, ours[i0 : i + 1]))}|{','.join(map(str, theirs[j0 : j + 1]))}")
                i0, j0 = i + 1, j + 1
            i, j = i + (p <= q), j + (q <= p)
        return len(ours), len(theirs), ";".join(groups), links

    def all_rows(rows):
        made = [(doc_id, *one(text)) for doc_id, text in rows]
        count = Counter(x for m in made for x in m[4])
        most = {}
        for (_, j), n in count.items():
            most[j] = max(most.get(j, 0), n)
        out = []
        for doc_id, n_a, n_b, groups, links in made:
            n_groups = groups.count(";") + 1 if groups else 0
            n_best = sum(count[x] == most[x[1]] for x in links)
            out.append((doc_id, n_a, n_b, n_groups, len(links), n_best, sum(count[x] for x in links), groups))
        return out, count, made

    return all_rows


HARD = [
    "a  b", " lead", "trail ", "  ", " ", "x▁y z", "\n", "a\n b", "<|endoftext|> tail", "</s> <s> x", "don't we'll", "\x00 a", "é é",
    "中文 \U0001f600 1234", "word " * 500, "y" * 5_000, "tab\t tab", "a \n b", "　 z", "ﬁ Ｆ", "<0x41> b", "<unk> c",
]


def told(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("block_docs", [1 << 16, 3])
def test_equals_plain_version(spark, plain, block_docs):
    rows = [(r[0], r[1]) for r in awkward()] + list(enumerate(HARD, 1_000))
    docs = frame(spark).select("doc_id", "text").union(spark.createDataFrame(rows[-len(HARD) :], "doc_id long, text string"))
    got = align_tokenizers(docs.repartition(2), A, B, block_docs=block_docs).collect()
    want, _, _ = plain(rows)
    assert told((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got) == told(want)


def test_units_give_what_whole_texts_give(plain):
    """Steps, caches and cuts of one worker on random texts, against the loop over whole texts."""
    aligner, rnd = Aligner(load_spec(A), Path(B).read_bytes()), random.Random(4)
    parts = [" ", " ", "\n", "a", "the", "Wort", "é", "'s", "12", ".", "▁", "中", "zq", "  "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(1_500)] + HARD + [""]
    n_a, n_b, n_groups, n_links, groups, codes = aligner.align(pa.array(texts))
    _, _, made = plain(list(enumerate(texts)))
    assert groups.to_pylist() == [m[3] for m in made]
    assert n_a.tolist() == [m[1] for m in made] and n_b.tolist() == [m[2] for m in made]
    assert n_links.tolist() == [len(m[4]) for m in made]
    assert codes.tolist() == [i * aligner.size_b + j for m in made for i, j in m[4]]
    assert n_groups.tolist() == [m[3].count(";") + 1 if m[3] else 0 for m in made]


def test_bitmaps_hold_documents_and_multiplicities():
    rnd = random.Random(6)
    links = [(rnd.randrange(40), rnd.randrange(65_536)) for _ in range(3_000)] + [(3, d) for d in range(0, 60_000, 2)] * 3
    links += [(5, 65_535)] * 1_000
    code, level, n, bitmap = bitmaps(np.array([c for c, _ in links], np.uint32), np.array([d for _, d in links], np.uint16))
    entry, doc = members(np.asarray(n), bitmap)
    got = Counter()
    for e, d in zip(entry.tolist(), doc.tolist(), strict=True):
        got[int(code[e]), d] += 1 if level[e] < 0 else 1 << int(level[e])
    assert got == Counter(links)
    assert np.bincount(entry, minlength=len(n)).tolist() == n.tolist()
    assert max(len(x.as_py()) for x in bitmap) == 8_192
    code, level, n, bitmap = bitmaps(np.zeros(0, np.uint32), np.zeros(0, np.uint16))
    assert len(code) == len(n) == len(bitmap) == 0 and len(members(n, bitmap)[0]) == 0


def test_counts_and_documents_of_pairs(spark, plain):
    rows = [(r[0], r[1]) for r in awkward()]
    index = pair_index(frame(spark), A, B)
    _, count, made = plain(rows)
    docs = Counter(x for m in made for x in set(m[4]))
    got = {(r.a, r.b): (r.n_docs, r.n_links) for r in pair_counts(index).collect()}
    assert got == {x: (docs[x], n) for x, n in count.items()}
    chosen = [x for x, _ in count.most_common(3)] + [(1, 1)]
    found = pair_documents(index, spark.createDataFrame(chosen, "a int, b int")).collect()
    want = Counter()
    for m in made:
        for x in m[4]:
            if x in chosen:
                want[(x, repr(m[0]))] += 1
    got = Counter()
    for r in found:
        got[((r.a, r.b), repr(r.doc_id))] += r.n_links
    assert got == want


def test_empty_table(spark):
    assert align_tokenizers(empty(spark), A, B).collect() == []


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, _, _ = plain(rows)
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want]
    assert told(tuple(r) for r in QUERIES["op11_alignment"](spark, sf).collect()) == told(want)
