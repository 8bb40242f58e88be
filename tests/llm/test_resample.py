import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from lakeloom.llm.crc import BLOCK, crc32_spans
from lakeloom.llm.resample import bucket_counts, importance_resample

from .cases import awkward, empty, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, orders):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [
        " ".join(words[i : i + k]) for k in range(orders[0], orders[1] + 1) for i in range(len(words) - k + 1)
    ]


def plain(docs, target, orders, buckets, min_words, percent, seed):
    def counts(texts):
        out = [0] * buckets
        for text in texts:
            for f in features(text, orders)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for doc_id, text in docs:
        n_words, fs = features(text, orders)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n_words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for r in rows:
        r.append(None)
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return rows


def told(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("orders,percent", [((1, 1), 10), ((1, 3), 50), ((2, 2), 100)])
def test_equals_plain_version(spark, orders, percent):
    rows = awkward()
    target = ["w1 w2 w3 W4 don't", None, "", "w5 " * 30]
    # Rows of one id and different texts, or of none, may change places where scores tie, so ranks are compared elsewhere
    docs = spark.createDataFrame(target_rows := [(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance_resample(frame(spark), docs, orders, 97, 20, percent, 7).collect()
    want = plain([(r[0], r[1]) for r in rows], [t for _, t in target_rows], orders, 97, 20, percent, 7)
    assert told([(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got]) == told(map(tuple, (r[:5] for r in want)))
    assert sorted(r.rank for r in got if r.rank) == sorted(r[5] for r in want if r[5])
    by_rank = {r.rank: (r.score, r.doc_id) for r in got if r.rank}
    assert by_rank == {r[5]: (r[4], r[0]) for r in want if r[5]}


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(7, "a b " * 15), (7, "a b " * 15), (3, "a b " * 15), (None, "a b " * 15)], "doc_id long, text string")
    rows = importance_resample(docs, docs, percent=100).collect()
    assert sorted(r.rank for r in rows) == [1, 2, 3, 4]
    ranks = sorted(r.rank for r in rows if r.doc_id == 7)
    assert ranks[1] == ranks[0] + 1


def test_empty_tables(spark):
    docs, none = frame(spark), empty(spark)
    assert importance_resample(none, docs).collect() == []
    rows = importance_resample(docs, none, percent=10).collect()
    want = plain([(r[0], r[1]) for r in awkward()], [], (1, 1), 10_000, 20, 10, 2024)
    assert told((r.doc_id, r.weight, r.score) for r in rows) == told((r[0], r[3], r[4]) for r in want)
    assert bucket_counts(none).collect() == []


def test_crc_of_spans_of_every_length():
    rnd = random.Random(3)
    data = np.frombuffer(rnd.randbytes(60_000), np.uint8)
    spans = [(a := rnd.randrange(50_000), a + n) for n in [*range(3 * BLOCK + 3), 1_000, 9_999, 10_000]]
    got = crc32_spans(data, *np.array(spans).T)
    assert [int(x) for x in got] == [zlib.crc32(data[a:b].tobytes()) for a, b in spans]


def test_very_long_words_and_texts(spark):
    texts = ["x" * 300_000, "É" * 1_000, "ab " * 400_000, "a" * BLOCK + " " + "a" * (BLOCK + 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = importance_resample(docs, docs, percent=100).collect()
    want = plain(list(enumerate(texts)), texts, (1, 1), 10_000, 20, 100, 2024)
    assert told((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got) == told((r[0], *r[2:]) for r in want)
