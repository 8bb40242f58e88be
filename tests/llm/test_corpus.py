import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm.chat import rotate_perspectives
from lakeloom.llm.common import new_path, written
from lakeloom.llm.inverted import build_index, decontaminate, intersect, pack_places, search_index, unpack_places, words_of
from lakeloom.llm.pack import pack
from lakeloom.llm.queries import ORACLE_SQL, QUERIES, vocabulary
from lakeloom.llm.records import frame as record
from lakeloom.llm.records import build_index as build_offsets
from lakeloom.llm.records import read_records, tokenize_to_records, unframe, write_records
from lakeloom.llm.simhash import byte_pairs, radius, set_fingerprint
from lakeloom.llm.tokens import PieceTokenizer, load_spec

from .cases import awkward, empty, frame, least_component
from .test_dedup import plain_line_dedup, text_key

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.mark.parametrize(("name", "cache"), [(NAMES[0], 10**6), (NAMES[0], 20), (NAMES[1], 10**6), (NAMES[1], 20)])
def test_pieces_give_the_same_ids(name, cache, monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from lakeloom.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", cache)
    monkeypatch.setattr(tokens, "STEP_BYTES", 10 * cache)

    rnd = random.Random(4)
    parts = [
        "a", "b", " ", "  ", "\n", "\t", "é", "'s", "!!", "1", "<|endoftext|>", "\x1c", "ß", "İ", "́", " \n", "中", "Σ",
        "\0", " ", " ", "x" * 60, "Word,", "Word.", "don't"
    ]
    texts = [r[1] for r in awkward()] + [
        "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)
    ]
    texts += [" ".join(rnd.choice(parts) for _ in range(1_000_000)), "word " * 1_000_000]  # millions of characters
    whole = Tokenizer.from_file(vocabulary(name))
    own = PieceTokenizer(load_spec(vocabulary(name)))
    assert own.kind != "whole"
    got = [run for ids, counts in own.encode(pa.array(texts).slice(0)) for run in np.split(ids, np.cumsum(counts)[:-1])]
    want = whole.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert len(got) == len(want) and all(np.array_equal(g, w.ids) for g, w in zip(got, want, strict=True))
    part = pa.array(texts).slice(3, 40)
    assert [
        len(run) for ids, counts in own.encode(part) for run in np.split(ids, np.cumsum(counts)[:-1])
    ] == [len(w.ids) for w in want[3:43]]
    assert not list(own.encode(part.slice(0, 0)))


def ids_of(name, rows, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    return [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [end]) for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_records_round_trip(spark):
    rows = awkward()
    want = sorted(((d, len(ids), crc(ids)) for d, ids in ids_of(NAMES[0], rows, 0)), key=text_key)
    path = new_path(spark, "round-trip")
    index = tokenize_to_records(frame(spark), vocabulary(NAMES[0]), 0, path)
    got = sorted(index.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)]).tolist()[:-1]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=text_key) == want
    some = index.where("n_tokens > 100")
    read = sorted(((r.doc_id, list(r.ids)) for r in read_records(some, path).collect()), key=text_key)
    assert read == sorted(((d, i) for d, i in ids_of(NAMES[0], rows, 0) if len(i) > 100), key=text_key)
    assert spark.read.parquet(f"{path}-index").count() == len(rows)
    assert tokenize_to_records(empty(spark), vocabulary(NAMES[0]), 0).count() == 0


def test_files_are_bounded_in_bytes(spark):
    path = new_path(spark, "chunks")
    write_records(frame(spark), vocabulary(NAMES[0]), 0, path, max_bytes=2000)
    files = (
        spark.read
        .format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("length", "content")
        .collect()
    )
    several = [f for f in files if f.length > 2000]
    assert len(files) > 8 and len(several) <= 3  # a longer record has a file to itself
    assert all(unframe(memoryview(bytes(f.content)), 0)[3] == f.length for f in several)
    assert build_offsets(spark, path).count() == len(awkward())


def test_every_byte_passes_through_the_files(spark):
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(vocabulary(NAMES[0])), np.random.default_rng(3)
    texts = [(k, tokenizer.decode(rng.integers(0, 50_000, 300).tolist())) for k in range(50)]
    path = new_path(spark, "bytes")
    index = tokenize_to_records(spark.createDataFrame(texts, "doc_id long, text string"), vocabulary(NAMES[0]), 0, path)
    content = b"".join(
        bytes(f.content) for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    )
    assert set(content) == set(range(256))
    want = dict(ids_of(NAMES[0], texts, 0))
    assert {r.doc_id: list(r.ids) for r in read_records(index, path).collect()} == want


def test_one_id_on_all_rows_is_dealt_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task again
    docs = spark.createDataFrame([(None, "same text")] * 4000, "doc_id long, text string").repartition(8)
    index = tokenize_to_records(docs, vocabulary(NAMES[0]), 0).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(index) == 4000 and len({r.part for r in index}) > 2
    assert sorted(r.start for r in index) == [k * index[0].n_tokens for k in range(4000)]


def test_damage_is_found():
    one = record(7, struct.pack("<3H", 1, 2, 3), False)
    assert unframe(memoryview(one + one), len(one)) == (7, struct.pack("<3H", 1, 2, 3), False, 2 * len(one))
    assert unframe(memoryview(record(None, b"", True)), 0)[0] is None
    for k in range(len(one)):
        bad = bytearray(one)
        bad[k] ^= 4
        with pytest.raises((ValueError, struct.error)):
            unframe(memoryview(bytes(bad)), 0)


@pytest.mark.parametrize(
    ("window", "packet", "targets"), [(2048, 128, None), (64, 8, None), (50, 7, {"s0": 3.0, "s1": 1.0, None: 1.0})]
)
def test_packing(spark, window, packet, targets):
    rows = awkward()
    pieces = pack(frame(spark), vocabulary(NAMES[1]), 1, window, packet, targets).collect()
    want = Counter((d, len(ids), crc(ids)) for d, ids in ids_of(NAMES[1], rows, 1))
    texts = {crc(ids): ids for _, ids in ids_of(NAMES[1], rows, 1)}
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append(p)
    # Each id lies in exactly one piece: the pieces of a document of a given length cover it as often as it occurs.
    for (doc_id, n), own in by_doc.items():
        times = sum(v for (d, m, _), v in want.items() if d == doc_id and m == n)
        cover = np.zeros(n, int)
        for p in own:
            cover[p.start : p.start + p.length] += 1
        assert (cover == times).all()
        candidates = [texts[c] for d, m, c in want if d == doc_id and m == n]
        assert all(p.ids_crc32 in {crc(c[p.start : p.start + p.length]) for c in candidates} for p in own)
    assert sum(p.length for p in pieces) == sum(n * v for (_, n, _), v in want.items())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for k, spans in sequences.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == window if k + 1 < len(sequences) else 0 < at <= window
    assert pack(empty(spark), vocabulary(NAMES[1]), 1).count() == 0


def test_windows_follow_the_mixture(spark):
    rows = [(k, f"token {k} " * 60, "en", f"s{k % 4 if k % 4 < 3 else 0}", 0) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = pack(
        docs, vocabulary(NAMES[1]), 1, window=256, packet=16
    ).join(docs.select("doc_id", "source"), "doc_id").collect()
    total, share, last = sum(p.length for p in pieces), Counter(), max(p.sequence_id for p in pieces)
    for p in pieces:
        share[p.source] += p.length / total
    for source in share:
        upto = 0
        for k in range(last):
            upto += sum(p.length for p in pieces if p.sequence_id == k and p.source == source)
            assert abs(upto - share[source] * 256 * (k + 1)) <= 2 * 16 * len(share)  # deficits stay within packets


@pytest.mark.parametrize("targets", [{"s0": 2.0, "s1": 1.0, "s2": 1.0}, {"s0": 1.0, "s2": 5.0}])
def test_windows_follow_given_targets(spark, targets):
    rows = [(k, f"token {k} " * 60, "en", f"s{k % 3}", 0) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = pack(
        docs, vocabulary(NAMES[1]), 1, window=256, packet=16, targets=targets
    ).join(docs.select("doc_id", "source"), "doc_id").collect()
    tokens = Counter()
    for p in pieces:
        tokens[p.source] += p.length
    weight = {s: targets.get(s, tokens[s] / sum(tokens.values())) for s in tokens}
    share = {s: w / sum(weight.values()) for s, w in weight.items()}
    first_empty = min(tokens[s] / share[s] for s in tokens)  # tokens packed when the first queue runs dry
    for source in share:
        upto = 0
        for k in range(int(first_empty / 256) - 1):
            upto += sum(p.length for p in pieces if p.sequence_id == k and p.source == source)
            assert abs(upto - share[source] * 256 * (k + 1)) <= 2 * 16 * len(share)


@pytest.mark.parametrize("weight", [0, 0.0, -1.0, float("nan"), float("inf")])
def test_targets_must_be_positive(spark, weight):
    with pytest.raises(ValueError, match="positive"):
        pack(empty(spark), vocabulary(NAMES[1]), 1, targets={"s0": weight})


def plain_hits(rows, tests, n, slop=0):
    words = {k: words_of((r[1] or "").encode()) for k, r in enumerate(rows)}
    out = []
    for k, r in enumerate(rows):
        hit, items = set(), set()
        for item, text in tests:
            w = words_of((text or "").encode())
            for i in range(max(len(w) - n, 0) + 1 if w and item is not None else 0):
                window = w[i : i + n]
                for s in range(len(words[k]) - len(window) + 1):
                    if words[k][s : s + len(window)] == window:
                        hit.update(range(s, s + len(window)))
                        items.add(str(item))
        out.append(
            (r[0], len(words[k]), len(hit), tuple(sorted(items)), len(hit) > 0 and 20 * len(hit) >= len(words[k]))
        )
    return out


@pytest.mark.parametrize("n", [3, 13])
def test_decontamination(spark, n):
    rows = awkward()
    tests = [
        (1, rows[9][1]), (22, "one two"), (3, None), (4, ""), (None, "one"), (5, " ".join(rows[20][1].split()[5:25])),
        (6, "ÀÉ́ y"), (3, "w1"), (3, "w1")
    ]
    bench = spark.createDataFrame([(*t, 0, "x") for t in tests], "item_id long, text string, block int, part string")
    got = decontaminate(frame(spark), bench, n).collect()
    assert sorted(
        ((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got),
        key=lambda r: text_key(r[:3]) + (r[3],)
    ) == sorted(plain_hits(rows, tests, n), key=lambda r: text_key(r[:3]) + (r[3],))
    assert all(sum(b - a for a, b in zip(r.starts, r.ends, strict=True)) == r.n_hit for r in got)
    assert decontaminate(empty(spark), bench, n).count() == 0
    assert decontaminate(frame(spark), bench.where("item_id < 0"), n).agg(F.sum("n_hit")).first()[0] == 0


def plain_matches(words, window, slop):
    """The hit words by the definition: the first word at s, every word k within slop of s + k; the nearest places
    count.
    """
    hit = set()
    for s in range(len(words)):
        if words[s] != window[0]:
            continue
        spots = []
        for k, w in enumerate(window):
            near = [p for p in range(max(s + k - slop, 0), min(s + k + slop, len(words) - 1) + 1) if words[p] == w]
            spots.append(min(near, key=lambda p: (abs(p - s - k), p)) if near else None)  # noqa: B023
        if None not in spots:
            hit.update(range(min(spots), max(spots) + 1))
    return hit


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity_against_brute_force(spark, slop):
    """The same hits however the documents are dealt to blocks, and for two benchmarks against one stored index."""
    rnd = random.Random(slop)
    docs = [
        (k, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 40)))) for k in range(120)
    ] + [(None, None), (500, "x a"), (501, "a b"), (502, "a x b y c")]
    tests = [
        [
            (k, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7)))) for k in range(12)
        ] + [(90, "a b c"), (91, "a b"), (92, "zz a")] for _ in range(2)
    ]
    for parts in (1, 3, 50):
        index = build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts))
        for items in tests if parts == 3 else tests[:1]:
            bench = spark.createDataFrame(items, "item_id long, text string")
            want = []
            for doc_id, text in docs:
                hit, named = set(), set()
                for item, phrase in items:
                    w = phrase.split()
                    for i in range(max(len(w) - 5, 0) + 1):
                        if own := plain_matches((text or "").split(), w[i : i + 5], slop):
                            hit |= own
                            named.add(str(item))
                want.append((doc_id, len(hit), tuple(sorted(named))))
            got = [(r.doc_id, r.n_hit, tuple(r["items"])) for r in search_index(index, bench, 5, slop).collect()]
            assert sorted(got, key=text_key) == sorted(want, key=text_key)


def test_postings_hold_all_words(spark):
    texts = {r[0]: words_of((r[1] or "").encode()) for r in awkward() if r[0] is not None and r[0] != 10}
    index = build_index(frame(spark, [r for r in awkward() if r[0] in texts]))
    heads = {r.block: r for r in index.documents.collect()}
    got = {d: [None] * len(w) for d, w in texts.items()}
    for r in index.postings.collect():
        firsts = np.array(heads[r.block].firsts)
        places = unpack_places(bytes(r.positions), np.array([r.n]))
        assert len(places) == r.n
        for p, k in zip(places.tolist(), (np.searchsorted(firsts, places, side="right") - 1).tolist(), strict=True):
            got[heads[r.block].doc_ids[k]][p - int(firsts[k])] = bytes(r.term)
    assert got == texts


def test_packed_places():
    rng = np.random.default_rng(2)
    lists = [
        np.sort(rng.choice(m, k, replace=False)) for m,
        k in ((10, 1), (300, 200), (10**6, 50), (1 << 27, 9), (1 << 27, 1))
    ] + [np.array([5, 1 << 28, (1 << 34) + 7]), np.array([1 << 33])]
    places = np.concatenate(lists)
    first = np.zeros(len(places), bool)
    first[np.cumsum([0, *map(len, lists)])[:-1]] = True
    packed, size = pack_places(places, first)
    assert size.sum() == len(packed) and unpack_places(
        packed.tobytes(), np.array([len(x) for x in lists])
    ).tolist() == places.tolist()


def test_intersection_in_small_rounds(monkeypatch):
    from lakeloom.llm import inverted

    monkeypatch.setattr(inverted, "CANDIDATES", 5)
    rnd = random.Random(9)
    words = np.array([rnd.randrange(3) for _ in range(400)])
    where = [np.flatnonzero(words == t) for t in range(3)]
    windows = np.unique([words[k : k + 4] for k in range(0, 390, 13)], axis=0)
    counts = np.array([len(x) for x in where])
    window, first, last = intersect(
        windows, np.full(len(windows), 4), np.argmin(counts[windows], axis=1), counts, np.concatenate(where),
        np.array([0, 400])
    )
    got = {(tuple(windows[w]), int(s)) for w, s in zip(window, first, strict=True)}
    want = {(tuple(w), s) for w in windows for s in range(397) if (words[s : s + 4] == w).all()}
    assert got == want and (last - first == 3).all()


def test_chat_rotation(spark):
    rows = [
        (1, 0, "system", "be nice"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "é!"),
        (2, 0, "system", "x"), (3, None, None, "lost"), (None, 1, "u", "a"), (None, 1, "u", "a")
    ]
    df = spark.createDataFrame(
        [(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, parts string, speaker int"
    )
    got = sorted(
        (
            (
                r.conv_id, r.speaker, r.n_turns, r.n_own, r.text, [(m.start, m.end) for m in r["mask"]]
            ) for r in rotate_perspectives(df).collect()
        ),
        key=lambda r: (r[0] or 0, r[1])
    )
    assert [g[:4] for g in got] == [
        (None, "u", 1, 1), (None, "u", 1, 1), (1, "ann", 4, 2), (1, "bob", 4, 1), (3, "unknown", 1, 1)
    ]
    ann = got[2]
    assert ann[4] == "<|system|>\nbe nice<|end|>\n<|assistant|>\nhi<|end|>\n<|user:bob|>\n<|end|>\n<|assistant|>\né!<|end|>\n"
    assert [ann[4][a:b] for a, b in ann[5]] == ["hi<|end|>\n", "é!<|end|>\n"]
    assert [got[3][4][a:b] for a, b in got[3][5]] == ["<|end|>\n"]
    assert rotate_perspectives(df.where("turn < 0")).count() == 0


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as p

    sf_dir = "/root/testdata/sf0.001"
    # noqa: E731
    plain = lambda df: [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.orderBy("doc_id").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = plain(docs)

    from lakeloom.llm.quality import document_scores, train

    one = written(p.quality_stage(spark, docs, sf_dir), "stage")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = [r for r, s in zip(rows, document_scores(model, [r[1] for r in rows]), strict=True) if s >= 0.3]
    assert plain(one) == want and one.columns == docs.columns

    two = written(p.line_dedup_stage(spark, one, sf_dir), "stage")
    rows = [(r[0], x[1], r[2], r[3], len(x[1])) for r, x in zip(want, plain_line_dedup(want, 10), strict=True)]
    assert plain(two) == rows and two.columns == docs.columns

    three = written(p.simhash_stage(spark, two, sf_dir), "stage")
    codes = np.array([np.frombuffer(set_fingerprint(r[1].encode()), np.uint8) for r in rows])
    within = np.array([np.bitwise_count(codes ^ c).sum(axis=1) <= radius(0.8, 512) for c in codes])
    meet = np.any(
        [
            (codes[:, None, i] == codes[None, :, i]) & (codes[:, None, j] == codes[None, :, j]) for i,
            j in byte_pairs(64, 48)
        ],
        axis=0
    )
    groups = least_component(
        [r[0] for r in rows],
        [(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(within & meet), strict=True) if i < j]
    )
    rows = [r for r in rows if groups[r[0]] == r[0]]
    assert plain(three) == rows and three.columns == docs.columns

    four = written(p.decontamination_stage(spark, three, sf_dir), "stage")
    tests = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {h[0] for h in plain_hits(rows, tests, 13) if h[4]}
    rows = [r for r in rows if r[0] not in bad]
    assert plain(four) == rows and bad and four.columns == docs.columns

    five = p.packing_stage(spark, four, sf_dir).collect()
    assert sum(x.length for x in five) == sum(len(i) for _, i in ids_of(NAMES[1], rows, 1))
    assert {x.doc_id for x in five} == {r[0] for r in rows}
    assert {
        (x.doc_id, x.start, x.length) for x in p.run(spark, sf_dir).collect()
    } == {(x.doc_id, x.start, x.length) for x in five}


def test_pipeline_stages_take_awkward_tables(spark):
    import corpus_pipeline as p

    sf_dir = "/root/testdata/sf0.001"
    for df in (frame(spark), empty(spark)):
        for _, stage in p.STAGES[:-1]:
            df, before = written(stage(spark, df, sf_dir), "stage"), df.count()
            assert df.columns == list(p.COLUMNS) and df.count() <= before
        left = Counter(r.doc_id for r in df.collect())
        pieces = p.STAGES[-1][1](spark, df, sf_dir).collect()
        assert {x.doc_id for x in pieces} == set(left) and sum(x.start == 0 for x in pieces) == sum(left.values())


def test_kept_text_digest_is_of_utf8():
    assert hashlib.sha256("é".encode()).hexdigest() == "4a99557e4033c3539de2eb65472017cad5f9557f7a0625a09f1c3f6e2ba69c4c"
