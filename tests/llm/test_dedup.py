import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeloom.llm.embedding import calibrate, embedding_groups
from lakeloom.llm.graph import components
from lakeloom.llm.line_dedup import LineRuns, line_dedup
from lakeloom.llm.simhash import fingerprint_of, hamming_links, near_duplicates, radius, set_fingerprint, simhash_groups
from lakeloom.llm.substring import _gaps, _places, substring_dedup, window_hashes

from .cases import awkward, empty, frame, least_component

SPACE = " \t\n\x0b\x0c\r"


def lower_ascii(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def test_components(spark):
    rnd = random.Random(3)
    edges = [
        (rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(150)
    ] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, x) for x in range(5001, 5200)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 4), (5, None)], "a long, b long")
    want = least_component({x for e in edges for x in e}, edges)
    got = dict(components(df, "a", "b").collect())
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(df.where("a < 0"), "a", "b").count() == 0


def plain_line_dedup(rows, min_docs):
    keys = [[lower_ascii(line.strip(SPACE)) for line in (r[1] or "").split("\n")] for r in rows]
    n = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for r, ks in zip(rows, keys, strict=True):
        lines = (r[1] or "").split("\n")
        kept = [x for x, k in zip(lines, ks, strict=True) if not k or n[k] < min_docs]
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def text_key(row):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in row)


@pytest.mark.parametrize("min_docs", [2, 10])
def test_line_dedup(spark, min_docs):
    rows = awkward()
    got = [
        tuple(r) for r in line_dedup(frame(spark), min_docs=min_docs).select(
            "doc_id", "text", "n_lines", "n_dropped"
        ).collect()
    ]
    assert sorted(got, key=text_key) == sorted(plain_line_dedup(rows, min_docs), key=text_key)


def test_line_dedup_keeps_columns_and_empty_tables(spark):
    assert line_dedup(frame(spark), keep=("lang", "source")).columns == [
        "doc_id", "text", "n_lines", "n_dropped", "lang", "source"
    ]
    assert line_dedup(empty(spark)).count() == 0


def test_line_runs_compact(spark):
    runs = LineRuns(spark, fanout=2, settled=5)
    total = Counter()
    for k in range(7):
        batch = {f"h{i}": 1 + i % 2 for i in range(k, k + 20)}
        runs.add(spark.createDataFrame(list(batch.items()), "hash string, n_docs long"))
        total.update(batch)
    assert len(runs.runs()) <= 4 and len(runs.levels) == 3
    got = dict(runs.counts().collect())
    assert got.keys() == total.keys()
    assert all(got[h] == n if n < 5 else got[h] >= 5 for h, n in total.items())
    assert [
        r.hash for r in runs.unseen(
            spark.createDataFrame([("h1", 1), ("new", 1)], "hash string, n_docs long")
        ).collect()
    ] == ["new"]


def test_line_runs_are_not_shuffled_again(spark):
    runs = LineRuns(spark, fanout=3, settled=5)
    batch = (
        lambda k: spark
        .range(k, k + 50)
        .select(F.unhex(F.md5(F.col("id").cast("string"))).alias("hash"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    runs.add(batch(0))
    runs.add(batch(20))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(runs.counts())
    assert sorted(r.n_docs for r in runs.counts().collect()) == [1] * 40 + [2] * 30
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = plan(runs.unseen(batch(30)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert joined.count("SortMergeJoin") == 2 and joined.count("Exchange") == 1  # the batch's own grouping
    assert runs.unseen(batch(30)).count() == 10


def plain_fingerprint(text):
    words = [
        lower_ascii(w) for w in (text or "").replace("\x1c", "\x1c").translate(
            str.maketrans(dict.fromkeys(SPACE, " "))
        ).split(" ") if w
    ]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_fingerprints():
    for row in awkward():
        assert fingerprint_of(row[1]) == plain_fingerprint(row[1])


def test_simhash_groups(spark):
    rows = awkward()
    prints = [plain_fingerprint(r[1]) for r in rows]
    nodes = range(len(rows))
    pairs = [(i, j) for i, j in itertools.combinations(nodes, 2) if (prints[i] ^ prints[j]).bit_count() <= 3]
    comp = least_component(nodes, pairs)
    least = defaultdict(list)
    for i in nodes:
        least[comp[i]].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    want = sorted(((rows[i][0], f"{prints[i]:016x}", least[comp[i]]) for i in nodes), key=text_key)
    assert sorted(
        (tuple(r) for r in simhash_groups(frame(spark)).select("doc_id", "fingerprint", "component_id").collect()),
        key=text_key
    ) == want
    assert simhash_groups(empty(spark)).count() == 0


@pytest.mark.parametrize("spread", [3, 9, 60])
def test_hamming_links_connect_the_same(spark, spread):
    """Clusters of very many close codes, so that blocks take several leaves and partitions."""
    rnd = random.Random(spread)
    codes = {0}
    for _ in range(4):
        middle = rnd.getrandbits(64)
        for _ in range(500):
            code = middle
            for b in rnd.sample(range(64), rnd.randint(0, min(spread, 64))):
                code ^= 1 << b
            codes.add(code)
    codes = sorted(codes)
    a = np.array(codes, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3
    want = least_component(
        range(len(codes)), [(int(i), int(j)) for i, j in zip(*np.nonzero(near), strict=True) if i < j]
    )
    rows = [(i, c.to_bytes(8, "big")) for i, c in enumerate(codes)]
    links = hamming_links(spark.createDataFrame(rows, "id long, code binary").repartition(3)).collect()
    pairs = [(r.a, r.b) for r in links]
    assert least_component(range(len(codes)), pairs) == want
    assert len(pairs) < 12 * len(codes)


def test_window_hashes():
    h = np.random.default_rng(1).integers(0, 1 << 63, 90).astype(np.uint64)
    for n in (1, 2, 3, 5, 7, 13, 20, 31):
        base = 0x9E3779B97F4A7C15
        want = [
            sum(
                int(x) * pow(base, n - 1 - k, 1 << 64) for k, x in enumerate(h[i : i + n])
            ) % (1 << 64) for i in range(90 - n + 1)
        ]
        assert window_hashes(h, n).tolist() == want


def plain_substring(rows, n):
    docs = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    words = [(r[1] or "").encode().split() for r in rows]
    seen, gone = set(), [set() for _ in rows]
    for i in docs:
        for k in range(len(words[i]) - n + 1):
            window = tuple(words[i][k : k + n])
            if window in seen:
                gone[i].update(range(k, k + n))
            seen.add(window)
    return [
        (
            rows[i][0], len(words[i]), len(gone[i]),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words[i]) if k not in gone[i])).hexdigest()
        ) for i in range(len(rows))
    ]


@pytest.mark.parametrize("n", [3, 20])
def test_substring_dedup(spark, n):
    rows = [r for r in awkward() if r[0] is not None]
    got = substring_dedup(frame(spark, rows), n).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain_substring(rows, n))


@pytest.mark.parametrize("partitions", [1, 3, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_of_one_id_with_different_texts(spark, partitions, seed):
    """Rows of one id count in reading order, wherever the second round takes them."""
    rnd = random.Random(seed)
    words = lambda n: [f"v{rnd.randrange(900)}" for _ in range(n)]
    passages = [words(20), words(33)]
    rows = []
    for k in range(12):
        for _ in range(rnd.randint(1, 3)):
            rows.append((k % 7, " ".join(words(rnd.randint(0, 9)) + rnd.choice(passages) + words(rnd.randint(0, 9)))))
        rows.append((None, " ".join(words(3) + passages[k % 2])))
    rows += [rows[3], rows[0], (0, rows[0][1] + " more"), rows[0]]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, partitions), "doc_id long, text string")
    got = substring_dedup(docs, 20, buckets=5).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_substring(rows, 20), key=repr)


def test_substring_dedup_with_very_many_buckets(spark):
    rows = [r for r in awkward() if r[0] is not None]
    got = substring_dedup(frame(spark, rows), 20, buckets=1 << 20).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(plain_substring(rows, 20))


@pytest.mark.parametrize("bits", [8, 1])
def test_substring_dedup_with_colliding_hashes(spark, bits):
    """The first round only finds candidates: with a hash of a few bits, which all windows share, the second still tells
    them apart.
    """
    rows = [r for r in awkward() if r[0] is not None]
    got = substring_dedup(
        frame(spark, rows), 20, buckets=3, hash_bits=bits
    ).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain_substring(rows, 20))


def test_positions_as_gaps():
    rng = np.random.default_rng(8)
    for at in (
        [], [0], [255, 256, 511, 766], [70_000, 200_000], rng.choice(10_000, 300, replace=False),
        rng.choice(3_000_000, 200, replace=False)
    ):
        at = np.sort(np.array(at, np.int64))
        assert _places(_gaps(at)).tolist() == at.tolist()


def test_many_rows_equal_in_id_and_text(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(None, "")] * 300 + [(None, long)] * 300 + [(4, long)] * 3 + [(5, "short text")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(docs).collect())
    assert got == {(None, 0, 0): 300, (None, 50, 50): 299, (None, 50, 0): 1, (4, 50, 50): 3, (5, 2, 0): 3}
    plan = substring_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_substring_dedup_null_ids_and_empty_tables(spark):
    got = substring_dedup(frame(spark), 20).select("doc_id", "n_words", "n_removed").collect()
    assert len(got) == len(awkward())
    # they stand before all others
    assert {tuple(r) for r in got if r.doc_id is None} == {(None, 3, 0), (None, 40, 0), (None, 0, 0)}
    assert substring_dedup(empty(spark), 20).count() == 0


def plain_embedding(rows, cosine):
    sound = [
        k for k,
        (_, v, label) in enumerate(rows) if v is not None and label is not None and all(
            x is not None and np.isfinite(x) for x in v
        ) and any(v)
    ]
    # so that no square overflows
    scaled = {k: np.array(rows[k][1], float) / np.abs(np.array(rows[k][1], float)).max() for k in sound}
    unit = {k: v / np.linalg.norm(v) for k, v in scaled.items()}
    pairs = [
        (i, j) for i,
        j in itertools.combinations(sound, 2) if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine
    ]
    n = Counter(x for p in pairs for x in p)
    comp = least_component(
        range(len(rows)), [(min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])) for i, j in pairs]
    )
    return [(rows[k][0], n[k], comp[rows[k][0]], comp[rows[k][0]] == rows[k][0]) for k in range(len(rows))]


def test_embedding_groups(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(700):
        base = rng.standard_normal(16) if k % 5 == 0 else np.array(rows[-1][1]) + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.5])
        rows.append((k, [float(x) for x in base], int(k // 50) % 3))
    rows += [
        (700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] * 16, 1), (703, [None] + [1.0] * 15, 1),
        (704, rows[0][1], None), (705, [1.0, 2.0], 1), (706, [1e200, 2e200], 1), (707, [2.0, 4.0], 1), (708, [], 1)
    ]
    df = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, cid int, block string"
    ).repartition(3)
    got = sorted(map(tuple, embedding_groups(df).collect()))
    want = sorted(plain_embedding(rows, 0.93))
    assert got == want
    assert embedding_groups(df.where("vec_id < 0")).count() == 0


def test_calibration():
    """The chance and the count against drawn pairs at the threshold: cells, offsets and windows as the tables have
    them.
    """
    from lakeloom.llm import embedding

    reach = 2.5
    tables, grids, cell = embedding.layout(3000, 0.93, reach, 0.999)
    width, rng, hits = np.sqrt(2 - 2 * 0.93), np.random.default_rng(2), []
    for k in range(40):
        x, y = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        y = 0.93 * x + np.sqrt(1 - 0.93**2) * y
        keys, at = embedding._cells(np.array([x, y]), np.zeros(2, np.int64), width, cell, tables, grids, k)
        hits.append(int(((keys[0] == keys[1]) & (np.abs(at[0] - at[1]) <= reach * width)).sum()))
    chance = embedding.collision_chance(reach, cell, grids)
    assert abs(np.mean(hits) / tables - chance) < 0.02
    count = calibrate(tables, chance, 0.999)
    assert count >= 2 and np.mean(np.array(hits) >= count) >= 0.95


def test_layout_keeps_collisions_in_check():
    """Per vector and table about one random collision, whatever the size; recall by calculation."""
    from lakeloom.llm import embedding

    far = np.sqrt(2) / np.sqrt(2 - 2 * 0.93)
    for largest in (1, 2, 100, 5000, 10**6, 10**9):
        tables, grids, cell = embedding.layout(largest, 0.93, 2.5, 0.999)
        assert largest * embedding.collision_chance(2.5 / far, cell / far, grids) <= 1.01
        assert calibrate(tables, embedding.collision_chance(2.5, cell, grids), 0.999) >= 2 and tables < 2000


def all_pairs(rows, cosine):
    """(links by row, component by row) of vectors by label, by brute force."""
    labels = np.array([r[2] for r in rows])
    n, pairs = np.zeros(len(rows), int), []
    for g in np.unique(labels):
        own = np.flatnonzero(labels == g)
        x = np.array([rows[i][1] for i in own])
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = np.triu(x @ x.T >= cosine, 1)
        n[own] += near.sum(axis=0) + near.sum(axis=1)
        pairs += [(int(own[i]), int(own[j])) for i, j in zip(*np.nonzero(near), strict=True)]
    return n, least_component(range(len(rows)), pairs)


@pytest.mark.parametrize("kind", ["sparse", "dense"])
def test_embedding_recall_against_all_pairs(spark, kind):
    """Pairs just above the threshold among random vectors; and a group of near copies that fills large cells."""
    rng, rows = np.random.default_rng(6), []
    if kind == "sparse":
        for _ in range(1500):
            x, y = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
            rows += [(len(rows), x.tolist(), 0), (len(rows) + 1, (0.9301 * x + np.sqrt(1 - 0.9301**2) * y).tolist(), 0)]
    else:
        middle = rng.standard_normal(64)
        for k in range(1800):
            spread = 0.02 if k % 3 == 0 else 0.2 if k % 3 == 1 else 3.0
            rows.append((k, (middle + spread * rng.standard_normal(64)).tolist(), k % 2))
    got = {
        r.vec_id: r for r in embedding_groups(
            spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        ).collect()
    }
    n, component = all_pairs(rows, 0.93)
    assert all(got[k].n_links <= n[k] for k in range(len(rows)))
    found = sum(got[k].n_links for k in range(len(rows)))
    assert found >= 0.995 * n.sum() and n.sum() >= 2 * 1400
    assert np.mean([got[k].component_id == component[k] for k in range(len(rows))]) >= 0.99


def test_a_threshold_of_one(spark):
    rows = [(1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0), (3, [1.0, 2.5], 0)]
    got = {
        r.vec_id: r.n_links for r in embedding_groups(
            spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=1.0 - 1e-12
        ).collect()
    }
    assert got == {1: 1, 2: 1, 3: 0}
    assert embedding_groups(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=1.0
    ).count() == 3


def test_repeated_vectors_and_null_ids(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.01], 0), (9, [0.0, 1.0], 0)],
        "vec_id long, embedding array<double>, label int"
    )
    got = sorted((tuple(r) for r in embedding_groups(df).collect()), key=text_key)
    assert got == [(None, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (9, 0, 9, True)]
    assert df.select(F.lit(1)).count() == 4


def plain_shingles(text):
    words = lower_ascii(text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def near_copies(seed, texts, edits, least=60, most=300):
    """Copies with edits at all distances, so that most near ones differ in more than three bits of their fingerprints.
    """
    rnd, rows = random.Random(seed), []
    for _ in range(texts):
        body = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(least, most))]
        for n in edits:
            copy = list(body)
            for _ in range(n):
                copy[rnd.randrange(len(copy))] = f"e{rnd.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(copy), "en", "s", 1))
    rnd.shuffle(rows)
    return rows


def similar_pairs(rows, least):
    """(similarity, doc_id, doc_id) of all pairs of at least that similarity, by brute force over shared shingles."""
    sets = [plain_shingles(r[1]) for r in rows]
    owners = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            owners[s].append(i)
    pairs = {(i, j) for own in owners.values() for i, j in itertools.combinations(own, 2)}
    told = ((len(sets[i] & sets[j]) / len(sets[i] | sets[j]), rows[i][0], rows[j][0]) for i, j in pairs)
    return [t for t in told if t[0] >= least]


def test_near_duplicates_by_similarity(spark):
    rows = near_copies(8, 60, (0, 0, 1, 2, 3, 4, 6, 9, 14, 20))
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).repartition(3)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    pairs = similar_pairs(rows, 0.6)
    sure = [p for p in pairs if p[0] >= 0.8]
    assert len(sure) > 400 and sum(got[a] == got[b] for _, a, b in sure) >= 0.97 * len(sure)
    allowed = least_component([r[0] for r in rows], [p[1:] for p in pairs])
    assert all(allowed[a] == allowed[b] for a, b in got.items())  # no link is far below the similarity


def test_near_duplicates_of_awkward_texts(spark):
    rows = awkward()
    got = near_duplicates(frame(spark)).collect()
    assert len(got) == len(rows)
    groups = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert groups[0] == groups[1] == groups[2] == 0  # null, empty and blank texts are alike
    assert groups[9] == groups[10] == 9
    assert {r.doc_id for r in got if r.kept} == {c for c in groups.values() if c is not None} | {
        r.doc_id for r in got if r.kept and r.doc_id is None
    }
    assert near_duplicates(empty(spark)).count() == 0


def test_radius():
    rng = np.random.default_rng(4)
    for similarity, low, high in ((0.8, 0.7, 0.95), (0.9, 0.97, 1), (0.6, 0, 0.02)):
        hits = 0
        for _ in range(200):
            common = rng.integers(0, 10**9, round(400 * 2 * similarity / (1 + similarity)))
            texts = [
                " ".join(map(str, np.r_[common, rng.integers(0, 10**9, 400 - len(common))])).encode() for _ in range(2)
            ]
            a, b = (np.frombuffer(set_fingerprint(t, 1), np.uint8) for t in texts)
            hits += np.bitwise_count(a ^ b).sum() <= radius(0.8, 512)
        assert low <= hits / 200 <= high


def test_pipeline_keeps_one_document_of_each_group(spark):
    """Null and repeated ids: what is kept follows the group, not the id."""
    import corpus_pipeline as p

    one, two = ("alpha beta gamma delta epsilon zeta eta theta " * 3 + x for x in ("iota", "iota"))
    other, third = "completely different words stand in this text of mine", "and here is one more text that nothing resembles at all"
    rows = [
        (5, one), (None, two), (None, other), (None, third), (None, third), (7, other), (7, third), (8, None), (9, "")
    ]
    docs = spark.createDataFrame(
        [(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    kept = sorted(((r.doc_id, r.text) for r in p.simhash_stage(spark, docs, "").collect()), key=text_key)
    assert kept == sorted([(5, one), (7, other), (7, third), (8, None)], key=text_key)


@pytest.mark.parametrize("noise", [0.02, 0.2, 0.3])
def test_embedding_groups_with_a_cluster_of_near_copies(spark, noise):
    """Half of six thousand vectors of a label are near copies: close ones are counted around a pivot, others compared once.
    """
    import time

    rng = np.random.default_rng(1)
    x = np.vstack([rng.standard_normal((3_000, 64)), rng.standard_normal(64) + noise * rng.standard_normal((3_000, 64))])
    rng.shuffle(x)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    began = time.time()
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(df).collect()}
    took = time.time() - began
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    roots = least_component(range(len(x)), zip(*(v.tolist() for v in np.nonzero(np.triu(near))), strict=True))
    assert got == {i: (int(near[i].sum()), roots[i]) for i in range(len(x))}
    assert took < 120  # some 15 s alone on four cores


def test_no_pair_of_blocks_is_compared_twice(spark):
    from lakeloom.llm import embedding

    rng = np.random.default_rng(2)
    x = rng.standard_normal(16) + 0.22 * rng.standard_normal((900, 16))
    rows = [(i, 1, 16, 1, v.astype("<f8").tobytes()) for i, v in enumerate(x)]
    packed = spark.createDataFrame(rows, "cid long, owner long, dims int, copies long, vector binary")
    cells = [(t * 10 + int(c), i) for t in range(30) for i, c in enumerate(rng.random(900) < 0.8)]
    large = spark.createDataFrame(cells, "key long, cid long")
    links, homes, pairs = embedding._crowds(large, packed, 0.93)
    got = links.collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    count = [0] * 900
    for r in got:
        if r.cid is not None:
            count[r.cid] += r.links
    assert count == near.sum(axis=1).tolist()
    own = {r.cid: r.home for r in homes.collect()}
    assert len(own) == 900 and own[0] == min(k for k, i in cells if i == 0)
    told = [(r.g, r.h) for r in pairs.collect()]
    assert len(told) == len(set(told)) and all(g <= h for g, h in told)
