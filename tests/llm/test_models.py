import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lakeloom.llm import langid, quality

from .cases import awkward, empty, frame


def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return float(np.mean(good[:, None] > bad[None, :]) + 0.5 * np.mean(good[:, None] == bad[None, :]))


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = {"weights": rng.standard_normal(3 * quality.OWN), "moves": rng.standard_normal((2, 2))}
    documents = [rng.standard_normal((n, 3 * quality.OWN)) for n in (1, 2, 4, 4, 6)]
    x, there = quality._padded(documents)
    good, pairs, total = quality.marginals(model, x, there)
    for k, d in enumerate(documents):
        sums, weights = np.zeros(len(d)), []
        for y in itertools.product((0, 1), repeat=len(d)):
            w = np.exp(
                sum(
                    d[i] @ model["weights"] for i in range(len(d)) if y[i]
                ) + sum(model["moves"][a, b] for a, b in itertools.pairwise(y))
            )
            weights.append(w)
            sums += w * np.array(y)
        assert np.allclose(good[k, : len(d)], sums / sum(weights))
        assert np.isclose(total[k], np.log(sum(weights)))
        assert np.allclose(pairs[k, : len(d) - 1].sum(axis=(1, 2)), 1)


def test_features_of_odd_texts():
    for row in awkward():
        x, weight = quality.line_features(row[1])
        assert x.shape == (
            len((row[1] or "").split("\n")), 3 * quality.OWN
        ) and np.isfinite(x).all() and (weight > 0).all()


def test_scores_do_not_depend_on_neighbours_in_a_batch():
    rng = np.random.default_rng(2)
    model = {
        "weights": rng.standard_normal(3 * quality.OWN) / 4, "moves": np.array([[1.0, -1.0], [-1.0, 1.0]]),
        "slope": 1.0, "middle": 0.0
    }
    texts = [r[1] for r in awkward()] + ["long\n" * 45_000]
    together = quality.document_scores(model, texts)
    assert np.allclose(together, [quality.document_scores(model, [t])[0] for t in texts])


def test_emissions_in_runs_equal_features_times_weights(monkeypatch):
    monkeypatch.setattr(quality, "RUN_LINES", 3)
    weights = np.random.default_rng(3).standard_normal(3 * quality.OWN)
    for text in [r[1] for r in awkward()] + ["a\nb b\n\nC!\nd 1\n|\nlast"]:
        x, weight = quality.line_features(text)
        emission, again = quality.line_emissions(weights, text)
        assert np.allclose(emission, x @ weights) and (weight == again).all()


def test_gradient_of_the_hidden_chain():
    """The expectations' difference is the slope of the log likelihood of the documents' labels, by enumeration of all
    line labels.
    """
    rng = np.random.default_rng(5)
    x, there = quality._padded([rng.standard_normal((4, 3 * quality.OWN))])
    witness = np.log(9.0)

    def likelihood(model):
        told, free = [], []
        for y in itertools.product((0, 1), repeat=4):
            score = sum(x[0, i] @ model["weights"] for i in range(4) if y[i]) + sum(
                model["moves"][a, b] for a, b in itertools.pairwise(y)
            )
            free.append(score)
            told.append(score + witness * sum(y))
        return np.logaddexp.reduce(told) - np.logaddexp.reduce(free)

    model = {"weights": rng.standard_normal(3 * quality.OWN) / 3, "moves": rng.standard_normal((2, 2))}
    free, free_pairs, _ = quality.marginals(model, x, there)
    told, told_pairs, _ = quality.marginals(model, x, there, witness)
    slope = np.einsum("dl,dlf->f", told - free, x)
    for k in range(0, 3 * quality.OWN, 7):
        step = np.zeros(3 * quality.OWN)
        step[k] = 1e-5
        up, down = (likelihood(model | {"weights": model["weights"] + s * step}) for s in (1, -1))
        assert np.isclose((up - down) / 2e-5, slope[k], atol=1e-4)
    for a, b in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        up, down = (likelihood(model | {"moves": model["moves"] + s * step}) for s in (1, -1))
        assert np.isclose((up - down) / 2e-5, (told_pairs - free_pairs).sum(axis=(0, 1))[a, b], atol=1e-4)


def test_lines_may_differ_from_their_document():
    """Good documents that carry some junk and bad ones that carry some prose: the chain switches inside a document."""
    rnd = random.Random(6)
    prose = lambda: " ".join(
        rnd.choice(["the", "river", "was", "calm", "and", "cold,"]) for _ in range(rnd.randint(8, 15))
    ).capitalize() + "."
    junk = lambda: "!!! $$$ BUY NOW 9999 *** " * rnd.randint(1, 3)

    def lines(share):
        out = []
        while len(out) < 12:
            one = prose if rnd.random() < share else junk
            out += [one() for _ in range(rnd.randint(1, 5))]
        return out

    made = [quality.line_features("\n".join(lines(share))) for share in [0.75] * 300 + [0.25] * 300]
    labels = [1] * 300 + [0] * 300
    model = quality.calibrate(quality.fit([x for x, _ in made], labels), made, labels)
    mixed = [prose() for _ in range(6)] + [junk() for _ in range(8)] + [prose() for _ in range(6)]
    told = (quality.line_marginals(model, ["\n".join(mixed)])[0][0] >= 0.5).tolist()
    assert told[:5] == [True] * 5 and told[8:12] == [False] * 4 and told[-5:] == [True] * 5
    texts = ["\n".join(prose() for _ in range(20)), "\n".join(mixed), "\n".join(junk() for _ in range(20))]
    scores = quality.document_scores(model, texts)
    assert scores[0] > scores[1] > scores[2]


def test_line_labels(spark):
    rng = np.random.default_rng(7)
    model = {
        "weights": rng.standard_normal(3 * quality.OWN) / 4, "moves": np.array([[1.0, -1.0], [-1.0, 1.0]]),
        "slope": 1.0, "middle": 0.0
    }
    rows = quality.label_lines(frame(spark), model).collect()
    assert len(rows) == sum(len((r[1] or "").split("\n")) for r in awkward())
    for doc_id, text, *_ in awkward():
        if doc_id == 20:
            own = sorted((r.line, r.length, r.good, r.label) for r in rows if r.doc_id == 20)
            assert [o[1] for o in own] == [len(x) for x in text.split("\n")]
            assert np.allclose(
                [o[2] for o in own], quality.line_marginals(model, [text])[0][0]
            ) and all(o[3] == (o[2] >= 0.5) for o in own)
    assert quality.label_lines(empty(spark), model).count() == 0


def test_a_text_of_a_million_lines():
    model = {"weights": np.ones(3 * quality.OWN) / 50, "moves": np.zeros((2, 2)), "slope": 1.0, "middle": 0.0}
    assert 0 < quality.document_scores(model, ["one two\n" * 1_000_000])[0] < 1


@pytest.fixture(scope="module")
def tables():
    return "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark, tables):
    docs, labels = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.classify_quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert all(
        r.held_out == (
            zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        ) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows
    )
    held = [r for r in rows if r.held_out]
    assert auc([r.score for r in held if r.quality], [r.score for r in held if not r.quality]) >= 0.98
    assert sum(r.predicted for r in held if r.quality) >= 0.99 * sum(1 for r in held if r.quality)


def test_quality_of_awkward_tables(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 1), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int"
    )
    rows = quality.classify_quality(frame(spark), labels).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert {r.score for r in quality.classify_quality(frame(spark), labels.where("doc_id < 0")).collect()} == {0.5}
    assert quality.classify_quality(empty(spark), labels).count() == 0


def test_language_of_held_out_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = langid.classify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_kernel_counts_common_ngrams():
    a, b = (langid.presence(x) for x in ("abc", "abd"))
    own = lambda x: {(n, x[i : i + n]) for n in range(1, 5) for i in range(len(x) - n + 1)}
    want = len(own("abc") & own("abd")) / np.sqrt(len(own("abc")) * len(own("abd")))
    assert np.isclose(langid.kernel(a[None], b[None])[0, 0], want)
    assert langid.presence("12 !\n") is None and langid.presence(None) is None


def test_fused_matrix_equals_dense_kernel_regression():
    """With every row a landmark, the product with the fused matrix is kernel ridge regression on the n-gram sets
    themselves.
    """
    rnd = random.Random(2)
    words = {
        "aa": ["der", "und", "nicht", "haus"], "bb": ["the", "and", "not", "house"], "cc": ["le", "et", "pas", "maison"]
    }
    texts = [
        (lang, " ".join(rnd.choice(w) + rnd.choice("xyz ") for _ in range(8))) for lang,
        w in words.items() for _ in range(25)
    ]
    train, test = texts[::2], texts[1::2]
    grams = lambda t: {
        ("".join(c if c.isalpha() else " " for c in t))[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)
    }
    dense = lambda p, q: np.array(
        [[len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b))) for _, b in q] for _, a in p]
    )
    k, n = dense(train, train), len(train)
    y = np.array([[1.0 if g == name else -1.0 for name in sorted(words)] for g, _ in train])
    center = np.eye(n) - 1 / n
    weights = np.linalg.solve(center @ k @ center + 1e-3 * n * np.eye(n), y - y.mean(axis=0))
    want = (dense(test, train) - k.mean(axis=0)) @ center @ weights + y.mean(axis=0)
    model = langid.fit(np.array([langid.presence(t) for _, t in train]), [g for g, _ in train], landmarks=n)
    got = langid.values(model, [langid.presence(t) for _, t in test])
    assert np.allclose(got, want, atol=2e-2)


def test_language_of_very_long_texts(spark, tables):
    """Texts of 20,000 words, joined from held-out documents of one language."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    model = langid.train(docs)
    held = defaultdict(list)
    for r in docs.orderBy("doc_id").collect():
        if zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            held[r.lang] += r.text.split()
    texts = [
        (lang, " ".join((words * (1 + 40_000 // len(words)))[at : at + 20_000])) for lang,
        words in held.items() for at in (0, 7_000)
    ]
    assert len(held) > 2 and [g for g, _ in langid.predict(model, [t for _, t in texts])] == [lang for lang, _ in texts]
    filled = [langid.presence(t)[-langid.SLOTS[-1] :].mean() for _, t in texts]
    assert max(filled) < 0.5  # presence doesn't saturate


def test_presence_takes_the_whole_text(monkeypatch):
    text = "abcdefgh xyz " * 50 + "q" * 5
    whole = langid.presence(text)
    monkeypatch.setattr(langid, "PIECE", 17)
    assert (langid.presence(text) == whole).all()


def test_language_of_awkward_tables(spark):
    rows = langid.classify_language(frame(spark)).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.lang_pred in ("en", "und") for r in rows) and any(r.lang_pred == "und" for r in rows)
    assert langid.classify_language(empty(spark)).count() == 0
