"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, has_columns, ship, text_hash

#: Classes of characters: lower and upper letters, other letters, digits, white space, sentence marks, bars, other
#: signs.
LOWER, UPPER, LETTER, DIGIT, BLANK, SENTENCE, BAR, SIGN = range(8)
OWN, RUN_LINES = 14, 20_000


@functools.cache
def _classes():
    import numpy as np

    table = np.full(0x110000, SIGN, np.uint8)
    for c in range(0x30000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = LOWER if ch.islower() else UPPER if ch.isupper() else LETTER
        elif ch.isdigit():
            table[c] = DIGIT
        elif ch.isspace():
            table[c] = BLANK
    table[[ord(c) for c in ".,;:?'\"()-"]] = SENTENCE
    table[ord("|")] = BAR
    return table


def _own_features(lines: list[str]):
    """A row for each line, and the lines' lengths."""
    import numpy as np

    n = len(lines)
    points = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    line = np.cumsum(points == 10)
    counts = (
        np
        .bincount(line * 8 + _classes()[points] if len(points) else np.zeros(0, np.int64), minlength=8 * n)
        .reshape(n, 8)
        .astype(np.float64)
    )
    length = np.array([len(x) for x in lines], np.float64)
    counts[:-1, BLANK] -= 1  # the line feed itself
    words = np.zeros((n, 4))
    for k, x in enumerate(lines):
        w = x.split()
        if w:
            words[k] = len(w), len(set(w)), sum(map(str.__eq__, w, w[1:])), sum(y[-1] in "*$%&#!~^" for y in w)
    size, w = np.maximum(length, 1), np.maximum(words[:, 0], 1)
    letters = np.maximum(counts[:, :3].sum(axis=1), 1)
    own = np.column_stack([
        np.ones(n), np.log1p(length) / 5, length == 0, counts[:, UPPER] / letters, counts[:, DIGIT] / size,
        counts[:, SENTENCE] / size * 5,
        np.minimum(counts[:, BAR] / w, 1), np.minimum(counts[:, SIGN] / w, 2), 1 - words[:, 1] / w, words[:, 2] / w,
        words[:, 3] / w,
        np.minimum(letters / w, 20) / 10, words[:, 0] == 1, counts[:, BAR] > 0,
    ])
    return own, length


def line_features(text: str | None):
    """(features, weights): a row for each line, with its own features and those of the lines before and after it;
    weights are lengths plus one.

    A text of no line feed is one line, so that null and empty texts have one empty line.
    """
    import numpy as np

    own, length = _own_features((text or "").split("\n"))
    around = np.zeros((len(own), 3 * OWN))
    around[:, :OWN] = own
    around[1:, OWN : 2 * OWN] = own[:-1]
    around[:-1, 2 * OWN :] = own[1:]
    return around, length + 1


def line_emissions(weights, text: str | None):
    """(emissions, weights) by line: line_features() times the weights, in runs of RUN_LINES, so that a long text takes
    a few numbers a line.
    """
    import numpy as np

    lines = (text or "").split("\n")
    out, length = np.zeros(len(lines)), np.zeros(len(lines))
    own, before, after = weights[:OWN], weights[OWN : 2 * OWN], weights[2 * OWN :]
    for at in range(0, len(lines), RUN_LINES):
        run, length[at : at + RUN_LINES] = _own_features(lines[at : at + RUN_LINES])
        out[at : at + len(run)] += run @ own
        out[at + 1 : at + 1 + len(run)] += (run @ before)[: len(lines) - at - 1]
        first = max(at - 1, 0)
        out[first : at + len(run) - 1] += (run @ after)[first - at + 1 :]
    return out, length + 1


def _padded(documents: list):
    """Documents of similar length side by side: features (document, line, feature) and which lines exist."""
    import numpy as np

    longest = max(map(len, documents))
    x = np.zeros((len(documents), longest, documents[0].shape[1]))
    for k, d in enumerate(documents):
        x[k, : len(d)] = d
    return x, np.arange(longest)[None, :] < np.array([len(d) for d in documents])[:, None]


def good_lines(moves, scores, there):
    """Forward and backward over all lines, by logarithms: the probability of a good line, and the sums that pairs and
    the partition need.

    `scores` (document, line) favours a good line; `there` marks lines that exist.
    """
    import numpy as np

    emission = np.zeros((*scores.shape, 2))
    emission[..., 1] = scores
    forward, backward = np.zeros_like(emission), np.zeros_like(emission)
    forward[:, 0] = emission[:, 0]
    for t in range(1, scores.shape[1]):
        reach = forward[:, t - 1, :, None] + moves
        new = np.logaddexp(reach[:, 0], reach[:, 1]) + emission[:, t]
        forward[:, t] = np.where(there[:, t, None], new, forward[:, t - 1])
    for t in range(scores.shape[1] - 2, -1, -1):
        reach = moves + (emission[:, t + 1] + backward[:, t + 1])[:, None, :]
        backward[:, t] = np.where(there[:, t + 1, None], np.logaddexp(reach[..., 0], reach[..., 1]), 0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    good = np.exp(np.minimum(forward[..., 1] + backward[..., 1] - total[:, None], 0)) * there
    return good, emission, forward, backward, total


def marginals(model: dict, x, there, told=0.0):
    """The probability of a good line, and what training needs: pair marginals and the log partition; `told` is added to
    every line's score.
    """
    import numpy as np

    moves = model["moves"]
    good, emission, forward, backward, total = good_lines(moves, x @ model["weights"] + told, there)
    pairs = forward[:, :-1, :, None] + moves + (
        emission[:, 1:] + backward[:, 1:]
    )[:, :, None, :] - total[:, None, None, None]
    return good, np.exp(np.minimum(pairs, 0)) * there[:, 1:, None, None], total


def _ascend(model: dict, batches: list, witness: float, steps: int, rate: float, ridge: float) -> dict:
    """The model with weights that maximise the likelihood of the documents' labels (Adam)."""
    import numpy as np

    weights = model["weights"]
    first, second, rng = np.zeros_like(weights), np.zeros_like(weights), np.random.default_rng(1)
    for step in range(1, steps + 1):
        x, there, y = batches[rng.integers(len(batches))]
        scores = x @ weights
        free = good_lines(model["moves"], scores, there)[0]
        told = good_lines(model["moves"], scores + np.where(y == 1, witness, -witness)[:, None], there)[0]
        g = np.einsum("dl,dlf->f", (told - free) / there.sum(axis=1)[:, None], x) / len(y) - ridge * weights
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        weights = weights + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model | {"weights": weights}


def fit(
    documents: list, labels: list[int], trust: float = 0.9, steps: int = 160, rate: float = 0.08, ridge: float = 2e-3
) -> dict:
    """A CRF with hidden line labels, fitted to the documents' labels.

    Each line's label is hidden; the document's label is a witness of it that is right with probability `trust`. So the
    gradient is what the chain expects with the witnesses less what it expects without, and a line may come out other
    than its document. Lines of a document share the likelihood equally, so that long documents don't outweigh short
    ones.

    The same likelihood would teach the moves never to switch, as a document has one label. So the weights are fitted
    without moves first; the moves are then the pointwise mutual information of neighbouring lines under these weights,
    and the weights are fitted again with them.
    """
    import numpy as np

    model = {"weights": np.zeros(3 * OWN), "moves": np.zeros((2, 2))}
    if not documents:
        return model
    order = sorted(range(len(documents)), key=lambda k: len(documents[k]))
    batches = []
    for k in range(0, len(order), 256):
        own = order[k : k + 256]
        x, there = _padded([documents[i] for i in own])
        batches.append((x, there, np.array([labels[i] for i in own])))
    witness = np.log(trust / (1 - trust))
    model = _ascend(model, batches, witness, steps, rate, ridge)
    pairs = np.full((2, 2), 0.25)
    for x, there, _ in batches:
        pairs += marginals(model, x, there)[1].sum(axis=(0, 1))
    pairs /= pairs.sum()
    model["moves"] = np.log(pairs / pairs.sum(axis=1, keepdims=True) / pairs.sum(axis=0, keepdims=True))
    return _ascend(model, batches, witness, steps // 2, rate, ridge)


def calibrate(model: dict, documents: list, labels: list[int]) -> dict:
    """Adds a logistic curve of the length-weighted mean, fitted with equal weight for both classes, so that a score is
    a probability.
    """
    import numpy as np

    means = np.array(
        [_mean(g, w) for x, w in documents for g in [marginals(model, x[None], np.ones((1, len(x)), bool))[0][0]]]
    )
    y = np.array(labels)
    if not 0 < y.sum() < len(y):
        return model | {"slope": 1.0 if len(y) else 0.0, "middle": 0.0}
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    x, b = np.column_stack([_logit(means), np.ones(len(y))]), np.array([1.0, 0.0])
    for _ in range(50):  # Newton's method with a ridge that keeps the slope finite where the classes part
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (share * (y - p)) - 0.002 * (b - [1.0, 0.0])
        b = b + np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 0.002 * np.eye(2), slope)
    return model | {"slope": float(b[0]), "middle": float(b[1])}


def _mean(good, weight) -> float:
    return float(good @ weight / weight.sum())


def _logit(mean):
    import numpy as np

    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def train(
    docs: DataFrame, labels: DataFrame, sample_docs: int = 3000, sample_lines: int = 300, held_out_of: int = 5
) -> dict:
    """Fits on at most `sample_docs` labelled documents of at most `sample_lines` lines: those of least hash, held-out
    rows excepted.

    Only the sample's features reach the driver, at most sample_docs * sample_lines rows of 43 numbers. Conflicting or
    repeated labels of a document count by the least; null labels and null ids don't count.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = has_columns(docs, doc_id="long", text="string")
    labelled = (
        has_columns(labels, doc_id="long", quality="int")
        .where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    known = (
        docs
        .where((crc_remainder(F.col("doc_id"), held_out_of) > 0) & (lines <= sample_lines))
        .select("doc_id")
        .join(labelled, "doc_id")
    )
    chosen = known.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def featurise(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = [np.column_stack(line_features(t)).astype(np.float32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["doc_id", "quality", "x"]
            )

    # Of rows that share an id, the text of least hash is learned from; so at most sample_docs rows reach the driver.
    picked = (
        docs
        .where(lines <= sample_lines)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min_by("text", F.struct(text_hash(F.col("text")), "text")).alias("text"))
    )
    rows = picked.mapInArrow(featurise, "doc_id long, quality int, x binary").limit(sample_docs).collect()
    import numpy as np

    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    made = [np.frombuffer(r.x, np.float32).reshape(-1, 3 * OWN + 1).astype(np.float64) for r in rows]
    good = [int(r.quality > 0) for r in rows]
    return calibrate(fit([x[:, :-1] for x in made], good), [(x[:, :-1], x[:, -1]) for x in made], good)


def line_marginals(model: dict, texts: list[str | None]) -> list[tuple]:
    """(probability of a good line, weight) by line, for each text."""
    import numpy as np

    made = [line_emissions(model["weights"], t) for t in texts]
    order = sorted(range(len(made)), key=lambda k: len(made[k][1]))
    out, at = [None] * len(made), 0
    while at < len(order):
        upto = at + 1  # documents of similar length side by side
        while upto < len(order) and upto - at < 128 and (upto - at + 1) * len(made[order[upto]][1]) <= 200_000:
            upto += 1
        own = order[at:upto]
        scores = np.zeros((len(own), len(made[own[-1]][0])))
        for row, k in enumerate(own):
            scores[row, : len(made[k][0])] = made[k][0]
        there = np.arange(scores.shape[1])[None, :] < np.array([len(made[k][0]) for k in own])[:, None]
        for k, good in zip(own, good_lines(model["moves"], scores, there)[0], strict=True):
            out[k] = good[: len(made[k][1])], made[k][1]
        at = upto
    return out


def document_scores(model: dict, texts: list[str | None]) -> list[float]:
    """The mean probability of a good line, weighted by the lines' lengths, on the calibrated scale; one half where
    nothing was learned.
    """
    import numpy as np

    slope, middle = model.get("slope", 1.0), model.get("middle", 0.0)
    values = [slope * _logit(_mean(good, weight)) + middle for good, weight in line_marginals(model, texts)]
    return [float(1 / (1 + np.exp(-np.clip(v, -30, 30)))) for v in values]


def label_lines(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, text_hash, line (from 0), length, good (the probability of a good line), label (1 where that is at least
    one half), for every line of every document.

    A null or empty text is one empty line. Repeated rows give their lines each time; null ids stay null; extra columns
    are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def label(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                told = line_marginals(sent.value, part.column("text").to_pylist())
                owner = pa.array(np.repeat(np.arange(len(told)), [len(g) for g, _ in told]))
                good, weight = (np.concatenate([t[i] for t in told]) for i in (0, 1))
                place = np.concatenate([np.arange(len(g)) for g, _ in told])
                columns = [
                    part.column("doc_id").take(owner), part.column("text_hash").take(owner), pa.array(place),
                    pa.array((weight - 1).astype(np.int64)), pa.array(good), pa.array((good >= 0.5).astype(np.int32))
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "line", "length", "good", "label"])

    docs = has_columns(docs, doc_id="long", text="string").withColumn("text_hash", text_hash(F.col("text")))
    return docs.mapInArrow(label, "doc_id long, text_hash long, line long, length long, good double, label int")


def score_quality(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """The documents with `column`, 0 to 1; all other columns stay, but an old one of that name is replaced."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop(column)
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                scores = document_scores(sent.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, column]
                )

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    return docs.mapInArrow(score, f"{kinds}, `{column}` double")


def classify_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out_of: int = 5, **sample: int
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row: 1 where the score is at least `threshold`.

    A null or empty text is one empty line and gets a score like any other. A null doc_id is never held out and never
    learned from. Without a usable label every score is one half. Repeated rows get their result each time; extra
    columns are left out; an empty table gives no rows. Texts are scored whole, in a few numbers a line, so that one of
    a million lines fits into a task.
    """
    model = train(docs, labels, held_out_of=held_out_of, **sample)
    scored = score_quality(has_columns(docs, doc_id="long", text="string"), model)
    return scored.select(
        "doc_id", (crc_remainder(F.col("doc_id"), held_out_of) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted")
    )
