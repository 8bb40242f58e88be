"""Language identification by blended-spectrum string kernels with Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, has_columns, ship, text_hash

#: Presence bits for the hashed n-grams of 1, 2, 3 and 4 characters: several times what the longest texts of one
#: language fill.
SLOTS, PIECE = (1 << 12, 1 << 13, 1 << 14, 1 << 15), 1_000_000
ORDERS, BITS = len(SLOTS), sum(SLOTS)


@functools.cache
def _letters():
    import numpy as np

    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def presence(text: str | None):
    """Which n-grams of letters occur in the whole text, lower-cased, with all else as a blank; None where there is no
    letter.
    """
    import numpy as np

    text = (text or "").lower()
    found, any_letter = np.zeros(BITS, bool), False
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE + ORDERS - 1].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[points]
        any_letter = any_letter or bool(letter.any())
        points = np.where(letter, points, 32).astype(np.uint32)
        code = np.zeros(len(points) + 1, np.uint32)
        for n in range(ORDERS):
            if len(points) <= n:
                break
            code = code[: len(points) - n] * np.uint32(0x01000193) + points[n:]
            slot = (code * np.uint32(0x9E3779B1)) >> np.uint32(33 - SLOTS[n].bit_length())
            found[sum(SLOTS[:n]) + slot] = True
    return found if any_letter else None


def _bits(rows):
    """Presence bits as they are, or unpacked from eight a byte."""
    import numpy as np

    return np.unpackbits(rows, axis=1) if rows.shape[1] == BITS // 8 else rows


def kernel(x, z):
    """The blended-spectrum presence kernel of rows: n-grams in common over the root of the product of their numbers."""
    import numpy as np

    z = z.astype(np.float32)
    out = np.zeros((len(x), len(z)), np.float32)
    for k in range(0, len(x), 128):
        part = _bits(x[k : k + 128]).astype(np.float32)
        out[k : k + 128] = (part @ z.T) / np.sqrt(np.maximum(part.sum(axis=1), 1))[:, None]
    return out / np.sqrt(np.maximum(z.sum(axis=1), 1))[None, :]


def fit(rows, langs: list[str], landmarks: int = 200, ridge: float = 1e-3) -> dict:
    """One-versus-rest kernel ridge regression on Nyström features of evenly spread landmarks.

    With landmarks Z and K(Z, Z) = U S U', the features of x are K(x, Z) U S^-1/2, and the scores are these times the
    ridge weights. As the kernel counts common n-grams, K(x, Z) times all weights is one product of x with a matrix of
    n-grams by languages.
    """
    import numpy as np

    names = sorted(set(langs))
    if not names:
        return {"names": [], "matrix": np.zeros((BITS, 0), np.float32), "offset": np.zeros(0, np.float32)}
    z = _bits(rows[np.unique(np.linspace(0, len(rows) - 1, min(landmarks, len(rows))).astype(int))]).astype(np.float32)
    s, u = np.linalg.eigh(kernel(z, z).astype(np.float64))
    keep = s > 1e-8 * s[-1]
    root = u[:, keep] / np.sqrt(s[keep])
    phi = kernel(rows, z).astype(np.float64) @ root
    y = np.array([[1.0 if g == n else -1.0 for n in names] for g in langs])
    mean, middle = phi.mean(axis=0), y.mean(axis=0)
    weights = np.linalg.solve(
        (phi - mean).T @ (phi - mean) + ridge * len(rows) * np.eye(phi.shape[1]), (phi - mean).T @ (y - middle)
    )
    scaled = z / np.sqrt(np.maximum(z.sum(axis=1), 1))[:, None]
    return {
        "names": names, "matrix": (scaled.T @ (root @ weights)).astype(np.float32),
        "offset": (middle - mean @ weights).astype(np.float32)
    }


def values(model: dict, x):
    """The regression values by row of presence bits and language: one product of matrices."""
    import numpy as np

    x = np.asarray(x, np.float32)
    return (x @ model["matrix"]) / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] + model["offset"]


def predict(model: dict, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) by text: the language of the highest regression value, and its share after a softmax."""
    import numpy as np

    found = [presence(t) for t in texts]
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    known = [k for k, x in enumerate(found) if x is not None]
    if known and model["names"]:
        value = values(model, [found[k] for k in known])
        share = np.exp(4 * (value - value.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        for k, row in zip(known, share, strict=True):
            out[k] = (model["names"][int(row.argmax())], float(row.max()))
    return out


def train(
    docs: DataFrame, sample_docs: int = 3000, landmarks: int = 200, held_out_of: int = 4, held_out: int = 2
) -> dict:
    """Fits on at most `sample_docs` documents with a language: those of least hash, held-out rows excepted. Their
    presence bits (8 kB each) reach the driver.
    """
    import numpy as np

    spark = docs.sparkSession
    ship(spark)
    docs = has_columns(
        docs, doc_id="long", text="string", lang="string"
    ).where("doc_id IS NOT NULL AND lang IS NOT NULL")
    remainder = crc_remainder(F.col("doc_id"), held_out_of)
    chosen = (
        docs
        .where(remainder != held_out)
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )

    def featurise(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bits = [
                None if (x := presence(t)) is None else np.packbits(x).tobytes() for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(bits, pa.binary())], ["doc_id", "lang", "bits"]
            )

    # Of rows that share an id, the one whose text has the least hash is learned from; so at most sample_docs rows reach
    # the driver.
    least = F.struct(text_hash(F.col("text")).alias("hash"), F.col("lang"), F.col("text"))
    picked = (
        docs
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(least).alias("row"))
        .select("doc_id", "row.text", "row.lang")
    )
    rows = picked.mapInArrow(featurise, "doc_id long, lang string, bits binary").where("bits IS NOT NULL").collect()
    rows.sort(key=lambda r: r.doc_id)
    packed = np.array([np.frombuffer(r.bits, np.uint8) for r in rows], np.uint8).reshape(-1, BITS // 8)
    return fit(packed, [r.lang for r in rows], landmarks)


def identify_language(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score for every row; `und` with score 0 where the text is null or has no letter, or nothing
    was learned.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def label(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                said = predict(sent.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([s[0] for s in said], pa.string()),
                        pa.array([s[1] for s in said], pa.float64())
                    ],
                    ["doc_id", "lang_pred", "score"]
                )

    return has_columns(docs, doc_id="long", text="string").mapInArrow(
        label, "doc_id long, lang_pred string, score double"
    )


def classify_language(docs: DataFrame, held_out_of: int = 4, held_out: int = 2, **sample: int) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, learned from the rows that aren't held out.

    A null doc_id is never held out and never learned from; repeated rows get their result each time; extra columns are
    left out; an empty table gives no rows. Whole texts count, a million characters at a time, however long.
    """
    model = train(docs, held_out_of=held_out_of, held_out=held_out, **sample)
    out = identify_language(docs, model)
    return out.select(
        "doc_id", (crc_remainder(F.col("doc_id"), held_out_of) == held_out).alias("held_out"), "lang_pred", "score"
    )
