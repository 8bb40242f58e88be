"""Importance resampling towards a target distribution: hashed features, log-ratio weights, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import has_columns, ship, text_hash, written
from .pack import running_total

#: Texts are cut into words in steps of about so many bytes (or one longer text).
STEP_BYTES = 4 << 20


def feature_buckets(texts, orders: tuple[int, int], buckets: int) -> Iterator[tuple]:
    """(n_words, n_features, bucket) for one run of an Arrow array of texts after the other: words and features by
    text, and the features' buckets laid end to end.

    Words are the runs of ASCII digits and letters (lower-cased) and of characters beyond ASCII; a feature is a run of
    orders[0] to orders[1] words of one text, joined by a space; its bucket is the CRC-32 of its bytes mod `buckets`.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from .crc import crc32_spans

    byte = np.arange(256, dtype=np.uint8)
    upper = (byte >= 65) & (byte <= 90)
    lower = np.where(upper, byte + 32, byte).astype(np.uint8)
    in_word = ((byte >= 48) & (byte <= 57)) | upper | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    size = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + STEP_BYTES, side="right")))
        run = texts.slice(at, upto - at)
        at = upto
        bounds = np.frombuffer(run.buffers()[1], np.int64)[run.offset : run.offset + len(run) + 1]
        held = np.frombuffer(run.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        word, data = in_word[held], lower[held]
        first = np.zeros(len(word) + 1, bool)  # where a text begins, so no word runs over it
        first[bounds] = True
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1] | first[1:-1]
        ends[:-1] &= ~word[1:] | first[1:-1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        n_words = np.diff(np.searchsorted(starts, bounds))
        if orders[1] > 1:  # the words of all texts with one space after each
            length = ends - starts
            new_ends = np.cumsum(length + 1) - 1
            new_starts = new_ends - length
            spaced = np.full(int(new_ends[-1]) + 1 if len(new_ends) else 0, 32, np.uint8)
            spaced[np.repeat(new_starts - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(int(length.sum()))] = (
                data[word]
            )
            data, starts, ends = spaced, new_starts, new_ends
        made, owner = [], []
        doc = np.repeat(np.arange(len(run)), n_words)
        for k in range(orders[0], orders[1] + 1):
            whole = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
            made.append(crc32_spans(data, starts[whole], ends[whole + k - 1]) % np.uint32(buckets))
            owner.append(doc[whole])
        bucket, owner = np.concatenate(made), np.concatenate(owner)
        if orders[0] < orders[1]:
            order = np.argsort(owner, kind="stable")
            bucket, owner = bucket[order], owner[order]
        yield n_words, np.bincount(owner, minlength=len(run)), bucket


def bucket_counts(docs: DataFrame, orders: tuple[int, int] = (1, 1), buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has any. Each task counts its own features
    before anything is shuffled.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, bucket in feature_buckets(batch.column("text"), orders, buckets):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    counts = has_columns(docs, text="string").mapInArrow(count, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    docs: DataFrame, target: DataFrame, orders: tuple[int, int] = (1, 1), buckets: int = 10_000
) -> DataFrame:
    """(bucket, gain): floor(1000 ln) of the smoothed ratio of the target's share of each bucket to that of `docs`."""
    ours = bucket_counts(docs, orders, buckets).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, orders, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = written(every.join(ours, "bucket", "left").join(theirs, "bucket", "left").na.fill(0, ["s", "t"]), "buckets")
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = ((F.col("t") + 1.0) * (sums["s"] + float(buckets))) / ((F.col("s") + 1.0) * (sums["t"] + float(buckets)))
    return both.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 g), g a Gumbel draw that depends on the seed and the id alone: from the first 8 hex digits of a SHA-256.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def importance_resample(
    docs: DataFrame, target: DataFrame, orders: tuple[int, int] = (1, 1), buckets: int = 10_000, min_words: int = 20,
    percent: int = 10, seed: int = 2024
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight, score, rank) of every row of `docs`; the rows with a rank are
    the sample.

    A document's weight is the floored mean of its features' gains (none: 0), its score the weight plus 1000 times a
    Gumbel draw; of the N documents with `min_words` words or more the floor(percent N / 100) highest scores are drawn
    without replacement, ties to the smaller doc_id (null last), then to the smaller text hash; equal rows are drawn
    one after the other. A null text has no words. Extra columns are left out; an empty target weighs all buckets by
    `docs` alone; an empty `docs` gives no rows.

    Texts are read twice, for the counts and for the weights, and never shuffled; the weights, a narrow row a document,
    are written before they are ranked. What the tasks of the second reading
    get is one number a bucket, so its size is bounded by `buckets`. Ranks are running totals over range partitions,
    so no partition holds more than its share, whatever the ties.
    """
    import numpy as np

    spark = docs.sparkSession
    ship(spark)
    gains = np.zeros(buckets, np.int64)
    for row in bucket_gains(docs, target, orders, buckets).collect():  # one row a bucket
        gains[row["bucket"]] = row["gain"]
    shared = spark.sparkContext.broadcast(gains)

    def weigh(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at = 0
            for n_words, n, bucket in feature_buckets(batch.column("text"), orders, buckets):
                sums = np.r_[0, np.cumsum(shared.value[bucket])]
                upto = np.cumsum(n)
                weight = (sums[upto] - sums[upto - n]) // np.maximum(n, 1)
                rows = [c.slice(at, len(n)) for c in batch.select(["doc_id", "digest"]).columns]
                made = [pa.array(x.astype(np.int64)) for x in (n_words, n, weight)]
                yield pa.RecordBatch.from_arrays([*rows, *made], ["doc_id", "digest", "n_words", "n", "weight"])
                at += len(n)

    rows = has_columns(docs, doc_id="long", text="string").select("doc_id", "text", text_hash(F.col("text")).alias("digest"))
    rows = written(rows.mapInArrow(weigh, "doc_id long, digest long, n_words long, n long, weight long"), "weights")
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    rows = rows.withColumn("score", score).withColumns({
        "able": (F.col("n_words") >= min_words).cast("long"), "worst": -F.col("score"),
        "no_id": F.col("doc_id").isNull(), "row": F.monotonically_increasing_id(),
    })
    ranked = running_total(rows.withColumn("late", -F.col("able")), "able", "late", "worst", "no_id", "doc_id", "digest", "row")
    able = ranked.agg(F.coalesce(F.sum("able"), F.lit(0))).first()[0]
    drawn = (F.col("able") == 1) & (F.col("before") < able * percent // 100)
    return ranked.select(
        "doc_id", F.col("digest").alias("text_hash"), "n_words", F.col("n").alias("n_features"), "weight", "score",
        F.when(drawn, F.col("before") + 1).alias("rank"),
    )
