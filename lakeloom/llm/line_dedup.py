"""Line dedup: levelled sorted runs of line hashes, in DataFrame operations only."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, bucketed, discard, text_hash, written


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs as one: a merge of their buckets, counts added."""
    both = a.join(b.withColumnRenamed("n_docs", "more"), "hash", "full_outer")
    return both.select("hash", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"))


class LineRuns:
    """Counts of documents by line hash, kept as sorted runs on levels.

    A run is a table (hash, n_docs) in buckets of the hash, each one sorted file, so that runs are merged and batches
    anti-joined bucket by bucket: two runs are merged without a shuffle, of more (a `fanout` over two) the sums are
    shuffled. A batch of documents adds one run on level 0. As soon as a level holds `fanout` runs they are merged,
    counts added, into one run of the next level, so that about fanout * log(batches) runs exist at any time and each
    entry is rewritten once a level. Hashes that an earlier run already settles (at least `settled` documents) aren't
    added again: the batch is anti-joined to each run, so very common lines stop growing the index.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2, settled: int | None = None):
        self.spark, self.fanout, self.settled = spark, fanout, settled
        self.levels: list[list[DataFrame]] = [[]]

    def _run(self, counts: DataFrame, level: int, dealt: bool = False) -> DataFrame:
        return bucketed(counts, f"run-{level}", "hash", dealt)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def counts(self) -> DataFrame | None:
        """(hash, n_docs) over all runs."""
        runs = self.runs()
        if not runs:
            return None
        return functools.reduce(_merged, runs)

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch's (hash, n_docs), one row a hash; returns the run that was added."""
        for run in self.runs() if self.settled is not None else ():
            batch = batch.join(run.where(F.col("n_docs") >= self.settled), "hash", "left_anti")
        run = self._run(batch, 0)
        self.levels[0].append(run)
        self._compact()
        return run

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose hash is in no run so far."""
        for run in self.runs():
            batch = batch.join(run, "hash", "left_anti")
        return batch

    def _compact(self) -> None:
        for level in range(64):
            if level >= len(self.levels) or len(self.levels[level]) < self.fanout:
                return
            full, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._run(functools.reduce(_merged, full), level + 1, dealt=True))
            for run in full:
                discard(run)


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, n_batches: int = 4, fanout: int = 2,
    keep: tuple[str, ...] = ()
) -> DataFrame:
    """Drops every line whose key is found in at least `min_docs` documents.

    Returns doc_id, text (the kept lines joined by a line feed), n_lines, n_dropped and the columns named in `keep`; one
    row for each input row. Keys under `min_chars` code points (so empty lines) always stay. A null or empty text is one
    empty line. Each input row counts as one document, whatever its doc_id, null included; a repeated row gets its
    result each time. Other columns are left out. An empty table gives an empty result.

    Lines are hashed (MD5) into one narrow row a document, written once. The documents' hashes then enter the sorted
    runs batch by batch; hashes over the threshold are looked up by a join that Spark may split where a key is hot, and
    only flags, no texts, are grouped back to documents.
    """
    spark = docs.sparkSession
    carried = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), carried.alias("carried"))
    docs = docs.withColumn("text_hash", text_hash(F.col("text")))
    long_enough = lambda key: F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key)))
    hashed = docs.select(
        "doc_id", "text_hash",
        F.transform(split_lines(F.col("text")), lambda line: long_enough(line_key(line))).alias("hashes"),
        F.pmod(F.hash("doc_id", "text_hash"), F.lit(n_batches)).alias("batch"),
    )
    hashed = written(hashed, "line-hashes", "batch")
    runs = LineRuns(spark, fanout, settled=min_docs)
    for k in range(n_batches):
        batch = hashed.where(F.col("batch") == k).select(F.explode(F.array_distinct("hashes")).alias("hash"))
        runs.add(batch.where("hash IS NOT NULL").groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs")))
    # Written, so that its size is known to the join, which Spark can then split where a hash is hot.
    common = written(runs.counts().where(F.col("n_docs") >= min_docs).select("hash"), "common-lines")

    lines = hashed.select("doc_id", "text_hash", F.posexplode("hashes").alias("pos", "hash"))
    dropped = (
        lines
        .join(common, "hash", "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    return _without(docs, dropped).select(
        "doc_id", "text", "n_lines", "n_dropped", *(F.col("carried")[c].alias(c) for c in keep)
    )


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    d, x = docs.alias("d"), dropped.alias("x")
    joined = d.join(
        x, F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("d.text_hash") == F.col("x.text_hash")), "left"
    )
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(_kept(lines, F.col("dropped")), "\n")
    )
    return joined.select(
        F.col("d.doc_id"), "carried", F.coalesce(kept, F.lit("")).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped")
    )


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped positions, slice by slice; `lines` is bound to a variable, so a text is split once.
    """
    ends = F.concat(F.array_sort(dropped), F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(F.array_sort(dropped), lambda p: p + 1))
    between = F.transform(
        F.array(lines),
        lambda all_lines: F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(all_lines, a + 1, b - a)))
    )
    return F.element_at(between, 1)
