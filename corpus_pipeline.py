"""From raw documents to packed training sequences: the corpus operators one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import table, text_hash, written
from lakeloom.llm.inverted import decontaminate
from lakeloom.llm.line_dedup import line_dedup
from lakeloom.llm.pack import pack
from lakeloom.llm.quality import score_quality, train
from lakeloom.llm.queries import vocabulary
from lakeloom.llm.simhash import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF scores at 0.3 or more stay.

    A null or empty text is one empty line and scored like any other; repeated rows stay or go together, null ids are kept
    out of the training only, and extra columns, also those of clashing names, are left out. An empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, "quality_score").where("quality_score >= 0.3").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays, with the length of its new text.

    A null text is one empty line, so it comes out empty. Each row counts as a document, whatever its id; extra columns are
    left out.
    """
    out = line_dedup(docs, min_docs=10, min_chars=1, keep=("lang", "source"))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: of the least doc_id (null last), and of the least text hash
    where that id repeats.

    Groups link documents by SimHash fingerprints of their sets of 5-word shingles, at the radius of a Jaccard
    similarity of 0.8. Of rows equal in id and text one stays, and so of null texts; clashing extra columns are left
    out.
    """
    docs = docs.select(*COLUMNS)
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    kept = written(
        near_duplicates(docs, words=5, similarity=0.8).where("kept").select(
            key, F.col("text_hash").alias("digest")
        ).distinct(),
        "kept"
    )
    chosen = docs.select("*", key, text_hash(F.col("text")).alias("digest")).join(kept, ["key", "digest"], "left_semi")
    return chosen.dropDuplicates(["key", "digest"]).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in twenty inside a benchmark phrase go.

    Rows are judged by id and text, so those of one id with different texts on their own; null texts have no words and
    stay; extra columns are left out.
    """
    docs = docs.select(*COLUMNS)
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    found = decontaminate(
        docs, table(spark, sf_dir, "benchmark")
    ).where("contaminated").select(key, F.col("text_hash").alias("digest"))
    found = written(found.distinct(), "contaminated")
    return (
        docs
        .select("*", key, text_hash(F.col("text")).alias("digest"))
        .join(found, ["key", "digest"], "left_anti")
        .select(*COLUMNS)
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens, in the proportions of their sources.

    A null or empty text has the end id alone; null ids and repeated rows are packed each; a null source is a source of its
    own; extra columns are left out; an empty table gives no pieces.
    """
    return pack(docs, vocabulary("word_bpe_49k.json"), end_id=1, window=2048, packet=128)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("near-duplicate removal", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The first stage learns a model, which SQL can't express; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
