"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeloom.operators.cdc import change_order


def read_log_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """An append-only change log as a stream of its new files."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return reader.parquet(path)


def _path(spark: SparkSession, where: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def upsert_sink(
    path: str, staging: str, keys: list[str], partition: str, schema: StructType
) -> Callable[[DataFrame, int], None]:
    """A sink for foreachBatch: rows of a batch replace the table's rows of equal keys (null is a key). Only the
    partitions that the batch's rows lie in are read and rewritten; a key's rows must always have the same partition.

    A batch has one row a key. Its partitions are written to `staging` first; a batch that runs again after a failure
    takes them from there, so that a half-replaced partition is whole again. Staged copies of older batches are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        staged, fs = _path(spark, f"{staging}/batch={number}/_SUCCESS")
        if not fs.exists(staged):
            batch.select(*schema.names).write.mode("overwrite").parquet(f"{staging}/news={number}")
            news = spark.read.schema(schema).parquet(f"{staging}/news={number}")
            # no more values than the table has partitions
            touched = [r[0] for r in news.select(partition).distinct().collect()]
            if not touched:
                return
            rows = news
            table, fs = _path(spark, path)
            if fs.exists(table):
                now = spark.read.schema(schema).parquet(path).where(F.col(partition).isin(touched)).select(*schema.names)
                new = news.select(*(F.col(k).alias(f"_k_{k}") for k in keys))
                same = reduce(lambda a, b: a & b, (now[k].eqNullSafe(new[f"_k_{k}"]) for k in keys))
                rows = now.join(new, same, "left_anti").unionByName(news)
            rows.write.mode("overwrite").parquet(f"{staging}/batch={number}")
        rows = spark.read.schema(schema).parquet(f"{staging}/batch={number}")
        rows.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            partition
        ).parquet(path)
        for name in ("news", "batch"):
            old, fs = _path(spark, f"{staging}/{name}={number - 1}")
            fs.delete(old, True)

    return merge


def stream_current_state(
    log: DataFrame, state_path: str, checkpoint: str, entity: str = "mg_id", buckets: int = 64
) -> StreamingQuery:
    """Keeps the current state of a change log up to date, a batch at a time.

    The winner of each entity lives in Spark's keyed state store: a streaming aggregation in update mode, whose output
    of a batch is the entities that it changed. A sink replaces their rows in the table at `state_path`, dealt to
    `buckets` partitions by hash of the entity; other buckets are not touched, so a batch costs what it changes. State
    rows keep their deletes; late, older changes lose against the row that is there, however late they come, since
    nothing is dropped by a watermark. A restart goes on from the checkpoint. For states over executor memory choose the
    RocksDB state store.
    """
    place = F.struct(*change_order(log))
    won = log.groupBy(entity).agg(F.max_by(F.struct(*log.columns), place).alias("_row")).select("_row.*")
    won = won.withColumn("bucket", F.pmod(F.hash(entity), F.lit(buckets)))
    return (
        won.writeStream
        .outputMode("update")
        .foreachBatch(upsert_sink(state_path, f"{checkpoint}-staging", [entity], "bucket", won.schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, state_path: str, schema: StructType) -> DataFrame:
    """The living entities of a state, with the log's columns."""
    return spark.read.schema(schema).parquet(state_path).select(*schema.names).where("action <> 'd'")


def dedup_message_stream(raw: DataFrame, at: str = "publish_time", delay: str = "10 minutes") -> DataFrame:
    """One row for each message_id, for repeats that come within the delay."""
    return raw.withWatermark(at, delay).dropDuplicatesWithinWatermark(["message_id"])


def windowed_counts(
    events: DataFrame, at: str, keys: list[str], size: str = "1 hour", delay: str = "0 seconds"
) -> DataFrame:
    """Rows by tumbling window and keys; batch and stream alike."""
    events = events.withWatermark(at, delay) if events.isStreaming else events
    counts = events.groupBy(F.window(at, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("slot"), *keys, "n")


def windowed_count_stream(
    events: DataFrame, at: str, keys: list[str], path: str, checkpoint: str, size: str = "1 hour", delay: str = "1 day"
) -> StreamingQuery:
    """Keeps the table at `path` (slot, keys, n, day) of counts by tumbling window up to date with a stream.

    A row that comes up to `delay` after the newest one seen amends its window: changed windows leave the state store
    in update mode and replace their rows, in the partitions of their days only. Later rows are dropped, and counted by
    late_rows(). Windows older than the delay leave the state.
    """
    counts = windowed_counts(events, at, keys, size, delay).withColumn("day", F.to_date("slot"))
    return (
        counts.writeStream
        .outputMode("update")
        .foreachBatch(upsert_sink(path, f"{checkpoint}-staging", ["slot", *keys], "day", counts.schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """How many rows came too late for their window, of the batches that the query still tells of. Rows of one window and
    keys that came in one task count as one, as they are added up before they meet the state.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_to_end(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs a stream over all that is there now."""
    df.writeStream.foreachBatch(each).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
