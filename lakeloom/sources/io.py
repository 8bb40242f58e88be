"""Reading and writing tables: pruned scans, external files, snapshots, partitioned and audited writes."""

from __future__ import annotations

import csv
import io
import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir; a temporary one only where that is
    unset.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not conf and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or "file://" + tempfile.mkdtemp(prefix="lakeloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_table(
    spark: SparkSession, root: str, name: str, columns: list[str] | None = None, since: Column | None = None,
    time_col: str = "ingest_time"
) -> DataFrame:
    """A Parquet table by name, its columns pruned and its rows after `since`, both of which reach the scan."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    df = df if since is None else df.where(F.col(time_col) > since)
    return df.select(*columns) if columns else df


def read_csv_rows(spark: SparkSession, text: str, types: dict[str, str] | None = None) -> DataFrame:
    """Inline CSV with a header as rows of text; empty cells are null; `types` casts by column."""
    header, *rows = [r for r in csv.reader(io.StringIO(text.strip())) if r]
    header = [h.strip() for h in header]
    rows = [[(v.strip() or None) for v in r] + [None] * (len(header) - len(r)) for r in rows]
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


def read_external_files(spark: SparkSession, path: str, columns: list[str], header_rows: int = 1) -> DataFrame:
    """CSV files as text columns of a declared schema, without each file's first rows."""
    df = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", header_rows == 1).csv(path)
    if header_rows <= 1:
        return df
    numbered = df.select(
        "*", F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"),
        F.col("_metadata.file_path").alias("_file")
    )
    first = numbered.groupBy("_file").agg(F.min_by("_id", F.struct("_at", "_id")).alias("_first"))
    return numbered.join(first, "_file").where(F.col("_id") >= F.col("_first") + header_rows).select(*columns)


def inline_rows(spark: SparkSession, rows: list[dict], id_column: str = "id") -> DataFrame:
    """Literal rows as a small dimension, numbered in the order given."""
    return spark.createDataFrame([Row(**{id_column: i, **r}) for i, r in enumerate(rows, 1)])


def read_date_suffixed(spark: SparkSession, root: str, prefix: str, start: str, end: str) -> DataFrame:
    """Tables named prefix + yyyyMMdd, those from start to end, with `suffix`; Spark lists the folder, on any file
    system.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"/{prefix}(\d{{8}})[/.]", 1)
    df = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(f"{root}/{prefix}*")
    return df.select("*", name.alias("suffix")).where(F.col("suffix").between(start, end))


def truncate_insert(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_cutoff_snapshot(df: DataFrame, path: str, as_of: Column, grain: str = "hour") -> None:
    """Appends a copy stamped with the truncated time, in a partition of its date."""
    stamped = df.withColumn(
        "cutoff_timestamp", F.date_trunc(grain, as_of)
    ).withColumn("cutoff_date", F.to_date("cutoff_timestamp"))
    stamped.write.mode("append").partitionBy("cutoff_date").parquet(path)


def write_partitioned(
    df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    """Partition folders, rows sorted inside files by the clustering columns; only the partitions that df has are
    replaced.

    Rows are dealt by the partition and clustering columns together, so a partition with very many rows is written by
    many tasks.
    """
    if cluster_by:
        df = df.repartitionByRange(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def audit_row(spark: SparkSession, name: str, retry: int, at: Column, props: dict) -> DataFrame:
    """A log row: uuid, name, retry, time and JSON properties."""
    return spark.range(1).select(
        F.uuid().alias("id"), F.lit(name).alias("name"), F.lit(retry).alias("retry"), at.alias("at"),
        F.lit(json.dumps(props, sort_keys=True)).alias("props")
    )


def export_events_json_shape(
    df: DataFrame, event_type: str, user: str, at: str, product: str, quantity: str
) -> DataFrame:
    """One event in a recommender's feed form for each row: type, visitor, RFC 3339 time, and an array of product
    structs.
    """
    return df.select(
        F.lit(event_type).alias("eventType"),
        F.col(user).cast("string").alias("visitorId"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        F.array(
            F.struct(
                F.struct(F.col(product).cast("string").alias("id")).alias("product"),
                F.col(quantity).cast("int").alias("quantity")
            )
        ).alias("productDetails"),
    )
