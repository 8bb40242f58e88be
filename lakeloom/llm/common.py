"""What the corpus operators share: shared folders, written tables, row keys, ASCII text rules."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six ASCII white-space characters, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


def session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a temporary one only where that is unset
    and Spark runs on one machine.
    """
    sc = spark.sparkContext
    if where := sc.getConf().get("spark.checkpoint.dir"):
        return where.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not (where := getattr(sc, "_lakeloom_dir", None)):
        where = sc._lakeloom_dir = "file://" + tempfile.mkdtemp(prefix="lakeloom-")
    return where


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The rows, written once to the shared folder and read again: lineage ends here and survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lakeloom_path = path
    return out


def bucketed(df: DataFrame, name: str, key: str, dealt: bool = False) -> DataFrame:
    """As written(), dealt by hash of `key` to as many buckets as there are shuffle partitions, so that joins and
    groupings by it need no exchange.

    Each bucket is one sorted file; `dealt` says that the rows are dealt so already.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    n, table_name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"lakeloom_{uuid.uuid4().hex}"
    (
        df if dealt else df.repartition(n, key)
    ).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table_name)
    out = spark.table(table_name)
    out._lakeloom_path, out._lakeloom_table = path, table_name
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a table from written() or bucketed() that nothing reads any more."""
    if name := getattr(df, "_lakeloom_table", None):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    if path := getattr(df, "_lakeloom_path", None):
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark context, so that tasks can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_lakeloom_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    into = Path(tempfile.mkdtemp(prefix="lakeloom-"))
    copy = into / "src" / root.name
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(into / root.name), "zip", into / "src"))
    sc._lakeloom_shipped = True


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; plain lower() where every byte is ASCII, which is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def has_columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast; other columns of the input can't clash with an operator's own."""
    return df.select(*(F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()))


def text_hash(text: Column) -> Column:
    """Tells texts of one doc_id apart; null has a value of its own."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def crc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))
