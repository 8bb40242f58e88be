"""Queries over the given tables, each with SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame; `sql` runs on DuckDB over the same tables."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; zone-less times are read as instants in UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


#: A change log from the events table, as `events` has no deletes of its own: by day, so that an entity has ties.
LOG = """log AS (
    SELECT event_id AS key, user_id AS mg_id, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'i' ELSE 'u' END
    AS action,
           CAST(ts AS DATE) AS synced_at, ts AS ingest_time, value, props FROM events
)"""


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "i").otherwise("u")
    return t(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"), F.col("user_id").alias("mg_id"), action.alias("action"),
        F.to_date("ts").cast("timestamp").alias("synced_at"), F.col("ts").alias("ingest_time"), "value", "props"
    )


def day(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d')"


def day_text(x):
    return F.date_format(x, "yyyy-MM-dd")
