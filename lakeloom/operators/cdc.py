"""Change logs to current state: dedup, merge, incremental refresh and repair.

A change log has `key` (row id), `mg_id` (entity), `action` (i, u, d), `synced_at`, `ingest_time` and payload columns.
Where two changes of an entity have the same `synced_at`, a delete beats an update, an update an insert; then the later
`last_updated_time`, then the greater `key` wins, so that every order is total.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.columns import safe_cast


def action_rank(action: str = "action") -> Column:
    return F.when(F.col(action) == "d", 3).when(F.col(action) == "u", 2).otherwise(1)


def change_order(df: DataFrame, by_action: bool = True) -> list[Column]:
    """What tells which of an entity's changes is newer, ascending."""
    out = [F.col("synced_at")] + ([action_rank()] if by_action else [])
    return out + [F.col(c) for c in ("last_updated_time", "key") if c in df.columns]


def latest_by_key(
    log: DataFrame, keys: list[str] | str = "mg_id", drop_deleted: bool = True, by_action: bool = True
) -> DataFrame:
    """The newest change of each entity; an entity whose newest change is a delete is dropped."""
    keys = [keys] if isinstance(keys, str) else keys
    rank = Window.partitionBy(*keys).orderBy(*(c.desc_nulls_last() for c in change_order(log, by_action)))
    out = log.withColumn("_n", F.row_number().over(rank)).where("_n = 1").drop("_n")
    return out.where("action <> 'd'") if drop_deleted else out


def winning_key_semi_join(
    log: DataFrame, entity: str = "mg_id", row_id: str = "key", drop_deleted: bool = True, by_action: bool = True
) -> DataFrame:
    """latest_by_key for wide rows: a narrow, map-side combined maximum finds the winning row ids, and only those wide
    rows are moved.
    """
    place = F.struct(*change_order(log, by_action), F.col("action").alias("_action"))
    best = (
        log
        .select(entity, row_id, place.alias("_place"))
        .groupBy(entity)
        .agg(F.max("_place").alias("_place"), F.max_by(row_id, "_place").alias(row_id))
    )
    best = best.where("_place._action <> 'd'") if drop_deleted else best
    wide = (
        log
        .join(best.select(entity, row_id, F.col("_place.synced_at").alias("_at")), [entity, row_id])
        .where(F.col("synced_at") == F.col("_at"))
        .drop("_at")
    )
    # a row id may repeat
    again = Window.partitionBy(entity).orderBy(*(c.desc_nulls_last() for c in change_order(log, by_action)))
    return wide.withColumn("_n", F.row_number().over(again)).where("_n = 1").drop("_n")


def incremental_current_state(
    log: DataFrame, target: DataFrame | None, overlap: str = "1 hour", lookback: str = "3 hours",
    checkpoint: str = "ingest_time"
) -> DataFrame:
    """The current state after the log's new rows: untouched rows of the target, and the winners of touched entities.

    The checkpoint is the target's greatest ingest time less `overlap`; winners are looked for from `lookback` before
    that, and compared with the target's own row, so that a late and older change doesn't replace a newer one. A state
    keeps its deletes as rows (`action` d), which readers drop, so that an older change can't bring an entity back.
    """
    if target is None:
        return latest_by_key(log, drop_deleted=False)
    since = target.agg((F.max(checkpoint) - F.expr(f"INTERVAL {overlap}")).alias("_since"))
    # with one row
    late = log.crossJoin(F.broadcast(since)).where(
        F.col("_since").isNull() | (F.col(checkpoint) > F.col("_since") - F.expr(f"INTERVAL {lookback}"))
    )
    fresh = late.where(F.col("_since").isNull() | (F.col(checkpoint) > F.col("_since"))).select("mg_id").distinct()
    touched = late.drop("_since").join(fresh, "mg_id", "left_semi")
    before = target.join(fresh, "mg_id", "left_semi")
    winners = latest_by_key(touched.unionByName(before, allowMissingColumns=True), drop_deleted=False)
    return target.join(fresh, "mg_id", "left_anti").select(*target.columns).unionByName(winners.select(*target.columns))


def refresh_partitions(
    log: DataFrame, path: str, staging: str, partition: str, as_of: str, cutoff_days: int = 7, overlap: str = "1 hour",
    lookback: str = "3 hours", checkpoint: str = "ingest_time", undated: str = "2099-01-01",
) -> bool:
    """Brings the table at `path` up to date with the log, rewriting only the partitions that touched entities lie in;
    False where nothing was new.

    The checkpoint is the greatest ingest time in the partitions of the last `cutoff_days` before `as_of` (of all, where
    they hold none), less `overlap`; the partition `undated` of rows without a date isn't one of the last days. Entities with a later change are touched; their winners come from the log since `lookback`
    before that and from their own row. Their old rows leave their partitions, and the winners enter those of their own
    `partition` value, a date. Deletes stay as rows (`action` d), which readers drop. The new partitions are written to
    `staging` first, as a table can't be overwritten while it is read.
    """
    spark = log.sparkSession
    try:
        target = spark.read.schema(log.schema).parquet(path)
    except AnalysisException:  # there is no table yet
        latest_by_key(log, drop_deleted=False).write.partitionBy(partition).parquet(path)
        return True
    recent = (
        target
        .where((F.col(partition) >= F.date_sub(F.lit(as_of).cast("date"), cutoff_days)) & (F.col(partition) != F.lit(undated).cast("date")))
        .agg(F.max(checkpoint))
        .first()[0]
    )
    since = recent or target.agg(F.max(checkpoint)).first()[0]
    from_ = F.lit(since) - F.expr(f"INTERVAL {overlap}")
    late = log if since is None else log.where(F.col(checkpoint) > from_ - F.expr(f"INTERVAL {lookback}"))
    fresh = late if since is None else late.where(F.col(checkpoint) > from_)
    known = target.select("mg_id", "key", checkpoint)
    news = fresh.join(known, ["mg_id", "key", checkpoint], "left_anti").select("mg_id").distinct()
    before = target.join(news, "mg_id", "left_semi")
    winners = latest_by_key(late.join(news, "mg_id", "left_semi").unionByName(before), drop_deleted=False)
    changed = winners.join(known, ["mg_id", "key", checkpoint], "left_anti")
    changed.write.mode("overwrite").parquet(f"{staging}/winners")
    changed = spark.read.schema(log.schema).parquet(f"{staging}/winners")
    if changed.isEmpty():
        return False
    gone = target.join(changed.select("mg_id"), "mg_id", "left_semi")
    # as many rows as the table has partitions, at most
    parts = gone.select(partition).union(changed.select(partition)).distinct()
    parts.write.mode("overwrite").parquet(f"{staging}/parts")
    parts = spark.read.parquet(f"{staging}/parts")
    kept = target.join(parts, partition, "left_semi").join(changed.select("mg_id"), "mg_id", "left_anti")
    kept.select(*log.columns).unionByName(changed.select(*log.columns)).write.mode("overwrite").parquet(f"{staging}/rows")
    rows = spark.read.schema(log.schema).parquet(f"{staging}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    empty = parts.join(rows.select(partition), partition, "left_anti")  # partitions that their last row left
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for row in empty.toLocalIterator():
        where = hadoop(f"{path}/{partition}={row[0]}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return True


def ignore_changes(log: DataFrame, predicate: Column | str) -> DataFrame:
    """Without the changes for which the predicate holds; where it is null they stay."""
    predicate = F.expr(predicate) if isinstance(predicate, str) else predicate
    return log.where(~F.coalesce(predicate, F.lit(False)))


def dedup_messages(raw: DataFrame) -> DataFrame:
    """One row for each message_id: the latest publish, ties by data."""
    newest = Window.partitionBy("message_id").orderBy(
        F.col("publish_time").desc_nulls_last(), F.col("data").desc_nulls_last()
    )
    return raw.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def cdc_winners(raw: DataFrame, pk_paths: list[str], separator: str = ":::") -> DataFrame:
    """The newest change of each entity from JSON envelopes, deletes included: pk, operation, sync_at, data.

    The key is made of the primary key's parts; by equal sync_at DELETE beats UPDATE beats INSERT; rows without a key
    don't count.
    """
    said = lambda path: F.get_json_object("data", path)
    parts = [F.coalesce(said(f"$.primary_key.{p}"), F.lit("")) for p in pk_paths]
    known = F.coalesce(*(said(f"$.primary_key.{p}") for p in pk_paths)).isNotNull()
    rows = (
        dedup_messages(raw)
        .withColumn("pk", F.when(known, F.concat_ws(separator, *parts)))
        .withColumn("operation", said("$.operation"))
        .withColumn("sync_at", F.try_to_timestamp(said("$.sync_at")))
    )
    rank = F.when(F.col("operation") == "DELETE", 3).when(F.col("operation") == "UPDATE", 2).otherwise(1)
    best = (
        rows
        .where("pk IS NOT NULL")
        .groupBy("pk")
        .agg(
            F.max(F.struct("sync_at", rank.alias("rank"), "publish_time", "message_id", "operation", "data")).alias("w")
        )
    )
    return best.select("pk", "w.operation", "w.sync_at", "w.data")


def typed_projection(
    raw: DataFrame, schema_meta: list[tuple[str, str]], payload: str = "$.after", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed columns from a JSON payload by (name, type) metadata; what can't be read as its type is null; type `json`
    stays text.
    """
    columns = []
    for name, kind in schema_meta:
        value = F.get_json_object("data", f"{payload}.{name}")
        columns.append(
            (
                value if kind in ("json", "string") else F.from_json(value, kind) if kind.startswith("array") else safe_cast(value, kind)
            ).alias(name)
        )
    return raw.select(*keep, *columns)


def evolve_schema(target: DataFrame, schema_meta: list[tuple[str, str]]) -> DataFrame:
    """The target with a null column for each one that the metadata names and it lacks."""
    have = {c.lower() for c in target.columns}
    return target.withColumns(
        {n: F.lit(None).cast("string" if k == "json" else k) for n, k in schema_meta if n.lower() not in have}
    )


def merge_upsert(
    target: DataFrame, winners: DataFrame, key: str = "pk", at: str = "sync_at", operation: str = "operation"
) -> DataFrame:
    """The target after a merge: a delete at least as new removes, a strictly newer change replaces, an unmatched one
    that is no delete is inserted.

    A row whose time is null, and a change without one, compare as neither newer nor older, so that such rows stay as
    they are.
    """
    t, w = target.alias("t"), winners.alias("w")
    both = t.join(w, F.col(f"t.{key}") == F.col(f"w.{key}"), "full")
    has_t, has_w = F.col(f"t.{key}").isNotNull(), F.col(f"w.{key}").isNotNull()
    delete = F.coalesce(F.col(f"w.{operation}") == "DELETE", F.lit(False))
    newer = lambda c: F.coalesce(c, F.lit(False))
    removed = has_w & delete & (~has_t | newer(F.col(f"w.{at}") >= F.col(f"t.{at}")))
    taken = has_w & ~delete & (~has_t | newer(F.col(f"w.{at}") > F.col(f"t.{at}")))
    values = [F.when(taken, F.col(f"w.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return both.where(~removed & (has_t | taken)).select(*values)


def base_plus_delta_view(
    base: DataFrame, delta: DataFrame, key: str = "pk", at: str = "sync_at", operation: str = "operation"
) -> DataFrame:
    """Base and fresh delta merged at reading: the newest wins, the delta on ties, and a delete hides its row."""
    rows = base.withColumn("_delta", F.lit(0)).unionByName(
        delta.withColumn("_delta", F.lit(1)), allowMissingColumns=True
    )
    newest = Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last(), F.col("_delta").desc())
    rows = rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    return rows.where(F.coalesce(F.col(operation) != "DELETE", F.lit(True))).select(*base.columns)


def base_anti_delta_union(
    base: DataFrame, delta: DataFrame, key: str = "pk", operation: str = "operation"
) -> DataFrame:
    """The base's rows that the delta doesn't touch, and the delta's rows that aren't deletes."""
    return (
        base
        .join(delta.select(key), key, "left_anti")
        .select(*base.columns)
        .unionByName(delta.where(F.coalesce(F.col(operation) != "DELETE", F.lit(True))).select(*base.columns))
    )


def replace_window(target: DataFrame, fresh: DataFrame, time_col: str, start: Column, retain_from: Column) -> DataFrame:
    """The target's rows in [retain_from, start) with the fresh rows from `start` on."""
    return target.where((F.col(time_col) < start) & (F.col(time_col) >= retain_from)).unionByName(
        fresh.where(F.col(time_col) >= start).select(*target.columns)
    )


def append_since(target: DataFrame, df: DataFrame, time_col: str) -> DataFrame:
    """The rows of df that are newer than all of the target's; all where the target is empty."""
    last = target.agg(F.max(time_col).alias("_last"))
    # with one row
    return (
        df
        .crossJoin(F.broadcast(last))
        .where(F.col("_last").isNull() | (F.col(time_col) > F.col("_last")))
        .drop("_last")
    )


def replace_touched_keys(
    target: DataFrame, source: DataFrame, recomputed: DataFrame, keys: list[str], changed: Column
) -> DataFrame:
    """The target with the rows of keys that changed in the source replaced by recomputed ones."""
    touched = source.where(changed).select(*keys).distinct()
    return (
        target
        .join(touched, keys, "left_anti")
        .select(*target.columns)
        .unionByName(recomputed.join(touched, keys, "left_semi").select(*target.columns))
    )


def migrate_merge(main: DataFrame, migrated: DataFrame, entity: str = "mg_id") -> DataFrame:
    """Changes that reconcile a log with a re-extracted table: missing or newer rows, and a delete for each live entity
    absent within the migrated id range.
    """
    state = latest_by_key(main, entity, drop_deleted=False)
    m, s = migrated.alias("m"), state.alias("s")
    newer = (
        m
        .join(s, F.col(f"m.{entity}") == F.col(f"s.{entity}"), "left")
        .where(F.col(f"s.{entity}").isNull() | (F.col("m.synced_at") > F.col("s.synced_at")))
        .select("m.*")
    )
    bounds = migrated.agg(F.min(entity).alias("_low"), F.max(entity).alias("_high"), F.max("synced_at").alias("_at"))
    # with one row
    gone = (
        state
        .where("action <> 'd'")
        .join(migrated.select(entity), entity, "left_anti")
        .crossJoin(F.broadcast(bounds))
    )
    gone = (
        gone
        .where(F.col(entity).between(F.col("_low"), F.col("_high")))
        .withColumn("action", F.lit("d"))
        .withColumn("synced_at", F.greatest("synced_at", "_at"))
    )
    return newer.select(*main.columns).unionByName(gone.select(*main.columns))


def remove_duplicate_batches(df: DataFrame, batch_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the newest extraction batch, and the times of the batches that were removed."""
    last = df.agg(F.max(batch_col).alias("_last"))
    marked = df.crossJoin(F.broadcast(last))  # with one row
    return (
        marked
        .where(F.col(batch_col) == F.col("_last"))
        .drop("_last"), marked
        .where(F.col(batch_col) < F.col("_last"))
        .groupBy(batch_col)
        .agg(F.count(F.lit(1)).alias("removed"))
    )


def swapped_deletes(log: DataFrame, entity: str = "mg_id") -> DataFrame:
    """Pairs of an entity's two newest changes with the same synced_at, one of them a delete: entity, synced_at, delete
    key, runner-up key.
    """
    newest = Window.partitionBy(entity).orderBy(F.col("synced_at").desc(), action_rank().desc(), F.col("key").desc())
    # Each task keeps its entities' two newest before anything is shuffled.
    two = log.withColumn("_n", F.row_number().over(newest)).where("_n <= 2")
    pair = two.groupBy(entity).agg(*(F.max(F.when(F.col("_n") == k, F.struct("key", "action", "synced_at"))).alias(n) for k, n in ((1, "a"), (2, "b"))))
    found = pair.where("a.synced_at = b.synced_at AND a.action = 'd' AND b.action <> 'd'")
    return found.select(entity, F.col("a.synced_at").alias("synced_at"), F.col("a.key").alias("delete_key"), F.col("b.key").alias("runner_up_key"))


def repair_swapped_delete(log: DataFrame, entity: str = "mg_id") -> DataFrame:
    """The log with each such runner-up moved by a microsecond, so that it wins over the delete."""
    moved = swapped_deletes(log, entity).select(
        F.col(entity), F.col("runner_up_key").alias("key"), F.lit(True).alias("_moved")
    )
    out = log.join(moved, [entity, "key"], "left")
    return out.withColumn(
        "synced_at",
        F.when(F.col("_moved"), F.col("synced_at") + F.expr("INTERVAL 1 MICROSECOND")).otherwise(F.col("synced_at"))
    ).select(*log.columns)
