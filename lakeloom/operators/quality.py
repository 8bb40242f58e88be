"""Checks that return failing rows, reports on change logs, and repairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cdc import latest_by_key
from .scans import exact_quantiles


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def in_touched_partitions(df: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """The rows of the partitions in which changed rows lie; a null partition is one."""
    parts = touched.select(F.col(partition).alias("_p")).distinct()
    return df.join(parts, df[partition].eqNullSafe(parts["_p"]), "left_semi")


def failing_keys(
    df: DataFrame, key_sets: list[list[str]], touched: DataFrame | None = None, partition: str | None = None
) -> DataFrame:
    """(keys, value, n): every value of each set of keys that more than one row has, one row each, whatever their number;
    with `touched`, among the rows of the partitions that it lies in.
    """
    df = df if touched is None else in_touched_partitions(df, touched, partition)

    def one(keys: list[str]) -> DataFrame:
        value = F.concat_ws(",", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
        return check_unique(df, keys).select(F.lit(",".join(keys)).alias("keys"), value.alias("value"), "n")

    return reduce(DataFrame.unionByName, map(one, key_sets))


def unique_assertion(
    df: DataFrame, key_sets: list[list[str]], at_most: int | None = None, touched: DataFrame | None = None,
    partition: str | None = None
) -> DataFrame:
    """One row for each set of keys: the keys, how many of their values repeat, and the values that do, least first, in an
    array of all of them, or of `at_most` for a short report. failing_keys() has them as rows, for tables in which very
    many may fail.
    """
    failed = failing_keys(df, key_sets, touched, partition)
    w = Window.partitionBy("keys").orderBy("value")
    some = failed if at_most is None else failed.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= at_most)
    n = failed.groupBy("keys").agg(F.count(F.lit(1)).alias("failures"))
    examples = some.groupBy("keys").agg(F.sort_array(F.collect_list("value")).alias("examples"))
    every = df.sparkSession.createDataFrame([(",".join(k),) for k in key_sets], "keys string")
    out = every.join(n, "keys", "left").join(examples, "keys", "left")
    return out.select("keys", F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def check_not_null(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """One row for each null in the named columns, with the reason."""
    reasons = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in columns)))
    return df.select(*keep, F.explode(reasons).alias("reason"))


def check_rows(df: DataFrame, conditions: dict[str, Column | str], keep: list[str]) -> DataFrame:
    """One row for each named condition that doesn't hold; a null condition counts as failed."""
    said = {n: F.expr(c) if isinstance(c, str) else c for n, c in conditions.items()}
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in said.items())))
    return df.select(*keep, F.explode(failed).alias("failed"))


def check_expected(df: DataFrame, golden: DataFrame, keys: list[str]) -> DataFrame:
    """Golden rows that the table doesn't have as given, with both values as text; a missing row has nulls."""
    values = [c for c in golden.columns if c not in keys]
    actual = df.select(*keys, *(F.col(c).alias(f"actual_{c}") for c in values))
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"actual_{c}")) for c in values))
    return golden.join(actual, keys, "left").where(differs)


def check_coverage(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the source that the target lacks, each once."""
    return source.select(*keys).subtract(target.select(*keys))


def check_balance(df: DataFrame, group: list[str], lhs: Column, rhs: Column, tolerance: float = 0.0) -> DataFrame:
    """Groups whose two sums differ."""
    sums = df.groupBy(*group).agg(lhs.alias("lhs"), rhs.alias("rhs"))
    return sums.where(F.abs(F.coalesce("lhs", F.lit(0)) - F.coalesce("rhs", F.lit(0))) > tolerance)


def mismatch_report(log: DataFrame, state: DataFrame, entity: str = "mg_id") -> DataFrame:
    """How a state table differs from its log: kind, entity and how often the entity had each action, that of the newest
    change first.

    DELETED_RECORDS: in the state, but deleted in the log; MISSING_RECORDS: live in the log, not in the state;
    WRONG_UPDATE: another synced_at than the log's newest. One more row, TOTAL COUNT, has the number of live entities in
    `n`.
    """
    narrow = log.select(entity, "action", "synced_at", *(c for c in ("last_updated_time", "key") if c in log.columns))
    newest = latest_by_key(narrow, entity, drop_deleted=False).select(
        entity, "action", F.col("synced_at").alias("log_at")
    )
    both = newest.join(
        state.select(entity, F.col("synced_at").alias("state_at"), F.lit(True).alias("there")), entity, "full"
    )
    live = F.coalesce(F.col("action") != "d", F.lit(False))
    kind = (
        F.when(F.col("there").isNotNull() & (F.col("action") == "d"), "DELETED_RECORDS")
        .when(F.col("there").isNull() & live, "MISSING_RECORDS")
        .when(live & (F.col("log_at") != F.col("state_at")), "WRONG_UPDATE")
    )
    wrong = both.withColumn("kind", kind).where("kind IS NOT NULL").select(entity, "kind")
    # Counted by action before they meet, so that an entity with very many changes costs a few rows.
    counts = (
        narrow
        .join(wrong.select(entity), entity, "left_semi")
        .groupBy(entity, "action")
        .agg(F.max("synced_at").alias("at"), F.count(F.lit(1)).alias("times"))
    )
    history = counts.groupBy(entity).agg(
        F.sort_array(F.collect_list(F.struct("at", "action", "times")), asc=False).alias("history")
    )
    told = F.array_join(
        F.transform("history", lambda h: F.concat(h["action"], F.lit(" "), h["times"].cast("string"))), ","
    )
    found = wrong.join(history, entity).select(
        "kind", F.col(entity).cast("string").alias("entity"), told.alias("actions"), F.lit(1).cast("long").alias("n")
    )
    total = newest.agg(F.count_if(F.col("action") != "d").alias("n")).select(
        F.lit("TOTAL COUNT").alias("kind"), F.lit(None).cast("string").alias("entity"),
        F.lit(None).cast("string").alias("actions"), "n"
    )
    return found.unionByName(total)


def mismatch_percent(report: DataFrame) -> float:
    """Mismatches in percent of the live entities, rounded to whole percents."""
    row = report.agg(
        F.sum(F.when(F.col("kind") == "TOTAL COUNT", F.col("n"))).alias("total"),
        F.count_if(F.col("kind") != "TOTAL COUNT").alias("wrong")
    ).first()
    return float(round(100 * row["wrong"] / row["total"])) if row["total"] else (100.0 if row["wrong"] else 0.0)


def mismatch_gate(
    report: Callable[[], DataFrame], rebuild: Callable[[], None], percent: float = 1.0, retries: int = 2
) -> list[dict]:
    """Rebuilds while the mismatch is at least `percent`, up to `retries` times, then fails; returns the log of
    attempts.
    """
    log = []
    for attempt in range(retries + 1):
        now = mismatch_percent(report())
        log.append({"attempt": attempt, "percent": now, "passed": now < percent})
        if now < percent:
            return log
        if attempt < retries:
            rebuild()
    raise RuntimeError(f"mismatch of {log[-1]['percent']} % after {retries} rebuilds")


def keep_newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return (
        df
        .withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .where("_n = 1")
        .drop("_n")
    )


def repair_duplicates(
    read: Callable[[], DataFrame], write: Callable[[DataFrame], None], keys: list[str], order: list[Column],
    retries: int = 2
) -> list[dict]:
    """Rewrites the table with the newest row of each key until the check is clean, up to `retries` times; returns the
    log.
    """
    log = []
    for attempt in range(retries + 1):
        n = check_unique(read(), keys).count()
        log.append({"attempt": attempt, "duplicates": n})
        if not n:
            return log
        if attempt < retries:
            write(keep_newest(read(), keys, order))
    raise RuntimeError(f"{log[-1]['duplicates']} keys still repeat")


def guarded_snapshot_repair(
    read: Callable[[], DataFrame], write: Callable[[DataFrame], None], snapshot: Callable[[DataFrame], None],
    keys: list[str], order: list[Column]
) -> bool:
    """Where keys repeat: saves the bad table, rewrites one row for each key, and asserts that it is clean. True if it
    repaired.
    """
    if check_unique(read(), keys).isEmpty():
        return False
    snapshot(read())
    write(keep_newest(read(), keys, order))
    if not check_unique(read(), keys).isEmpty():
        raise RuntimeError("keys still repeat after the repair")
    return True


def latency_profile(log: DataFrame, group: list[str], start: str = "synced_at", end: str = "ingest_time") -> DataFrame:
    """Seconds from start to end by group: avg, min, max and the 50th, 90th and 95th percentiles, all exact."""
    seconds = F.unix_micros(end) / F.lit(1e6) - F.unix_micros(start) / F.lit(1e6)
    rows = log.groupBy(*group, seconds.alias("seconds")).agg(F.count(F.lit(1)).alias("_times"))
    known = F.sum(F.when(F.col("seconds").isNotNull(), F.col("_times")))
    mean = F.try_divide(F.sum(F.col("seconds") * F.col("_times")), known)
    out = rows.groupBy(*group).agg(mean.alias("avg"), F.min("seconds").alias("min"), F.max("seconds").alias("max"))
    return exact_quantiles(rows, group, "seconds", {"p50": 50, "p90": 90, "p95": 95}, out, times="_times")


def throughput(log: DataFrame, at: str, size: Column, grain: str = "hour") -> DataFrame:
    """Rows and bytes by hour (or another grain), and the change against the one before."""
    hours = log.groupBy(F.date_trunc(grain, at).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")
    )
    before = Window.orderBy("slot")  # one row for each slot of the calendar
    return hours.withColumns(
        {"n_change": F.col("n") - F.lag("n").over(before), "bytes_change": F.col("bytes") - F.lag("bytes").over(before)}
    )


def table_freshness(df: DataFrame, times: list[str], start: Column, end: Column, grain: str = "hour") -> DataFrame:
    """Counts of each named time by slot, for every slot of the spine from start to end, zero where there are none."""
    spark = df.sparkSession
    spine = spark.range(1).select(
        F.explode(
            F.sequence(F.date_trunc(grain, start), F.date_trunc(grain, end), F.expr(f"INTERVAL 1 {grain}"))
        ).alias("slot")
    )
    slots = F.array(*(F.struct(F.lit(t).alias("name"), F.date_trunc(grain, F.col(t)).alias("slot")) for t in times))
    counts = df.select(F.explode(slots).alias("s")).groupBy("s.slot").pivot("s.name", times).count()
    return spine.join(
        counts.select(F.col("slot"), *(F.col(t).alias(f"n_{t}") for t in times)), "slot", "left"
    ).na.fill(0)


def job_cost_usage(jobs: DataFrame, group: list[str], size: str, failed: Column) -> DataFrame:
    """Jobs, failures and size by group and day."""
    return jobs.groupBy(*group).agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if(failed).alias("failures"), F.sum(size).alias("size"),
        F.max(size).alias("largest")
    )


def compare_series(a: DataFrame, b: DataFrame, grains: list[str], value: str) -> DataFrame:
    """One metric from two pipelines by grain: both sums, their difference, and which side lacks it."""
    x = a.groupBy(*grains).agg(F.sum(value).alias("a"))
    y = b.groupBy(*grains).agg(F.sum(value).alias("b"))
    side = F.when(F.col("a").isNull(), "only b").when(F.col("b").isNull(), "only a").otherwise("both")
    return x.join(y, grains, "full").withColumns(
        {"side": side, "difference": F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))}
    )


def full_refresh_compare(incremental: DataFrame, full: DataFrame) -> DataFrame:
    """Rows of one but not the other, repeats counted."""
    full = full.select(*incremental.columns)
    return (
        incremental
        .exceptAll(full)
        .withColumn("side", F.lit("incremental"))
        .unionByName(full.exceptAll(incremental).withColumn("side", F.lit("full")))
    )
