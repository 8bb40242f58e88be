import glob
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cdc
from lakeloom.streaming import stream

LOG = "key string, mg_id string, action string, synced_at timestamp, ingest_time timestamp, last_updated_time timestamp, value int"
T0 = datetime(2024, 1, 1)


def log_rows(seed, n=120, entities=12):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = T0 + timedelta(hours=rnd.randint(0, 30))
        rows.append(
            (
                f"k{i:04}", f"e{rnd.randint(1, entities)}", rnd.choice("iuud"), at, T0 + timedelta(minutes=20 * i),
                at if rnd.random() < 0.7 else None, i
            )
        )
    return rows


def plain_state(rows, deleted=True):
    best = {}
    for r in rows:
        place = (r[3], {"d": 3, "u": 2, "i": 1}[r[2]], r[5] is not None, r[5] or T0, r[0])
        if r[1] not in best or place > best[r[1]][0]:
            best[r[1]] = (place, r)
    return sorted((r[1], r[0]) for _, r in best.values() if deleted or r[2] != "d")


def pairs(df):
    return sorted((r.mg_id, r.key) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_by_key_both_ways(spark, seed):
    rows = log_rows(seed)
    log = spark.createDataFrame(rows, LOG)
    want = plain_state(rows, deleted=False)
    assert pairs(cdc.latest_by_key(log)) == want
    assert pairs(cdc.winning_key_semi_join(log)) == want
    assert pairs(cdc.latest_by_key(log, drop_deleted=False)) == plain_state(rows)


@pytest.mark.parametrize("cuts", [[40], [10, 11, 90], [60, 60, 119]])
def test_incremental_equals_full_refresh_in_any_split(spark, cuts):
    """Changes are ingested in order, but may be much older than what is there already."""
    rows = log_rows(5)
    state = None
    for upto in [*cuts, len(rows)]:
        log = spark.createDataFrame(rows[:upto], LOG)
        state = spark.createDataFrame(cdc.incremental_current_state(log, state).collect(), LOG)
    assert pairs(state) == plain_state(rows)
    again = cdc.incremental_current_state(spark.createDataFrame(rows, LOG), state)
    assert pairs(again) == plain_state(rows)


def test_ignore_changes_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(r.x or 0 for r in cdc.ignore_changes(df, "x = 2").collect()) == [0, 1]


def test_envelopes(spark):
    raw = spark.createDataFrame([
        (
            "m1", T0,
            '{"primary_key":{"a":1,"b":"x"},"operation":"INSERT","sync_at":"2024-01-01 01:00:00","after":{"n":"5","j":{"q":1},"l":[1,2]}}'
        ),
        ("m2", T0, '{"primary_key":{"a":1,"b":"x"},"operation":"DELETE","sync_at":"2024-01-01 01:00:00","after":null}'),
        (
            "m3", T0,
            '{"primary_key":{"a":2,"b":null},"operation":"UPDATE","sync_at":"2024-01-02 01:00:00","after":{"n":"bad"}}'
        ),
        (
            "m3", T0 + timedelta(hours=1),
            '{"primary_key":{"a":2,"b":null},"operation":"UPDATE","sync_at":"2024-01-02 01:00:00","after":{"n":"7"}}'
        ),
        ("m4", T0, "not json"),
    ], "message_id string, publish_time timestamp, data string")
    assert cdc.dedup_messages(raw).count() == 4
    winners = {r.pk: r for r in cdc.cdc_winners(raw, ["a", "b"]).collect()}
    assert {k: w.operation for k, w in winners.items()} == {"1:::x": "DELETE", "2:::": "UPDATE"}
    typed = (
        cdc
        .typed_projection(raw, [("n", "int"), ("j", "json"), ("l", "array<int>")], keep=("message_id",))
        .orderBy("message_id")
        .collect()
    )
    assert (typed[0].n, typed[0].j, typed[0].l) == (5, '{"q":1}', [1, 2])
    assert {r.n for r in typed if r.message_id == "m3"} == {7, None}
    assert cdc.evolve_schema(raw, [("Data", "string"), ("new", "long")]).dtypes[-1] == ("new", "bigint")


def test_merge_is_idempotent_and_equals_the_view(spark):
    target = spark.createDataFrame(
        [(1, T0, "a"), (2, T0, "b"), (3, T0, "c"), (4, T0, "d")], "pk int, sync_at timestamp, v string"
    )
    later, before = T0 + timedelta(hours=1), T0 - timedelta(hours=1)
    winners = spark.createDataFrame(
        [
            (1, later, "A", "UPDATE"), (2, T0, None, "DELETE"), (3, before, "old", "UPDATE"),
            (4, before, None, "DELETE"), (5, T0, "e", "INSERT"), (6, T0, None, "DELETE")
        ],
        "pk int, sync_at timestamp, v string, operation string"
    )
    once = cdc.merge_upsert(target, winners)
    want = [(1, "A"), (3, "c"), (4, "d"), (5, "e")]
    assert sorted((r.pk, r.v) for r in once.collect()) == want
    assert sorted((r.pk, r.v) for r in cdc.merge_upsert(once, winners).collect()) == want
    assert sorted(
        (r.pk, r.v) for r in cdc.base_plus_delta_view(
            target.withColumn("operation", F.lit("INSERT")), winners
        ).collect()
    ) == want
    assert sorted(
        (r.pk, r.v) for r in cdc.base_anti_delta_union(target, winners).collect()
    ) == [(1, "A"), (3, "old"), (5, "e")]


def test_merge_leaves_rows_without_a_time(spark):
    target = spark.createDataFrame(
        [(1, None, "a"), (2, T0, "b"), (3, None, "c")], "pk int, sync_at timestamp, v string"
    )
    winners = spark.createDataFrame(
        [(1, T0, "A", "UPDATE"), (2, None, "B", "UPDATE"), (3, T0, None, "DELETE"), (4, None, "d", "INSERT")],
        "pk int, sync_at timestamp, v string, operation string"
    )
    assert sorted(
        (r.pk, r.v) for r in cdc.merge_upsert(target, winners).collect()
    ) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_refresh_rewrites_touched_partitions_alone(spark):
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    kind = "key long, mg_id long, action string, synced_at timestamp, ingest_time timestamp, created date"
    day = lambda n: (T0 + timedelta(days=n)).date()
    row = lambda k, m, a, n, made: (k, m, a, T0 + timedelta(days=n), T0 + timedelta(days=n), made)
    as_of = day(9).isoformat()
    first = [row(1, 1, "i", 0, day(0)), row(2, 2, "i", 0, day(0)), row(3, 3, "i", 1, day(1)), row(4, 4, "i", 2, day(2))]
    # noqa: E731
    state = lambda: {(r.mg_id, r.key, r.created.isoformat()) for r in spark.read.parquet(f"{root}/t").collect()}
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/t/*/*.parquet")}
    refresh = lambda rows, k: cdc.refresh_partitions(
        spark.createDataFrame(rows, kind), f"{root}/t", f"{root}/s{k}", "created", as_of
    )
    assert refresh(first, 0) and len(state()) == 4
    before = files()
    assert not refresh(first, 1) and files() == before  # nothing new, nothing written
    more = [*first, row(5, 3, "u", 5, day(1)), row(6, 4, "d", 5, day(9))]
    assert refresh(more, 2)
    assert state() == {(1, 1, str(day(0))), (2, 2, str(day(0))), (3, 5, str(day(1))), (4, 6, str(day(9)))}
    after = files()
    # only that partition kept its files
    assert {f for f in before if f in after} == {f for f in before if f"created={day(0)}" in f}
    assert all(before[f] == after[f] for f in before if f in after)
    late = [*more, (7, 3, "u", T0 + timedelta(days=2), T0 + timedelta(days=6), day(1))]
    assert not refresh(late, 3)  # ingested later, but older than the row that is there


def test_windows_and_appends(spark):
    rows = spark.createDataFrame([(i, T0 + timedelta(days=i)) for i in range(10)], "i int, at timestamp")
    day = lambda n: F.lit(T0 + timedelta(days=n))
    fresh = rows.withColumn("i", F.col("i") + 100)
    assert sorted(
        r.i for r in cdc.replace_window(rows, fresh, "at", day(7), day(3)).collect()
    ) == [3, 4, 5, 6, 107, 108, 109]
    assert sorted(r.i for r in cdc.append_since(rows.where("i < 4"), rows, "at").collect()) == [4, 5, 6, 7, 8, 9]
    assert cdc.append_since(rows.where("i < 0"), rows, "at").count() == 10
    assert sorted(
        r.i for r in cdc.replace_touched_keys(
            rows, rows, rows.withColumn("at", day(50)), ["i"], F.col("i") > 7
        ).where("at > '2024-02-01'").collect()
    ) == [8, 9]
    kept, removed = cdc.remove_duplicate_batches(rows.withColumn("b", F.col("i") % 2), "b")
    assert kept.count() == 5 and removed.collect() == [(0, 5)]


def test_migrate_merge(spark):
    log = spark.createDataFrame(log_rows(3), LOG)
    state = {r.mg_id: r for r in cdc.latest_by_key(log, drop_deleted=False).collect()}
    live = sorted(k for k, r in state.items() if r.action != "d")
    gone = live[len(live) // 2]
    migrated = (
        cdc
        .latest_by_key(log)
        .where(F.col("mg_id") != gone)
        .withColumn(
            "synced_at",
            F.col("synced_at") + F.when(
                F.col("mg_id") == live[0], F.expr("INTERVAL 1 DAY")
            ).otherwise(F.expr("INTERVAL 0 DAY"))
        )
    )
    got = sorted((r.mg_id, r.action) for r in cdc.migrate_merge(log, migrated).collect())
    assert got == sorted([(gone, "d"), (live[0], state[live[0]].action)])
    after = cdc.latest_by_key(log.unionByName(cdc.migrate_merge(log, migrated)))
    assert sorted(r.mg_id for r in after.collect()) == sorted(set(live) - {gone})


def test_swapped_delete_is_repaired(spark):
    rows = [
        ("k1", "a", "u", T0, T0, None, 1), ("k2", "a", "d", T0, T0, None, 2), ("k3", "b", "d", T0, T0, None, 3),
        ("k4", "b", "u", T0 - timedelta(hours=1), T0, None, 4)
    ]
    log = spark.createDataFrame(rows, LOG)
    assert [tuple(r)[2:] for r in cdc.swapped_deletes(log).collect()] == [("k2", "k1")]
    assert pairs(cdc.latest_by_key(log)) == []
    assert pairs(cdc.latest_by_key(cdc.repair_swapped_delete(log))) == [("a", "k1")]


def test_stream_in_shuffled_order_equals_batch(spark):
    rows = log_rows(8)
    random.Random(1).shuffle(rows)
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    log = spark.createDataFrame(rows, LOG)
    for k in range(3):
        spark.createDataFrame(rows[k::3], LOG).coalesce(1).write.mode("append").parquet(f"{root}/log")
    query = stream.stream_current_state(
        stream.read_log_stream(spark, f"{root}/log", log.schema, 1), f"{root}/state", f"{root}/checkpoint"
    )
    query.awaitTermination()
    assert pairs(stream.read_state(spark, f"{root}/state", log.schema)) == plain_state(rows, deleted=False)


def test_message_stream_and_windows(spark):
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    raw = spark.createDataFrame(
        [("a", T0, "x"), ("a", T0, "x"), ("b", T0 + timedelta(hours=1), "y")],
        "message_id string, publish_time timestamp, data string"
    )
    raw.write.parquet(f"{root}/in")
    seen = []
    stream.run_to_end(
        stream.dedup_message_stream(spark.readStream.schema(raw.schema).parquet(f"{root}/in")), lambda df,
        _: seen.extend(r.message_id for r in df.collect()), f"{root}/c1"
    )
    assert sorted(seen) == ["a", "b"]
    counts = []
    stream.run_to_end(
        stream.windowed_counts(spark.readStream.schema(raw.schema).parquet(f"{root}/in"), "publish_time", []),
        lambda df, _: counts.extend(r.n for r in df.collect()), f"{root}/c2"
    )
    # the newest hour stays open
    assert stream.windowed_counts(raw, "publish_time", []).agg(F.sum("n")).first()[0] == 3 and sum(counts) == 2


def test_refresh_depends_on_no_clock(spark):
    """Rows of the partition without a date don't count as recent, so a log is read from the newest dated change on."""
    kind = "key int, mg_id int, action string, synced_at timestamp, ingest_time timestamp, created date"
    root, far = tempfile.mkdtemp(prefix="lakeloom-test-"), datetime(2099, 1, 1).date()
    row = lambda k, m, a, n, made: (k, m, a, T0 + timedelta(days=n), T0 + timedelta(days=n), made)
    day = lambda n: (T0 + timedelta(days=n)).date()
    rows = [row(1, 1, "i", 0, day(0)), row(2, 2, "d", 1, far), row(3, 3, "i", 30, day(30))]
    frame = lambda some: spark.createDataFrame(some, kind)
    refresh = lambda some, k, as_of: cdc.refresh_partitions(frame(some), f"{root}/t", f"{root}/s{k}", "created", as_of)
    assert refresh(rows, 0, "2030-01-01")
    late = row(4, 1, "u", 29, day(0))  # older than the newest dated change by more than the overlap and the look-back
    assert not refresh([*rows, late], 1, day(31).isoformat())
    assert refresh([*rows, row(5, 1, "u", 31, day(0))], 2, day(31).isoformat())
