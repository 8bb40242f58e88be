import os
import random
import tempfile
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lakeloom.operators import cdc
from lakeloom.streaming import stream

from .test_cdc import LOG, log_rows, plain_state


def pairs(df):
    return sorted((r.mg_id, r.key) for r in df.collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def add(spark, root, rows, schema=LOG):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/log")
    time.sleep(0.05)


def run(spark, root, schema, buckets=8):
    rows = stream.read_log_stream(spark, f"{root}/log", schema, 1)
    query = stream.stream_current_state(rows, f"{root}/state", f"{root}/checkpoint", buckets=buckets)
    query.awaitTermination()
    return query


def test_state_goes_on_from_its_checkpoint_and_touches_only_changed_buckets(spark):
    rows = log_rows(12)
    random.Random(2).shuffle(rows)
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    add(spark, root, rows)
    schema = spark.createDataFrame(rows, LOG).schema
    run(spark, root, schema)
    assert pairs(stream.read_state(spark, f"{root}/state", schema)) == plain_state(rows, deleted=False)
    before = files(f"{root}/state")
    # A late change of one entity, older than what is there, and a new change of the same entity.
    old = min(r for r in rows if r[1] is not None)
    late = ("zz", old[1], "u", datetime(2000, 1, 1), *old[4:])
    new = ("zy", old[1], "u", datetime(2090, 1, 1), *old[4:])
    add(spark, root, [late])
    add(spark, root, [new])
    run(spark, root, schema)
    rows = rows + [late, new]
    assert pairs(stream.read_state(spark, f"{root}/state", schema)) == plain_state(rows, deleted=False)
    after = files(f"{root}/state")
    kept = {f for f in before if after.get(f) == before[f]}
    gone = {f.split("bucket=")[1].split("/")[0] for f in set(before) - kept}
    assert len(gone) == 1 and len(kept) == len(before) - sum(f"bucket={next(iter(gone))}/" in f for f in before)


def test_state_under_any_split_into_files_equals_batch(spark):
    for seed in (3, 4):
        rows = log_rows(10)
        random.Random(seed).shuffle(rows)
        root = tempfile.mkdtemp(prefix="lakeloom-test-")
        for k in range(4):
            add(spark, root, rows[k::4])
        log = spark.createDataFrame(rows, LOG)
        run(spark, root, log.schema, buckets=2)
        whole = spark.read.parquet(f"{root}/state")
        assert pairs(whole) == pairs(cdc.latest_by_key(log, drop_deleted=False))


def test_a_batch_that_runs_again_is_taken_from_its_staged_copy(spark):
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    first = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "c", 1)], "k int, v string, p int")
    merge = stream.upsert_sink(f"{root}/t", f"{root}/s", ["k"], "p", first.schema)
    merge(first, 0)
    second = spark.createDataFrame([(1, "A", 0), (None, "C", 1)], "k int, v string, p int")
    merge(second, 1)
    # What a crash in the middle of replacing a partition leaves: no files.
    part = f"{root}/t/p=0"
    for f in os.listdir(part):
        os.rename(f"{part}/{f}", f"{root}/{f}")
    merge(second, 1)
    got = sorted(((r.k, r.v, r.p) for r in spark.read.parquet(f"{root}/t").collect()), key=repr)
    assert got == sorted([(1, "A", 0), (2, "b", 0), (None, "C", 1)], key=repr)
    merge(second.limit(0), 2)
    assert spark.read.parquet(f"{root}/t").count() == 3


def test_late_rows_amend_their_window_or_are_counted(spark):
    start = datetime(2024, 1, 1)
    at = lambda h, m=0: start + timedelta(hours=h, minutes=m)
    schema = "kind string, at timestamp"
    batches = [
        [("a", at(1)), ("a", at(1, 30)), ("b", at(30))],
        [("a", at(1, 45)), ("b", at(31)), ("c", at(29))],  # 1:45 is in the delay of two days
        [("a", at(100))],
        [("a", at(1, 50)), ("b", at(99))],  # 1:50 is not
        [("a", at(101))],
    ]
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    dropped, seen = 0, []
    for k, rows in enumerate(batches):
        add(spark, root, rows, schema)
        events = stream.read_log_stream(spark, f"{root}/log", spark.createDataFrame(rows, schema).schema, 1)
        query = stream.windowed_count_stream(events, "at", ["kind"], f"{root}/counts", f"{root}/checkpoint", delay="2 days")
        query.awaitTermination()
        dropped += stream.late_rows(query)
        hour = spark.read.parquet(f"{root}/counts").where((F.col("slot") == F.lit(at(1))) & (F.col("kind") == "a"))
        seen.append(hour.first()["n"])
    assert seen == [2, 3, 3, 3, 3] and dropped == 1
    got = sorted((r.slot, r.kind, r.n) for r in spark.read.parquet(f"{root}/counts").collect())
    assert got == [(at(1), "a", 3), (at(29), "c", 1), (at(30), "b", 1), (at(31), "b", 1), (at(99), "b", 1), (at(100), "a", 1), (at(101), "a", 1)]
