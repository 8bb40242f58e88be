import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators import quality
from lakeloom.operators import relational as R
from lakeloom.operators import scans as S
from lakeloom.plans import foundations, registry  # noqa: F401

from .oracle import compare


def told(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def frame(spark, n=3_000, hot=0.9, seed=1):
    """One key has most rows; nulls in keys, order and values; the order is total by `i`."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < hot else rnd.choice(["a", "b", None])
        rows.append((k, rnd.choice([None, *range(50)]), i, rnd.choice([None, None, *range(-5, 6)]), rnd.choice(["x", "y", None])))
    return spark.createDataFrame(rows, "k string, at int, i int, v int, s string").repartition(5)


@pytest.mark.parametrize("hot", [0.0, 0.5, 0.9, 1.0])
def test_scan_equals_window(spark, hot):
    df = frame(spark, hot=hot).cache()
    got = S.segmented_scan(
        df, ["k"], ["at", "i"], min_rows=100, total=S.running_sum("v"), low=S.running_min("v"), high=S.running_max("v"),
        last=S.last_known("s"), nxt=S.next_known("s"), before=S.row_before("v"), after=S.row_after("v"), n=S.running_sum(F.lit(1)),
    )
    w = Window.partitionBy("k").orderBy("at", "i")
    upto, on = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.withColumns({
        "total": F.sum("v").over(upto), "low": F.min("v").over(upto), "high": F.max("v").over(upto),
        "last": F.last("s", True).over(upto), "nxt": F.first("s", True).over(on), "before": F.lag("v").over(w),
        "after": F.lead("v").over(w), "n": F.row_number().over(w),
    })
    names = ["i", "total", "low", "high", "last", "nxt", "before", "after", "n"]
    assert told(got, *names) == told(want, *names)
    assert set(got.columns) == set(want.columns)


def test_a_hot_key_is_cut(spark):
    """No slice of a key with nine tenths of the rows has more than some shares of a task."""
    df = frame(spark, n=8_000).cache()
    cuts = S._hot_cuts(df, ["k"], ["at", "i"], 100)
    assert [r.k for r in cuts.collect()] == ["hot"] and len(cuts.first()["_cuts"]) == 3
    hot = [(r.at is not None, r.at, r.i) for r in df.where("k = 'hot'").collect()]
    edges = [(c.at is not None, c.at, c.i) for c in cuts.first()["_cuts"]]
    as_key = lambda x: (x[0], x[1] or 0, x[2])
    sizes = [0] * (len(edges) + 1)
    for x in hot:
        sizes[sum(as_key(e) <= as_key(x) for e in edges)] += 1
    assert max(sizes) < 2 * len(df.collect()) / 4
    plan = S.segmented_scan(df, ["k"], ["at", "i"], 100, t=S.running_sum("v"))._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "NestedLoop" not in plan and "Python" not in plan


def test_keys_within_their_share_give_the_plain_window(spark):
    plan = S.segmented_scan(frame(spark), ["k"], ["i"], t=S.running_sum("v"))._jdf.queryExecution().executedPlan().toString()
    assert "_slice" not in plan


def test_many_cuts_and_several_keys(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = frame(spark, n=4_000, hot=0.7).withColumn("j", F.lit(1)).cache()
        got = S.segmented_scan(df, ["k", "j"], ["i"], 50, total=S.running_sum("v"), before=S.row_before("s"))
        w = Window.partitionBy("k", "j").orderBy("i")
        want = df.withColumns({"total": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), "before": F.lag("s").over(w)})
        assert told(got, "i", "total", "before") == told(want, "i", "total", "before")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_cuts_are_shared_by_scans_of_fewer_rows(spark):
    df = frame(spark).cache()
    cuts = S.find_cuts(df, ["k"], ["i"], 100)
    assert cuts.rows is not None
    some = df.where("v IS NOT NULL")
    w = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    got = S.segmented_scan(some, ["k"], ["i"], cuts=cuts, t=S.running_sum("v"))
    assert told(got, "i", "t") == told(some.withColumn("t", F.sum("v").over(w)), "i", "t")


def test_scans_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, i int, v int")
    assert S.segmented_scan(df, ["k"], ["i"], t=S.running_sum("v")).collect() == []
    assert S.as_of_join(df, df.select("k", F.col("i").alias("j"), F.col("v").alias("w")), ["k"], "i", "j").collect() == []


def test_derived_scans_equal_their_windows(spark):
    df = frame(spark).cache()
    order = ["at", "i"]
    assert told(S.changes(df, ["k"], order, "s", 100), "i") == told(R.change_points(df, ["k"], order, "s"), "i")
    w = Window.partitionBy("k").orderBy(*order)
    was = F.lag(F.struct("s")).over(w)
    flagged = df.withColumn("new", (was.isNull() | ~was["s"].eqNullSafe(F.col("s"))).cast("int"))
    want = flagged.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert told(S.runs(df, ["k"], order, "s", 100), "i", "island") == told(want, "i", "island")
    assert told(S.byte_runs(df, ["k"], order, "s", 7, 100), "i", "bucket") == told(R.byte_buckets(df, ["k"], order, "s", 7), "i", "bucket")
    assert told(S.fill(df, ["k"], order, 100, f="s"), "i", "f") == told(df.select("i", R.fill_forward("s", ["k"], order).alias("f")), "i", "f")
    run = df.withColumn("running", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("running >= 9")
    first = R.top_k(run, ["k"], [F.col("at"), F.col("i")])
    assert told(S.reached(df, ["k"], order, "v", 9, 100), "i", "running") == told(first, "i", "running")
    assert told(S.spans(df, ["k"], ["i"], min_rows=100), "i", "start", "end") == told(
        df.select("i", F.col("i").alias("start"), F.lead("i").over(Window.partitionBy("k").orderBy("i")).alias("end")), "i", "start", "end")


def plain_as_of(left, right, direction, strict):
    out = []
    for k, at, i in left:
        fits = [
            (b, t, x) for k2, b, t, x in right
            if None not in (k, at, k2, b) and k == k2 and ((b < at) if direction == "backward" else (b > at)) | ((not strict) & (b == at))
        ]
        best = (max if direction == "backward" else min)(fits, default=(None, None, None))
        out.append((i, best[0], best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("min_rows", [10, 10_000])
def test_as_of_join(spark, direction, strict, min_rows):
    rnd = random.Random(3)
    key = lambda: rnd.choice(["a"] * 8 + ["b", "c", None])
    left = [(key(), rnd.choice([None, *range(40)]), i) for i in range(250)]
    right = [(key(), rnd.choice([None, *range(40)]), t, t * 10) for t in range(60)]
    one = spark.createDataFrame(left, "k string, at int, i int")
    two = spark.createDataFrame(right, "k string, b int, t int, x int")
    got = S.as_of_join(one, two, ["k"], "at", "b", ["t"], direction, strict, min_rows=min_rows)
    assert got.columns == ["k", "at", "i", "b", "t", "x"]
    assert told(got, "i", "b", "x") == plain_as_of(left, right, direction, strict)
    inner = S.as_of_join(one, two, ["k"], "at", "b", ["t"], direction, strict, "inner", min_rows)
    assert told(inner, "i", "x") == told(got.where("x IS NOT NULL"), "i", "x")


def test_as_of_join_refuses_names_of_both_sides(spark):
    df = spark.createDataFrame([(1, 2)], "k int, at int")
    with pytest.raises(ValueError, match="both sides"):
        S.as_of_join(df, df, ["k"], "at", "at")


def test_between_events(spark):
    rnd = random.Random(5)
    events = [(rnd.choice("aab"), rnd.randint(0, 30), i) for i in range(40)] + [("a", None, 99), (None, 3, 98)]
    notes = [(rnd.choice("aabc"), rnd.randint(0, 32), j) for j in range(150)] + [("a", None, 999), (None, 4, 998)]
    e, n = spark.createDataFrame(events, "k string, at int, e int"), spark.createDataFrame(notes, "k string, note_at int, n int")
    got = S.between_events(e, n, ["k"], "at", "note_at", ["e"], min_rows=20)
    known = [x for x in events if None not in x[:2]]
    want = []
    for k, at, j in notes:
        if k is None or at is None or any(x[0] == k and x[1] == at for x in known):
            continue
        before = [(x[1], x[2]) for x in known if x[0] == k and x[1] < at]
        if before:
            want.append((k, *max(before), at, j))
    assert told(got, "k", "at", "e", "note_at", "n") == sorted(want, key=repr)


def test_a_hundred_thousand_events_and_notes_of_one_key(spark):
    """The product would have 10^10 pairs."""
    events = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("at"), F.col("id").alias("e"))
    notes = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 10 + F.col("id") % 10).alias("note_at"), F.col("id").alias("n"))
    found = S.between_events(events, notes, ["k"], "at", "note_at")
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 90_000 and found.where("e <> n").count() == 0


def test_dyadic_cover(spark):
    rnd = random.Random(7)
    rows = [(i, a := rnd.randint(0, 5_000), a + rnd.randint(-3, 3_000)) for i in range(300)] + [(300, 0, S.LAST_DAY - S.FIRST_DAY)]
    df = spark.createDataFrame(rows, "i int, a long, b long").select("*", S.dyadic_cover(F.col("a"), F.col("b")).alias("c"))
    for r in df.collect():
        days = sorted((x.node << x.level, (x.node + 1) << x.level) for x in r.c)
        assert (days == []) == (r.b < r.a)
        if days:
            assert days[0][0] == r.a and days[-1][1] == r.b + 1
            assert all(x[1] == y[0] for x, y in zip(days, days[1:], strict=False))
        assert len(r.c) <= 2 * (S.LEVELS + 1)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_range_join(spark, keys):
    rnd = random.Random(8)
    day = dt.datetime(2020, 1, 1)
    moment = lambda: None if rnd.random() < 0.05 else day + dt.timedelta(hours=rnd.randint(-20_000, 90_000))
    points = [(rnd.choice(["a", "b", None]), moment(), i) for i in range(250)]
    held = [(rnd.choice(["a", "b", None]), moment(), moment() if rnd.random() < 0.8 else None, j) for j in range(120)]
    held += [("a", day, day, 1_000), ("b", dt.datetime(1, 1, 2), dt.datetime(9999, 12, 30), 1_001)]
    left = spark.createDataFrame(points, "k string, at timestamp, i int")
    right = spark.createDataFrame(held, "k string, a timestamp, b timestamp, j int")
    left, right = (left, right) if keys else (left.drop("k"), right.drop("k"))
    got = S.range_join(left, right, "at", "a", "b", keys)
    want = [
        (i, j) for k, at, i in points for k2, a, b, j in held
        if at and a and a <= at and (b is None or at <= b) and (not keys or (k is not None and k == k2))
    ]
    assert told(got, "i", "j") == sorted(want, key=repr)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()


def test_range_totals(spark):
    """suppliers' open terms met every order of their nation, so rows grew by the square of the tables."""
    rnd = random.Random(5)
    first = dt.date(2020, 1, 1)
    day = lambda: None if rnd.random() < 0.05 else first + dt.timedelta(days=rnd.randint(0, 70))
    points = [(rnd.choice(["a", "b", None]), day(), rnd.choice([*range(12), None]), i) for i in range(600)]
    held = [(rnd.choice(["a", "b", "c", None]), day(), rnd.choice([day(), None]), j) for j in range(150)]
    held += [("a", dt.date(1, 1, 1), None, 150), ("b", dt.date(1990, 5, 1), dt.date(9999, 12, 31), 151), ("a", first, first, 152)]
    left = spark.createDataFrame(points, "k string, at date, who int, v int")
    right = spark.createDataFrame(held, "k string, a date, b date, j int")
    want = []
    for k, a, b, j in held:
        met = [(w, v) for k2, at, w, v in points if k and k == k2 and at and a and a <= at and (b is None or at <= b)]
        if met:
            want.append((j, len(met), len({w for w, _ in met if w is not None}), max(v for _, v in met)))
    got = S.range_totals(left, right, "at", "a", "b", ["k"], "who", "v")
    assert told(got, "j", "n", "entities", "top") == sorted(want, key=repr)
    assert S.range_totals(left.limit(0), right, "at", "a", "b", ["k"], "who", "v").collect() == []


def test_open_terms_of_a_supplier_in_two_nations(spark, tmp_path):
    """its customers are counted once over both nations, and a repeated row counts its orders twice."""
    SQL, query = foundations_query("j6_open_intervals")
    day = dt.datetime(1999, 1, 1)
    tables = {
        "supplier": ([(3, 1), (3, 2), (4, 1), (4, 1), (None, 1), (5, None)], "s_suppkey long, s_nationkey int"),
        "customer": ([(1, 1), (1, 2), (2, 2), (3, 1), (4, None)], "c_custkey long, c_nationkey int"),
        "orders": ([(i, i % 5, day + dt.timedelta(days=i * 37 - 3_000)) for i in range(150)] + [(999, 1, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    compare(spark, con, query, SQL, str(tmp_path))


def foundations_query(name):
    return registry.ORACLE_SQL[name], registry.QUERIES[name]


@pytest.mark.parametrize("min_rows", [50, 10_000_000])
def test_exact_quantiles(spark, min_rows):
    """percentile_approx was exact only for groups of at most as many rows as its accuracy."""
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.choice([None, *range(300)])) for _ in range(4_000)] + [("none", None)]
    rows += [("c", i) for i in range(1, 21)]  # 0.95 * 20 is 19
    got = S.exact_quantiles(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", {"p50": 50, "p95": 95}, min_rows=min_rows)
    want = []
    for k in {k for k, _ in rows}:
        v = sorted(x for g, x in rows if g == k and x is not None)
        want.append((k, *((v[-(-len(v) * p // 100) - 1] if v else None) for p in (50, 95))))
    assert told(got, "k", "p50", "p95") == sorted(want, key=repr)


def test_latency_of_more_different_times_than_a_sketch_holds(spark):
    """the middle of 400,001 times of one group is one of them."""
    at = F.timestamp_micros(F.col("id") * 7_919 % 400_001 * 1_000)
    log = spark.range(400_001).select(F.lit("x").alias("k"), F.timestamp_micros(F.lit(0)).alias("a"), at.alias("b"))
    assert told(quality.latency_profile(log, ["k"], "a", "b"), "p50", "p90", "p95", "max") == [(200.0, 360.0, 380.0, 400.0)]


def test_slices_stay_tasks(spark):
    """slices that compress well were put together into few tasks, and a row's slice was looked up by two filters."""
    df = frame(spark, hot=1.0)
    rows = S.segmented_scan(df, ["k"], ["i"], min_rows=100, t=S.running_sum("v"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"{2 * int(spark.conf.get('spark.sql.shuffle.partitions'))}), REPARTITION_BY_NUM" in plan
    assert "lambdafunction" not in plan
