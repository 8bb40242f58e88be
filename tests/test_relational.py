import tempfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import quality
from lakeloom.operators import relational as R
from lakeloom.operators import scans as S
from lakeloom.plans import customers, inventory, operations, orders
from lakeloom.sources import io


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_exact_or_any_equals_the_or_join(spark):
    left = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", None)], "k string, region string")
    right = spark.createDataFrame(
        [("a", "1", 10), ("a", None, 20), ("a", "00", 30), ("b", "2", 40), ("c", "00", 50)],
        "k string, region string, price int"
    )
    r = right.withColumnRenamed("region", "r").withColumnRenamed("k", "k2")
    want = left.join(
        r, (F.col("k") == F.col("k2")) & ((F.col("region") == F.col("r")) | F.col("r").isNull() | (F.col("r") == "00"))
    ).select("k", "region", "price")
    assert rows(R.exact_or_any_join(left, right, ["k"], "region").select("k", "region", "price")) == rows(want)


def test_range_join_over_bucket_borders(spark):
    left = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i),) for i in range(0, 200, 7)], "d date")
    right = spark.createDataFrame(
        [
            (
                i, date(2024, 1, 1) + timedelta(days=i * 10), date(2024, 1, 1) + timedelta(days=i * 10 + i * 9)
            ) for i in range(12)
        ],
        "i int, a date, b date"
    )
    want = left.crossJoin(right).where("d BETWEEN a AND b")
    assert rows(S.range_join(left, right, "d", "a", "b").select("d", "i", "a", "b")) == rows(want)


def test_anti_join_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(R.not_in(left, spark.createDataFrame([(1,), (None,)], "k int"), "k")) == [(2,), (None,)]


def test_windows(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("a", 4, "y"), ("b", 1, None)], "k string, i int, v string"
    )
    assert rows(R.change_points(df, ["k"], ["i"], "v").select("k", "i")) == [("a", 1), ("a", 3), ("a", 4), ("b", 1)]
    filled = df.select(
        "k", "i", R.fill_forward("v", ["k"], ["i"]).alias("f"), R.fill_backward("v", ["k"], ["i"]).alias("b"),
        R.spread("v", ["k"], ["i"]).alias("s")
    )
    assert rows(filled) == [
        ("a", 1, "x", "x", "x"), ("a", 2, "x", "x", "x"), ("a", 3, "x", "y", "x"), ("a", 4, "y", "y", "x"),
        ("b", 1, None, None, None)
    ]
    assert rows(
        R.islands(df, ["k"], ["i"], F.col("v") == "y").select("k", "i", "island")
    ) == [("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("a", 4, 2), ("b", 1, 1)]
    assert rows(R.gate_by_newest(df, ["k"], [F.col("i").desc()], F.col("v") == "y").select("k").distinct()) == [("a",)]
    assert rows(
        R.byte_buckets(df, ["k"], ["i"], "v", 2).select("k", "i", "bucket")
    ) == [("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("a", 4, 1), ("b", 1, 0)]
    assert rows(R.latest_set(df, ["k"], "i").select("k", "i")) == [("a", 4), ("b", 1)]


def test_shares_of_zero(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("b", 1.0), ("b", 3.0)], "k string, v double")
    assert rows(
        df.select("k", R.share_of_total("v", ["k"]).alias("s"))
    ) == [("a", None), ("a", None), ("b", 0.25), ("b", 0.75)]


def test_checks_find_planted_defects_and_pass_clean_data(spark):
    clean = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "k int, s string, v double")
    bad = clean.union(spark.createDataFrame([(2, None, -1.0)], clean.schema))
    for check in (
        lambda d: quality.check_unique(d, ["k"]), lambda d: quality.check_not_null(d, ["s", "v"], ["k"]),
        lambda d: quality.check_rows(d, {"positive": "v > 0"}, ["k"])
    ):
        assert check(clean).isEmpty() and check(bad).count() == 1
    assert quality.check_coverage(bad, clean, ["k"]).isEmpty() and quality.check_coverage(
        clean.withColumn("k", F.col("k") + 1), clean, ["k"]
    ).collect() == [(3,)]
    assert [
        r.k for r in quality.check_expected(
            clean, spark.createDataFrame([(1, "x"), (2, "z"), (9, "q")], "k int, s string"), ["k"]
        ).orderBy("k").collect()
    ] == [2, 9]
    assert quality.check_balance(bad, ["k"], F.sum("v"), F.sum(F.abs("v"))).count() == 1


def test_gate_rebuilds_then_fails():
    class Report:
        def __init__(self, spark, wrong):
            self.spark, self.wrong = spark, wrong

        def __call__(self):
            return self.spark.createDataFrame(
                [("TOTAL COUNT", 100)] + [("MISSING_RECORDS", 1)] * self.wrong, "kind string, n long"
            )

    from pyspark.sql import SparkSession

    report = Report(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate(), 3)
    log = quality.mismatch_gate(report, lambda: setattr(report, "wrong", 0))
    assert [x["passed"] for x in log] == [False, True]
    report.wrong = 3
    with pytest.raises(RuntimeError):
        quality.mismatch_gate(report, lambda: None)


def test_repairs(spark):
    state = {"df": spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, at int")}
    saved = []
    assert quality.guarded_snapshot_repair(
        lambda: state["df"], lambda d: state.update(df=d), saved.append, ["k"], [F.col("at").desc()]
    )
    assert rows(state["df"]) == [(1, 2), (2, 1)] and len(saved) == 1
    assert not quality.guarded_snapshot_repair(lambda: state["df"], lambda d: None, saved.append, ["k"], [F.col("at")])
    state["df"] = spark.createDataFrame([(1, 1), (1, 2)], "k int, at int")
    assert [
        x["duplicates"] for x in quality.repair_duplicates(
            lambda: state["df"], lambda d: state.update(df=d), ["k"], [F.col("at")]
        )
    ] == [1, 0]


def test_sources(spark):
    root = tempfile.mkdtemp(prefix="lakeloom-test-")
    assert rows(io.read_csv_rows(spark, "a,b\n1,\n x ,2\n", {"b": "int"})) == [("1", None), ("x", 2)]
    with open(f"{root}/x.csv", "w") as f:
        f.write("title\nh1,h2\n1,2\n3,4\n")
    assert rows(io.read_external_files(spark, f"{root}/x.csv", ["p", "q"], header_rows=2)) == [("1", "2"), ("3", "4")]
    assert rows(io.inline_rows(spark, [{"n": "x"}, {"n": "y"}]).select("id", "n")) == [(1, "x"), (2, "y")]
    for day in ("20240101", "20240102", "20240103"):
        spark.createDataFrame([(day,)], "v string").write.parquet(f"{root}/stock_{day}")
    assert rows(
        io.read_date_suffixed(spark, root, "stock_", "20240102", "20240103")
    ) == [("20240102", "20240102"), ("20240103", "20240103")]
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, p string")
    io.write_partitioned(df, f"{root}/t", ["p"], ["v"])
    io.write_partitioned(df.where("p = 'b'").withColumn("v", F.lit(9)), f"{root}/t", ["p"])
    assert rows(spark.read.parquet(f"{root}/t")) == [(1, "a"), (2, "a"), (9, "b")]
    for hour in (1, 2):
        io.append_cutoff_snapshot(df, f"{root}/s", F.lit(datetime(2024, 1, 1, hour, 30)))
    assert spark.read.parquet(f"{root}/s").select("cutoff_timestamp").distinct().count() == 2
    io.truncate_insert(df.limit(1), f"{root}/u")
    io.truncate_insert(df, f"{root}/u")
    assert spark.read.parquet(f"{root}/u").count() == 3
    assert io.audit_row(spark, "n", 1, F.lit(datetime(2024, 1, 1)), {"a": 1}).first().props == '{"a": 1}'
    df.withColumn(
        "at", F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(F.col("v"))
    ).write.parquet(f"{root}/named.parquet")
    read = lambda **how: rows(io.read_table(spark, root, "named", ["v"], **how))
    assert read() == [(1,), (2,), (3,)] and read(since=F.lit(datetime(2024, 1, 2)), time_col="at") == [(2,), (3,)]


def test_lifecycle_gaps_and_partition(spark):
    facts = spark.createDataFrame(
        [("a", datetime(2024, m, 5)) for m in (1, 2, 4, 7)] + [("b", datetime(2024, 7, 1))], "k string, at timestamp"
    )
    states = customers.lifecycle(customers.monthly_activity(facts, "k", "at", spark, "2024-08-15"))
    assert [r.state for r in states.where("k = 'a'").orderBy("month").collect()] == [
        "new", "repeat", "churn", "reacquired", "churn", "idle", "reacquired", "churn"
    ]
    assert [r.state for r in states.where("k = 'b'").orderBy("month").collect()] == ["new", "churn"]
    active = states.where("active")
    assert active.where("state IN ('new', 'repeat', 'reacquired')").count() == active.count()


def test_bundles_keep_the_price(spark):
    items = spark.createDataFrame(
        [(1, 10, 2.0, 100.0), (2, 99, 1.0, 5.0), (3, 11, 1.0, 7.0)],
        "line int, product int, quantity double, price double"
    )
    bundles = spark.createDataFrame(
        [(10, 1, 2, 5.0), (10, 2, 1, 30.0), (11, 1, 1, 0.0), (11, 2, 1, 0.0)],
        "product int, component int, units int, value double"
    )
    out = orders.explode_bundle(items, bundles, "line", "product", "quantity", "price")
    assert rows(
        out.groupBy("line").agg(F.round(F.sum("price"), 6), F.sum("quantity"))
    ) == [(1, 100.0, 6.0), (2, 5.0, 1.0), (3, 7.0, 2.0)]
    assert rows(out.where("line = 1").select("sku", "price")) == [(1, 25.0), (2, 75.0)]
    # 50 a bundle worth 40: at most their own price
    assert rows(out.where("line < 3").select("sku", "unit_price")) == [(1, 5.0), (2, 30.0), (99, 5.0)]


def test_stock_and_status(spark):
    a = spark.createDataFrame([("x", 5.0), ("y", 1.0)], "sku string, q double")
    b = spark.createDataFrame([("x", 2.0), ("z", 1.0)], "sku string, q double")
    assert rows(
        inventory.stock_balance(a, b, ["sku"], "q").select("sku", "balance", "only")
    ) == [("x", 3.0, None), ("y", 1.0, "in"), ("z", -1.0, "out")]
    changes = spark.createDataFrame(
        [
            ("x", 1, datetime(2024, 1, 3), "ON"), ("x", 2, datetime(2024, 1, 4), "ON"),
            ("x", 3, datetime(2024, 1, 5), "OFF")
        ],
        "k string, i int, at timestamp, s string"
    )
    spans = inventory.status_intervals(changes, ["k"], "at", "s", "i", F.lit(datetime(2024, 1, 8)))
    days = inventory.status_by_day(spans, ["k"], "s", "2024-01-01", "2024-01-07").orderBy("day").collect()
    assert [(r.day.day, r.s, r.filled) for r in days] == [
        (1, "ON", True), (2, "ON", True), (3, "ON", False), (4, "ON", False), (5, "OFF", False), (6, "OFF", False),
        (7, "OFF", False)
    ]


def test_rules_that_must_fail(spark):
    people = spark.createDataFrame([(1, "A")], "c_custkey long, c_mktsegment string")
    sold = spark.createDataFrame([(1, datetime(2024, 1, 1))], "o_custkey long, o_orderdate timestamp")
    with pytest.raises(ValueError, match="no segment kind"):
        customers.filter_active_segment(
            people, sold, {}, "OLD", F.lit(datetime(2024, 1, 1)), F.lit(datetime(2024, 1, 2))
        )
    assert customers.filter_active_segment(
        people, sold, {"c_mktsegment": "A,B"}, "NEW", F.lit(datetime(2024, 1, 1)), F.lit(datetime(2024, 1, 2))
    ).count() == 0


def test_stage_durations_are_monotone(spark):
    e = spark.createDataFrame(
        [(1, "a", datetime(2024, 1, 1, 10)), (1, "b", datetime(2024, 1, 1, 9)), (1, "c", datetime(2024, 1, 1, 11, 30))],
        "k int, s string, at timestamp"
    )
    r = operations.stage_durations(e, "k", "s", "at", ("a", "b", "c")).first()
    assert (r.a_to_b, r.b_to_c, r.gap) == (0, 90, 0)


@pytest.mark.parametrize("dense", [0, 64])
def test_interval_join_either_way(spark, dense):
    day = date(2024, 1, 1)
    left = spark.createDataFrame([("a", day + timedelta(days=i), i) for i in range(50)] + [(None, day, 99)], "k string, d date, i int")
    held = [("a", day + timedelta(days=3 * i), day + timedelta(days=5 * i) if i % 3 else None, i) for i in range(12)]
    held += [("a", None, day, 50), (None, day, None, 51), ("a", day + timedelta(days=9), day, 52)]
    right = spark.createDataFrame(held, "k string, a date, b date, j int")
    want = sorted((i, j) for k, d, i in left.collect() for k2, a, b, j in held if k and k == k2 and a and a <= d and (b is None or d <= b))
    got = R.interval_join(left, right, ["k"], "d", "a", "b", dense=dense)
    assert sorted((r.i, r.j) for r in got.collect()) == want
    assert ("_level" in got._jdf.queryExecution().analyzed().toString()) == (dense == 0)


def test_unique_assertion_names_all_values_of_touched_partitions(spark):
    rows = [(i // 2, i % 7, p) for p in (1, 2, None) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, v int, p int")
    got = {r["keys"]: (r.failures, r.examples) for r in quality.unique_assertion(df, [["k", "p"], ["k", "v", "p"]]).collect()}
    assert got["k,v,p"] == (0, []) and got["k,p"][0] == 60 and len(got["k,p"][1]) == 60
    touched = spark.createDataFrame([(2,), (None,)], "p int")
    some = quality.unique_assertion(df, [["k"]], 3, touched, "p").first()
    assert (some.failures, some.examples) == (20, ["0", "1", "10"])
    rows = quality.failing_keys(df, [["k"]], touched, "p").collect()
    assert sorted((r.value, r.n) for r in rows) == sorted((str(k), 4) for k in range(20))
