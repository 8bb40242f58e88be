"""Domain operators on small hand-made frames, under other column names than those of the given tables."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import scans
from lakeloom.plans import customers, inventory, operations, orders, registry

from .oracle import compare, connect


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(day, month=1, hour=0):
    return datetime(2024, month, day, hour)


def test_monthly_recency(spark):
    users = spark.createDataFrame([("a", at(5)), ("b", at(1, 2))], "who string, joined timestamp")
    bought = [("a", at(10, 2)), ("a", at(28, 2)), ("a", at(2, 3)), ("a", at(30, 5)), ("a", at(30, 5, 7))]
    sold = spark.createDataFrame(bought, "who string, at timestamp")
    out = customers.monthly_recency(users, sold, "who", "at", "joined", "2024-06-15")
    by_month = {(r.who, r.month.month): r.label for r in out.collect()}
    labels = ["USER_ONLY", "NEW", "REPEAT", "CHURN", "REACQUIRED_FAR", "CHURN"]
    assert [by_month["a", m] for m in range(1, 7)] == labels
    assert [by_month["b", m] for m in range(2, 7)] == ["USER_ONLY"] * 5


def test_segment_quota_takes_the_newest_run(spark):
    runs = spark.createDataFrame([("s", 1, 7), ("s", 1, 8), ("s", 2, 7), ("t", 1, 7), ("t", 1, 9)], "seg string, run int, who int")
    assert rows(customers.segment_quota(runs, "seg", "run", "who", 1)) == [("s", 2, 1, True), ("t", 1, 2, False)]


def test_prices_by_region_and_window(spark):
    shops = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A")], "sku int, region string")
    offers = [
        (1, "A", 9.0, at(1), at(31)), (1, None, 8.0, at(1), None), (1, "00", 7.0, at(20), None),
        (2, "B", 1.0, at(1), None), (2, "A", 5.0, at(1), at(2)),
    ]
    frame = spark.createDataFrame(offers, "sku int, region string, price double, start_time timestamp, end_time timestamp")
    out = orders.valid_prices(shops, frame, "sku", "region", F.lit(at(10)))
    assert rows(out) == [(1, "A", 8.0), (1, "B", 8.0)]


def test_profit_after_rebates_and_fees(spark):
    kind = "line int, sku int, shop int, day timestamp, price double, n double, cost double"
    lines = spark.createDataFrame([(1, 7, 1, at(5), 10.0, 2.0, 5.0), (2, 7, 2, at(9), 10.0, 1.0, None)], kind)
    rebates = [(7, date(2024, 1, 1), None, 0.1), (7, date(2024, 1, 4), date(2024, 1, 6), 0.2), (8, date(2024, 1, 1), None, 0.9)]
    rebates = spark.createDataFrame(rebates, "sku int, start date, end date, rate double")
    fees = spark.createDataFrame([(1, 0.05)], "shop int, fee_rate double")
    out = orders.profit_lines(lines, rebates, fees, "sku", "shop", "day", F.col("price"), "n")
    assert rows(out.select("line", "net_cost", "fee", "profit")) == [(1, 4.0, 0.5, 11.0), (2, None, 0.0, None)]


def test_rebate_progress_counts_bought_and_sold(spark):
    rebates = [("x", date(2024, 1, 1), date(2024, 1, 10), "value", 100.0), ("y", date(2024, 1, 1), None, "quantity", 10.0)]
    rebates = spark.createDataFrame(rebates, "sku string, start date, end date, unit string, goal double")
    moves = spark.createDataFrame([("x", at(3), 20.0, 1.0), ("x", at(11), 99.0, 1.0), ("y", at(20), 5.0, 4.0)], "sku string, at timestamp, v double, q double")
    out = orders.rebate_progress(rebates, moves, moves.where("sku = 'x'"), "sku", "at", "v", "q")
    assert rows(out.select("sku", "bought", "sold", "bought_percent")) == [("x", 20.0, 20.0, 20.0), ("y", 4.0, 0.0, 40.0)]


def test_nested_detail_keeps_rows_without_children(spark):
    detail = '[{"sku":"p","picks":[{"bin":"b","scans":[{"code":"c","n":2},{"code":"d","n":3}]},{"bin":"e"}]},{"sku":"q","picks":[]}]'
    frame = spark.createDataFrame([(1, detail), (2, None), (3, "[]")], "k int, detail string")
    got = [tuple(r) for r in orders.nested_detail(frame, "k", "detail").where("k = 1").collect()]
    want = [(1, "p", "b", "c", 2), (1, "p", "b", "d", 3), (1, "p", "e", None, None), (1, "q", None, None, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert orders.nested_detail(frame, "k", "detail").count() == 6


def test_feeds_net_of_returns(spark):
    seen = [("u", 1, "view", at(1)), ("u", 2, "add", at(2)), ("u", 3, "scroll", at(2))]
    events = spark.createDataFrame(seen, "user string, item int, event_type string, at timestamp")
    lines = [("u", 1, at(3), 5.0, 2.0), ("u", 2, at(3), 5.0, 5.0), ("v", 2, at(3), 1.0, None)]
    lines = spark.createDataFrame(lines, "user string, item int, at timestamp, quantity double, returned double")
    out = orders.recommendation_feeds(events, lines, "user", "item", "at", {"view": "view", "add": "cart"})
    want = [("u", 1, "completed", 3.0), ("u", 1, "view", 1.0), ("u", 2, "cart", 1.0), ("v", 2, "completed", 1.0)]
    assert rows(out.select("user", "item", "kind", "weight")) == want


def test_newest_rating(spark):
    kind = "o_orderkey int, o_custkey int, o_totalprice double, o_orderstatus string, o_orderdate timestamp"
    sold = spark.createDataFrame([(1, 1, 10.0, "F", at(1)), (2, 1, 5.0, "P", at(2))], kind)
    items = spark.createDataFrame([(1, 10.0, 0.0, at(3))], "l_orderkey int, l_extendedprice double, l_discount double, l_shipdate timestamp")
    ratings = spark.createDataFrame([(1, 2, at(4)), (1, 5, at(6)), (1, 4, at(6))], "o_orderkey int, rating int, rated_at timestamp")
    out = orders.order_fact(sold, items, ratings=ratings)
    assert rows(out.select("o_orderkey", "gmv_live", "fulfilled", "rating")) == [(1, 10.0, 10.0, 5), (2, 0.0, 0.0, None)]


def test_store_classes_with_promotions(spark):
    sums = [("s", 1, 10.0, 0.96, 0.1), ("s", 2, 12.0, 0.96, 0.1), ("s", 3, 13.0, 0.96, 0.9), ("s", 4, 9.0, 0.5, 0.1)]
    frame = spark.createDataFrame(sums, "store string, year int, total double, margin double, promo double")
    out = customers.store_classification(frame, "store", "year", "total", "margin", "promo").orderBy("year")
    assert [r["class"] for r in out.collect()] == ["new", "star", "growing", "weak"]


def test_stock_labels_and_ages(spark):
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "sku int")
    sold = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (2, 12)], "sku int, so int")
    assert rows(inventory.oos_label(one(1, 2, 3), sold, one(2, 2), "sku", "so")) == [(1, "OVERLAPPING", 1), (2, "IN-COMBO", 2), (3, "REAL", 0)]
    moves = spark.createDataFrame([(1, at(1), "put"), (1, at(20, 12), "pick"), (2, at(1), "put"), (3, at(1, 6), "pick")], "sku int, at timestamp, kind string")
    out = inventory.stock_ageing(moves, "sku", "at", F.col("kind") == "pick", F.lit(date(2024, 12, 31)))
    assert rows(out.select("sku", "class", "age")) == [(1, "active", "II"), (2, "dead", "II"), (3, "black", "III")]
    assert rows(inventory.nearly_out(one(1).withColumn("left", F.lit(3)), sold.withColumn("q", F.lit(2.0)), "sku", "left", "q", 1).select("sku", "demand")) == [(1, 4.0)]


def test_rules_tickets_and_ranks(spark):
    rules = spark.createDataFrame([("r", 2, 4), ("none", 5, 4), ("null", None, 4)], "rule string, low int, high int")
    assert rows(operations.expand_rules(rules, F.col("low"), F.col("high"), "hour").select("rule", "hour")) == [("r", 2), ("r", 3), ("r", 4)]
    work = spark.createDataFrame([("ann", True), ("ann", False), ("bob", True)], "who string, bad boolean")
    out = operations.productivity({"pick": work, "pack": work.where("bad")}, "who", {"errors": F.col("bad")})
    want = [("ann", "pack", 1, 1, 1), ("ann", "pick", 2, 1, 1), ("bob", "pack", 1, 1, 1), ("bob", "pick", 1, 1, 2)]
    assert rows(out) == want
    tickets = spark.createDataFrame([("ann", at(1), at(2), "good"), ("ann", at(3), at(2), "bad")], "who string, done timestamp, due timestamp, said string")
    assert rows(operations.ticket_sla(tickets, "who", "done", F.col("due"), "said", ["done"])) == [("ann", 1, 1, "bad")]


def test_channels_variants_and_classes(spark):
    a, b = spark.createDataFrame([(1, True), (2, None)], "k int, fast boolean"), spark.createDataFrame([(1,)], "id int")
    sources = {"a": (a, F.col("k"), [(F.col("fast"), "express")], "slow"), "b": (b, F.col("id"), [(F.lit(False), "x")], "y")}
    assert rows(orders.order_channels(sources)) == [(1, "a", "express"), (1, "b", "y"), (2, "a", "slow")]
    codes = spark.createDataFrame([("Ab",), ("AB",), ("ab",), ("Ab",), ("c",), (None,)], "code string")
    assert rows(customers.case_variants(codes, "code")) == [("ab", 3, ["AB", "Ab", "ab"])]
    wares = spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, "x", 3), (4, "x", 9), (5, "y", 1)], "p int, kind string, size int")
    got = rows(orders.substitute_classes(wares, "p", ["kind"], "size"))
    assert got == [("x", 1, 1, "same size", 2, 2), ("x", 1, 3, "near size", 2, 1), ("x", 1, 9, "other size", 2, 1), ("x", 3, 9, "other size", 1, 1)]
    pairs = orders.substitutes(wares, "p", ["kind"], "size")
    assert pairs.count() == sum(n * (n - 1) // 2 if s == o else n * m for _, s, o, _, n, m in got)


def test_balances_snapshots_signs_and_rollups(spark):
    told = spark.createDataFrame([("a", 10.0), ("b", 3.0), ("c", 1.0)], "k string, told double")
    hand = spark.createDataFrame([("a", 8.0), ("b", 0.0), ("d", 1.0)], "k string, hand double")
    assert rows(inventory.balance_difference(told, hand, ["k"], "told", "hand")) == [("a", 10.0, 8.0, 2.0, 0.25), ("b", 3.0, 0.0, 3.0, None)]
    days = spark.createDataFrame([(1, date(2024, 1, 3), 5), (1, date(2024, 1, 30), 6), (1, date(2024, 2, 1), 7), (None, date(2024, 1, 1), 8)], "k int, d date, n int")
    assert sorted((r.k or 0, r.n) for r in inventory.last_snapshots(days, ["k"], "d").collect()) == [(0, 8), (1, 6), (1, 7)]
    ledger = spark.createDataFrame([("r", 1.0, "back"), ("r", 3.0, "open"), (None, 2.0, "sold"), ("z", 0.0, "sold")], "ref string, q double, kind string")
    signs = [(F.col("kind") == "back", -1), (F.col("kind") == "open", 0)]
    got = inventory.signed_allocation(ledger, ["ref"], "q", signs)
    assert rows(got.select("ref", "signed", "share")) == rows(spark.createDataFrame(
        [("r", -1.0, 0.25), ("r", 0.0, 0.75), (None, 2.0, 1.0), ("z", 0.0, None)], "ref string, signed double, share double"
    ))
    states = spark.createDataFrame([("g", 1, "ok"), ("g", 1, "out"), ("g", 2, "out"), ("g", 3, "out"), ("g", 3, None)], "g string, d int, s string")
    said = inventory.status_rollup(states, [F.col("g"), F.col("d")], F.col("s") == "ok", F.col("s") == "out")
    assert rows(said) == [("g", 1, "NORMAL"), ("g", 2, "OUT"), ("g", 3, "MIXED")]


def test_territories_of_staff_at_any_level(spark):
    staff = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x")], "who string, boss string")
    owned = spark.createDataFrame([("a", 1), ("c", 3), ("d", 3), ("d", 4), ("x", 8), ("y", 9)], "who string, ward int")
    got = operations.territory_access(staff, "who", "boss", owned, "ward")
    want = [
        ("a", 1, 0), ("a", 3, 2), ("a", 4, 3), ("b", 3, 1), ("b", 4, 2), ("c", 3, 0), ("c", 4, 1), ("d", 3, 0), ("d", 4, 0),
        ("x", 8, 0), ("x", 9, 1), ("y", 8, 1), ("y", 9, 0),
    ]
    assert rows(got) == want


def shuffled_tasks(df):
    """The numbers of tasks of the shuffles that Spark leaves as they are."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"Exchange hashpartitioning\([^\n]*?, (\d+)\), REPARTITION_BY_NUM", plan)}


def in_small_tasks(spark, monkeypatch, name):
    """A query equals its SQL where a task holds few rows, and its shuffle has tasks by rows, however well they compress."""
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(scans, "TASK_ROWS", 500)
    rows = max(spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("orders", "lineitem"))
    assert shuffled_tasks(registry.QUERIES[name](spark, sf)) == {-(-rows // 500)}
    compare(spark, connect(sf), registry.QUERIES[name], registry.ORACLE_SQL[name], sf)


@pytest.mark.parametrize("name", ["b33_voucher_usage", "b32_voucher_allocation"])
def test_vouchers_in_small_tasks(spark, monkeypatch, name):
    """tasks grew with the tables."""
    in_small_tasks(spark, monkeypatch, name)


def test_b13_strategic_measures_in_small_tasks(spark, monkeypatch):
    """tasks grew with the tables."""
    in_small_tasks(spark, monkeypatch, "b13_strategic_measures")


def test_b27_price_frequency_in_small_tasks(spark, monkeypatch):
    """F8: tasks grew with the tables."""
    in_small_tasks(spark, monkeypatch, "b27_price_frequency")


def test_b62_item_discount_split_in_small_tasks(spark, monkeypatch):
    """tasks grew with the tables."""
    in_small_tasks(spark, monkeypatch, "b62_item_discount_split")


def test_substitutes_of_large_groups(spark, monkeypatch):
    """all pairs of a group were made in one task."""
    monkeypatch.setattr(orders, "BLOCK_ROWS", 7)
    wares = [(i, "x" if i % 5 else "y", None if i % 11 == 0 else i % 6) for i in range(120)] + [(3, "x", 9), (None, "x", 1), (8, None, 1), (9, None, 1)]
    got = orders.substitutes(spark.createDataFrame(wares, "p int, kind string, size int"), "p", ["kind"], "size")
    near = lambda a, b: "other size" if None in (a, b) or abs(a - b) > 2 else "near size" if a != b else "same size"
    want = [(p, q, near(s, z)) for p, k, s in wares for q, o, z in wares if None not in (p, q, k) and k == o and p < q]
    assert rows(got) == sorted(want, key=repr)
    assert shuffled_tasks(got) == {-(-(97**2 + 24**2 + 2**2) // (2 * 7**2))}


def test_substitutes_meet_sizes(spark, monkeypatch):
    """blocks were sent product by product, and each pair had its relation worked out anew."""
    monkeypatch.setattr(orders, "BLOCK_ROWS", 9)
    sizes = [None, 0.0, -0.0, 1.5, 2.0, 9.0, float("nan"), float("nan")]
    wares = [(i, "x", sizes[i * 7 % 8]) for i in range(60)] + [(100 + i, "y", 3.0) for i in range(40)] + [(7, "x", 2.0), (200, "z", 1.0)]
    got = orders.substitutes(spark.createDataFrame(wares, "p long, kind string, size double"), "p", ["kind"], "size")
    near = lambda a, b: "other size" if None in (a, b) or not abs(a - b) <= 2 else "near size" if a != b else "same size"
    want = [(p, q, near(s, z)) for p, k, s in wares for q, o, z in wares if k == o and p < q]
    assert rows(got) == sorted(want, key=repr)
    above, below = got._jdf.queryExecution().executedPlan().toString().split("Generate explode(_others", 1)
    assert "CASE" not in above and "CASE" in below.split("Join")[0]
    assert "collect_list" in below.split("REPARTITION_BY_NUM")[1]
