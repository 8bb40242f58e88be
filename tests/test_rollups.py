import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import rollups as U


def told(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_merged_sketches_tell_ranks_within_their_error(spark):
    rnd = random.Random(1)
    rows = [(h % 24, h // 24, rnd.lognormvariate(0, 2)) for h in range(96) for _ in range(rnd.randint(1, 400))] + [(0, 0, None), (0, 0, float("nan"))]
    df = spark.createDataFrame(rows, "hour int, day int, v double").repartition(5)
    hours = U.quantile_sketches(df, ["day", "hour"], "v")
    for keys in (["day"], []):
        got = U.sketch_quantiles(U.merge_sketches(hours, keys), {"p01": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99}).collect()
        for r in got:
            values = sorted(v for _, day, v in rows if v is not None and v == v and (not keys or day == r.day))
            assert r.n == len(values) and (r.low, r.high) == (values[0], values[-1])
            for name, rank in (("p01", 0.01), ("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
                assert abs(sum(v <= r[name] for v in values) / len(values) - rank) < 0.01
    whole = U.sketch_distribution(U.merge_sketches(hours, [])).orderBy("bucket").collect()
    values = sorted(v for _, _, v in rows if v is not None and v == v)
    assert [r.bucket for r in whole] == list(range(101)) and (whole[0].value, whole[100].value) == (values[0], values[-1])
    assert [r.value for r in whole] == sorted(r.value for r in whole) and [r.tail for r in whole].index(True) == 95


def test_bitmaps_roll_up_exactly(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.randint(1, 12), rnd.choice([None, rnd.randint(1, 200_000), rnd.randint(1, 50)])) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "region string, month int, who long").repartition(3)
    stored = U.distinct_bitmaps(df, ["region", "month"], "who").cache()
    for keys in (["region", "month"], ["month"], ["region"], []):
        want = df.where("who IS NOT NULL").groupBy(*keys).agg(F.count_distinct("who").alias("n"))
        assert told(U.count_bitmaps(stored, keys), *keys, "n") == told(want, *keys, "n")


@pytest.mark.parametrize("seed", range(3))
def test_checksum_difference_equals_except_all(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(1, 60), rnd.choice(["x", "y", None]), rnd.choice([None, 1.5, 2.5])) for _ in range(300)]
    other = rows[:]
    for _ in range(seed * 4):
        other[rnd.randrange(len(other))] = (rnd.randint(1, 60), None, 9.5)
    other += rows[:seed]
    rnd.shuffle(other)
    schema = "k int, s string, v double"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    want = a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))
    assert told(U.checksum_difference(a, b, ["k"], 16)) == told(want)


def test_equal_tables_compare_no_rows(spark):
    a = spark.range(1_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = U.checksum_difference(a, a.orderBy(F.desc("k")), ["k"])
    assert got.collect() == []
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    swapped = spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    assert U.checksum_difference(swapped, spark.createDataFrame([(1, "x", None)], swapped.schema), ["k"]).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_contributions_equal_a_full_refresh(spark, seed):
    rnd = random.Random(seed)
    schema = "id int, k string, amount decimal(12,2), at int"
    new = lambda i: (i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, Decimal(rnd.randint(0, 999)) / 100]), rnd.choice([None, rnd.randint(1, 30)]))
    table = {i: new(i) for i in range(40)}
    frame = lambda rows: spark.createDataFrame(list(rows), schema)
    spec = {"sums": {"total": F.col("amount")}, "least": {"first": F.col("at")}, "most": {"last": F.col("at"), "top": F.col("amount")}}
    fact = U.contributions(frame(table.values()), ["k"], **spec)
    for _ in range(2):
        ids = rnd.sample(sorted(table), 9)
        before = [table[i] for i in ids]
        if seed == 3:  # a whole group goes
            before += [r for r in table.values() if r[1] == "a" and r not in before]
            ids = [r[0] for r in before]
        after = [new(i) for i in ids[:5] if seed != 3] + [new(i) for i in range(max(table) + 1, max(table) + 4)]
        for i in ids:
            del table[i]
        table |= {r[0]: r for r in after}
        fact = U.apply_changes(fact, frame(before), frame(after), frame(table.values()), ["k"], **spec)
        fact = spark.createDataFrame(fact.collect(), fact.schema)
        assert told(fact) == told(U.contributions(frame(table.values()), ["k"], **spec).select(*fact.columns))


def plain_closure(edges):
    up = {}
    for c, p in edges:
        if c is not None and p is not None:
            up.setdefault(c, set()).add(p)
    out = []
    for c in up:
        depth, level, seen = 1, set(up[c]), {}
        while level:
            for x in level:
                seen.setdefault(x, depth)
            level, depth = {p for x in level for p in up.get(x, ())} - set(seen), depth + 1
        out += [(c, a, d, c in seen) for a, d in seen.items()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("edges", [
    [(1, 0)], [(2, 1), (1, 0), (3, 1), (None, 1), (5, None), (2, 1)], [(1, 2), (2, 3), (3, 1), (9, 1)], [(7, 7)],
    [(i, i // 2) for i in range(1, 60)], [(i, j) for i in range(1, 14) for j in (i - 1, i - 2) if j >= 0], [],
])
def test_closure_equals_plain_walk(spark, edges):
    got = U.closure(spark.createDataFrame(edges, "c int, p int"), "c", "p")
    assert told(got) == plain_closure(edges)


def test_closure_of_a_thousand_levels(spark):
    chain = spark.range(1, 1_001).select(F.col("id").alias("c"), (F.col("id") - 1).alias("p"))
    got = U.closure(chain, "c", "p")
    assert got.count() == 1_000 * 1_001 // 2 and got.agg(F.max("depth")).first()[0] == 1_000
    assert got.where("depth <> child - ancestor OR cyclic").count() == 0
