import random
from datetime import datetime, timedelta

import pytest

from lakeloom.plans import customers

AS_OF = datetime(2024, 6, 1)
NAMES = "segment_id segments time_range count_order sum_gmv operator range1 products1 range2 products2".split()


def day_of(text):
    return datetime.strptime(text, "%Y-%m-%d") if "-" in text else AS_OF - timedelta(days=int(text))


def inside(text, day):
    if not text:
        return True
    start, *end = text.replace('"', "").split(",")
    return day_of(start) <= day <= (day_of(end[0]) if end else AS_OF)


def meets(text, value):
    if text is None:
        return True
    numbers = [float(x) for x in text.strip("><=").split(",")]
    if text[0] not in "><":
        return (value or 0) == numbers[0]
    if value is None:
        return False
    if text.startswith("><"):
        return numbers[0] < value < numbers[1]
    return value > numbers[0] if text[0] == ">" else value < numbers[0]


def plain(rules, people, orders, items):
    out = []
    live = [o for o in orders if o[4] != "P"]
    for rule in rules:
        r = dict(zip(NAMES, rule, strict=True))

        def bought(who, i):
            listed = r[f"products{i}"]
            wanted = None if listed is None else {int(x) for x in listed.split(",")}
            return any(
                o[1] == who and inside(r[f"range{i}"], o[3]) and any(k == o[0] and (wanted is None or p in wanted) for k, p in items)
                for o in live
            )

        for who, segment in people:
            if r["segments"] is not None and segment not in [x.strip() for x in r["segments"].split(",")]:
                continue
            mine = [o for o in live if o[1] == who and inside(r["time_range"], o[3])]
            n, gmv = (len(mine), sum(o[2] for o in mine)) if mine else (None, None)
            if not (meets(r["count_order"], n) and meets(r["sum_gmv"], gmv)):
                continue
            kind = r["operator"]
            if kind is None or (kind == "NEW" and not bought(who, 1)) or (kind in ("CHURN", "EXCEPT") and bought(who, 1) and not bought(who, 2)):
                out.append((r["segment_id"], who))
    return sorted(out)


def tables(spark, rnd, n_rules, n_people, n_orders):
    people = [(c, rnd.choice(["A", "B", "C"])) for c in range(n_people)]
    orders = [
        (k, rnd.randrange(n_people - 2), rnd.randint(1, 9) * 10.25, AS_OF - timedelta(days=rnd.randint(-3, 60)), rnd.choice("OOOP"))
        for k in range(n_orders)
    ]
    items = [(rnd.randrange(n_orders), rnd.randint(1, 6)) for _ in range(2 * n_orders)]
    span = lambda: rnd.choice([None, "10", "30,5", "45", "0", '"2024-05-01","2024-05-20"', "20,20", "59,58"])
    wares = lambda: rnd.choice([None, None, "1", "2, 3", "4,5,6", "99"])
    rules = [
        (
            i, rnd.choice([None, None, "A", "A, C"]), span(), rnd.choice([None, "0", "2", ">1", "<3", "><0,4"]),
            rnd.choice([None, None, ">30", "<60", "><20,90"]), rnd.choice([None, "NEW", "CHURN", "EXCEPT"]), span(), wares(), span(), wares(),
        )
        for i in range(n_rules)
    ]
    schema = ", ".join(f"{n} {'int' if n == 'segment_id' else 'string'}" for n in NAMES)
    return (rules, people, orders, items), (
        spark.createDataFrame(rules, schema), spark.createDataFrame(people, "c_custkey int, c_mktsegment string"),
        spark.createDataFrame(orders, "o_orderkey int, o_custkey int, o_totalprice double, o_orderdate timestamp, o_orderstatus string"),
        spark.createDataFrame(items, "l_orderkey int, l_partkey long"),
    )


@pytest.mark.parametrize("n_rules,n_people,n_orders", [(400, 12, 80), (10_000, 4, 12)])
def test_rules_equal_plain_version(spark, n_rules, n_people, n_orders):
    """Ten thousand rules are evaluated like ten."""
    raw, frames = tables(spark, random.Random(n_rules), n_rules, n_people, n_orders)
    got = customers.dynamic_segment(*frames, "2024-06-01")
    assert sorted((r.segment_id, r.c_custkey) for r in got.collect()) == plain(*raw)


def test_rules_plan_no_nested_loop(spark):
    _, frames = tables(spark, random.Random(1), 5, 5, 10)
    plan = customers.dynamic_segment(*frames, "2024-06-01")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_an_unknown_operator_raises(spark):
    raw, frames = tables(spark, random.Random(1), 1, 5, 10)
    rule = spark.createDataFrame([(1, None, None, None, None, "SOMETIMES", None, None, None, None)], frames[0].schema)
    with pytest.raises(Exception, match="no operator SOMETIMES"):
        customers.dynamic_segment(rule, *frames[1:], "2024-06-01").collect()


def test_no_rules(spark):
    _, frames = tables(spark, random.Random(1), 1, 5, 10)
    assert customers.dynamic_segment(frames[0].limit(0), *frames[1:], "2024-06-01").collect() == []
