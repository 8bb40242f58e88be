"""Stock balances and movements, status through time, and items out of stock."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import relational as R
from lakeloom.operators import scans as S

from .registry import day_text, query, t


def stock_balance(stock_in: DataFrame, stock_out: DataFrame, keys: list[str], quantity: str) -> DataFrame:
    """In less out by key; a missing side counts as zero and is named in `only`."""
    a = stock_in.groupBy(*keys).agg(F.sum(quantity).alias("total_in"))
    b = stock_out.groupBy(*keys).agg(F.sum(quantity).alias("total_out"))
    only = F.when(F.col("total_out").isNull(), "in").when(F.col("total_in").isNull(), "out")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return (
        a
        .join(b, keys, "full")
        .withColumn("only", only)
        .withColumns({"total_in": zero("total_in"), "total_out": zero("total_out")})
        .withColumn("balance", F.col("total_in") - F.col("total_out"))
    )


def _flows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    items = t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    return items.where("l_returnflag <> 'R'"), items.where("l_returnflag = 'R'")


_BALANCE = """bal AS (SELECT l_partkey, l_suppkey, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 0) AS
total_in, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS total_out,
    CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') = 0 THEN 'in' WHEN count(*) FILTER (WHERE l_returnflag <> 'R')
    = 0 THEN 'out' END AS only FROM lineitem GROUP BY ALL)"""


@query("b15_stock_balance", f"WITH {_BALANCE} SELECT *, total_in - total_out AS balance FROM bal")
def b15_stock_balance(spark, sf_dir):
    """Received items as stock in, returned ones as stock out."""
    return stock_balance(*_flows(spark, sf_dir), ["l_partkey", "l_suppkey"], "l_quantity")


def balance_difference(balance: DataFrame, hand: DataFrame, keys: list[str], told: str, counted: str) -> DataFrame:
    """What the books and the count say of each key, their absolute difference, and that as a share of the count (null
    where nothing was counted).
    """
    diff = F.abs(F.col(told) - F.col(counted))
    return balance.select(*keys, told).join(hand.select(*keys, counted), keys).withColumns(
        {"diff": diff, "diff_share": F.round(F.try_divide(diff, counted), 6)}
    )


@query(
    "b16_balance_diff",
    f"""WITH {_BALANCE} SELECT l_partkey, balance, on_hand, abs(balance - on_hand) AS diff, round(abs(balance - on_hand)
    / nullif(on_hand, 0), 6) AS diff_share
    FROM (SELECT l_partkey, sum(total_in - total_out) AS balance FROM bal GROUP BY 1) JOIN (SELECT p_partkey, p_size *
    10.0 AS on_hand FROM part) ON p_partkey = l_partkey""",
)
def b16_balance_diff(spark, sf_dir):
    """Balance against stock on hand."""
    balance = stock_balance(*_flows(spark, sf_dir), ["l_partkey"], "l_quantity")
    hand = t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), (F.col("p_size") * F.lit(10.0)).alias("on_hand")
    )
    return balance_difference(balance, hand, ["l_partkey"], "balance", "on_hand")


def last_snapshots(snapshots: DataFrame, keys: list[str], day: str, grain: str = "month") -> DataFrame:
    """Of daily snapshots the last of each key and month (or another grain): an aggregate, combined before it is shuffled."""
    newest = F.max_by(F.struct(*snapshots.columns), day).alias("_last")
    return snapshots.groupBy(*keys, F.trunc(day, grain).alias("_grain")).agg(newest).select("_last.*")


@query(
    "b17_snapshots",
    """SELECT p, strftime(d, '%Y-%m-%d') AS day, q AS quantity FROM (SELECT l_partkey AS p, CAST(l_shipdate AS DATE) AS
    d, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY p, date_trunc('month',
    d) ORDER BY d DESC) = 1""",
)
def b17_snapshots(spark, sf_dir):
    """Daily snapshots, the last one of each month."""
    daily = t(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").alias("p"), F.to_date("l_shipdate").alias("d")
    ).agg(F.sum("l_quantity").alias("quantity"))
    return last_snapshots(daily, ["p"], "d").select("p", day_text("d").alias("day"), "quantity")


def accounting_month(at: Column, cut_off_day: int) -> Column:
    """The month that a day counts in: the next one after the cut-off day."""
    return F.trunc(F.when(F.dayofmonth(at) > cut_off_day, F.add_months(at, 1)).otherwise(F.to_date(at)), "month")


def stock_movement(
    transfers: DataFrame, details: str, fallback: DataFrame, key: str, cut_off_day: int = 25
) -> DataFrame:
    """Transfer lines by location from a JSON array of (location, quantity), the transfer itself where that is empty;
    typed and valued.

    A move within one site is internal, one that leaves is out, else in; the price falls back to the given table's.
    """
    rows = transfers.withColumn("_d", F.explode_outer(C.json_array(details, "struct<location:string,quantity:double>")))
    kind = R.classify(
        [(F.col("from_site") == F.col("to_site"), "internal"), (F.col("from_site").isNotNull(), "out")], "in"
    )
    price = F.coalesce("price", "fallback_price")
    rows = rows.join(fallback, key, "left").withColumns(
        {
            "location": F.coalesce(F.col("_d.location"), "to_site"),
            "moved": F.coalesce(F.col("_d.quantity"), "quantity"), "kind": kind
        }
    )
    return rows.withColumns(
        {"value": F.col("moved") * price, "account_month": accounting_month(F.col("moved_at"), cut_off_day)}
    ).drop("_d")


@query(
    "b18_stock_movement",
    """SELECT kind, location, strftime(CASE WHEN day(d) > 25 THEN date_trunc('month', d + INTERVAL 1 MONTH) ELSE
    date_trunc('month', d) END, '%Y-%m') AS account_month, count(*) AS n, sum(q) AS moved, round(sum(q * coalesce(price,
    p_retailprice)), 3) AS value
    FROM (SELECT *, CASE WHEN f = s THEN 'internal' WHEN f IS NOT NULL THEN 'out' ELSE 'in' END AS kind FROM (SELECT
    l_partkey, l_shipdate AS d, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice / l_quantity END AS price,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE concat('S', l_suppkey % 3) END AS f, concat('S', l_orderkey % 3) AS s,
    CASE WHEN l_linenumber % 2 = 0 THEN concat('L', k) ELSE concat('S', l_orderkey % 3) END AS location, CASE WHEN
    l_linenumber % 2 = 0 THEN k * 1.0 ELSE l_quantity END AS q
    FROM lineitem, (VALUES (1), (2)) v(k) WHERE l_linenumber % 2 = 0 OR k = 1)) JOIN part ON p_partkey = l_partkey GROUP
    BY ALL""",
)
def b18_stock_movement(spark, sf_dir):
    """Movements by kind, location and accounting month."""
    detail = lambda k: F.struct(F.lit(f"L{k}").alias("location"), F.lit(float(k)).alias("quantity"))
    rows = t(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_shipdate").alias("moved_at"), F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(F.col("l_linenumber") != 1, F.concat(F.lit("S"), F.col("l_suppkey") % 3)).alias("from_site"),
        F.concat(F.lit("S"), F.col("l_orderkey") % 3).alias("to_site"),
        F.when(
            F.col("l_linenumber") % 2 == 0, F.to_json(F.array(detail(1), detail(2)))
        ).otherwise("[]").alias("details"),
    )
    fallback = t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("fallback_price")
    )
    out = stock_movement(rows, "details", fallback, "l_partkey")
    return out.groupBy("kind", "location", F.date_format("account_month", "yyyy-MM").alias("account_month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("moved").alias("moved"), F.round(F.sum("value"), 3).alias("value")
    )


def signed_allocation(
    ledger: DataFrame, reference: list[str], amount: str, signs: list[tuple[Column, int]], otherwise: int = 1
) -> DataFrame:
    """Ledger rows with `signed`, the amount with the sign of the first rule that holds, and `share`, the row's part of its
    reference's total amount (null where that is zero). The total is an aggregate joined back, so a reference with very
    many rows is no single task.
    """
    sign = reduce(lambda c, r: c.when(r[0], r[1]), signs[1:], F.when(signs[0][0], signs[0][1])).otherwise(otherwise)
    total = ledger.groupBy(*(F.col(k).alias(f"_k_{k}") for k in reference)).agg(F.sum(amount).alias("_total"))
    same = reduce(lambda a, b: a & b, (ledger[k].eqNullSafe(total[f"_k_{k}"]) for k in reference))
    rows = ledger.join(total, same).withColumns(
        {"signed": sign * F.col(amount), "share": F.try_divide(F.col(amount), F.col("_total"))}
    )
    return rows.drop("_total", *(f"_k_{k}" for k in reference))


@query(
    "b19_signed_allocation",
    """SELECT l_orderkey, sum(signed) AS signed, round(max(share), 8) AS largest_share FROM (SELECT l_orderkey, CASE
    WHEN l_returnflag = 'R' THEN -1 WHEN l_linestatus = 'O' THEN 0 ELSE 1 END * l_quantity AS signed, l_quantity /
    sum(l_quantity) OVER (PARTITION BY l_orderkey) AS share FROM lineitem) GROUP BY 1""",
)
def b19_signed_allocation(spark, sf_dir):
    """A ledger's signs, and shares of the reference's total."""
    signs = [(F.col("l_returnflag") == "R", -1), (F.col("l_linestatus") == "O", 0)]
    rows = signed_allocation(t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity", signs)
    return rows.groupBy("l_orderkey").agg(
        F.sum("signed").alias("signed"), F.round(F.max("share"), 8).alias("largest_share")
    )


def status_intervals(
    changes: DataFrame, keys: list[str], at: str, status: str, tie: str, open_end: Column
) -> DataFrame:
    """Change points as [start, end) intervals; the last one of an entity ends at `open_end`."""
    cuts = S.find_cuts(changes, keys, [at, tie])
    points = S.spans(S.changes(changes, keys, [at, tie], status, cuts=cuts), keys, [at, tie], cuts=cuts)
    return points.select(*keys, status, "start", F.coalesce("end", open_end).alias("end"))


_SPAN = """span AS (SELECT user_id, event_type, ts AS start, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts,
event_id), TIMESTAMP '2024-02-01') AS stop FROM
    (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b IS NULL OR b
    <> event_type)"""


def _spans(spark, sf_dir) -> DataFrame:
    return status_intervals(
        t(spark, sf_dir, "events"), ["user_id"], "ts", "event_type", "event_id", F.lit("2024-02-01").cast("timestamp")
    )


@query(
    "b20_status_intervals",
    f"WITH {_SPAN} SELECT user_id, event_type, CAST(epoch_us(start) AS BIGINT) AS start, CAST(epoch_us(stop) AS "
    f"BIGINT) AS stop FROM span"
)
def b20_status_intervals(spark, sf_dir):
    return _spans(spark, sf_dir).select(
        "user_id", "event_type", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("stop")
    )


def status_by_day(intervals: DataFrame, keys: list[str], status: str, first_day: str, last_day: str) -> DataFrame:
    """Each entity's status at the end of each day: the interval that holds it; days before its first change get that
    change's status, marked as filled.
    """
    last = F.lit(last_day).cast("date")
    rows = intervals.withColumns(
        {"_from": F.to_date("start"), "_to": F.least(F.date_sub(F.to_date("end"), 1), last)}
    ).where("_from <= _to")
    days = rows.select(*keys, status, F.explode(F.sequence("_from", "_to")).alias("day"), F.lit(False).alias("filled"))
    first = (
        R.top_k(intervals, keys, [F.col("start")])
        .withColumn("_to", F.date_sub(F.to_date("start"), 1))
        .where(F.col("_to") >= F.lit(first_day).cast("date"))
    )
    before = first.select(
        *keys, status, F.explode(F.sequence(F.lit(first_day).cast("date"), "_to")).alias("day"),
        F.lit(True).alias("filled")
    )
    return days.unionByName(before)


_DAYS = f"""{_SPAN}, days AS (SELECT user_id, event_type, false AS filled, CAST(unnest(generate_series(CAST(start AS
DATE), CAST(stop AS DATE) - 1, INTERVAL 1 DAY)) AS DATE) AS d FROM span
    UNION ALL SELECT user_id, event_type, true, CAST(unnest(generate_series(DATE '2024-01-01', CAST(start AS DATE) - 1,
    INTERVAL 1 DAY)) AS DATE) FROM (SELECT * FROM span QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY start) =
    1))"""


@query(
    "b21_status_by_day", f"WITH {_DAYS} SELECT user_id, event_type, filled, strftime(d, '%Y-%m-%d') AS day FROM days"
)
def b21_status_by_day(spark, sf_dir):
    """Entity by day, gaps filled from the next change."""
    out = status_by_day(_spans(spark, sf_dir), ["user_id"], "event_type", "2024-01-01", "2024-01-31")
    return out.select("user_id", "event_type", "filled", day_text("day").alias("day"))


def status_rollup(
    days: DataFrame, group: list[Column], normal: Column, out: Column, names: tuple[str, str, str] = ("NORMAL", "OUT", "MIXED")
) -> DataFrame:
    """The status of each group and day from its members: normal where any is, out where all are, else mixed."""
    status = (
        F.when(F.count_if(normal) > 0, names[0]).when(F.count_if(out) == F.count(F.lit(1)), names[1]).otherwise(names[2])
    )
    return days.groupBy(*group).agg(status.alias("status"))


@query(
    "b22_status_rollup",
    f"""WITH {_DAYS} SELECT user_id % 10 AS grp, strftime(d, '%Y-%m-%d') AS day, CASE WHEN count(*) FILTER (WHERE
    event_type = 'purchase') > 0 THEN 'NORMAL' WHEN count(*) FILTER (WHERE event_type = 'error') = count(*) THEN 'OUT'
    ELSE 'MIXED' END AS status FROM days GROUP BY ALL""",
)
def b22_status_rollup(spark, sf_dir):
    """Any normal is normal, all out is out."""
    days = status_by_day(_spans(spark, sf_dir), ["user_id"], "event_type", "2024-01-01", "2024-01-31")
    kind = F.col("event_type")
    group = [(F.col("user_id") % 10).alias("grp"), day_text("day").alias("day")]
    return status_rollup(days, group, kind == "purchase", kind == "error")


def out_of_stock(changes: DataFrame, key: str, at: str, tie: str, out: Column, as_of: Column) -> DataFrame:
    """Entities whose newest change is `out`: when it began without a break, and the days since."""
    w = W.partitionBy(key).orderBy(at, tie)
    marked = changes.withColumn("_out", out)
    current = R.gate_by_newest(marked, [key], [F.col(at).desc(), F.col(tie).desc()], F.col("_out"))
    began = current.withColumn("_began", ~F.coalesce(F.lag("_out").over(w), F.lit(False)) & F.col("_out"))
    since = began.where("_began").groupBy(key).agg(F.max(at).alias("since"))
    return since.withColumn("days_out", F.datediff(as_of, "since"))


@query(
    "b23_out_of_stock",
    """SELECT e.user_id, strftime(since, '%Y-%m-%d') AS since, date_diff('day', since, DATE '2024-01-31') AS days_out,
    count(n.event_id) AS notes FROM (SELECT user_id, max(ts) AS since FROM (SELECT *, lag(event_type) OVER (PARTITION BY
    user_id ORDER BY ts, event_id) AS b,
    first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS newest FROM events) WHERE
    newest = 'error' AND event_type = 'error' AND (b IS NULL OR b <> 'error') GROUP BY 1) e LEFT JOIN events n ON
    n.user_id = e.user_id AND n.ts > since GROUP BY ALL""",
)
def b23_out_of_stock(spark, sf_dir):
    """Who is out now, since when, and the notes after."""
    events = t(spark, sf_dir, "events")
    gone = out_of_stock(
        events, "user_id", "ts", "event_id", F.col("event_type") == "error", F.lit("2024-01-31").cast("date")
    )
    notes = (
        gone
        .join(events.select("user_id", "event_id", "ts"), "user_id", "left")
        .groupBy("user_id", "since", "days_out")
        .agg(F.count_if(F.col("ts") > F.col("since")).alias("notes"))
    )
    return notes.withColumn("since", day_text("since"))


def out_of_stock_profile(
    gone: DataFrame, key: str, notes: DataFrame, incoming: DataFrame, sales: DataFrame, at: str, value: str,
    as_of: Column, days: int = 30
) -> DataFrame:
    """out_of_stock() rows with the number of notes since, the quantity still to come, and the sales of the last `days`;
    zero where there are none.
    """
    said = (
        gone
        .select(key, "since")
        .join(notes.select(key, F.col(at).alias("_at")), key)
        .where("_at > since")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("notes"))
    )
    due = incoming.groupBy(key).agg(F.sum("quantity").alias("incoming"))
    late = sales.where((F.col(at) > F.date_sub(as_of, days)) & (F.col(at) <= as_of))
    sold = late.groupBy(key).agg(F.sum(value).alias("recent_sales"))
    out = gone.join(said, key, "left").join(due, key, "left").join(sold, key, "left")
    return out.na.fill(0, ["notes", "incoming", "recent_sales"])


@query(
    "b23_out_of_stock_profile",
    """WITH gone AS (SELECT user_id, max(ts) AS since FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER
    BY ts, event_id) AS b,
    first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS newest FROM events) WHERE
    newest = 'error' AND event_type = 'error' AND (b IS NULL OR b <> 'error') GROUP BY 1)
    SELECT user_id, strftime(since, '%Y-%m-%d') AS since, date_diff('day', since, DATE '2024-01-31') AS days_out,
    (SELECT count(*) FROM events n WHERE n.user_id = gone.user_id AND n.ts > since) AS notes,
    coalesce((SELECT sum(l_quantity) FROM lineitem WHERE l_suppkey = user_id AND l_linestatus = 'O'), 0) AS incoming,
    round(coalesce((SELECT sum(value) FROM events v WHERE v.user_id = gone.user_id AND event_type = 'purchase' AND v.ts
    > TIMESTAMP '2024-01-01' AND v.ts <= TIMESTAMP '2024-01-31'), 0), 6) AS recent_sales FROM gone""",
)
def b23_out_of_stock_profile(spark, sf_dir):
    """Incoming open lines of the supplier of that number, and 30 days of purchases, beside the notes."""
    events, now = t(spark, sf_dir, "events"), F.lit("2024-01-31").cast("date")
    gone = out_of_stock(events, "user_id", "ts", "event_id", F.col("event_type") == "error", now)
    incoming = t(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").select(
        F.col("l_suppkey").alias("user_id"), F.col("l_quantity").alias("quantity")
    )
    rows = out_of_stock_profile(
        gone, "user_id", events, incoming, events.where("event_type = 'purchase'"), "ts", "value", now
    )
    return rows.select(
        "user_id", day_text("since").alias("since"), "days_out", "notes", "incoming",
        F.round("recent_sales", 6).alias("recent_sales")
    )


def oos_label(missing: DataFrame, orders: DataFrame, bundles: DataFrame, product: str, order: str) -> DataFrame:
    """Missing products with the orders of the lookback: REAL without any, IN-COMBO where a bundle holds it, else
    OVERLAPPING.
    """
    n = orders.groupBy(product).agg(F.count_distinct(order).alias("orders"))
    inside = bundles.select(product, F.lit(True).alias("_inside")).distinct()
    rows = missing.select(product).join(n, product, "left").join(inside, product, "left").na.fill(0, ["orders"])
    rules = [(F.col("orders") == 0, "REAL"), (F.col("_inside").isNotNull(), "IN-COMBO")]
    return rows.select(product, R.classify(rules, "OVERLAPPING").alias("label"), "orders")


@query(
    "b24_oos_label",
    """SELECT p_partkey, CASE WHEN n = 0 THEN 'REAL' WHEN p_partkey % 10 = 0 THEN 'IN-COMBO' ELSE 'OVERLAPPING' END AS
    label, n AS orders FROM (SELECT p_partkey, count(DISTINCT l_orderkey) AS n FROM part LEFT JOIN lineitem ON l_partkey
    = p_partkey AND l_shipdate > TIMESTAMP '2001-08-01' WHERE p_size < 10 GROUP BY 1)""",
)
def b24_oos_label(spark, sf_dir):
    """Kinds of missing items with a lookback of orders; every tenth product is in a bundle."""
    part = t(spark, sf_dir, "part")
    late = t(spark, sf_dir, "lineitem").where(F.col("l_shipdate") > F.lit("2001-08-01").cast("timestamp"))
    return oos_label(
        part.where("p_size < 10"), late.withColumnRenamed("l_partkey", "p_partkey"), part.where("p_partkey % 10 = 0"),
        "p_partkey", "l_orderkey"
    )


def nearly_out(
    stock: DataFrame, sales: DataFrame, product: str, available: str, quantity: str, periods: float
) -> DataFrame:
    """Products of which less is available than the mean demand of one of the `periods` that the sales cover."""
    demand = sales.groupBy(product).agg((F.sum(quantity) / periods).alias("demand"))
    return stock.join(demand, product).where(F.col(available) < F.col("demand"))


@query(
    "b25_nearly_oos",
    "SELECT p_partkey, round(demand, 6) AS demand FROM part JOIN (SELECT l_partkey, sum(l_quantity) / 80 AS demand "
    "FROM lineitem GROUP BY 1) ON l_partkey = p_partkey WHERE p_size < demand"
)
def b25_nearly_oos(spark, sf_dir):
    """Less available than the average demand of a month, over 80 months of sales."""
    sales = t(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    rows = nearly_out(t(spark, sf_dir, "part"), sales, "p_partkey", "p_size", "l_quantity", 80)
    return rows.select("p_partkey", F.round("demand", 6).alias("demand"))


def expense_hierarchy(rows: DataFrame, sheet: str, line: str, head: Column, code: Column) -> DataFrame:
    """Sheet rows with the nearest head above them in their sheet as `parent`, and a code cut out of a cell."""
    filled = S.segmented_scan(rows.withColumn("_head", head), [sheet], [line], parent=S.last_known("_head"))
    return filled.withColumn("code", code).drop("_head")


@query(
    "b53_expense_hierarchy",
    """SELECT p_partkey, last_value(CASE WHEN p_partkey % 10 = 0 THEN p_name END IGNORE NULLS) OVER (PARTITION BY
    p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS parent, string_split(p_brand, '#')[2] AS code FROM part""",
)
def b53_expense_hierarchy(spark, sf_dir):
    """Parents of sheet rows filled downward."""
    head = F.when(F.col("p_partkey") % 10 == 0, F.col("p_name"))
    return expense_hierarchy(
        t(spark, sf_dir, "part"), "p_brand", "p_partkey", head, C.part_at("p_brand", "#", 1)
    ).select("p_partkey", "parent", "code")


def status_then_and_now(changes: DataFrame, key: str, status: str, at: str, tie: str, then: Column) -> DataFrame:
    """The status of each entity at its last change before a time, and at its last change of all."""
    newest = lambda df, n: df.groupBy(key).agg(R.latest_value(status, at, tie).alias(n))
    return newest(changes.where(F.col(at) < then), "before").join(newest(changes, "now"), key, "full")


@query(
    "b59_month_end_status",
    """SELECT coalesce(a.u, b.u) AS user_id, a.s AS before, b.s AS now FROM (SELECT user_id AS u, arg_max(event_type,
    (ts, event_id)) AS s FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1) a FULL JOIN (SELECT user_id AS u,
    arg_max(event_type, (ts, event_id)) AS s FROM events GROUP BY 1) b ON a.u = b.u""",
)
def b59_month_end_status(spark, sf_dir):
    """The status at a day against now."""
    return status_then_and_now(
        t(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id", F.lit("2024-01-16").cast("timestamp")
    )


def stock_ageing(
    moves: DataFrame, product: str, at: str, picked: Column, as_of: Column, near: int = 90, far: int = 365
) -> DataFrame:
    """Products by days since the last pick (active, black over `near`, dead over `far` or never) and since the last put
    (I, II, III).
    """
    days = lambda c: F.datediff(as_of, F.max(F.when(c, F.col(at))))
    rows = moves.groupBy(product).agg(days(picked).alias("pick"), days(~picked).alias("put"))
    pick, put = F.col("pick"), F.col("put")
    kind = R.classify([(pick.isNull() | (pick > far), "dead"), (pick > near, "black")], "active")
    return rows.withColumns({"class": kind, "age": R.classify([(put <= near, "I"), (put <= far, "II")], "III")})


@query(
    "b61_stock_ageing",
    """SELECT l_partkey, CASE WHEN pick IS NULL OR pick > 365 THEN 'dead' WHEN pick > 90 THEN 'black' ELSE 'active' END
    AS class, CASE WHEN put <= 90 THEN 'I' WHEN put <= 365 THEN 'II' ELSE 'III' END AS age FROM (SELECT l_partkey,
    date_diff('day', max(l_shipdate) FILTER (WHERE l_returnflag = 'R'), DATE '2001-11-04') AS pick,
    date_diff('day', max(l_shipdate) FILTER (WHERE l_returnflag <> 'R'), DATE '2001-11-04') AS put FROM lineitem GROUP
    BY 1)""",
)
def b61_stock_ageing(spark, sf_dir):
    """Days since the last pick and put to classes; returned lines are picks."""
    rows = stock_ageing(
        t(spark, sf_dir, "lineitem"), "l_partkey", "l_shipdate", F.col("l_returnflag") == "R",
        F.lit("2001-11-04").cast("date")
    )
    return rows.select("l_partkey", "class", "age")


def location_flow(
    locations: DataFrame, stock_in: DataFrame, stock_out: DataFrame, location: str, quantity: str
) -> DataFrame:
    """Total in, total out and what is there now for each listed location, zero where nothing moved."""
    flow = stock_balance(stock_in, stock_out, [location], quantity).withColumnRenamed("balance", "now").drop("only")
    return locations.select(location).join(flow, location, "left").na.fill(0.0)


@query(
    "b63_damage_flow",
    f"""WITH {_BALANCE} SELECT s_suppkey, coalesce(sum(total_in), 0) AS total_in, coalesce(sum(total_out), 0) AS
    total_out, coalesce(sum(total_in - total_out), 0) AS now FROM supplier LEFT JOIN bal ON l_suppkey = s_suppkey WHERE
    s_acctbal < 5000 GROUP BY 1""",
)
def b63_damage_flow(spark, sf_dir):
    """Stock, in and out for a list of locations; suppliers of a low balance are the damage locations."""
    stock_in, stock_out = (df.withColumnRenamed("l_suppkey", "s_suppkey") for df in _flows(spark, sf_dir))
    listed = t(spark, sf_dir, "supplier").where("s_acctbal < 5000")
    return location_flow(
        listed, stock_in, stock_out, "s_suppkey", "l_quantity"
    ).select("s_suppkey", "total_in", "total_out", "now")
