"""Calendars, places, customers and sellers through time, segments and journeys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import relational as R
from lakeloom.operators import scans as S
from lakeloom.sources.io import scratch_folder

from .registry import day_text, query, t


def calendar(
    spark: SparkSession, start: str, end: str, holidays: tuple[str, ...] = (), as_of: str | None = None
) -> DataFrame:
    """One row a day: keys, bounds of week, month and quarter, ages in days and months at `as_of`, labels, holiday."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    d, now = F.col("day"), F.lit(as_of or end).cast("date")
    return days.select(
        d, F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), F.year(d).alias("year"),
        F.quarter(d).alias("quarter"), F.month(d).alias("month"), C.week_of_year(d).alias("week"),
        F.dayofweek(d).alias("day_of_week"),
        F.trunc(d, "week").alias("week_start"), F.date_add(F.trunc(d, "week"), 6).alias("week_end"),
        F.trunc(d, "month").alias("month_start"), F.last_day(d).alias("month_end"),
        F.trunc(d, "quarter").alias("quarter_start"),
        C.date_diff("DAY", now, d).alias("days_ago"), C.date_diff("MONTH", now, d).alias("months_ago"),
        F.date_format(d, "yyyy-MM").alias("month_label"),
        d.isin(*(F.lit(h).cast("date") for h in holidays)).alias("is_holiday"),
    )


@query(
    "b1_calendar",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS
    month, CAST(strftime(d, '%W') AS INTEGER) AS week, dayofweek(d) + 1 AS day_of_week,
    strftime(date_trunc('week', d), '%Y-%m-%d') AS week_start, strftime(date_trunc('week', d) + INTERVAL 6 DAY,
    '%Y-%m-%d') AS week_end, strftime(date_trunc('month', d), '%Y-%m-%d') AS month_start,
    strftime(last_day(d), '%Y-%m-%d') AS month_end, strftime(date_trunc('quarter', d), '%Y-%m-%d') AS quarter_start,
    date_diff('day', d, DATE '2001-08-01') AS days_ago, date_diff('month', d, DATE '2001-08-01') AS months_ago,
    strftime(d, '%m') = '01' AND strftime(d, '%d') = '01' AND year(d) = 2000 AS is_holiday, coalesce(n, 0) AS orders
    FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS d) LEFT
    JOIN (SELECT CAST(o_orderdate AS DATE) AS o, count(*) AS n FROM orders GROUP BY 1) ON o = d""",
)
def b1_calendar(spark, sf_dir):
    """The calendar with the orders of each day."""
    n = t(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    days = calendar(spark, "1995-01-01", "2001-08-01", ("2000-01-01",))
    out = days.join(n, "day", "left").na.fill(0, ["orders"])
    return out.select(
        "date_key", "year", "quarter", "month", "week", "day_of_week",
        *(day_text(c).alias(c) for c in ("week_start", "week_end", "month_start", "month_end", "quarter_start")),
        "days_ago", "months_ago", "is_holiday", "orders"
    )


def geo_hierarchy(nations: DataFrame, regions: DataFrame, urban: Column) -> DataFrame:
    """Places of both levels as one dimension: code, level, name, parent, and whether it is urban (null for regions)."""
    low = nations.select(
        F.concat(F.lit("N"), "n_nationkey").alias("code"), F.lit("nation").alias("level"),
        F.col("n_name").alias("name"), F.concat(F.lit("R"), "n_regionkey").alias("parent"),
        F.when(urban, "urban").otherwise("rural").alias("kind")
    )
    high = regions.select(
        F.concat(F.lit("R"), "r_regionkey").alias("code"), F.lit("region").alias("level"),
        F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast("string").alias("kind")
    )
    return low.unionByName(high)


@query(
    "b2_geo_hierarchy",
    """SELECT concat('N', n_nationkey) AS code, 'nation' AS level, n_name AS name, concat('R', n_regionkey) AS parent,
    CASE WHEN n_nationkey % 4 = 0 THEN 'urban' ELSE 'rural' END AS kind FROM nation
    UNION ALL SELECT concat('R', r_regionkey), 'region', r_name, NULL, NULL FROM region""",
)
def b2_geo_hierarchy(spark, sf_dir):
    return geo_hierarchy(t(spark, sf_dir, "nation"), t(spark, sf_dir, "region"), F.col("n_nationkey") % 4 == 0)


def customer_dim(
    customers: DataFrame, orders: DataFrame, nations: DataFrame, cancelled: str = "P", tags: DataFrame | None = None,
    licences: DataFrame | None = None, as_of: Column | None = None,
) -> DataFrame:
    """Profile, place, first and last order, counts, level label and flags, one row a customer.

    `tags` (c_custkey, tag) adds the sorted list of a customer's different tags; `licences` (c_custkey, kind, until)
    adds a list of the kinds that are valid at `as_of` and a flag for one that has run out; customers without any have
    empty lists.
    """
    done = orders.where(F.col("o_orderstatus") != cancelled)
    facts = done.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"),
        R.latest_value("o_orderkey", "o_orderdate", "o_orderkey").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("gmv")
    )
    level = R.classify(
        [(F.col("gmv") >= 3e6, "gold"), (F.col("gmv") >= 1.5e6, "silver"), (F.col("gmv") > 0, "bronze")], "none"
    )
    out = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(facts, "c_custkey", "left")
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    more = []
    if tags is not None:
        out = out.join(tags.groupBy("c_custkey").agg(listed("tag").alias("tags")), "c_custkey", "left")
        more.append(F.coalesce("tags", F.lit("")).alias("tags"))
    if licences is not None:
        valid = F.col("until") >= as_of
        held = licences.groupBy("c_custkey").agg(
            listed(F.when(valid, F.col("kind"))).alias("licences"), F.max(~valid).alias("lapsed")
        )
        out = out.join(held, "c_custkey", "left")
        more += [F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("lapsed", F.lit(False)).alias("lapsed")]
    return out.select(
        "c_custkey", F.initcap("c_mktsegment").alias("segment"), F.coalesce("n_name", F.lit("unknown")).alias("nation"),
        day_text("first_at").alias("first_day"), day_text("last_at").alias("last_day"), "last_order",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"), level.alias("level"),
        (F.col("c_acctbal") < 0).alias("in_debt"), *more,
    )


@query(
    "b3_customer_dim",
    """SELECT c_custkey, concat(upper(c_mktsegment[1]), lower(c_mktsegment[2:])) AS segment, n_name AS nation,
    strftime(first_at, '%Y-%m-%d') AS first_day, strftime(last_at, '%Y-%m-%d') AS last_day, last_order, coalesce(n, 0)
    AS n_orders,
    CASE WHEN gmv >= 3000000 THEN 'gold' WHEN gmv >= 1500000 THEN 'silver' WHEN gmv > 0 THEN 'bronze' ELSE 'none' END AS
    level, c_acctbal < 0 AS in_debt FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN
    (SELECT o_custkey, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, arg_max(o_orderkey, (o_orderdate,
    o_orderkey)) AS last_order, count(*) AS n, sum(o_totalprice) AS gmv FROM orders WHERE o_orderstatus <> 'P' GROUP BY
    1) ON o_custkey = c_custkey""",
)
def b3_customer_dim(spark, sf_dir):
    return customer_dim(t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders"), t(spark, sf_dir, "nation"))


@query(
    "b3_customer_tags",
    """SELECT c_custkey, coalesce(tags, '') AS tags, coalesce(licences, '') AS licences, coalesce(lapsed, false) AS lapsed
    FROM customer LEFT JOIN (SELECT o_custkey AS k, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority)
    AS tags, coalesce(string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus)
    FILTER (WHERE o_orderdate >= TIMESTAMP '2000-01-01'), '') AS licences,
    bool_or(o_orderdate < TIMESTAMP '2000-01-01') AS lapsed FROM orders GROUP BY 1) ON k = c_custkey""",
)
def b3_customer_tags(spark, sf_dir):
    """Tags and licences of customers; priorities stand for tags, an order's status and date for a licence."""
    orders = t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    tags = orders.select("c_custkey", F.col("o_orderpriority").alias("tag"))
    licences = orders.select("c_custkey", F.col("o_orderstatus").alias("kind"), F.col("o_orderdate").alias("until"))
    people, nations = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    as_of = F.lit("2000-01-01").cast("timestamp")
    rows = customer_dim(people, t(spark, sf_dir, "orders"), nations, tags=tags, licences=licences, as_of=as_of)
    return rows.select("c_custkey", "tags", "licences", "lapsed")


def monthly_activity(facts: DataFrame, entity: str, at: str, spark: SparkSession, end: str) -> DataFrame:
    """Entity by month from its first one to `end`: whether it was active, and when it last was before.

    The spine of months joins each entity from its first month on, so that its size is bounded by the entities' ages.
    """
    month = F.trunc(F.to_date(at), "month")
    active = facts.groupBy(entity, month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    first = active.groupBy(entity).agg(F.min("month").alias("first_month"))
    spine = first.select(
        entity, "first_month",
        F.explode(
            F.sequence("first_month", F.trunc(F.lit(end).cast("date"), "month"), F.expr("INTERVAL 1 MONTH"))
        ).alias("month")
    )
    rows = spine.join(active, [entity, "month"], "left").withColumn("active", F.col("n").isNotNull())
    w = W.partitionBy(entity).orderBy("month")
    last = F.last(
        F.when(F.col("active"), F.col("month")), ignorenulls=True
    ).over(w.rowsBetween(W.unboundedPreceding, -1))
    return rows.select(
        entity, "month", "first_month", "active", F.lag("active").over(w).alias("active_before"),
        last.alias("last_active")
    )


def lifecycle(activity: DataFrame) -> DataFrame:
    """Activity with one state a row: new, repeat (also active the month before), reacquired, churn (the first inactive
    month) or idle.
    """
    before = F.coalesce("active_before", F.lit(False))
    return activity.withColumn(
        "state",
        F.when(
            F.col("month") == F.col("first_month"), "new"
        ).when(F.col("active") & before, "repeat").when(F.col("active"), "reacquired").when(before, "churn").otherwise("idle")
    )


_ACTIVITY = """active AS (SELECT DISTINCT {k} AS k, date_trunc('month', {d}) AS m FROM {tab}), spine AS (SELECT k,
first, CAST(unnest(generate_series(first, TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS m FROM (SELECT k,
CAST(min(m) AS TIMESTAMP) AS first FROM active GROUP BY k)),
    acts AS (SELECT s.k, s.m, s.first, a.k IS NOT NULL AS act, lag(a.k IS NOT NULL) OVER (PARTITION BY s.k ORDER BY s.m)
    AS before, lag(a.k IS NOT NULL, 2) OVER (PARTITION BY s.k ORDER BY s.m) AS before2 FROM spine s LEFT JOIN active a
    ON a.k = s.k AND a.m = s.m)"""
_STATE = (
    "CASE WHEN m = first THEN 'new' WHEN act AND coalesce(before, false) THEN 'repeat' WHEN act THEN 'reacquired' "
    "WHEN coalesce(before, false) THEN 'churn' ELSE 'idle' END"
)


@query(
    "b9_customer_lifecycle",
    f"WITH {_ACTIVITY.format(k='o_custkey', d='o_orderdate', tab='orders')} SELECT strftime(m, '%Y-%m') AS month, "
    f"{_STATE} AS state, count(*) AS customers FROM acts GROUP BY ALL",
)
def b9_customer_lifecycle(spark, sf_dir):
    """Customers by month and state."""
    states = lifecycle(monthly_activity(t(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", spark, "2001-08-01"))
    return states.groupBy(
        F.date_format("month", "yyyy-MM").alias("month"), "state"
    ).agg(F.count(F.lit(1)).alias("customers"))


@query(
    "b11_sku_profile",
    f"""WITH {_ACTIVITY.format(k='l_partkey', d='l_shipdate', tab="(SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-08-31')")}
    SELECT strftime(m, '%Y-%m') AS month, count(*) FILTER (WHERE act) AS active, count(*) FILTER (WHERE NOT act
    AND before) AS churn_1m,
    count(*) FILTER (WHERE NOT act AND NOT before AND before2) AS churn_2m FROM acts GROUP BY 1""",
)
def b11_sku_profile(spark, sf_dir):
    """Items active, churned one and two months."""
    items = t(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("2001-08-31").cast("timestamp"))
    rows = monthly_activity(items, "l_partkey", "l_shipdate", spark, "2001-08-01")
    two = F.lag("active", 2).over(W.partitionBy("l_partkey").orderBy("month"))
    gone = ~F.col("active")
    return (
        rows
        .withColumn("two", two)
        .groupBy(F.date_format("month", "yyyy-MM").alias("month"))
        .agg(
            F.count_if("active").alias("active"), F.count_if(gone & F.col("active_before")).alias("churn_1m"),
            F.count_if(gone & ~F.col("active_before") & F.col("two")).alias("churn_2m")
        )
    )


def recency_lifecycle(orders: DataFrame, entity: str, at: str, near: int = 30, far: int = 60) -> DataFrame:
    """Each entity's purchases with a label by days since the one before: NEW, REPEAT (under `near`), REACQUIRED_NEAR
    (under `far`), REACQUIRED_FAR.
    """
    days = orders.select(entity, F.to_date(at).alias("day")).distinct()
    gap = F.datediff("day", F.lag("day").over(W.partitionBy(entity).orderBy("day")))
    return days.withColumn("gap", gap).withColumn(
        "label",
        R.classify(
            [(F.col("gap").isNull(), "NEW"), (F.col("gap") < near, "REPEAT"), (F.col("gap") < far, "REACQUIRED_NEAR")],
            "REACQUIRED_FAR"
        )
    )


@query(
    "b10_recency_lifecycle",
    """SELECT strftime(d, '%Y-%m') AS month, CASE WHEN gap IS NULL THEN 'NEW' WHEN gap < 30 THEN 'REPEAT' WHEN gap < 60
    THEN 'REACQUIRED_NEAR' ELSE 'REACQUIRED_FAR' END AS label, count(DISTINCT k) AS customers
    FROM (SELECT k, d, date_diff('day', lag(d) OVER (PARTITION BY k ORDER BY d), d) AS gap FROM (SELECT DISTINCT
    o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders)) GROUP BY ALL""",
)
def b10_recency_lifecycle(spark, sf_dir):
    rows = recency_lifecycle(t(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    return rows.groupBy(
        F.date_format("day", "yyyy-MM").alias("month"), "label"
    ).agg(F.count_distinct("o_custkey").alias("customers"))


def seller_classification(items: DataFrame, seller: str, at: str) -> DataFrame:
    """Active months of each seller with new, repeat or return, and whether the seller is gone in the month after."""
    months = items.select(seller, F.trunc(F.to_date(at), "month").alias("month")).distinct()
    w = W.partitionBy(seller).orderBy("month")
    before, after = (
        C.date_diff("MONTH", "month", F.lag("month").over(w)), C.date_diff("MONTH", F.lead("month").over(w), "month")
    )
    return months.withColumns(
        {
            "kind": R.classify([(before.isNull(), "new"), (before == 1, "repeat")], "return"),
            "gone_next": F.coalesce(after != 1, F.lit(True))
        }
    )


def monthly_recency(
    users: DataFrame, orders: DataFrame, who: str, at: str, joined: str, end: str, near: int = 30, far: int = 60
) -> DataFrame:
    """One label for each user and month from the month of joining on.

    USER_ONLY: nothing bought so far; NEW: the month of the first purchase; REPEAT, REACQUIRED_NEAR, REACQUIRED_FAR:
    bought, by the days between the month's first purchase and the one before it; CHURN: bought before, but not in this
    month. The spine is bounded by the users' ages.
    """
    month = lambda c: F.trunc(F.to_date(c), "month")
    bought = orders.groupBy(who, month(at).alias("month")).agg(
        F.to_date(F.min(at)).alias("_first"), F.to_date(F.max(at)).alias("_last")
    )
    last = F.trunc(F.lit(end).cast("date"), "month")
    spine = users.select(who, F.explode(F.sequence(month(joined), last, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    rows = spine.join(bought, [who, "month"], "left")
    before = F.last("_last", ignorenulls=True).over(
        W.partitionBy(who).orderBy("month").rowsBetween(W.unboundedPreceding, -1)
    )
    gap, none = F.datediff("_first", "_before"), F.col("_first").isNull()
    rules = [
        (none & F.col("_before").isNull(), "USER_ONLY"), (none, "CHURN"), (F.col("_before").isNull(), "NEW"),
        (gap < near, "REPEAT"), (gap < far, "REACQUIRED_NEAR"),
    ]
    return rows.withColumn("_before", before).select(who, "month", R.classify(rules, "REACQUIRED_FAR").alias("label"))


@query(
    "b10_monthly_recency",
    """WITH spine AS (SELECT k, CAST(unnest(generate_series(TIMESTAMP '1995-01-01' + to_months(CAST(k % 40 AS INTEGER)),
    TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS m FROM (SELECT c_custkey AS k FROM customer)),
    bought AS (SELECT o_custkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(min(o_orderdate) AS
    DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY ALL),
    told AS (SELECT s.k, s.m, a, last_value(b IGNORE NULLS) OVER (PARTITION BY s.k ORDER BY s.m ROWS BETWEEN UNBOUNDED
    PRECEDING AND 1 PRECEDING) AS before FROM spine s LEFT JOIN bought o ON o.k = s.k AND o.m = s.m)
    SELECT k AS c_custkey, strftime(m, '%Y-%m') AS month, CASE WHEN a IS NULL AND before IS NULL THEN 'USER_ONLY' WHEN a
    IS NULL THEN 'CHURN' WHEN before IS NULL THEN 'NEW' WHEN date_diff('day', before, a) < 30 THEN 'REPEAT'
    WHEN date_diff('day', before, a) < 60 THEN 'REACQUIRED_NEAR' ELSE 'REACQUIRED_FAR' END AS label FROM told""",
)
def b10_monthly_recency(spark, sf_dir):
    """Labels by customer and month; a customer's number gives the month of joining."""
    joined = F.add_months(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 40).cast("int"))
    users = t(spark, sf_dir, "customer").select("c_custkey", joined.alias("joined"))
    orders = t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    rows = monthly_recency(users, orders, "c_custkey", "o_orderdate", "joined", "2001-08-01")
    return rows.withColumn("month", F.date_format("month", "yyyy-MM"))


@query(
    "b12_seller_classification",
    """SELECT strftime(m, '%Y-%m') AS month, kind, count(*) AS sellers, count(*) FILTER (WHERE gone) AS gone FROM
    (SELECT k, m, CASE WHEN lag(m) OVER w IS NULL THEN 'new' WHEN date_diff('month', lag(m) OVER w, m) = 1 THEN 'repeat'
    ELSE 'return' END AS kind,
    coalesce(date_diff('month', m, lead(m) OVER w) <> 1, true) AS gone FROM (SELECT DISTINCT l_suppkey AS k,
    date_trunc('month', l_shipdate) AS m FROM lineitem) WINDOW w AS (PARTITION BY k ORDER BY m)) GROUP BY ALL""",
)
def b12_seller_classification(spark, sf_dir):
    rows = seller_classification(t(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate")
    return rows.groupBy(F.date_format("month", "yyyy-MM").alias("month"), "kind").agg(
        F.count(F.lit(1)).alias("sellers"), F.count_if("gone_next").alias("gone")
    )


def store_classification(
    sales: DataFrame, store: str, period: str, value: str, margin: str, promotion: str | None = None,
    good_margin: float = 0.95,
    high_promotion: float = 0.5,
) -> DataFrame:
    """Stores by period in five classes of growth by margin; `promotion`, a share of promoted sales, takes a star that
    lives on promotions down to growing.
    """
    growth = F.col(value) - F.lag(value).over(W.partitionBy(store).orderBy(period))
    g, high = F.col("growth"), F.col(margin) >= good_margin
    bought = F.col(promotion) > high_promotion if promotion else F.lit(False)
    rules = [(g.isNull(), "new"), ((g >= 0) & high & ~bought, "star"), (g >= 0, "growing"), (high, "solid")]
    return sales.withColumn("growth", growth).withColumn("class", R.classify(rules, "weak"))


@query(
    "b30_store_classification",
    """SELECT k AS s_suppkey, y AS year, CASE WHEN growth IS NULL THEN 'new' WHEN growth >= 0 AND margin >= 0.95 THEN
    'star' WHEN growth >= 0 THEN 'growing' WHEN margin >= 0.95 THEN 'solid' ELSE 'weak' END AS class FROM
    (SELECT k, y, total - lag(total) OVER (PARTITION BY k ORDER BY y) AS growth, margin FROM (SELECT l_suppkey AS k,
    year(l_shipdate) AS y, round(sum(l_extendedprice), 2) AS total, round(1 - sum(l_discount) / count(*), 6) AS margin
    FROM lineitem GROUP BY ALL))""",
)
def b30_store_classification(spark, sf_dir):
    """Growth by margin to five classes."""
    keys = F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year")
    margin = F.round(1 - F.sum("l_discount") / F.count(F.lit(1)), 6).alias("margin")
    sums = t(spark, sf_dir, "lineitem").groupBy(*keys).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"), margin)
    return store_classification(sums, "s_suppkey", "year", "total", "margin").select("s_suppkey", "year", "class")


def user_journey(events: DataFrame, user: str, at: str, tie: str, name: str) -> DataFrame:
    """Steps of each user with repeats collapsed: step number, event, next event. A row has the same few bytes however
    long the session is; journey_paths() tells the path up to a step.
    """
    order = [at, tie]
    cuts = S.find_cuts(events, [user], order)
    steps = S.changes(events, [user], order, name, cuts=cuts)
    return S.segmented_scan(steps, [user], order, cuts=cuts, step=S.running_sum(F.lit(1)), next_event=S.row_after(name))


def journey_paths(steps: DataFrame, user: str, name: str, separator: str = ">") -> DataFrame:
    """Each step with `path`: the text of all events of its session up to this one. A session's events are one array,
    shared by its rows until the text is made, which is the square of a session in bytes: for sessions of bounded length.
    """
    whole = steps.groupBy(user).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", name))), lambda x: x[name]).alias("_events")
    )
    text = F.array_join(F.slice("_events", F.lit(1), F.col("step").cast("int")), separator)
    return steps.join(whole, user).withColumn("path", text).drop("_events")


@query(
    "b35_user_journey",
    """SELECT event_id, row_number() OVER w AS step, string_agg(event_type, '>') OVER (w ROWS UNBOUNDED PRECEDING) AS
    path, lead(event_type) OVER w AS next_event
    FROM (SELECT * FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS d, lag(event_type) OVER (PARTITION BY user_id,
    strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS b FROM events) WHERE b IS NULL OR b <> event_type) WINDOW w AS
    (PARTITION BY user_id, d ORDER BY ts, event_id)""",
)
def b35_user_journey(spark, sf_dir):
    """A user's day as a session."""
    events = t(spark, sf_dir, "events").withColumn(
        "session", F.concat_ws("/", F.col("user_id").cast("string"), day_text("ts"))
    )
    steps = user_journey(events, "session", "ts", "event_id", "event_type")
    return journey_paths(steps, "session", "event_type").select("event_id", "step", "path", "next_event")


def daily_activity(events: DataFrame, days: DataFrame, user: str, at: str, kinds: dict[str, Column]) -> DataFrame:
    """The spine of days with the users of each kind of activity (views, chats, ...) and those with all kinds, zero
    where there are none.
    """
    marks = [F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in kinds.items()]
    users = events.groupBy(F.to_date(at).alias("day"), user).agg(*marks)
    both = F.sum(reduce(lambda a, b: a * b, (F.col(n) for n in kinds))).alias("all_kinds")
    sums = users.groupBy("day").agg(*(F.sum(n).alias(n) for n in kinds), both)
    return days.select("day").join(sums, "day", "left").na.fill(0)


@query(
    "b37_daily_activity",
    """SELECT strftime(d, '%Y-%m-%d') AS day, coalesce(v, 0) AS viewers, coalesce(b, 0) AS buyers, coalesce(both_n, 0)
    AS both_n FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE)
    AS d) LEFT JOIN
    (SELECT CAST(ts AS DATE) AS e, count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS v, count(DISTINCT
    CASE WHEN event_type = 'purchase' THEN user_id END) AS b FROM events GROUP BY 1) ON e = d LEFT JOIN
    (SELECT e2, count(*) AS both_n FROM (SELECT CAST(ts AS DATE) AS e2, user_id FROM events WHERE event_type IN ('view',
    'purchase') GROUP BY ALL HAVING count(DISTINCT event_type) = 2) GROUP BY 1) ON e2 = d""",
)
def b37_daily_activity(spark, sf_dir):
    """A spine of days with presence of two kinds."""
    kinds = {"viewers": F.col("event_type") == "view", "buyers": F.col("event_type") == "purchase"}
    rows = daily_activity(
        t(spark, sf_dir, "events"), calendar(spark, "2024-01-01", "2024-01-31"), "user_id", "ts", kinds
    )
    return rows.select(day_text("day").alias("day"), "viewers", "buyers", F.col("all_kinds").alias("both_n"))


def _range(rule: str, as_of: Column) -> tuple[Column, Column]:
    """Both ends of a rule's text range: each a date or a number of days before `as_of`; a missing end is `as_of`, a
    missing start null.
    """

    def end(i: int, default: Column) -> Column:
        said = F.replace(F.get(F.split(F.col(rule), ","), F.lit(i)), F.lit('"'), F.lit(""))
        days = C.safe_cast(F.regexp_extract(said, "[0-9]+", 0), "int")
        return F.coalesce(F.try_to_date(said, "yyyy-MM-dd"), F.date_sub(as_of, F.coalesce(days, default)))

    return end(0, F.lit(None).cast("int")), end(1, F.lit(0))


def _meets(rule: str, value: Column) -> Column:
    """Whether a value meets a threshold text: `>n`, `<n`, `n` (a missing value counts as 0) or `><n,m`; no text is met
    by all.
    """
    numbers = F.split(F.regexp_replace(rule, "[^0-9,]+", ""), ",")
    low, high = (C.safe_cast(F.get(numbers, F.lit(i)), "double") for i in (0, 1))
    operator = F.regexp_replace(rule, "[^><=]", "")
    met = (
        F.when(operator == ">", value > low)
        .when(operator == "<", value < low)
        .when(operator == "><", (value > low) & (value < high))
        .when(operator.isin("", "="), F.coalesce(value, F.lit(0)) == low)
    )
    return F.col(rule).isNull() | F.coalesce(met, F.lit(False))


def _listed(rule: str, value: str) -> Column:
    return F.col(rule).isNull() | F.array_contains(
        F.transform(F.split(F.col(rule), ","), lambda x: F.trim(x)), F.col(value).cast("string")
    )


def _range_totals(customers: DataFrame, ranges: DataFrame, live: DataFrame, items: DataFrame) -> DataFrame:
    """(c_custkey, c_mktsegment, range_id, n, gmv, sold) of every customer and range: orders and their value in the range
    (null where there are none) and items sold in it.

    Each customer's days and the edges of all ranges lie in one frame; a total of a range is the difference of the
    running totals at its two edges, so no order meets a range by comparison.
    """
    by_day = (
        live.groupBy("c_custkey", "day")
        .agg(F.count_distinct("o_orderkey").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(30,6)")).alias("gmv"))
        .join(
            live.join(items, "o_orderkey").groupBy("c_custkey", "day").agg(F.count(F.lit(1)).alias("sold")),
            ["c_custkey", "day"], "left",
        )
    )
    both = ranges.select(
        "range_id",
        # An open range has all days; the running total before the first is the edge of no day at all.
        F.explode(F.array(
            F.struct(F.lit(1).alias("sign"), F.when(F.col("from").isNull(), F.lit("9999-12-31").cast("date")).otherwise(F.col("to")).alias("day")),
            F.struct(F.lit(-1).alias("sign"), F.coalesce(F.date_sub("from", 1), F.lit("0001-01-01").cast("date")).alias("day")),
        )).alias("e"),
    ).select("range_id", "e.sign", "e.day")
    edges = both.agg(F.collect_list(F.struct("range_id", "sign", "day")).alias("edges")).scalar()
    asked = customers.select("c_custkey", "c_mktsegment", F.explode(edges).alias("e")).select(
        "c_custkey", "c_mktsegment", "e.range_id", "e.sign", "e.day"
    )
    rows = by_day.withColumn("asked", F.lit(0)).unionByName(asked.withColumn("asked", F.lit(1)), allowMissingColumns=True)
    values = ("n", "gmv", "sold")
    rows = S.segmented_scan(
        rows, ["c_custkey"], ["day", "asked", "range_id", "sign"], **{f"to_{v}": S.running_sum(v) for v in values}
    ).where("asked = 1")
    sums = {v: F.sum(F.col("sign") * F.coalesce(F.col(f"to_{v}"), F.lit(0))) for v in values}
    out = rows.groupBy("c_custkey", "c_mktsegment", "range_id").agg(*(c.alias(v) for v, c in sums.items()))
    some = F.col("n") > 0
    return out.withColumns({"gmv": F.when(some, F.col("gmv").cast("double")), "n": F.when(some, F.col("n"))})


def dynamic_segment(
    rules: DataFrame, customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: str, cancelled: str = "P"
) -> DataFrame:
    """(segment_id, c_custkey) of the customers that meet each rule row; every part of a rule may be null.

    segments: comma list of market segments; time_range with count_order and sum_gmv: thresholds on the orders in it;
    operator with range1, products1, range2, products2: NEW (nothing bought of the first), CHURN and EXCEPT (bought of
    the first, nothing of the second). Any number of rules: each customer's totals are found once for each distinct
    range, from running totals by day; rules meet them, and the sold items of the products that they list, by equal
    joins. `customers` has a row a customer.
    """
    now, names = F.lit(as_of).cast("date"), ("time_range", "range1", "range2")
    parsed = rules
    for name in names:
        start, end = _range(name, now)
        parsed = parsed.withColumns({f"{name}_from": start, f"{name}_to": end}).withColumn(
            name + "_id", F.concat_ws("/", F.coalesce(F.col(f"{name}_from").cast("string"), F.lit("")), F.col(f"{name}_to").cast("string"))
        )
    ranges = reduce(DataFrame.unionByName, (
        parsed.select(F.col(f"{n}_id").alias("range_id"), F.col(f"{n}_from").alias("from"), F.col(f"{n}_to").alias("to")) for n in names
    )).distinct()
    live = orders.where(F.col("o_orderstatus") != cancelled).select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice", F.to_date("o_orderdate").alias("day")
    )
    items = items.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    spark, path = customers.sparkSession, scratch_folder(customers.sparkSession, "range-totals")
    totals = _range_totals(customers, ranges, live, items)
    totals.write.parquet(path)  # rules meet them up to three times
    totals = spark.read.schema(totals.schema).parquet(path)
    sold = live.join(items, "o_orderkey").select("c_custkey", "l_partkey", "day")

    def bought(i: int) -> DataFrame:
        used = parsed.where(F.col("operator").isin(*(("NEW", "CHURN", "EXCEPT") if i == 1 else ("CHURN", "EXCEPT"))))
        product = F.explode(
            F.array_distinct(F.transform(F.split(f"products{i}", ","), lambda x: C.safe_cast(F.trim(x), "long")))
        )
        start = F.coalesce(f"range{i}_from", F.lit("0001-01-01").cast("date"))
        end = F.when(F.col(f"range{i}_from").isNotNull(), F.col(f"range{i}_to"))  # no start: all days
        listed = used.where(F.col(f"products{i}").isNotNull()).select(
            "segment_id", product.alias("l_partkey"), start.alias("_from"), end.alias("_to")
        )
        named = sold.join(listed.select("l_partkey").distinct(), "l_partkey", "left_semi").distinct()
        listed = S.range_join(named, listed, "day", "_from", "_to", ["l_partkey"]).select("segment_id", "c_custkey")
        open_lists = used.where(F.col(f"products{i}").isNull()).select("segment_id", F.col(f"range{i}_id").alias("range_id"))
        any_product = totals.where("sold > 0").join(open_lists, "range_id").select("segment_id", "c_custkey")
        return listed.unionByName(any_product).distinct().withColumn(f"bought{i}", F.lit(True))

    keys = ["segment_id", "c_custkey"]
    rows = totals.join(parsed.withColumn("range_id", F.col("time_range_id")), "range_id").where(
        _listed("segments", "c_mktsegment") & _meets("count_order", F.col("n").cast("double")) & _meets("sum_gmv", F.col("gmv"))
    )
    rows = rows.select(*keys, "operator").join(bought(1), keys, "left").join(bought(2), keys, "left")
    one, two = F.col("bought1").isNotNull(), F.col("bought2").isNotNull()
    kind = F.col("operator")
    met = (
        F.when(kind.isNull(), True)
        .when(kind == "NEW", ~one)
        .when(kind.isin("CHURN", "EXCEPT"), one & ~two)
        .otherwise(F.raise_error(F.concat(F.lit("no operator "), kind)))
    )
    return rows.where(met).select(*keys)


_SEGMENT = """live AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'P'), sold AS (SELECT
o_custkey, d, l_partkey FROM live JOIN lineitem ON l_orderkey = o_orderkey), seg AS (
    SELECT 1 AS segment_id, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM live WHERE d BETWEEN DATE
    '2000-08-01' AND DATE '2001-08-01' GROUP BY 1 HAVING count(*) > 2) AND c_custkey NOT IN (SELECT o_custkey FROM sold
    WHERE d BETWEEN DATE '2001-07-02' AND DATE '2001-08-01')
    UNION ALL SELECT 2, c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey IN (SELECT
    o_custkey FROM live WHERE d BETWEEN DATE '1999-01-01' AND DATE '2000-12-31' GROUP BY 1 HAVING sum(o_totalprice) >
    500000 AND sum(o_totalprice) < 1500000)
    UNION ALL SELECT 3, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM sold WHERE d BETWEEN DATE
    '1999-08-02' AND DATE '2000-07-31') AND c_custkey NOT IN (SELECT o_custkey FROM sold WHERE d BETWEEN DATE
    '2000-08-01' AND DATE '2001-08-01')
    UNION ALL SELECT 4, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM live WHERE d BETWEEN DATE
    '2001-05-03' AND DATE '2001-08-01')
    UNION ALL SELECT 5, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM sold WHERE l_partkey IN (10,
    20, 30, 40, 50)) AND c_custkey NOT IN (SELECT o_custkey FROM sold WHERE l_partkey IN (11, 21)))"""


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "segment_id segments time_range count_order sum_gmv operator range1 products1 range2 products2".split()
    rules = [
        {"segment_id": 1, "time_range": "365", "count_order": ">2", "operator": "NEW", "range1": "30"},
        {
            "segment_id": 2, "segments": "BUILDING, MACHINERY", "time_range": '"1999-01-01","2000-12-31"',
            "sum_gmv": "><500000,1500000"
        },
        {"segment_id": 3, "operator": "CHURN", "range1": "730,366", "range2": "365"},
        {"segment_id": 4, "time_range": "90,0", "count_order": "0"},
        {"segment_id": 5, "operator": "EXCEPT", "products1": "10, 20, 30, 40, 50", "products2": "11,21"},
    ]
    frame = spark.createDataFrame(
        [tuple(r.get(n) for n in names) for r in rules],
        ", ".join(f"{n} {'int' if n == 'segment_id' else 'string'}" for n in names)
    )
    return dynamic_segment(frame, *(t(spark, sf_dir, n) for n in ("customer", "orders", "lineitem")), "2001-08-01")


@query("b48_dynamic_segment", f"WITH {_SEGMENT} SELECT segment_id, c_custkey FROM seg")
def b48_dynamic_segment(spark, sf_dir):
    """Rule rows with text ranges, thresholds and bought or not bought products."""
    return _segments(spark, sf_dir)


def segment_quota(runs: DataFrame, segment: str, run_at: str, member: str, quota: int) -> DataFrame:
    """The newest run of each segment with its number of members, and whether that is within the quota."""
    newest = runs.groupBy(segment).agg(F.max(run_at).alias(run_at))
    n = runs.join(newest, [segment, run_at]).groupBy(segment, run_at).agg(F.count_distinct(member).alias("n"))
    return n.withColumn("allowed", F.col("n") <= quota)


@query(
    "b49_segment_quota",
    """WITH run AS (SELECT c_mktsegment AS segment, year(o_orderdate) AS run_year, o_custkey FROM orders JOIN customer
    ON c_custkey = o_custkey),
    newest AS (SELECT segment, max(run_year) AS run_year FROM run GROUP BY 1)
    SELECT segment, run_year, count(DISTINCT o_custkey) AS n, count(DISTINCT o_custkey) <= 200 AS allowed FROM run JOIN
    newest USING (segment, run_year) GROUP BY ALL""",
)
def b49_segment_quota(spark, sf_dir):
    """The newest run of each segment, gated by its size; a year's buyers of a market segment are a run."""
    people = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    runs = t(spark, sf_dir, "orders").join(people, "o_custkey").withColumn(
        "run_year", F.year("o_orderdate").cast("long")
    )
    return segment_quota(runs, "segment", "run_year", "o_custkey", 200)


def filter_active_segment(
    customers: DataFrame, orders: DataFrame, lists: dict[str, str], kind: str, since: Column, until: Column
) -> DataFrame:
    """Customers whose columns are in comma lists, less those with an order in the range for kind NEW; other kinds fail.
    """
    if kind not in ("NEW", "ALL"):
        raise ValueError(f"no segment kind {kind!r}")
    for column, said in lists.items():
        customers = customers.where(F.col(column).isin(*(x.strip() for x in said.split(","))))
    bought = orders.where(F.col("o_orderdate").between(since, until)).select(F.col("o_custkey").alias("c_custkey"))
    return customers.join(bought, "c_custkey", "left_anti") if kind == "NEW" else customers


@query(
    "p13_active_segment",
    "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey NOT IN (SELECT "
    "o_custkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2001-05-01' AND TIMESTAMP '2001-08-01')"
)
def p13_active_segment(spark, sf_dir):
    """Comma lists and a relative range."""
    import datetime as dt

    start, end = C.relative_range("l3m", dt.date(2001, 8, 1))
    stamp = lambda d: F.lit(d.isoformat()).cast("timestamp")
    return filter_active_segment(
        t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders"), {"c_mktsegment": "BUILDING, MACHINERY"}, "NEW",
        stamp(start), stamp(end)
    ).select("c_custkey")


def case_variants(df: DataFrame, code: str) -> DataFrame:
    """(folded, variants, spellings): codes that are spelt in several ways that differ in letter case alone, with the
    spellings in order.
    """
    spelt = df.where(F.col(code).isNotNull()).select(F.lower(code).alias("folded"), F.col(code).alias("_code")).distinct()
    found = spelt.groupBy("folded").agg(F.count(F.lit(1)).alias("variants"), F.sort_array(F.collect_list("_code")).alias("spellings"))
    return found.where("variants > 1")


@query(
    "b54_case_variants",
    "SELECT lower(code) AS folded, count(DISTINCT code) AS variants FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN "
    "p_brand ELSE upper(p_brand) END AS code FROM part) GROUP BY 1 HAVING count(DISTINCT code) > 1"
)
def b54_case_variants(spark, sf_dir):
    """Codes that differ only in letter case."""
    code = F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.upper("p_brand"))
    return case_variants(t(spark, sf_dir, "part").select(code.alias("code")), "code").select("folded", "variants")


def shortlist(rows: DataFrame, who: str, product: str, at_least: int) -> DataFrame:
    """Who took at least so many different products of the rows, with the sorted list of them."""
    kinds = rows.groupBy(who).agg(F.sort_array(F.collect_set(product)).alias("_kinds"))
    return kinds.select(
        who, F.size("_kinds").cast("long").alias("n"), F.array_join("_kinds", ",").alias("kinds")
    ).where(F.col("n") >= at_least)


@query(
    "b55_shortlist",
    """SELECT o_custkey, count(DISTINCT p_type) AS n, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS kinds FROM
    orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey AND p_brand IN ('Brand#1',
    'Brand#2', 'Brand#3') GROUP BY 1 HAVING count(DISTINCT p_type) >= 3""",
)
def b55_shortlist(spark, sf_dir):
    """Customers with at least k of a product list."""
    parts = t(spark, sf_dir, "part").where(
        F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
    ).select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rows = t(spark, sf_dir, "lineitem").join(parts, "l_partkey").join(
        t(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    return shortlist(rows, "o_custkey", "p_type", 3)


def followup(events: DataFrame, user: str, at: str, tie: str, name: str, first: str) -> DataFrame:
    """Each `first` event that something follows: the next event of its user, and the whole seconds until then."""
    rows = S.segmented_scan(events, [user], [at, tie], _next=S.row_after(F.struct(F.col(name).alias("nxt"), F.col(at).alias("at"))))
    rows = rows.where((F.col(name) == first) & F.col("_next.nxt").isNotNull())
    seconds = F.floor((F.unix_micros("_next.at") - F.unix_micros(at)) / 1000000)
    return rows.withColumns({"nxt": F.col("_next.nxt"), "seconds": seconds}).drop("_next")


@query(
    "b57_search_followup",
    "SELECT event_id, nxt, CAST(floor(epoch(t2) - epoch(ts)) AS BIGINT) AS seconds FROM (SELECT *, lead(event_type) "
    "OVER w AS nxt, lead(ts) OVER w AS t2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) "
    "WHERE event_type = 'view' AND nxt IS NOT NULL"
)
def b57_search_followup(spark, sf_dir):
    """What follows each view, and when."""
    return followup(
        t(spark, sf_dir, "events"), "user_id", "ts", "event_id", "event_type", "view"
    ).select("event_id", "nxt", "seconds")


def channel_first_last(orders: DataFrame, who: str, at: str, online: Column) -> DataFrame:
    """Orders of each channel by customer, with the first online and the last offline time."""
    when = lambda c: F.when(c, F.col(at))
    return orders.groupBy(who).agg(
        F.count_if(online).alias("online"), F.count_if(~online).alias("offline"),
        F.min(when(online)).alias("first_online"), F.max(when(~online)).alias("last_offline"),
    )


@query(
    "b58_channel_first_last",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS online, count(*) FILTER (WHERE o_orderkey % 3 <>
    0) AS offline, strftime(min(o_orderdate) FILTER (WHERE o_orderkey % 3 = 0), '%Y-%m-%d') AS first_online,
    strftime(max(o_orderdate) FILTER (WHERE o_orderkey % 3 <> 0), '%Y-%m-%d') AS last_offline FROM orders GROUP BY
    o_custkey""",
)
def b58_channel_first_last(spark, sf_dir):
    rows = channel_first_last(t(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", F.col("o_orderkey") % 3 == 0)
    return rows.withColumns({c: day_text(c) for c in ("first_online", "last_offline")})
