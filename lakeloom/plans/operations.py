"""Process stages, backlogs, routes, tickets and territories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import relational as R
from lakeloom.operators import rollups as U
from lakeloom.operators import scans as S

from .registry import day_text, query, t

STAGES = ("signup", "view", "click", "purchase")


def stage_durations(events: DataFrame, key: str, name: str, at: str, stages: tuple[str, ...]) -> DataFrame:
    """First time of each stage, made monotone (a stage never starts before an earlier one), and whole minutes between
    them; null where a stage is missing.
    """
    first = events.groupBy(key).agg(*(F.min(F.when(F.col(name) == s, F.col(at))).alias(s) for s in stages))
    clamped = {
        s: F.when(F.col(s).isNotNull(), F.greatest(*(F.col(x) for x in stages[: i + 1]))) if i else F.col(s) for i,
        s in enumerate(stages)
    }
    rows = first.select(key, *(c.alias(s) for s, c in clamped.items()))
    minutes = {
        f"{a}_to_{b}": F.timestamp_diff("MINUTE", F.col(a), F.col(b)) for a, b in zip(stages, stages[1:], strict=False)
    }
    total = reduce(lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)), (F.col(m) for m in minutes))
    return rows.withColumns(minutes).withColumn(
        "gap", F.timestamp_diff("MINUTE", F.col(stages[0]), F.col(stages[-1])) - total
    )


_FIRST = (
    "f AS (SELECT user_id, strftime(ts, '%d') AS d, min(ts) FILTER (WHERE event_type = 'signup') AS s1, min(ts) "
    "FILTER (WHERE event_type = 'view') AS v1, min(ts) FILTER (WHERE event_type = 'click') AS c1, min(ts) FILTER "
    "(WHERE event_type = 'purchase') AS p1 FROM events GROUP BY ALL)"
)
_CLAMP = (
    f"{_FIRST}, c AS (SELECT user_id, d, s1 AS s, CASE WHEN v1 IS NOT NULL THEN greatest(s1, v1) END AS v, CASE WHEN "
    f"c1 IS NOT NULL THEN greatest(s1, v1, c1) END AS c, CASE WHEN p1 IS NOT NULL THEN greatest(s1, v1, c1, p1) END AS "
    f"p FROM f)"
)


@query(
    "b38_stage_durations",
    f"""WITH {_CLAMP}, m AS (SELECT user_id, d, date_sub('minute', s, v) AS a, date_sub('minute', v, c) AS b,
    date_sub('minute', c, p) AS e, date_sub('minute', s, p) AS whole FROM c)
    SELECT concat(user_id, '/', d) AS session, a AS signup_to_view, b AS view_to_click, e AS click_to_purchase, whole -
    (coalesce(a, 0) + coalesce(b, 0) + coalesce(e, 0)) AS gap FROM m""",
)
def b38_stage_durations(spark, sf_dir):
    """Milestones of each user's day."""
    events = t(spark, sf_dir, "events").withColumn(
        "session", F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "dd"))
    )
    return stage_durations(events, "session", "event_type", "ts", STAGES).select(
        "session", "signup_to_view", "view_to_click", "click_to_purchase", "gap"
    )


@query(
    "b39_stage_pivot",
    """SELECT user_id, strftime(min(ts) FILTER (WHERE event_type = 'view'), '%Y-%m-%d %H') AS view_started,
    strftime(max(ts) FILTER (WHERE event_type = 'view'), '%Y-%m-%d %H') AS view_done,
    strftime(min(ts) FILTER (WHERE event_type = 'click'), '%Y-%m-%d %H') AS click_started, strftime(max(ts) FILTER
    (WHERE event_type = 'click'), '%Y-%m-%d %H') AS click_done FROM events GROUP BY user_id""",
)
def b39_stage_pivot(spark, sf_dir):
    """Started and done columns by stage."""
    hour = lambda c: F.date_format(c, "yyyy-MM-dd HH")
    return R.pivot(
        t(spark, sf_dir, "events"), ["user_id"], "event_type", ["view", "click"], started=hour(F.min("ts")),
        done=hour(F.max("ts"))
    )


def backlog_ageing(tickets: DataFrame, opened: str, as_of: Column, cap: int = 121) -> DataFrame:
    """Hours since opening, rounded up and capped, with a code: 1 up to a day, 2 up to two, 3 up to five, 4 beyond."""
    hours = F.least(F.ceil((F.unix_seconds(as_of) - F.unix_seconds(opened)) / 3600), F.lit(cap))
    return tickets.withColumn("age_hours", hours).withColumn(
        "age_code", F.when(hours <= 24, 1).when(hours <= 48, 2).when(hours < cap, 3).otherwise(4)
    )


@query(
    "b40_backlog_ageing",
    """SELECT o_orderkey, h AS age_hours, CASE WHEN h <= 24 THEN 1 WHEN h <= 48 THEN 2 WHEN h < 121 THEN 3 ELSE 4 END AS
    age_code FROM (SELECT o_orderkey, least(CAST(ceil((epoch(TIMESTAMP '2001-08-01 10:30:00') - epoch(o_orderdate)) /
    3600) AS BIGINT), 121) AS h FROM orders WHERE o_orderstatus = 'O')""",
)
def b40_backlog_ageing(spark, sf_dir):
    open_ = t(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    return backlog_ageing(
        open_, "o_orderdate", F.lit("2001-08-01 10:30:00").cast("timestamp")
    ).select("o_orderkey", "age_hours", "age_code")


def expand_rules(rules: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """One row for each whole number of a rule's range, both ends included; a rule whose end is before its start or null
    gives none.
    """
    return rules.where(low <= high).withColumn(name, F.explode(F.sequence(low, high)))


@query(
    "b41_expand_rules",
    """SELECT s_suppkey, h AS hour, count(event_id) AS events FROM (SELECT s_suppkey,
    unnest(generate_series(CAST(s_suppkey % 12 AS INTEGER), CAST(s_suppkey % 12 + 6 AS INTEGER))) AS h FROM supplier)
    LEFT JOIN events ON user_id = s_suppkey AND hour(ts) = h GROUP BY ALL""",
)
def b41_expand_rules(spark, sf_dir):
    """One row for each hour of a rule's range."""
    low = (F.col("s_suppkey") % 12).cast("int")
    rules = expand_rules(t(spark, sf_dir, "supplier").select("s_suppkey"), low, low + 6, "hour")
    n = t(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("s_suppkey"), F.hour("ts").alias("hour")
    ).agg(F.count(F.lit(1)).alias("events"))
    return rules.join(n, ["s_suppkey", "hour"], "left").na.fill(0, ["events"])


def cutoff_route(tickets: DataFrame, routes: DataFrame, key: str, ready: str) -> DataFrame:
    """The first route of the weekday whose cut-off (minutes of the day) isn't before the ready time; else the first one
    of the next day.

    Routes are few (weekday by cut-off), so each ticket meets those of two weekdays.
    """
    minute, dow = F.hour(ready) * 60 + F.minute(ready), F.dayofweek(ready)
    both = tickets.select(
        key, minute.alias("_m"),
        F.explode(
            F.array(
                F.struct(dow.alias("day_of_week"), F.lit(0).alias("next_day")),
                F.struct((dow % 7 + 1).alias("day_of_week"), F.lit(1).alias("next_day"))
            )
        ).alias("x")
    ).select(key, "_m", "x.*")
    rows = both.join(routes, "day_of_week").where((F.col("next_day") == 1) | (F.col("cut_off") >= F.col("_m")))
    return R.top_k(rows, [key], [F.col("next_day"), F.col("cut_off"), F.col("route")]).select(key, "route", "next_day")


_ROUTES = (
    "routes AS (SELECT d AS day_of_week, k * 360 + d * 10 AS cut_off, concat('R', d, '-', k) AS route FROM (SELECT "
    "unnest(generate_series(1, 7)) AS d), (SELECT unnest(generate_series(1, 3)) AS k))"
)


@query(
    "b42_cutoff_route",
    f"""WITH {_ROUTES}, e AS (SELECT event_id, hour(ts) * 60 + minute(ts) AS m, dayofweek(ts) + 1 AS dow FROM events)
    SELECT event_id, route, n AS next_day FROM (SELECT event_id, route, cut_off, 0 AS n FROM e JOIN routes ON
    day_of_week = dow AND cut_off >= m
    UNION ALL SELECT event_id, route, cut_off, 1 FROM e JOIN routes ON day_of_week = dow % 7 + 1) QUALIFY row_number()
    OVER (PARTITION BY event_id ORDER BY n, cut_off, route) = 1""",
)
def b42_cutoff_route(spark, sf_dir):
    routes = spark.range(1, 8).select(
        F.col("id").cast("int").alias("day_of_week"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k")
    )
    routes = routes.select(
        "day_of_week", (F.col("k") * 360 + F.col("day_of_week") * 10).alias("cut_off"),
        F.concat(F.lit("R"), "day_of_week", F.lit("-"), "k").alias("route")
    )
    return cutoff_route(t(spark, sf_dir, "events"), routes, "event_id", "ts")


def productivity(stages: dict[str, DataFrame], worker: str, flags: dict[str, Column] | None = None) -> DataFrame:
    """Tickets of all stages by worker and stage, with the number of each flag, ranked within the stage."""
    rows = reduce(DataFrame.unionByName, (df.withColumn("stage", F.lit(n)) if n else df for n, df in stages.items()))
    counts = [F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(n) for n, c in (flags or {}).items())]
    sums = rows.groupBy(worker, "stage").agg(*counts)
    return sums.withColumn("place", F.rank().over(W.partitionBy("stage").orderBy(F.col("n").desc())))


@query(
    "b43_productivity",
    """SELECT worker, stage, n, late, rank() OVER (PARTITION BY stage ORDER BY n DESC) AS place FROM (SELECT l_suppkey
    AS worker, 'ship' AS stage, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'O') AS late FROM lineitem GROUP BY
    1
    UNION ALL SELECT o_custkey % 50, 'order', count(*), count(*) FILTER (WHERE o_orderstatus = 'O') FROM orders GROUP BY
    1 UNION ALL SELECT user_id, event_type, count(*), count(*) FILTER (WHERE value > 50) FROM events GROUP BY ALL)""",
)
def b43_productivity(spark, sf_dir):
    """Tickets of all stages with a flag, ranked by worker."""
    ships = t(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("worker"), (F.col("l_linestatus") == "O").alias("is_late")
    )
    orders = t(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).alias("worker"), (F.col("o_orderstatus") == "O").alias("is_late")
    )
    events = t(spark, sf_dir, "events").select(
        F.col("user_id").alias("worker"), (F.col("value") > 50).alias("is_late"), F.col("event_type").alias("stage")
    )
    return productivity({"ship": ships, "order": orders, "": events}, "worker", {"late": F.col("is_late")})


def ticket_sla(
    tickets: DataFrame, owner: str, done: str, due: Column, feedback: str, newest_by: list[str]
) -> DataFrame:
    """Tickets done in time and late by owner, and the feedback of the newest one."""
    late = F.col(done) > due
    return tickets.groupBy(owner).agg(
        F.count_if(~late).alias("on_time"), F.count_if(late).alias("late"),
        F.max_by(feedback, F.struct(*newest_by)).alias("last_flag")
    )


@query(
    "b44_ticket_sla",
    """SELECT l_suppkey, count(*) FILTER (WHERE l_shipdate <= o_orderdate + INTERVAL 30 DAY) AS on_time, count(*) FILTER
    (WHERE l_shipdate > o_orderdate + INTERVAL 30 DAY) AS late, arg_max(l_returnflag, (l_shipdate, l_orderkey,
    l_linenumber, l_partkey, l_returnflag)) AS last_flag FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def b44_ticket_sla(spark, sf_dir):
    """On time or late against the due time, and the newest feedback."""
    rows = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    due = F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")
    return ticket_sla(
        rows, "l_suppkey", "l_shipdate", due, "l_returnflag",
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]
    )


def care_followup(
    tasks: DataFrame, orders: DataFrame, key: str, task: str, at: str, days: int = 7, cancelled: str = "P"
) -> DataFrame:
    """The first order, not cancelled, of a task's customer from `days` before the task on; null where there is none."""
    live = orders.where(F.col("o_orderstatus") != cancelled).select(
        F.col("o_custkey").alias(key), F.col("o_orderkey").alias("first_order"), F.col("o_orderdate").alias("_ordered")
    )
    since = F.col(at) - F.expr(f"INTERVAL {days} DAYS")
    found = S.as_of_join(tasks, live, [key], since, "_ordered", ["first_order"], direction="forward")
    return found.groupBy(task).agg(F.min_by("first_order", F.struct("_ordered", "first_order")).alias("first_order"))


@query(
    "b45_care_followup",
    """SELECT t.o_orderkey AS task, arg_min(x.o_orderkey, (x.o_orderdate, x.o_orderkey)) AS first_order FROM (SELECT *
    FROM orders WHERE o_orderpriority = '1-URGENT') t LEFT JOIN orders x ON x.o_custkey = t.o_custkey AND
    x.o_orderstatus <> 'P' AND x.o_orderdate >= t.o_orderdate - INTERVAL 7 DAY GROUP BY 1""",
)
def b45_care_followup(spark, sf_dir):
    """Urgent orders as care tasks."""
    orders = t(spark, sf_dir, "orders")
    tasks = orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("who"), F.col("o_orderkey").alias("task"), F.col("o_orderdate").alias("task_at")
    )
    return care_followup(tasks, orders, "who", "task", "task_at")


def territory_access(staff: DataFrame, person: str, manager: str, owned: DataFrame, place: str) -> DataFrame:
    """(person, place, depth) of every place that a person may see: their own (depth 0) and those of all staff below them,
    at any number of levels; the least depth where there are several. `owned` has a person and a place. Managers in a
    circle see each other's places.
    """
    above = U.closure(staff, person, manager).select(F.col("child").alias("_owner"), F.col("ancestor").alias(person), "depth")
    mine = owned.select(F.col(person).alias("_owner"), place)
    below = mine.join(above, "_owner").select(person, place, "depth")
    own = owned.select(person, place, F.lit(0).cast("long").alias("depth"))
    return own.unionByName(below).groupBy(person, place).agg(F.min("depth").alias("depth"))


@query(
    "b52_territory_access",
    """WITH RECURSIVE edge AS (SELECT s_suppkey AS c, s_suppkey // 4 AS p FROM supplier WHERE s_suppkey >= 4), walk AS (
    SELECT s_suppkey AS owner, s_suppkey AS person, 0 AS depth FROM supplier UNION ALL
    SELECT owner, p, depth + 1 FROM walk JOIN edge ON c = person)
    SELECT person, s_nationkey AS nation, min(depth) AS depth FROM walk JOIN supplier ON s_suppkey = owner GROUP BY ALL""",
)
def b52_territory_access(spark, sf_dir):
    """Suppliers as staff, supplier n below n / 4, and the nations that each may see."""
    people = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("person"), F.col("s_nationkey").alias("nation"))
    staff = people.where("person >= 4").select("person", F.expr("person div 4").alias("manager"))
    return territory_access(staff, "person", "manager", people, "nation")


@query(
    "b52_growth_territory",
    """SELECT s_suppkey AS employee, w.n_nationkey AS ward,
    coalesce(CASE WHEN w.n_nationkey = s_nationkey THEN 'nation ' || w.n_name END, r_name) AS territory
    FROM supplier JOIN nation s ON s.n_nationkey = s_nationkey JOIN region ON r_regionkey = s.n_regionkey
    JOIN nation w ON w.n_regionkey = r_regionkey""",
)
def b52_growth_territory(spark, sf_dir):
    """Employees to wards through nested territories in JSON."""
    nation, region = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    wards = F.to_json(
        F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("ward"), F.col("n_name").alias("name"))))
    )
    territory = (
        nation
        .join(region, F.col("r_regionkey") == F.col("n_regionkey"))
        .groupBy("n_regionkey", "r_name")
        .agg(wards.alias("doc"))
    )
    staff = t(spark, sf_dir, "supplier").join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey"
    )
    rows = staff.join(territory, "n_regionkey").select(
        "s_suppkey", "s_nationkey", "r_name",
        F.explode_outer(C.json_array("doc", "struct<ward:int,name:string>")).alias("w")
    )
    own = F.when(F.col("w.ward") == F.col("s_nationkey"), F.concat(F.lit("nation "), "w.name"))
    return rows.select(
        F.col("s_suppkey").alias("employee"), F.col("w.ward").alias("ward"),
        F.coalesce(own, "r_name").alias("territory")
    )


def stage_tickets(rows: DataFrame, key: str, times: list[tuple[str, str]]) -> DataFrame:
    """One (ticket, stage, started, done) row for each pair of consecutive time columns that has a start."""
    stages = F.array(
        *(
            F.struct(
                F.lit(name).alias("stage"), F.col(times[i][1]).alias("started"), F.col(times[i + 1][1]).alias("done")
            ) for i,
            (name, _) in enumerate(times[:-1])
        )
    )
    return rows.select(key, F.explode(stages).alias("s")).select(key, "s.*").where("started IS NOT NULL")


@query(
    "b64_stage_tickets",
    """SELECT user_id, stage, strftime(a, '%Y-%m-%d %H') AS started, strftime(b, '%Y-%m-%d %H') AS done FROM (SELECT
    user_id, 'signup' AS stage, min(ts) FILTER (WHERE event_type = 'signup') AS a, min(ts) FILTER (WHERE event_type =
    'view') AS b FROM events GROUP BY 1
    UNION ALL SELECT user_id, 'view', min(ts) FILTER (WHERE event_type = 'view'), min(ts) FILTER (WHERE event_type =
    'purchase') FROM events GROUP BY 1) WHERE a IS NOT NULL""",
)
def b64_stage_tickets(spark, sf_dir):
    names = ("signup", "view", "purchase")
    wide = t(spark, sf_dir, "events").groupBy("user_id").agg(
        *(F.min(F.when(F.col("event_type") == n, F.col("ts"))).alias(n) for n in names)
    )
    hour = lambda c: F.date_format(c, "yyyy-MM-dd HH").alias(c)
    return stage_tickets(wide, "user_id", [(n, n) for n in names]).select(
        "user_id", "stage", hour("started"), hour("done")
    )
