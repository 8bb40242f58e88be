"""Queries for change logs, incremental state, data quality and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import cdc, quality
from lakeloom.sources import io
from lakeloom.streaming import stream

from .registry import LOG, change_log, day, day_text, query, t

_RANK = "CASE action WHEN 'd' THEN 3 WHEN 'u' THEN 2 ELSE 1 END"
_LATEST = f"latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY mg_id ORDER BY synced_at DESC, {_RANK} DESC, key DESC) = 1)"


@query(
    "s6_latest_by_key",
    f"WITH {LOG}, {_LATEST} SELECT mg_id, key, {day('synced_at')} AS synced, value FROM latest WHERE action <> 'd'"
)
def s6_latest_by_key(spark, sf_dir):
    """The newest change of each entity, deleted ones dropped."""
    return cdc.latest_by_key(change_log(spark, sf_dir)).select(
        "mg_id", "key", day_text("synced_at").alias("synced"), "value"
    )


@query(
    "s7_winning_keys",
    f"WITH {LOG}, {_LATEST} SELECT mg_id, key, {day('synced_at')} AS synced, value FROM latest WHERE action <> 'd'"
)
def s7_winning_keys(spark, sf_dir):
    """The same from narrow winners and wide rows."""
    return cdc.winning_key_semi_join(change_log(spark, sf_dir)).select(
        "mg_id", "key", day_text("synced_at").alias("synced"), "value"
    )


@query("s8_incremental_state", f"WITH {LOG}, {_LATEST} SELECT mg_id, key, action FROM latest")
def s8_incremental_state(spark, sf_dir):
    """Two steps by ingest time give the state of a full refresh."""
    log = change_log(spark, sf_dir)
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp")
    first = cdc.incremental_current_state(log.where(F.col("ingest_time") <= cut), None)
    return cdc.incremental_current_state(log, first).select("mg_id", "key", "action")


@query(
    "s8_partitioned_state",
    f"""WITH {LOG}, {_LATEST} SELECT mg_id, key, action, CASE WHEN action = 'd' THEN '2099-01-01' ELSE
    {day('synced_at')} END AS created FROM latest""",
)
def s8_partitioned_state(spark, sf_dir):
    """Three refreshes of a partitioned table by its touched partitions, the last of which finds nothing new."""
    log = change_log(spark, sf_dir)
    made = F.when(F.col("action") != "d", F.to_date("synced_at"))
    log = log.withColumn("created_date", F.coalesce(made, F.lit("2099-01-01").cast("date")))
    path, staging = io.scratch_folder(spark, "state"), io.scratch_folder(spark, "staging")
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp")
    cdc.refresh_partitions(log.where(F.col("ingest_time") <= cut), path, f"{staging}/1", "created_date", "2024-01-31")
    cdc.refresh_partitions(log, path, f"{staging}/2", "created_date", "2024-01-31")
    cdc.refresh_partitions(log, path, f"{staging}/3", "created_date", "2024-01-31")
    return (
        spark.read
        .schema(log.schema)
        .parquet(path)
        .select("mg_id", "key", "action", day_text("created_date").alias("created"))
    )


@query(
    "s11_ignore_changes",
    f"WITH {LOG} SELECT key, action FROM log WHERE NOT (action = 'd' AND synced_at BETWEEN DATE '2024-01-05' AND "
    f"DATE '2024-01-09')"
)
def s11_ignore_changes(spark, sf_dir):
    bad = F.expr("action = 'd' AND synced_at BETWEEN '2024-01-05' AND '2024-01-09'")
    return cdc.ignore_changes(change_log(spark, sf_dir), bad).select("key", "action")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC envelopes as JSON from the change log; every seventh message comes twice."""
    log = change_log(spark, sf_dir)
    operation = F.when(F.col("action") == "d", "DELETE").when(F.col("action") == "i", "INSERT").otherwise("UPDATE")
    after = F.when(
        F.col("action") != "d",
        F.struct(
            "mg_id", F.col("value").alias("amount"), F.get_json_object("props", "$.k").alias("k"),
            F.lit("x").alias("bad")
        )
    )
    data = F.to_json(
        F.struct(
            F.struct(F.col("mg_id").alias("id"), (F.col("mg_id") % 3).alias("shop")).alias("primary_key"),
            operation.alias("operation"), F.date_format("synced_at", "yyyy-MM-dd HH:mm:ss").alias("sync_at"),
            after.alias("after")
        )
    )
    raw = log.select(F.col("key").alias("message_id"), F.col("ingest_time").alias("publish_time"), data.alias("data"))
    again = raw.where("message_id % 7 = 0").withColumn(
        "publish_time", F.col("publish_time") + F.expr("INTERVAL 1 HOUR")
    )
    return raw.unionByName(again).withColumn("message_id", F.format_string("%012d", "message_id"))


_WINNER = f"""winner AS (SELECT mg_id, key, action, value, props, synced_at FROM log QUALIFY row_number() OVER
(PARTITION BY mg_id ORDER BY synced_at DESC, {_RANK} DESC,
    CASE WHEN key % 7 = 0 THEN ingest_time + INTERVAL 1 HOUR ELSE ingest_time END DESC, key DESC) = 1)"""


@query(
    "s13_dedup_messages",
    f"WITH {LOG} SELECT lpad(CAST(key AS VARCHAR), 12, '0') AS message_id, {day('ingest_time')} AS published FROM log"
)
def s13_dedup_messages(spark, sf_dir):
    rows = cdc.dedup_messages(envelopes(spark, sf_dir))
    log = change_log(spark, sf_dir).select(
        F.format_string("%012d", "key").alias("message_id"), day_text("ingest_time").alias("published")
    )
    return rows.join(log, "message_id").select("message_id", "published")


@query(
    "s12_cdc_winners",
    f"WITH {LOG}, {_WINNER} SELECT concat(mg_id, ':::', mg_id % 3) AS pk, CASE action WHEN 'd' THEN 'DELETE' WHEN "
    f"'i' THEN 'INSERT' ELSE 'UPDATE' END AS operation, {day('synced_at')} AS synced FROM winner"
)
def s12_cdc_winners(spark, sf_dir):
    """Composite keys, newest change, deletes kept."""
    return cdc.cdc_winners(envelopes(spark, sf_dir), ["id", "shop"]).select(
        "pk", "operation", day_text("sync_at").alias("synced")
    )


@query(
    "s14_typed_projection",
    f"WITH {LOG}, {_WINNER} SELECT mg_id, value AS amount, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    f"CAST(NULL AS BIGINT) AS bad, CAST(NULL AS DATE) AS later FROM winner WHERE action <> 'd'"
)
def s14_typed_projection(spark, sf_dir):
    """Typed columns by metadata; a column added later is null."""
    meta = [("mg_id", "long"), ("amount", "double"), ("k", "long"), ("bad", "long")]
    winners = cdc.cdc_winners(envelopes(spark, sf_dir), ["id", "shop"]).where("operation <> 'DELETE'")
    return cdc.evolve_schema(cdc.typed_projection(winners, meta), [*meta, ("later", "date")])


@query(
    "s15_pg_arrays",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 1 END AS n, CASE p_partkey
    % 4 WHEN 2 THEN p_brand WHEN 3 THEN p_type END AS first, CASE p_partkey % 4 WHEN 2 THEN p_type END AS last FROM
    part""",
)
def s15_pg_arrays(spark, sf_dir):
    """Array literals."""
    text = (
        F.when(F.col("p_partkey") % 4 == 1, "{}")
        .when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("{"), "p_brand", F.lit(',NULL,"'), "p_type", F.lit('"}')))
        .when(F.col("p_partkey") % 4 == 3, F.col("p_type"))
    )
    parts = t(spark, sf_dir, "part").select("p_partkey", C.parse_pg_array(text).alias("a"))
    return parts.select(
        "p_partkey", F.when(F.col("a").isNotNull(), F.size("a")).alias("n"), F.get("a", F.lit(0)).alias("first"),
        F.get("a", F.lit(2)).alias("last")
    )


def _base_and_delta(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    log = change_log(spark, sf_dir).withColumn(
        "operation", F.when(F.col("action") == "d", "DELETE").otherwise("UPDATE")
    )
    cut = F.lit("2024-01-15").cast("timestamp")
    base = cdc.latest_by_key(log.where(F.col("synced_at") <= cut)).select(
        F.col("mg_id").alias("pk"), F.col("synced_at").alias("sync_at"), "value", "operation"
    )
    delta = cdc.latest_by_key(log.where(F.col("synced_at") >= cut), drop_deleted=False).select(
        F.col("mg_id").alias("pk"), F.col("synced_at").alias("sync_at"), "value", "operation"
    )
    return base, delta


_SPLIT = f"""base AS (SELECT * FROM (SELECT * FROM log WHERE synced_at <= DATE '2024-01-15' QUALIFY row_number() OVER
(PARTITION BY mg_id ORDER BY synced_at DESC, {_RANK} DESC, key DESC) = 1) WHERE action <> 'd'),
    delta AS (SELECT * FROM log WHERE synced_at >= DATE '2024-01-15' QUALIFY row_number() OVER (PARTITION BY mg_id ORDER
    BY synced_at DESC, {_RANK} DESC, key DESC) = 1)"""


@query(
    "s17_merge_upsert",
    f"""WITH {LOG}, {_SPLIT} SELECT coalesce(b.mg_id, d.mg_id) AS pk, CASE WHEN d.mg_id IS NOT NULL AND (b.mg_id IS NULL
    OR d.synced_at > b.synced_at) THEN d.value ELSE b.value END AS value
    FROM base b FULL JOIN delta d ON b.mg_id = d.mg_id WHERE NOT (coalesce(d.action, 'u') = 'd' AND (b.mg_id IS NULL OR
    d.synced_at >= b.synced_at))""",
)
def s17_merge_upsert(spark, sf_dir):
    return cdc.merge_upsert(*_base_and_delta(spark, sf_dir)).select("pk", "value")


@query(
    "s18_base_plus_delta",
    f"""WITH {LOG}, {_SPLIT} SELECT mg_id AS pk, value FROM (SELECT *, 0 AS side FROM base UNION ALL SELECT *, 1 FROM
    delta) QUALIFY row_number() OVER (PARTITION BY mg_id ORDER BY synced_at DESC, side DESC) = 1 AND action <> 'd'""",
)
def s18_base_plus_delta(spark, sf_dir):
    return cdc.base_plus_delta_view(*_base_and_delta(spark, sf_dir)).select("pk", "value")


@query(
    "s19_base_anti_delta",
    f"WITH {LOG}, {_SPLIT} SELECT mg_id AS pk, value FROM base WHERE mg_id NOT IN (SELECT mg_id FROM delta) UNION "
    f"ALL SELECT mg_id, value FROM delta WHERE action <> 'd'"
)
def s19_base_anti_delta(spark, sf_dir):
    return cdc.base_anti_delta_union(*_base_and_delta(spark, sf_dir)).select("pk", "value")


@query(
    "s20_replace_window",
    "SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2001-05-01' THEN 1 ELSE 0 END AS fresh FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '2000-08-01'"
)
def s20_replace_window(spark, sf_dir):
    """The last three months rewritten, twelve kept."""
    orders = t(spark, sf_dir, "orders").withColumn("fresh", F.lit(0))
    out = cdc.replace_window(
        orders, orders.withColumn("fresh", F.lit(1)), "o_orderdate", F.lit("2001-05-01").cast("timestamp"),
        F.lit("2000-08-01").cast("timestamp")
    )
    return out.select("o_orderkey", "fresh")


@query(
    "s21_append_since",
    "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"
)
def s21_append_since(spark, sf_dir):
    events = t(spark, sf_dir, "events")
    return cdc.append_since(
        events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp")), events, "ts"
    ).select("event_id")


@query(
    "s22_migrate_merge",
    f"""WITH {LOG}, {_LATEST}, migrated AS (SELECT mg_id, max(synced_at) + 1 AS synced_at FROM log WHERE value > 60
    GROUP BY mg_id)
    SELECT m.mg_id, 'u' AS action FROM migrated m LEFT JOIN latest l ON l.mg_id = m.mg_id WHERE l.mg_id IS NULL OR
    m.synced_at > l.synced_at UNION ALL SELECT mg_id, 'd' FROM latest WHERE action <> 'd' AND mg_id NOT IN (SELECT mg_id
    FROM migrated) AND mg_id BETWEEN (SELECT min(mg_id) FROM migrated) AND (SELECT max(mg_id) FROM migrated)""",
)
def s22_migrate_merge(spark, sf_dir):
    """Rows and deletes that reconcile a log with a re-extracted table, of the entities that had a large value."""
    log = change_log(spark, sf_dir)
    migrated = (
        log
        .where("value > 60")
        .groupBy("mg_id")
        .agg(
            F.max("key").alias("key"), F.lit("u").alias("action"),
            (F.max("synced_at") + F.expr("INTERVAL 1 DAY")).alias("synced_at"),
            F.max("ingest_time").alias("ingest_time"), F.max("value").alias("value"), F.max("props").alias("props")
        )
    )
    return cdc.migrate_merge(log, migrated).select("mg_id", "action")


@query(
    "s27_newest_batch",
    "SELECT event_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"
)
def s27_newest_batch(spark, sf_dir):
    kept, _ = cdc.remove_duplicate_batches(t(spark, sf_dir, "events").withColumn("batch", F.to_date("ts")), "batch")
    return kept.select("event_id")


@query(
    "s28_event_feed",
    """SELECT 'purchase' AS type, CAST(user_id AS VARCHAR) AS visitor, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at,
    CAST(event_id AS VARCHAR) AS product, CAST(floor(value) AS INTEGER) AS quantity FROM events WHERE event_type =
    'purchase'""",
)
def s28_event_feed(spark, sf_dir):
    """A recommender's feed."""
    feed = io.export_events_json_shape(
        t(spark, sf_dir, "events").where("event_type = 'purchase'").withColumn("q", F.floor("value")), "purchase",
        "user_id", "ts", "event_id", "q"
    )
    detail = F.col("productDetails")[0]
    return feed.select(
        F.col("eventType").alias("type"), F.col("visitorId").alias("visitor"), F.col("eventTime").alias("at"),
        detail["product"]["id"].alias("product"), detail["quantity"].alias("quantity")
    )


@query(
    "s29_swapped_deletes",
    f"""WITH {LOG}, n AS (SELECT *, row_number() OVER w AS n, lead(key) OVER w AS k2, lead(action) OVER w AS a2,
    lead(synced_at) OVER w AS s2 FROM log WINDOW w AS (PARTITION BY mg_id ORDER BY synced_at DESC, {_RANK} DESC, key
    DESC))
    SELECT l.mg_id, l.key, CASE WHEN n.k2 = l.key THEN 1 ELSE 0 END AS moved FROM log l LEFT JOIN n ON n.mg_id = l.mg_id
    AND n.n = 1 AND n.action = 'd' AND n.a2 <> 'd' AND n.s2 = n.synced_at""",
)
def s29_swapped_deletes(spark, sf_dir):
    """Runners-up of swapped deletes moved by a microsecond."""
    log = change_log(spark, sf_dir)
    fixed = cdc.repair_swapped_delete(log)
    return fixed.select("mg_id", "key", (F.unix_micros("synced_at") % 1000).alias("moved"))


@query(
    "s30_replace_touched",
    """SELECT o_custkey, round(sum(o_totalprice), 2) AS total, max(CASE WHEN c IS NULL THEN 0 ELSE 1 END) AS again FROM
    orders LEFT JOIN (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01') ON c =
    o_custkey GROUP BY o_custkey""",
)
def s30_replace_touched(spark, sf_dir):
    """The keys that changed lately recomputed, the others kept."""
    orders = t(spark, sf_dir, "orders")
    sums = lambda flag: orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.lit(flag).alias("again")
    )
    return cdc.replace_touched_keys(
        sums(0), orders, sums(1), ["o_custkey"], F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp")
    )


@query("c1_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def c1_unique(spark, sf_dir):
    return quality.check_unique(t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "c2_not_null",
    "SELECT o_orderkey, 'priority is null' AS reason FROM orders WHERE o_orderpriority = '5-LOW' UNION ALL SELECT "
    "o_orderkey, 'status is null' FROM orders WHERE o_orderstatus = 'P'"
)
def c2_not_null(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return quality.check_not_null(orders, ["priority", "status"], ["o_orderkey"])


@query(
    "c3_rows",
    "SELECT l_orderkey, l_linenumber, 'small discount' AS failed FROM lineitem WHERE l_discount > 0.08 UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'known flag' FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"
)
def c3_rows(spark, sf_dir):
    return quality.check_rows(
        t(spark, sf_dir, "lineitem"),
        {"small discount": "l_discount <= 0.08", "known flag": "l_returnflag IN ('A', 'N')"},
        ["l_orderkey", "l_linenumber"]
    )


@query(
    "c4_expected",
    "SELECT CAST(g AS BIGINT) AS o_orderkey FROM (VALUES (1, 'F'), (2, 'F'), (3, 'X')) v(g, s) LEFT JOIN orders ON "
    "o_orderkey = g WHERE o_orderstatus IS DISTINCT FROM s"
)
def c4_expected(spark, sf_dir):
    """Golden rows from inline CSV."""
    golden = io.read_csv_rows(spark, "o_orderkey,o_orderstatus\n1,F\n2,F\n3,X", {"o_orderkey": "long"})
    return quality.check_expected(t(spark, sf_dir, "orders"), golden, ["o_orderkey"]).select("o_orderkey")


@query("c5_coverage", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def c5_coverage(spark, sf_dir):
    return quality.check_coverage(
        t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"),
        ["c_custkey"]
    )


@query(
    "c6_balance",
    "SELECT l_returnflag, l_linestatus FROM (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS a, count(*) * 25 "
    "AS b FROM lineitem GROUP BY ALL) WHERE abs(a - b) > 5000"
)
def c6_balance(spark, sf_dir):
    return quality.check_balance(
        t(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], F.sum("l_quantity"), F.count(F.lit(1)) * 25,
        5000
    ).select("l_returnflag", "l_linestatus")


@query(
    "c7_mismatch_report",
    f"""WITH {LOG}, {_LATEST}, state AS (SELECT mg_id, CASE WHEN mg_id % 11 = 0 THEN synced_at - 1 ELSE synced_at END AS
    synced_at FROM latest WHERE (action <> 'd' OR mg_id % 5 = 0) AND mg_id % 13 <> 0)
    SELECT kind, entity, 1 AS n FROM (SELECT CAST(l.mg_id AS VARCHAR) AS entity, CASE WHEN s.mg_id IS NOT NULL AND
    l.action = 'd' THEN 'DELETED_RECORDS' WHEN s.mg_id IS NULL AND l.action <> 'd' THEN 'MISSING_RECORDS'
    WHEN l.action <> 'd' AND l.synced_at <> s.synced_at THEN 'WRONG_UPDATE' END AS kind FROM latest l LEFT JOIN state s
    ON s.mg_id = l.mg_id) WHERE kind IS NOT NULL
    UNION ALL SELECT 'TOTAL COUNT', NULL, count(*) FROM latest WHERE action <> 'd'""",
)
def c7_mismatch_report(spark, sf_dir):
    """Planted mismatches of all kinds are found."""
    log = change_log(spark, sf_dir)
    state = cdc.latest_by_key(log, drop_deleted=False).where("(action <> 'd' OR mg_id % 5 = 0) AND mg_id % 13 <> 0")
    state = state.withColumn(
        "synced_at",
        F.when(F.col("mg_id") % 11 == 0, F.col("synced_at") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("synced_at"))
    )
    return quality.mismatch_report(log, state).select("kind", "entity", "n")


@query(
    "c9_keep_newest",
    "SELECT user_id, max(event_id) AS event_id FROM events WHERE (user_id, ts) IN (SELECT user_id, max(ts) FROM "
    "events GROUP BY user_id) GROUP BY user_id"
)
def c9_keep_newest(spark, sf_dir):
    """What a repair of repeated keys keeps."""
    return quality.keep_newest(
        t(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    ).select("user_id", "event_id")


@query(
    "c8_mismatch_gate",
    f"""WITH {LOG}, {_LATEST} SELECT CAST(a AS INTEGER) AS attempt, CASE WHEN a = 0 THEN round(100.0 * count(*) FILTER
    (WHERE mg_id % 2 = 0) / count(*)) ELSE 0 END AS percent, a > 0 AS passed
    FROM latest, (VALUES (0), (1)) v(a) WHERE action <> 'd' GROUP BY a""",
)
def c8_mismatch_gate(spark, sf_dir):
    """A state that lacks every second entity is rebuilt once, and passes then."""
    log = change_log(spark, sf_dir)
    full = cdc.latest_by_key(log)
    state = [full.where("mg_id % 2 <> 0")]
    attempts = quality.mismatch_gate(lambda: quality.mismatch_report(log, state[-1]), lambda: state.append(full))
    return spark.createDataFrame([tuple(a.values()) for a in attempts], "attempt int, percent double, passed boolean")


@query(
    "g2_unique_assertion",
    """SELECT 'l_orderkey,l_linenumber' AS keys, count(*) AS failures, min(concat(l_orderkey, ',', l_linenumber)) AS
    first FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'l_orderkey', count(*), min(CAST(l_orderkey AS VARCHAR)) FROM (SELECT l_orderkey FROM lineitem
    GROUP BY ALL HAVING count(*) > 1)""",
)
def g2_unique_assertion(spark, sf_dir):
    """One assertion over several sets of keys."""
    rows = quality.unique_assertion(t(spark, sf_dir, "lineitem"), [["l_orderkey", "l_linenumber"], ["l_orderkey"]])
    return rows.select("keys", "failures", F.get("examples", F.lit(0)).alias("first"))


@query(
    "g2_failing_keys",
    """SELECT 'l_orderkey,l_suppkey' AS keys, concat(l_orderkey, ',', l_suppkey) AS value, count(*) AS n FROM lineitem WHERE
    CAST(l_shipdate AS DATE) IN (SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R') GROUP BY
    l_orderkey, l_suppkey HAVING count(*) > 1
    UNION ALL SELECT 'l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) IN
    (SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_orderkey HAVING count(*) >
    1""",
)
def g2_failing_keys(spark, sf_dir):
    """Every repeated key, in the days of shipment that returned lines touch."""
    items = t(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    touched = items.where("l_returnflag = 'R'")
    return quality.failing_keys(items, [["l_orderkey", "l_suppkey"], ["l_orderkey"]], touched, "day")


@query(
    "c10_guarded_repair",
    """SELECT 'repaired' AS kept_in, user_id, max(event_id) AS event_id, 1 AS n FROM events
    WHERE (user_id, ts) IN (SELECT user_id, max(ts) FROM events GROUP BY user_id) GROUP BY user_id
    UNION ALL SELECT 'snapshot', user_id, max(event_id), count(*) FROM events GROUP BY user_id""",
)
def c10_guarded_repair(spark, sf_dir):
    """A table with repeated keys is saved as it is, then rewritten with the newest row of each key."""
    root, state = io.scratch_folder(spark, "repair"), {"version": 0}
    read = lambda: spark.read.parquet(f"{root}/{state['version']}")

    def write(df: DataFrame) -> None:
        df.write.parquet(f"{root}/{state['version'] + 1}")
        state["version"] += 1

    t(spark, sf_dir, "events").select("user_id", "event_id", "ts").write.parquet(f"{root}/0")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    snapshot = lambda df: df.write.parquet(f"{root}/snapshot")
    quality.guarded_snapshot_repair(read, write, snapshot, ["user_id"], order)
    told = lambda df, name: df.groupBy(F.lit(name).alias("kept_in"), "user_id").agg(
        F.max("event_id").alias("event_id"), F.count(F.lit(1)).alias("n")
    )
    return told(read(), "repaired").unionByName(told(spark.read.parquet(f"{root}/snapshot"), "snapshot"))


@query(
    "c11_latency",
    """SELECT l_returnflag, round(avg(s), 3) AS avg, min(s) AS min, max(s) AS max, quantile_disc(s, 0.5) AS p50,
    quantile_disc(s, 0.9) AS p90, quantile_disc(s, 0.95) AS p95
    FROM (SELECT l_returnflag, epoch(l_shipdate) - epoch(o_orderdate) AS s FROM lineitem JOIN orders ON o_orderkey =
    l_orderkey) GROUP BY 1""",
)
def c11_latency(spark, sf_dir):
    both = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    out = quality.latency_profile(both, ["l_returnflag"], "o_orderdate", "l_shipdate")
    return out.select("l_returnflag", F.round("avg", 3).alias("avg"), "min", "max", "p50", "p90", "p95")


@query(
    "c12_throughput",
    """SELECT strftime(slot, '%Y-%m-%d %H') AS slot, n, n - lag(n) OVER (ORDER BY slot) AS n_change, CAST(bytes -
    lag(bytes) OVER (ORDER BY slot) AS BIGINT) AS bytes_change
    FROM (SELECT date_trunc('hour', ts) AS slot, count(*) AS n, sum(strlen(props)) AS bytes FROM events GROUP BY 1)""",
)
def c12_throughput(spark, sf_dir):
    """Rows and bytes by hour with their changes."""
    return quality.throughput(t(spark, sf_dir, "events"), "ts", F.octet_length("props")).select(
        F.date_format("slot", "yyyy-MM-dd HH").alias("slot"), "n", "n_change", "bytes_change"
    )


@query(
    "g3_table_freshness",
    """SELECT strftime(s, '%Y-%m-%d %H') AS slot, count(event_id) AS n_ts, 0 AS n_none FROM (SELECT
    unnest(generate_series(TIMESTAMP '2024-01-03 00:00:00', TIMESTAMP '2024-01-06 00:00:00', INTERVAL 1 HOUR)) AS s)
    LEFT JOIN events ON date_trunc('hour', ts) = s GROUP BY 1""",
)
def g3_table_freshness(spark, sf_dir):
    """Counts on an hour spine."""
    events = t(spark, sf_dir, "events").withColumn("none", F.lit(None).cast("timestamp"))
    out = quality.table_freshness(
        events, ["ts", "none"], F.lit("2024-01-03").cast("timestamp"), F.lit("2024-01-06").cast("timestamp")
    )
    return out.select(F.date_format("slot", "yyyy-MM-dd HH").alias("slot"), "n_ts", "n_none")


@query(
    "c13_job_cost",
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS jobs, count(*) FILTER (WHERE value > 50) AS "
    "failures, round(sum(value), 4) AS size, max(value) AS largest FROM events GROUP BY ALL"
)
def c13_job_cost(spark, sf_dir):
    """The events table read as a log of jobs."""
    jobs = t(spark, sf_dir, "events").withColumn("day", day_text("ts"))
    return quality.job_cost_usage(
        jobs, ["event_type", "day"], "value", F.col("value") > 50
    ).withColumn("size", F.round("size", 4))


@query(
    "c14_compare_series",
    """SELECT month, round(a, 2) AS a, round(b, 2) AS b, round(a - coalesce(b, 0), 2) AS difference, CASE WHEN b IS NULL
    THEN 'only a' ELSE 'both' END AS side FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS a,
    sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS b FROM orders GROUP BY 1)""",
)
def c14_compare_series(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    out = quality.compare_series(orders, orders.where("o_orderstatus <> 'P'"), ["month"], "o_totalprice")
    return out.select("month", *(F.round(c, 2).alias(c) for c in ("a", "b", "difference")), "side")


@query("c15_full_refresh", f"WITH {LOG}, {_LATEST} SELECT 'full' AS side, mg_id FROM latest WHERE action = 'i'")
def c15_full_refresh(spark, sf_dir):
    """Rows that an incremental table lacks."""
    full = cdc.latest_by_key(change_log(spark, sf_dir))
    return quality.full_refresh_compare(full.where("action <> 'i'"), full).select("side", "mg_id")


@query("m1_stream_state", f"WITH {LOG}, {_LATEST} SELECT mg_id, key, value FROM latest WHERE action <> 'd'")
def m1_stream_state(spark, sf_dir):
    """M1, M2, M5: the change log as a stream of files, merged batch by batch, equals the batch result."""
    root = io.scratch_folder(spark, "stream")
    log = change_log(spark, sf_dir)
    log.repartition(3, "key").write.mode("overwrite").parquet(f"{root}/log")
    rows = stream.read_log_stream(spark, f"{root}/log", log.schema, files_per_trigger=1)
    stream.stream_current_state(rows, f"{root}/state", f"{root}/checkpoint", buckets=8).awaitTermination()
    return stream.read_state(spark, f"{root}/state", log.schema).select("mg_id", "key", "value")


@query(
    "m4_windowed_counts",
    "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS slot, event_type, count(*) AS n FROM events GROUP BY ALL"
)
def m4_windowed_counts(spark, sf_dir):
    """Counts by hour kept by a stream whose files are out of order; each file amends the hours before."""
    root, events = io.scratch_folder(spark, "windows"), t(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    events.repartition(3, "event_id").write.parquet(f"{root}/in")
    rows = stream.read_log_stream(spark, f"{root}/in", events.schema, files_per_trigger=1)
    kept = stream.windowed_count_stream(rows, "ts", ["event_type"], f"{root}/counts", f"{root}/checkpoint", delay="40 days")
    kept.awaitTermination()
    counts = spark.read.parquet(f"{root}/counts")
    return counts.select(F.date_format("slot", "yyyy-MM-dd HH").alias("slot"), "event_type", "n")


@query("m3_message_dedup", f"WITH {LOG} SELECT lpad(CAST(key AS VARCHAR), 12, '0') AS message_id FROM log")
def m3_message_dedup(spark, sf_dir):
    """M3: repeated messages dropped from a stream; with a month's delay all of the log's repeats come in time."""
    root, raw = io.scratch_folder(spark, "messages"), envelopes(spark, sf_dir)
    raw.write.parquet(f"{root}/in")
    once = stream.dedup_message_stream(stream.read_log_stream(spark, f"{root}/in", raw.schema), delay="40 days")
    stream.run_to_end(
        once, lambda batch, k: batch.write.mode("overwrite").parquet(f"{root}/out/batch={k}"), f"{root}/checkpoint"
    )
    return spark.read.schema(raw.schema).parquet(f"{root}/out").select("message_id")


@query("s3_external_files", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def s3_external_files(spark, sf_dir):
    """S3: CSV files of a declared text schema."""
    path = io.scratch_folder(spark, "external")
    t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").write.option("header", True).csv(path)
    rows = io.read_external_files(spark, path, ["c_custkey", "c_mktsegment", "c_acctbal"])
    return rows.select(
        C.safe_cast("c_custkey", "long").alias("c_custkey"), "c_mktsegment",
        C.safe_cast("c_acctbal", "double").alias("c_acctbal")
    )


@query(
    "s5_date_suffixed",
    "SELECT event_id, strftime(ts, '%Y%m%d') AS suffix FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' "
    "AND DATE '2024-01-24'"
)
def s5_date_suffixed(spark, sf_dir):
    """A scan over tables named by day, one for each day of the table, filtered on the suffix."""
    root, events = io.scratch_folder(spark, "suffixed"), t(spark, sf_dir, "events").withColumn(
        "day", F.date_format("ts", "yyyyMMdd")
    )
    events.write.partitionBy("day").parquet(f"{root}/all")  # one job for all days; folders are renamed, not copied
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop(f"{root}/tables"))
    for folder in files.listStatus(hadoop(f"{root}/all")):
        if (name := folder.getPath().getName()).startswith("day="):
            files.rename(folder.getPath(), hadoop(f"{root}/tables/events_{name.removeprefix('day=')}"))
    return io.read_date_suffixed(
        spark, f"{root}/tables", "events_", "20240103", "20240124"
    ).select("event_id", "suffix")


@query("s23_truncate_insert", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def s23_truncate_insert(spark, sf_dir):
    """A table filled twice holds the second filling alone."""
    path, orders = io.scratch_folder(spark, "refilled"), t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    io.truncate_insert(orders, path)
    io.truncate_insert(orders.where("o_orderstatus <> 'P'"), path)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query("s24_cutoff_snapshots", "SELECT h AS hour, s_suppkey, s_acctbal FROM supplier, (VALUES (6), (18)) v(h)")
def s24_cutoff_snapshots(spark, sf_dir):
    """Copies stamped with a truncated time."""
    path, suppliers = io.scratch_folder(spark, "snapshots"), t(spark, sf_dir, "supplier")
    for at in ("2024-01-01 06:10:00", "2024-01-01 18:20:00"):
        io.append_cutoff_snapshot(suppliers, path, F.lit(at).cast("timestamp"))
    return spark.read.parquet(path).select(F.hour("cutoff_timestamp").alias("hour"), "s_suppkey", "s_acctbal")


@query(
    "s25_partitioned_table",
    "SELECT o_orderkey, year(o_orderdate) AS year, CASE WHEN year(o_orderdate) = 1999 THEN 1 ELSE 0 END AS "
    "rewritten FROM orders"
)
def s25_partitioned_table(spark, sf_dir):
    """Partitions written with clustering, one of them replaced."""
    path, orders = (
        io
        .scratch_folder(spark, "partitioned"), t(spark, sf_dir, "orders")
        .withColumn("year", F.year("o_orderdate"))
        .withColumn("rewritten", F.lit(0))
    )
    io.write_partitioned(orders, path, ["year"], ["o_custkey"])
    io.write_partitioned(orders.where("year = 1999").withColumn("rewritten", F.lit(1)), path, ["year"])
    return spark.read.parquet(path).select("o_orderkey", "year", "rewritten")


@query(
    "s26_audit_row",
    """SELECT 'unique lineitem' AS name, 0 AS retry, '2024-01-01' AS day, '{"columns": 11}' AS props, count(*) AS
    failures, true AS has_id FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def s26_audit_row(spark, sf_dir):
    """A log row for a check, with its result."""
    items = t(spark, sf_dir, "lineitem")
    failed = quality.check_unique(items, ["l_orderkey", "l_linenumber"]).agg(F.count(F.lit(1)).alias("failures"))
    row = io.audit_row(
        spark, "unique lineitem", 0, F.lit("2024-01-01").cast("timestamp"), {"columns": len(items.columns)}
    )
    # one row each
    return row.crossJoin(failed).select(
        "name", "retry", day_text("at").alias("day"), "props", "failures", (F.char_length("id") == 36).alias("has_id")
    )
