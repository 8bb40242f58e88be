"""Queries for scalar functions, predicates, joins, aggregations, windows and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import relational as R
from lakeloom.operators import rollups as U
from lakeloom.operators import scans as S
from lakeloom.sources import io

from .registry import day_text, query, t


@query(
    "f_text",
    """SELECT c_custkey, concat(c_name, '|', c_mktsegment) AS joined, lower(c_name) AS low, upper(c_mktsegment) AS up,
    lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded,
    substr(c_name, 1, 4) AS head, right(c_name, 3) AS tail, strpos(c_name, '#') AS at, replace(c_name, '#', '-') AS
    replaced,
    regexp_replace(c_name, '[0-9]+', 'N') AS masked, nullif(regexp_extract(c_name, '([1-9][0-9]*)$', 1), '') AS number,
    starts_with(c_mktsegment, 'B') AS is_b,
    ends_with(c_name, '7') AS is_7, length(c_name) AS n, strlen(c_name) AS n_bytes, list_extract(string_split(c_name,
    '#'), -1) AS last,
    regexp_matches(c_mktsegment, '^(BU|MA)') AS rule, contains(lower(c_mktsegment), 'build') AS builds, c_mktsegment
    LIKE '%I%' AS has_i, c_mktsegment IN ('BUILDING', 'MACHINERY') AS listed FROM customer""",
)
def f_text(spark, sf_dir):
    """Text functions and predicates."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(name, F.lit("|"), segment).alias("joined"), F.lower(name).alias("low"),
        F.upper(segment).alias("up"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"),
        F.substr(name, F.lit(1), F.lit(4)).alias("head"), F.right(name, F.lit(3)).alias("tail"),
        F.instr(name, "#").alias("at"), F.replace(name, F.lit("#"), F.lit("-")).alias("replaced"),
        F.regexp_replace(name, "[0-9]+", "N").alias("masked"), C.extract(name, "([1-9][0-9]*)$", 1).alias("number"),
        F.startswith(segment, F.lit("B")).alias("is_b"),
        F.endswith(name, F.lit("7")).alias("is_7"), F.char_length(name).alias("n"),
        F.octet_length(name).alias("n_bytes"), C.part_at(name, "#", -1).alias("last"),
        segment.rlike("^(BU|MA)").alias("rule"), C.contains_any_case(segment, "Build").alias("builds"),
        segment.like("%I%").alias("has_i"), segment.isin("BUILDING", "MACHINERY").alias("listed"),
    )


@query(
    "f5_nth_index",
    """SELECT p_partkey, CASE WHEN len(string_split(p_name, 'a')) > 2 THEN length(list_extract(string_split(p_name,
    'a'), 1)) + length(list_extract(string_split(p_name, 'a'), 2)) + 2 ELSE 0 END AS second_a FROM part""",
)
def f5_nth_index(spark, sf_dir):
    """the place of the second occurrence."""
    return t(spark, sf_dir, "part").select("p_partkey", C.nth_index("p_name", "a", 2).alias("second_a"))


@query(
    "f8_regex",
    """SELECT p_partkey, len(regexp_extract_all(p_name, '[aeiou]')) AS vowels,
    array_to_string(regexp_extract_all(p_name, '[aeiou]'), '') AS all_vowels,
    CASE WHEN regexp_matches(p_name, '[aeiou]') THEN length(regexp_replace(p_name, '[aeiou].*$', '')) + 1 ELSE 0 END AS
    first_at, nullif(regexp_extract(p_type, '^([A-Z]+)', 1), '') AS head FROM part""",
)
def f8_regex(spark, sf_dir):
    """F8: one match, all matches, the place of the first; no match is null."""
    found = F.regexp_extract_all("p_name", F.lit("[aeiou]"), F.lit(0))
    return t(spark, sf_dir, "part").select(
        "p_partkey", F.size(found).cast("long").alias("vowels"), F.array_join(found, "").alias("all_vowels"),
        F.regexp_instr("p_name", F.lit("[aeiou]")).cast("long").alias("first_at"),
        C.extract("p_type", "^([A-Z]+)", 1).alias("head"),
    )


@query(
    "f_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, TRY_CAST(l_returnflag AS INTEGER) AS bad,
    TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS good,
    round(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END, 6) AS ratio, CAST(floor(l_quantity / 7) AS
    BIGINT) AS f, CAST(ceil(l_quantity / 7) AS BIGINT) AS c, abs(l_quantity - 25) AS a,
    CAST(l_quantity AS BIGINT) // 7 AS d, CAST(l_quantity AS BIGINT) % 7 AS m, CASE WHEN l_returnflag = 'N' THEN NULL
    ELSE greatest(l_quantity, 20) END AS g,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE least(l_quantity, 20) END AS l, coalesce(nullif(l_returnflag, 'N'), '-')
    AS flag FROM lineitem""",
)
def f_numbers(spark, sf_dir):
    """Conversion, safe division, rounding, whole division, null-strict greatest and least."""
    q = F.col("l_quantity")
    known = F.when(F.col("l_returnflag") != "N", F.lit(20.0))
    return t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        C.safe_cast("l_returnflag", "int").alias("bad"), C.safe_cast(q.cast("string"), "double").alias("good"),
        F.round(C.safe_divide("l_tax", "l_discount"), 6).alias("ratio"), F.floor(q / 7).alias("f"),
        F.ceil(q / 7).alias("c"), F.abs(q - 25).alias("a"),
        C.div(q.cast("long"), F.lit(7)).alias("d"), (q.cast("long") % 7).alias("m"),
        C.greatest_strict(q, known).alias("g"), C.least_strict(q, known).alias("l"),
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("-")).alias("flag"),
    )


@query(
    "f11_readable_size",
    """SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%d B', CAST(floor(b) AS BIGINT)) WHEN b < 1048576 THEN
    printf('%.2f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576)
    ELSE printf('%.2f GB', b / 1073741824) END AS size FROM (SELECT o_orderkey, floor(o_totalprice) * (o_orderkey % 7) *
    (o_orderkey % 1000) + 0.3 AS b FROM orders)""",
)
def f11_readable_size(spark, sf_dir):
    """Bytes as text."""
    b = F.floor("o_totalprice") * (F.col("o_orderkey") % 7) * (F.col("o_orderkey") % 1000) + 0.3
    return t(spark, sf_dir, "orders").select("o_orderkey", C.readable_size(b).alias("size"))


@query(
    "f18_distance",
    """SELECT c_custkey, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat2 - lat1) / 2), 2) +
    cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))), 2) AS km
    FROM (SELECT c_custkey, c_custkey % 90 AS lat1, c_custkey % 180 AS lon1, c_nationkey * 3 AS lat2, c_nationkey * 7 AS
    lon2 FROM customer)""",
)
def f18_distance(spark, sf_dir):
    """great-circle distance."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return t(spark, sf_dir, "customer").select("c_custkey", C.distance_km(k % 180, k % 90, n * 7, n * 3).alias("km"))


@query(
    "d_dates",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%d %H') AS local, strftime(o_orderdate +
    INTERVAL 30 DAY, '%Y-%m-%d') AS plus30, strftime(o_orderdate - INTERVAL 2 MONTH, '%Y-%m-%d') AS minus2,
    strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week, strftime(date_trunc('quarter', o_orderdate),
    '%Y-%m-%d') AS quarter, date_diff('day', o_orderdate, DATE '2001-08-01') AS days,
    date_diff('month', o_orderdate, DATE '2001-08-01') AS months, date_diff('quarter', o_orderdate, DATE '2001-08-01')
    AS quarters, date_diff('year', o_orderdate, DATE '2001-08-01') AS years,
    date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', DATE '2001-08-01')) // 7 AS weeks,
    dayofweek(o_orderdate) + 1 AS dow, CAST(strftime(o_orderdate, '%W') AS INTEGER) AS week_no, strftime(o_orderdate,
    '%d/%m/%Y') AS told,
    strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
    CAST(epoch_us(o_orderdate) AS VARCHAR) AS micros,
    date_diff('year', o_orderdate, DATE '2001-08-01') - CASE WHEN '0801' < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0
    END AS age FROM orders""",
)
def d_dates(spark, sf_dir):
    """Local time, arithmetic, truncation, boundary counts, parts, formats, epochs, age."""
    d, end = F.col("o_orderdate"), F.lit("2001-08-01").cast("date")
    return t(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(d + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd HH").alias("local"),
        day_text(F.date_add(F.to_date(d), 30)).alias("plus30"),
        day_text(F.add_months(F.to_date(d), -2)).alias("minus2"),
        day_text(F.date_trunc("week", d)).alias("week"), day_text(F.date_trunc("quarter", d)).alias("quarter"),
        *(C.date_diff(p, end, d).alias(f"{p.lower()}s") for p in ("DAY", "MONTH", "QUARTER", "YEAR", "WEEK")),
        F.dayofweek(d).alias("dow"), C.week_of_year(F.to_date(d)).alias("week_no"),
        C.format_time(d, "%d/%m/%Y").alias("told"), day_text(F.last_day(d)).alias("month_end"),
        F.unix_seconds(d).alias("seconds"), F.unix_micros(d).cast("string").alias("micros"),
        C.age_years(d, end).alias("age"),
    )


@query(
    "d1_local_time",
    "SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M') AS here FROM events",
)
def d1_local_time(spark, sf_dir):
    """Zone-less local time of an instant; Indochina keeps seven hours all year."""
    return t(spark, sf_dir, "events").select(
        "event_id", F.date_format(C.to_local("ts", "Asia/Ho_Chi_Minh"), "yyyy-MM-dd HH:mm").alias("here")
    )


@query(
    "d10_dates_as_text",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day "
    "FROM orders",
)
def d10_dates_as_text(spark, sf_dir):
    """Dates of 10, 24 and 8 characters, and junk, to one form."""
    d, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    forms = {
        0: F.date_format(d, "dd/MM/yyyy"), 1: F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'.000Z'"),
        2: F.date_format(d, "ddMMyyyy")
    }
    said = F.lit("31/31/2000")
    for n, form in forms.items():
        said = F.when(kind == n, form).otherwise(said)
    return t(spark, sf_dir, "orders").select("o_orderkey", day_text(C.normalise_date(said)).alias("day"))


@query(
    "d14_now",
    "SELECT o_orderkey, 7 AS ahead, o_orderdate <= TIMESTAMP '2020-01-01' AS past FROM orders",
)
def d14_now(spark, sf_dir):
    """The local clocks of two places against each other, and order dates against now."""
    here, there = C.now_local("Asia/Ho_Chi_Minh"), C.now_local("UTC")
    ahead = (F.unix_seconds(here.cast("timestamp")) - F.unix_seconds(there.cast("timestamp"))) / 3600
    return t(spark, sf_dir, "orders").select(
        "o_orderkey", ahead.cast("int").alias("ahead"), (F.col("o_orderdate") <= there).alias("past")
    )


@query(
    "f19_error",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity AS checked FROM lineitem"
)
def f19_error(spark, sf_dir):
    """an expression that would fail the query on a negative quantity."""
    checked = C.fail_if(F.col("l_quantity") < 0, "negative quantity", F.col("l_quantity"))
    return t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", checked.alias("checked")
    )


@query(
    "d_parsing",
    """SELECT o_orderkey, strftime(try_strptime(s, '%d%m%Y'), '%Y-%m-%d') AS d8, strftime(try_strptime(m, '%d%m%Y'),
    '%Y-%m-%d') AS d6,
    CASE WHEN left_days < 0 THEN 'expired' WHEN left_days <= 90 THEN '0-3 months' WHEN left_days <= 180 THEN '3-6 months'
    WHEN left_days <= 365 THEN '6-12 months' ELSE 'over 12 months' END AS bucket
    FROM (SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y') AS s, concat('01', strftime(o_orderdate, '%m%Y')) AS m,
    date_diff('day', DATE '2000-06-30', o_orderdate) AS left_days FROM orders)""",
)
def d_parsing(spark, sf_dir):
    """Dates from text by length, expiry buckets."""
    d = F.col("o_orderdate")
    return t(spark, sf_dir, "orders").select(
        "o_orderkey", day_text(C.normalise_date(F.date_format(d, "ddMMyyyy"))).alias("d8"),
        day_text(C.normalise_date(F.date_format(d, "MMyyyy"))).alias("d6"),
        C.expiry_bucket(F.to_date(d), F.lit("2000-06-30").cast("date")).alias("bucket")
    )


@query(
    "s10_object_id_time",
    """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds, strftime(ts + INTERVAL 7 HOUR,
    '%Y-%m-%d') AS created FROM events""",
)
def s10_object_id_time(spark, sf_dir):
    """Creation times inside ids, local creation dates."""
    made = F.concat(F.lower(F.lpad(F.hex(F.unix_seconds("ts")), 8, "0")), F.lit("0123456789abcdef"))
    at = C.object_id_time(made)
    return t(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(at).alias("seconds"),
        day_text(C.created_partition(at, "Asia/Ho_Chi_Minh")).alias("created")
    )


@query(
    "n_json",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 AS
    twice, 'k' AS name, concat('{"k":', json_extract_string(props, '$.k'), '}') AS again FROM events""",
)
def n_json(spark, sf_dir):
    """JSON by path, variant access, keys, and back to text."""
    keys = F.map_keys(C.json_keys("props"))[0]
    k = F.variant_get(F.parse_json("props"), "$.k", "long")
    return t(spark, sf_dir, "events").select(
        "event_id", C.json_value("props", "$.k").alias("k"), (k * 2).alias("twice"), keys.alias("name"),
        F.to_json(F.struct(k.alias("k"))).alias("again")
    )


@query(
    "n2_json_parts",
    """SELECT o_orderkey, concat('{"price":', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), ',"tags":["',
    o_orderstatus, '","', o_orderpriority, '"]}') AS part,
    concat(o_orderstatus, '|', o_orderpriority) AS tags, o_orderpriority AS second FROM orders""",
)
def n2_json_parts(spark, sf_dir):
    """A sub-document by path, and arrays of strings in JSON."""
    inner = F.struct(F.floor("o_totalprice").alias("price"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    rows = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_json(F.struct(F.col("o_custkey").alias("who"), inner.alias("order"))).alias("doc")
    )
    part = F.get_json_object("doc", "$.order")
    tags = C.json_array(F.get_json_object("doc", "$.order.tags"))
    return rows.select(
        "o_orderkey", part.alias("part"), F.array_join(tags, "|").alias("tags"), F.get(tags, F.lit(1)).alias("second")
    )


@query(
    "n_arrays",
    """SELECT o_orderkey, count(*) AS n, string_agg(CAST(l_partkey AS VARCHAR), '-' ORDER BY l_partkey, l_linenumber) AS
    parts, sum(l_quantity) AS quantity, max(l_partkey) AS last
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def n_arrays(spark, sf_dir):
    """Arrays of structs through JSON, unnested again."""
    items = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    told = items.groupBy("o_orderkey").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct("l_partkey", "l_linenumber", "l_quantity")))).alias("doc")
    )
    rows = told.select(
        "o_orderkey",
        F.posexplode(C.json_array("doc", "struct<l_partkey:long,l_linenumber:int,l_quantity:double>")).alias("i", "x")
    )
    joined = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct("i", "x.l_partkey"))), lambda v: v["l_partkey"].cast("string")
        ),
        "-"
    )
    return rows.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), joined.alias("parts"), F.sum("x.l_quantity").alias("quantity"),
        F.max_by("x.l_partkey", "i").alias("last")
    )


@query(
    "n9_lookup",
    """SELECT o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN n END) AS urgent, max(CASE WHEN o_orderpriority
    = '5-LOW' THEN n END) AS low
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey""",
)
def n9_lookup(spark, sf_dir):
    """The value of a key in an array of pairs."""
    n = t(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").count()
    pairs = n.groupBy("o_custkey").agg(
        F.collect_list(F.struct(F.col("o_orderpriority").alias("key"), F.col("count").alias("value"))).alias("e")
    )
    return pairs.select("o_custkey", C.lookup("e", "1-URGENT").alias("urgent"), C.lookup("e", "5-LOW").alias("low"))


@query("s1_pruned_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def s1_pruned_scan(spark, sf_dir):
    """Named table, columns and slice pushed to the scan."""
    return io.read_table(
        spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"], F.lit("2000-01-01").cast("timestamp_ntz"),
        "o_orderdate"
    )


@query(
    "s4_inline_rows",
    "SELECT s.id, s.stage, count(o_orderkey) AS n FROM (VALUES (1, 'F', 'finished'), (2, 'O', 'open'), (3, 'P', "
    "'pending')) AS s(id, code, stage) LEFT JOIN orders ON o_orderstatus = s.code GROUP BY ALL",
)
def s4_inline_rows(spark, sf_dir):
    """Literal rows as a dimension."""
    stages = io.inline_rows(
        spark, [{"code": "F", "stage": "finished"}, {"code": "O", "stage": "open"}, {"code": "P", "stage": "pending"}]
    )
    return (
        stages
        .join(t(spark, sf_dir, "orders"), F.col("o_orderstatus") == F.col("code"), "left")
        .groupBy("id", "stage")
        .agg(F.count("o_orderkey").alias("n"))
    )


@query("p2_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def p2_distinct(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "p3_classify",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice >= 300000 THEN 'large' WHEN o_orderpriority
    LIKE '1%' THEN 'urgent' ELSE 'normal' END AS class,
    count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
)
def p3_classify(spark, sf_dir):
    """Ordered rules to a label."""
    rules = [
        (F.col("o_orderstatus") == "P", "pending"), (F.col("o_totalprice") >= 300000, "large"),
        (F.col("o_orderpriority").like("1%"), "urgent")
    ]
    return t(spark, sf_dir, "orders").groupBy(R.classify(rules, "normal").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "p4_j13_fallback",
    """SELECT c_custkey, coalesce(s.s_name, concat('nation ', n_name)) AS owner, CASE WHEN c_acctbal > 0 THEN c_acctbal
    WHEN c_nationkey > 0 THEN CAST(c_nationkey AS DOUBLE) END AS valid
    FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN supplier s ON s.s_suppkey = c_custkey""",
)
def p4_j13_fallback(spark, sf_dir):
    """First valid of a hierarchy, lookup with fallback."""
    names = t(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("k"), F.col("s_name").alias("owner")).unionByName(t(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("k"), F.concat(F.lit("nation "), "n_name").alias("owner")))
    people = t(spark, sf_dir, "customer").withColumns(
        {"own": F.concat(F.lit("s"), "c_custkey"), "land": F.concat(F.lit("n"), "c_nationkey")}
    )
    valid = R.first_valid(
        (F.col("c_acctbal"), F.col("c_acctbal") > 0), (F.col("c_nationkey").cast("double"), F.col("c_nationkey") > 0)
    )
    return R.fallback_lookup(
        people, names, ["own", "land"], "k", "owner"
    ).select("c_custkey", "owner", valid.alias("valid"))


@query(
    "j3_right_join",
    "SELECT n_name, count(c_custkey) AS customers FROM (SELECT * FROM customer WHERE c_acctbal > 9000) RIGHT JOIN "
    "nation ON n_nationkey = c_nationkey GROUP BY n_name"
)
def j3_right_join(spark, sf_dir):
    rich = t(spark, sf_dir, "customer").where("c_acctbal > 9000")
    return (
        rich
        .join(t(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "right")
        .groupBy("n_name")
        .agg(F.count("c_custkey").alias("customers"))
    )


@query(
    "j4_full_join",
    """SELECT strftime(coalesce(d1, d2), '%Y-%m') AS month, coalesce(a, 0) AS ordered, coalesce(b, 0) AS shipped FROM
    (SELECT date_trunc('month', o_orderdate) AS d1, count(*) AS a FROM orders GROUP BY 1) FULL JOIN (SELECT
    date_trunc('month', l_shipdate) AS d2, count(*) AS b FROM lineitem GROUP BY 1) ON d1 = d2""",
)
def j4_full_join(spark, sf_dir):
    """Both sides by month."""
    a = t(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month")
    ).agg(F.count(F.lit(1)).alias("ordered"))
    b = t(spark, sf_dir, "lineitem").groupBy(
        F.date_format("l_shipdate", "yyyy-MM").alias("month")
    ).agg(F.count(F.lit(1)).alias("shipped"))
    return a.join(b, "month", "full").na.fill(0, ["ordered", "shipped"])


@query(
    "j6_interval_join",
    """WITH span AS (SELECT s_suppkey, DATE '1996-01-01' + CAST(s_suppkey % 40 AS INTEGER) * 30 AS a FROM supplier)
    SELECT s_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN span ON s_suppkey =
    l_suppkey AND CAST(l_shipdate AS DATE) BETWEEN a AND a + 180 GROUP BY s_suppkey""",
)
def j6_interval_join(spark, sf_dir):
    """Equal key and date inside an interval."""
    start = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("s_suppkey") % 40 * 30).cast("int"))
    spans = t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), start.alias("a"), F.date_add(start, 180).alias("b")
    )
    items = t(spark, sf_dir, "lineitem").withColumn("on_day", F.to_date("l_shipdate"))
    return (
        R.interval_join(items, spans, ["l_suppkey"], "on_day", "a", "b")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query(
    "j6_pure_range_join",
    """WITH season AS (SELECT n_nationkey, DATE '1996-01-01' + n_nationkey * 37 AS a, DATE '1996-01-01' + n_nationkey *
    37 + 59 AS b FROM nation)
    SELECT n_nationkey, count(*) AS n FROM orders JOIN season ON CAST(o_orderdate AS DATE) BETWEEN a AND b GROUP BY
    n_nationkey""",
)
def j6_pure_range_join(spark, sf_dir):
    """J6 without an equal key: intervals as blocks of days."""
    start = F.date_add(F.lit("1996-01-01").cast("date"), F.col("n_nationkey") * 37)
    seasons = t(spark, sf_dir, "nation").select("n_nationkey", start.alias("a"), F.date_add(start, 59).alias("b"))
    orders = t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("on_day"))
    return (
        S.range_join(orders, seasons, "on_day", "a", "b")
        .groupBy("n_nationkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "j6_open_intervals",
    """WITH term AS (SELECT s_suppkey, s_nationkey AS nation, DATE '1992-01-01' + CAST(s_suppkey * 61 % 3000 AS INTEGER) AS a,
    CASE WHEN s_suppkey % 3 > 0 THEN DATE '1992-01-01' + CAST(s_suppkey * 61 % 3000 + s_suppkey % 7 * 90 AS INTEGER) END AS b
    FROM supplier)
    SELECT s_suppkey, count(*) AS n, count(DISTINCT o_custkey) AS customers, max(o_orderkey) AS last_key FROM orders JOIN
    customer ON c_custkey = o_custkey JOIN term ON nation = c_nationkey AND CAST(o_orderdate AS DATE) >= a AND (b IS NULL
    OR CAST(o_orderdate AS DATE) <= b) GROUP BY s_suppkey""",
)
def j6_open_intervals(spark, sf_dir):
    """Terms of suppliers, every third without an end, and the orders of their nation that fall into them."""
    first = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("s_suppkey") * 61 % 3000).cast("int"))
    last = F.when(F.col("s_suppkey") % 3 > 0, F.date_add(first, (F.col("s_suppkey") % 7 * 90).cast("int")))
    terms = t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), first.alias("a"), last.alias("b"))
    people = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    bought = orders.join(people, "o_custkey")
    terms = terms.groupBy(*terms.columns).agg(F.count(F.lit(1)).alias("times"))
    terms = terms.withColumn("_places", F.count(F.lit(1)).over(W.partitionBy("s_suppkey")))
    one = S.range_totals(bought, terms.where("_places = 1"), "day", "a", "b", ["nation"], "o_custkey", "o_orderkey").select(
        "s_suppkey", (F.col("n") * F.col("times")).alias("n"), F.col("entities").alias("customers"), F.col("top").alias("last_key")
    )
    # A supplier's number found in several nations: its customers are told apart over all of them.
    met = S.range_join(bought, terms.where("_places > 1"), "day", "a", "b", ["nation"])
    return one.unionByName(met.groupBy("s_suppkey").agg(
        F.sum("times").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.max("o_orderkey").alias("last_key")
    ))


@query(
    "j7_as_of_event",
    """SELECT p.event_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON v.user_id = p.user_id AND v.ts <= p.ts
    QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC NULLS LAST, v.event_id DESC) = 1""",
)
def j7_as_of_event(spark, sf_dir):
    """Each purchase with the user's last view at or before it."""
    events = t(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed"))
    return S.as_of_join(bought, views, ["user_id"], "ts", "viewed", ["view_id"]).select("event_id", "view_id")


@query(
    "w9_hot_key_scan",
    """SELECT l_orderkey, l_linenumber, round(sum(l_quantity) OVER w, 2) AS running, row_number() OVER (PARTITION BY
    l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS n, last_value(CASE WHEN l_discount = 0.05 THEN
    l_orderkey END IGNORE NULLS) OVER w AS last_air, lag(l_linestatus) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate,
    l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS before, max(l_discount) OVER w AS high FROM lineitem WINDOW w AS (PARTITION BY
    l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING)""",
)
def w9_hot_key_scan(spark, sf_dir):
    """Running values of three keys, each with a fifth of all lines or more."""
    air = F.when(F.col("l_discount") == 0.05, F.col("l_orderkey"))
    rows = S.segmented_scan(
        t(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], min_rows=1_000,
        running=S.running_sum("l_quantity"), n=S.running_sum(F.lit(1)), last_air=S.last_known(air),
        before=S.row_before("l_linestatus"), high=S.running_max("l_discount"),
    )
    return rows.select("l_orderkey", "l_linenumber", F.round("running", 2).alias("running"), "n", "last_air", "before", "high")


@query(
    "j7_as_of_latest",
    """SELECT c_custkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderkey END AS o_orderkey FROM customer
    LEFT JOIN
    (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
    = 1) ON o_custkey = c_custkey""",
)
def j7_as_of_latest(spark, sf_dir):
    """The newest row of a key, valid only from a time on."""
    people = t(spark, sf_dir, "customer").select("c_custkey", F.lit("2000-01-01").cast("timestamp").alias("since"))
    orders = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    out = R.latest_at_or_after(
        people, orders, "c_custkey", "since", "o_orderdate", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )
    return out.select("c_custkey", "o_orderkey")


_PRICE = (
    "price AS (SELECT p_brand AS brand, CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '00' ELSE CAST(p_partkey % 5 "
    "AS VARCHAR) END AS region, p_retailprice AS price FROM part)"
)


@query(
    "j8_exact_or_any",
    f"""WITH {_PRICE}, want AS (SELECT DISTINCT p_brand AS brand, CAST(r_regionkey AS VARCHAR) AS region FROM part,
    region)
    SELECT w.brand, w.region, count(*) AS n, round(min(price), 2) AS lowest FROM want w JOIN price p ON w.brand =
    p.brand AND (p.region = w.region OR p.region IS NULL OR p.region = '00') GROUP BY ALL""",
)
def j8_exact_or_any(spark, sf_dir):
    """A specific value or any, as two equal joins."""
    part = t(spark, sf_dir, "part")
    region = F.when(F.col("p_partkey") % 3 == 1, "00").when(
        F.col("p_partkey") % 3 == 2, (F.col("p_partkey") % 5).cast("string")
    )
    price = part.select(
        F.col("p_brand").alias("brand"), region.alias("region"), F.col("p_retailprice").alias("price")
    )
    # brands by five regions
    want = (
        part
        .select(F.col("p_brand").alias("brand"))
        .distinct()
        .crossJoin(t(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("region")))
    )
    return (
        R.exact_or_any_join(want, price, ["brand"], "region")
        .groupBy("brand", "region")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.min("price"), 2).alias("lowest"))
    )


@query(
    "j5_densify",
    """WITH first AS (SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS a FROM orders GROUP BY
    1),
    spine AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS
    DATE) AS m)
    SELECT first.o_custkey, strftime(m, '%Y-%m') AS month, count(o_orderkey) AS orders FROM first JOIN spine ON m >= a
    LEFT JOIN orders o ON o.o_custkey = first.o_custkey AND date_trunc('month', o_orderdate) = m GROUP BY ALL""",
)
def j5_densify(spark, sf_dir):
    """Customers by month of a spine from their first one on, with their orders."""
    orders = t(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    first = orders.groupBy("o_custkey").agg(F.min("month").alias("first_month"))
    months = F.sequence(F.lit("2000-01-01").cast("date"), F.lit("2001-08-01").cast("date"), F.expr("INTERVAL 1 MONTH"))
    rows = R.densify(first, "first_month", months, "month")
    n = orders.groupBy("o_custkey", "month").agg(F.count(F.lit(1)).alias("orders"))
    out = rows.join(n, ["o_custkey", "month"], "left").na.fill(0, ["orders"])
    return out.select("o_custkey", F.date_format("month", "yyyy-MM").alias("month"), "orders")


@query(
    "j9_j10_semi_anti",
    """SELECT 'with' AS kind, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE
    o_orderstatus = 'F')
    UNION ALL SELECT 'without', c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey =
    c_custkey AND o_orderstatus = 'F')""",
)
def j9_j10_semi_anti(spark, sf_dir):
    """IN and NOT IN with null keys kept."""
    people = t(spark, sf_dir, "customer")
    done = t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    kinds = {"with": people.join(done, "c_custkey", "left_semi"), "without": R.not_in(people, done, "c_custkey")}
    a, b = (df.select(F.lit(k).alias("kind"), "c_custkey") for k, df in kinds.items())
    return a.unionByName(b)


@query(
    "j11_correlated_in",
    "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier, lineitem WHERE l_suppkey = "
    "s_suppkey AND l_orderkey = o_orderkey)",
)
def j11_correlated_in(spark, sf_dir):
    """A set that depends on the outer row, as a semi join on both keys."""
    items = t(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("o_custkey"), F.col("l_orderkey").alias("o_orderkey")
    )
    return t(spark, sf_dir, "orders").join(items, ["o_custkey", "o_orderkey"], "left_semi").select("o_orderkey")


@query(
    "j12_scalar_subquery",
    "SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 2) AS above FROM orders WHERE "
    "o_totalprice > (SELECT avg(o_totalprice) FROM orders)"
)
def j12_scalar_subquery(spark, sf_dir):
    orders = t(spark, sf_dir, "orders")
    mean = orders.agg(F.avg("o_totalprice").alias("mean"))
    # with one row
    return (
        orders
        .crossJoin(F.broadcast(mean))
        .where("o_totalprice > mean")
        .select("o_orderkey", F.round(F.col("o_totalprice") - F.col("mean"), 2).alias("above"))
    )


@query(
    "j14_next_row",
    "SELECT a.event_id, CAST(floor(epoch(b.ts) - epoch(a.ts)) AS BIGINT) AS gap FROM events a JOIN events b ON "
    "a.event_id + 1 = b.event_id AND a.user_id = b.user_id"
)
def j14_next_row(spark, sf_dir):
    """Pairs of consecutive rows, by lead."""
    w = W.partitionBy("user_id").orderBy("event_id")
    e = t(spark, sf_dir, "events").withColumns({"next_id": F.lead("event_id").over(w), "next_ts": F.lead("ts").over(w)})
    return e.where("next_id = event_id + 1").select(
        "event_id", F.floor(F.unix_micros("next_ts") / 1e6 - F.unix_micros("ts") / 1e6).alias("gap")
    )


@query(
    "j18_null_safe_join",
    """WITH a AS (SELECT nullif(o_orderpriority, '5-LOW') AS p, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT
    nullif(o_orderpriority, '5-LOW') AS q, max(o_totalprice) AS m FROM orders GROUP BY 1)
    SELECT p, n, m FROM a JOIN b ON p IS NOT DISTINCT FROM q""",
)
def j18_null_safe_join(spark, sf_dir):
    p = t(spark, sf_dir, "orders").withColumn("p", F.nullif("o_orderpriority", F.lit("5-LOW")))
    a = p.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    b = p.groupBy(F.col("p").alias("q")).agg(F.max("o_totalprice").alias("m"))
    return a.join(b, F.col("p").eqNullSafe(F.col("q"))).select("p", "n", "m")


@query(
    "j19_correlated_sum",
    "SELECT s_suppkey, (SELECT round(sum(l_extendedprice), 2) FROM lineitem WHERE l_suppkey = s_suppkey AND "
    "l_shipdate > TIMESTAMP '2001-07-02') AS last_days FROM supplier",
)
def j19_correlated_sum(spark, sf_dir):
    """A sum for the outer row, grouped before the join."""
    sums = (
        t(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") > F.lit("2001-07-02").cast("timestamp"))
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("last_days"))
    )
    return t(spark, sf_dir, "supplier").join(sums, "s_suppkey", "left").select("s_suppkey", "last_days")


@query(
    "j20_between_events",
    """WITH e AS (SELECT user_id, event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM
    events WHERE event_type = 'error')
    SELECT e.event_id, count(*) AS n FROM e JOIN events n ON n.user_id = e.user_id AND n.event_type = 'view' AND n.ts >
    e.ts AND (nxt IS NULL OR n.ts < nxt) GROUP BY e.event_id""",
)
def j20_between_events(spark, sf_dir):
    """Notes strictly between an event and the next."""
    events = t(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'").select("user_id", "event_id", "ts")
    views = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("note_at"))
    return (
        S.between_events(errors, views, ["user_id"], "ts", "note_at", ["event_id"])
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "a_aggregates",
    """SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS quantity, min(l_extendedprice) AS low, max(l_extendedprice)
    AS high, round(avg(l_discount), 6) AS mean, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS
    returned,
    count(*) FILTER (WHERE l_linestatus = 'O') AS open, count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN
    l_returnflag = 'R' THEN l_partkey END) AS returned_parts,
    round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 8) AS weighted, CASE WHEN l_suppkey % 2 = 0 THEN
    sum(l_quantity) ELSE round(sum(l_extendedprice), 2) END AS by_unit,
    CASE WHEN count(*) FILTER (WHERE l_returnflag = 'N') > 0 THEN 'NORMAL' WHEN count(*) FILTER (WHERE l_returnflag =
    'R') = count(*) THEN 'RETURNED' ELSE 'MIXED' END AS state
    FROM lineitem GROUP BY l_suppkey HAVING count(*) > 3""",
)
def a_aggregates(spark, sf_dir):
    """Plain, conditional and distinct aggregates, having, weighted means, any and all."""
    back = F.col("l_returnflag") == "R"
    unit = F.when(F.col("l_suppkey") % 2 == 0, F.sum("l_quantity")).otherwise(F.round(F.sum("l_extendedprice"), 2))
    state = (
        F.when(F.count_if(F.col("l_returnflag") == "N") > 0, "NORMAL")
        .when(F.count_if(back) == F.count(F.lit(1)), "RETURNED")
        .otherwise("MIXED")
    )
    return t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"), F.round(F.avg("l_discount"), 6).alias("mean"),
        F.sum(F.when(back, F.col("l_quantity")).otherwise(0.0)).alias("returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("open"), F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct(F.when(back, F.col("l_partkey"))).alias("returned_parts"),
        F.round(
            F.try_divide(F.sum(F.col("l_extendedprice") * F.col("l_discount")), F.sum("l_extendedprice")), 8
        ).alias("weighted"),
        unit.alias("by_unit"), state.alias("state"),
    ).where("n > 3")


@query(
    "a4_string_agg",
    "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments FROM customer "
    "GROUP BY c_nationkey"
)
def a4_string_agg(spark, sf_dir):
    return t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ", ").alias("segments")
    )


@query(
    "a6_latest_value",
    "SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority, arg_min(o_orderkey, "
    "(o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY o_custkey"
)
def a6_latest_value(spark, sf_dir):
    """Values at the newest and oldest time, with a tie-break."""
    first = F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey"))
    return t(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        R.latest_value("o_orderpriority", "o_orderdate", "o_orderkey").alias("last_priority"),
        first.alias("first_order")
    )


@query(
    "a8_quantiles",
    "SELECT o_orderpriority, quantile_disc(o_totalprice, 0.5) AS p50, quantile_disc(o_totalprice, 0.9) AS p90, "
    "quantile_disc(o_totalprice, 0.95) AS p95 FROM orders GROUP BY o_orderpriority"
)
def a8_quantiles(spark, sf_dir):
    """Quantiles by counts of equal values, exact however many rows a group has."""
    orders = t(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    return S.exact_quantiles(orders, ["o_orderpriority"], "o_totalprice", {"p50": 50, "p90": 90, "p95": 95})


@query(
    "a8_sketch_rollup",
    """SELECT l_returnflag, count(*) AS n, CAST(min(d) AS DOUBLE) AS low, CAST(max(d) AS DOUBLE) AS high, true AS ordered, 101
    AS points FROM (SELECT l_returnflag, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d FROM
    lineitem JOIN orders ON o_orderkey = l_orderkey) GROUP BY l_returnflag""",
)
def a8_sketch_rollup(spark, sf_dir):
    """Days to shipment as sketches by month, merged to quantiles and a distribution of a hundred buckets. How
    far the ranks may be off is tested; counts, extremes and order are exact.
    """
    rows = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    months = U.quantile_sketches(rows.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")), ["l_returnflag", "month"], days)
    flags = U.merge_sketches(months, ["l_returnflag"])
    points = U.sketch_distribution(flags).groupBy("l_returnflag").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "value"))).alias("p")
    )
    values = F.transform("p", lambda x: x["value"])
    points = points.select("l_returnflag", F.size("p").alias("points"), (F.array_sort(values) == values).alias("rising"))
    told = U.sketch_quantiles(flags, {"p50": 0.5, "p90": 0.9, "p95": 0.95}).join(points, "l_returnflag")
    steps = [F.col(c) for c in ("low", "p50", "p90", "p95", "high")]
    ordered = reduce(lambda a, b: a & b, (x <= y for x, y in zip(steps, steps[1:], strict=False))) & F.col("rising")
    return told.select("l_returnflag", "n", "low", "high", ordered.alias("ordered"), "points")


@query(
    "a3_distinct_rollup",
    """WITH seen AS (SELECT c_mktsegment, strftime(o_orderdate, '%Y-%m') AS month, o_custkey FROM orders JOIN customer ON
    c_custkey = o_custkey)
    SELECT c_mktsegment, month, count(DISTINCT o_custkey) AS n FROM seen GROUP BY ALL UNION ALL
    SELECT NULL, month, count(DISTINCT o_custkey) FROM seen GROUP BY month UNION ALL
    SELECT c_mktsegment, NULL, count(DISTINCT o_custkey) FROM seen GROUP BY c_mktsegment UNION ALL
    SELECT NULL, NULL, count(DISTINCT o_custkey) FROM seen""",
)
def a3_distinct_rollup(spark, sf_dir):
    """Distinct buyers at four grains from one table of bitmaps at the finest."""
    people = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    seen = t(spark, sf_dir, "orders").join(people, "o_custkey").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    keys, root = ["c_mktsegment", "month"], io.scratch_folder(spark, "bitmaps")
    U.distinct_bitmaps(seen, keys, "o_custkey").write.parquet(root)
    stored, grains = spark.read.parquet(root), (keys, keys[1:], keys[:1], [])
    rows = [U.count_bitmaps(stored, g).select(*(F.col(k) if k in g else F.lit(None).cast("string").alias(k) for k in keys), "n") for g in grains]
    return reduce(DataFrame.unionByName, rows)


@query(
    "c7_checksum_difference",
    """SELECT 'a' AS side, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
    UNION ALL SELECT 'b', o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus =
    'O'""",
)
def c7_checksum_difference(spark, sf_dir):
    """A table against a copy in which some rows were changed, by sums of row hashes first."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    changed = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    price = F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    rows = U.checksum_difference(orders, orders.withColumn("o_totalprice", price), ["o_orderkey"])
    return rows.select("side", "o_orderkey", "o_totalprice")


@query(
    "s30_contributions",
    """SELECT o_custkey, count(*) AS n, CAST(sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10 ELSE o_totalprice
    END AS DECIMAL(18, 2))) AS DOUBLE) AS total, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE))
    AS last_day FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey""",
)
def s30_contributions(spark, sf_dir):
    """Orders by customer kept by contributions, through cancelled orders and corrected prices."""
    orders = t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"),
    )
    spec = {"sums": {"total": F.col("price")}, "least": {"first_day": F.col("day")}, "most": {"last_day": F.col("day")}}
    fact = U.contributions(orders, ["o_custkey"], **spec)
    before = orders.where("o_orderstatus IN ('P', 'F')")
    after = before.where("o_orderstatus = 'F'").withColumn("price", (F.col("price") + 10).cast("decimal(18,2)"))
    source = orders.where("o_orderstatus NOT IN ('P', 'F')").unionByName(after)
    rows = U.apply_changes(fact, before, after, source, ["o_custkey"], **spec)
    return rows.select("o_custkey", "n", F.col("total").cast("double").alias("total"), "first_day", "last_day")


@query(
    "u5_closure",
    """WITH RECURSIVE edge AS (SELECT p_partkey AS c, p_partkey // 2 AS p FROM part WHERE p_partkey > 1), walk AS (
    SELECT c AS child, p AS ancestor, 1 AS depth FROM edge UNION ALL
    SELECT child, p, depth + 1 FROM walk JOIN edge ON c = ancestor)
    SELECT child, ancestor, depth, false AS cyclic FROM walk""",
)
def u5_closure(spark, sf_dir):
    """All ancestors of parts in a tree in which part n hangs from part n / 2."""
    edges = t(spark, sf_dir, "part").where("p_partkey > 1").select("p_partkey", F.expr("p_partkey div 2").alias("parent"))
    return U.closure(edges, "p_partkey", "parent")


@query(
    "a11_pivot",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS F_n, count(*) FILTER (WHERE o_orderstatus = 'O')
    AS O_n, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS F_total,
    round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS O_total FROM orders GROUP BY o_custkey""",
)
def a11_pivot(spark, sf_dir):
    """Pivot with two aggregates."""
    out = R.pivot(
        t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", ["F", "O"], n=F.count(F.lit(1)),
        total=F.round(F.sum("o_totalprice"), 2)
    )
    return out.na.fill(0, ["F_n", "O_n"])


@query(
    "a13_unpivot",
    """SELECT o_orderstatus, measure, value FROM (SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total,
    CAST(count(*) AS DOUBLE) AS n, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE max(o_totalprice) END AS top
    FROM orders GROUP BY 1) UNPIVOT (value FOR measure IN (total, n, top))""",
)
def a13_unpivot(spark, sf_dir):
    """Measures as rows, without nulls."""
    sums = t(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).cast("double").alias("n"),
        F.when(F.col("o_orderstatus") != "P", F.max("o_totalprice")).alias("top")
    )
    return R.unpivot(sums, ["o_orderstatus"], ["total", "n", "top"])


@query(
    "a16_growth",
    """SELECT o_orderpriority, month, round(total, 2) AS total, round(total - lag(total) OVER (PARTITION BY
    o_orderpriority ORDER BY month), 2) AS growth
    FROM (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS total FROM orders GROUP
    BY ALL)""",
)
def a16_growth(spark, sf_dir):
    """Window over an aggregate."""
    sums = t(spark, sf_dir, "orders").groupBy(
        "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    ).agg(F.sum("o_totalprice").alias("total"))
    before = F.lag("total").over(W.partitionBy("o_orderpriority").orderBy("month"))
    return sums.select(
        "o_orderpriority", "month", F.round("total", 2).alias("total"),
        F.round(F.col("total") - before, 2).alias("growth")
    )


@query(
    "w_windows",
    """SELECT o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS dense,
    round(sum(o_totalprice) OVER (w ROWS UNBOUNDED PRECEDING), 2) AS running,
    round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 8) AS share, max(o_totalprice) OVER (PARTITION
    BY o_custkey) AS top, lag(o_orderkey, 2) OVER w AS two_before,
    count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate,
    o_orderkey)""",
)
def w_windows(spark, sf_dir):
    """Ranks, running sums, shares, and values of the whole partition."""
    w, whole = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), W.partitionBy("o_custkey")
    return t(spark, sf_dir, "orders").select(
        "o_orderkey", F.dense_rank().over(whole.orderBy(F.to_date("o_orderdate"))).alias("dense"),
        F.round(F.sum("o_totalprice").over(w.rowsBetween(W.unboundedPreceding, 0)), 2).alias("running"),
        F.round(R.share_of_total("o_totalprice", ["o_custkey"]), 8).alias("share"),
        F.max("o_totalprice").over(whole).alias("top"), F.lag("o_orderkey", 2).over(w).alias("two_before"),
        F.count(F.lit(1)).over(whole).alias("n"),
    )


@query(
    "w2_latest_set",
    "SELECT user_id, event_id FROM events QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1"
)
def w2_latest_set(spark, sf_dir):
    """All rows of the newest submission."""
    return R.latest_set(
        t(spark, sf_dir, "events").withColumn("on_day", F.to_date("ts")), ["user_id"], "on_day"
    ).select("user_id", "event_id")


@query(
    "w4_leaderboard",
    """SELECT l_suppkey, l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY CASE l_returnflag WHEN 'R' THEN n
    ELSE q END DESC) AS place
    FROM (SELECT l_suppkey, l_returnflag, CAST(count(*) AS DOUBLE) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY
    ALL)""",
)
def w4_leaderboard(spark, sf_dir):
    """Rank by a measure that depends on the stage."""
    sums = t(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("l_quantity").alias("q")
    )
    by = F.when(F.col("l_returnflag") == "R", F.col("n")).otherwise(F.col("q"))
    return sums.select(
        "l_suppkey", "l_returnflag", F.rank().over(W.partitionBy("l_returnflag").orderBy(by.desc())).alias("place")
    )


@query(
    "w6_gate",
    """SELECT event_id FROM (SELECT event_id, first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts DESC,
    event_id DESC) AS newest FROM events) WHERE newest = 'purchase'""",
)
def w6_gate(spark, sf_dir):
    """Groups whose newest row satisfies a predicate."""
    return R.gate_by_newest(
        t(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()],
        F.col("event_type") == "purchase"
    ).select("event_id")


@query(
    "w7_w8_fill",
    """SELECT event_id, last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forward,
    first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS back,
    first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS spread
    FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS v FROM events) WINDOW w AS (PARTITION BY
    user_id ORDER BY ts, event_id)""",
)
def w7_w8_fill(spark, sf_dir):
    """Spread, back-fill and forward fill."""
    e = t(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    order = ["ts", "event_id"]
    filled = S.segmented_scan(e, ["user_id"], order, forward=S.last_known("v"), back=S.next_known("v"))
    first = e.groupBy("user_id").agg(F.min_by("v", F.when(F.col("v").isNotNull(), F.struct(*order))).alias("spread"))
    return filled.join(first, "user_id").select("event_id", "forward", "back", "spread")


@query(
    "w12_change_points",
    "SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, "
    "event_id) AS b FROM events) WHERE b IS NULL OR b <> event_type",
)
def w12_change_points(spark, sf_dir):
    """Rows where the value changes."""
    return S.changes(
        t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type"
    ).select("event_id", "user_id", "event_type")


@query(
    "w14_islands",
    """SELECT user_id, island, count(*) AS n, min(event_id) AS first_id FROM (SELECT *, sum(flag) OVER (PARTITION BY
    user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM
    (SELECT *, CASE WHEN b IS NULL OR b <> event_type THEN 1 ELSE 0 END AS flag FROM (SELECT *, lag(event_type) OVER
    (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events))) GROUP BY ALL""",
)
def w14_islands(spark, sf_dir):
    """Gaps and islands."""
    return (
        S.runs(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type")
        .groupBy("user_id", "island")
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))
    )


@query(
    "w15_byte_buckets",
    """SELECT p_brand, CAST(floor(before / 500) AS BIGINT) AS bucket, count(*) AS n FROM (SELECT p_brand,
    sum(strlen(p_name)) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) - strlen(p_name) AS
    before FROM part) GROUP BY ALL""",
)
def w15_byte_buckets(spark, sf_dir):
    """Rows dealt to buckets of a number of bytes."""
    return (
        S.byte_runs(t(spark, sf_dir, "part"), ["p_brand"], ["p_partkey"], "p_name", 500)
        .groupBy("p_brand", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "t4_top_k",
    "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY "
    "o_totalprice DESC, o_orderkey) <= 3"
)
def t4_top_k(spark, sf_dir):
    """The first k of each group."""
    return R.top_k(
        t(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3
    ).select("o_custkey", "o_orderkey")


@query(
    "t3_last_valid",
    "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus <> 'P') AS "
    "last_valid FROM orders GROUP BY o_custkey"
)
def t3_last_valid(spark, sf_dir):
    """The last valid element of an array."""
    keys = F.transform(
        F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderstatus"))),
        lambda x: F.when(x["o_orderstatus"] != "P", x["o_orderkey"])
    )
    return (
        t(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(keys.alias("keys"))
        .select("o_custkey", C.last_valid("keys").alias("last_valid"))
    )


@query(
    "u_sets",
    "SELECT 'both' AS kind, c_nationkey AS k FROM customer INTERSECT SELECT 'both', s_nationkey FROM supplier UNION "
    "ALL (SELECT 'customer', c_custkey FROM customer EXCEPT SELECT 'customer', o_custkey FROM orders) UNION ALL "
    "(SELECT 'any', r_regionkey FROM region UNION SELECT 'any', n_regionkey FROM nation)"
)
def u_sets(spark, sf_dir):
    """Distinct union, difference, intersection."""
    k = lambda name, c: t(spark, sf_dir, name).select(F.col(c).cast("long").alias("k"))
    both = k("customer", "c_nationkey").intersect(k("supplier", "s_nationkey")).select(F.lit("both").alias("kind"), "k")
    left = k("customer", "c_custkey").subtract(k("orders", "o_custkey")).select(F.lit("customer").alias("kind"), "k")
    any_ = (
        k("region", "r_regionkey")
        .union(k("nation", "n_regionkey"))
        .distinct()
        .select(F.lit("any").alias("kind"), "k")
    )
    return both.unionByName(left).unionByName(any_)


@query(
    "u5_walk_array",
    "SELECT p_partkey, i - 1 AS i, part FROM (SELECT p_partkey, unnest(generate_series(1, len(parts))) AS i, "
    "parts[i] AS part FROM (SELECT p_partkey, string_split(p_name, ' ') AS parts FROM part))"
)
def u5_walk_array(spark, sf_dir):
    """Walking an array by index."""
    return t(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "part"))
