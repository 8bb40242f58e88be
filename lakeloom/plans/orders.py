"""Orders, their items, prices, margins, vouchers and rebates."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import relational as R
from lakeloom.operators import scans as S

from .registry import day_text, query, t


def items_of(spark, sf_dir) -> DataFrame:
    """Items with a line id, as order and line number repeat in the given table."""
    return t(spark, sf_dir, "lineitem").withColumn(
        "line", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    )


def order_channels(sources: dict[str, tuple[DataFrame, Column, list[tuple[Column, str]], str]]) -> DataFrame:
    """(order_key, origin, channel) of the orders of several systems. Each origin has its table, the column of its keys, its
    channel rules in order of precedence, and the channel of orders that no rule names.
    """
    rows = [
        df.select(key.alias("order_key"), F.lit(origin).alias("origin"), R.classify(rules, other).alias("channel"))
        for origin, (df, key, rules, other) in sources.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "b4_order_channel",
    """SELECT o_orderkey, 'store' AS origin, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'express' WHEN
    o_orderkey % 2 = 0 THEN 'app' ELSE 'web' END AS channel FROM orders
    UNION ALL SELECT event_id, 'events', CASE WHEN value > 50 THEN 'app' ELSE 'web' END FROM events WHERE event_type =
    'purchase'""",
)
def b4_order_channel(spark, sf_dir):
    """Channel rules, and a second source of orders."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    sources = {
        "store": (t(spark, sf_dir, "orders"), F.col("o_orderkey"), [(urgent, "express"), (F.col("o_orderkey") % 2 == 0, "app")], "web"),
        "events": (
            t(spark, sf_dir, "events").where("event_type = 'purchase'"), F.col("event_id"), [(F.col("value") > 50, "app")], "web"
        ),
    }
    return order_channels(sources).withColumnRenamed("order_key", "o_orderkey")


def exact_net() -> Column:
    """Price less discount as an exact decimal."""
    return F.col("l_extendedprice").cast("decimal(18,2)") * (
        F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    )


def customer_month_label(orders: DataFrame, cancelled: str = "P") -> DataFrame:
    """(o_custkey, month, label): New in a customer's first active month, Repeat one month after the active one before,
    else Reacquired. Cancelled orders make no month active.
    """
    months = (
        orders
        .where(F.col("o_orderstatus") != cancelled)
        .select("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
        .distinct()
    )
    gap = C.date_diff("MONTH", F.col("month"), F.lag("month").over(W.partitionBy("o_custkey").orderBy("month")))
    return months.withColumn("label", F.when(gap.isNull(), "New").when(gap > 1, "Reacquired").otherwise("Repeat"))


def order_fact(
    orders: DataFrame, items: DataFrame, cancelled: str = "P", ratings: DataFrame | None = None
) -> DataFrame:
    """One row an order: money by status, latest shipping, and the label of its customer's month, which all orders of
    the month share.

    `ratings` (o_orderkey, rating, rated_at) adds each order's newest rating; of equal times the greater one.
    """
    sums = items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(exact_net()).cast("double").alias("net"), F.max("l_shipdate").alias("last_ship")
    )
    live = F.col("o_orderstatus") != cancelled
    months = customer_month_label(orders, cancelled)
    rows = (
        orders
        .withColumn("month", F.trunc("o_orderdate", "month"))
        .join(months, ["o_custkey", "month"], "left")
        .join(sums, "o_orderkey", "left")
    )
    rating = []
    if ratings is not None:
        newest = ratings.groupBy("o_orderkey").agg(R.latest_value("rating", "rated_at", "rating").alias("rating"))
        rows, rating = rows.join(newest, "o_orderkey", "left"), ["rating"]
    return rows.select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("gmv"),
        F.when(live, F.round("o_totalprice", 2)).otherwise(0.0).alias("gmv_live"),
        F.when(F.col("o_orderstatus") == "F", F.col("net")).otherwise(0.0).alias("fulfilled"),
        day_text("last_ship").alias("last_ship"), "label", *rating,
    )


@query(
    "b5_order_fact",
    """SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS gmv, CASE WHEN o_orderstatus <> 'P' THEN
    round(o_totalprice, 2) ELSE 0 END AS gmv_live, CASE WHEN o_orderstatus = 'F' THEN net ELSE 0 END AS fulfilled,
    strftime(ship, '%Y-%m-%d') AS last_ship, label FROM orders LEFT JOIN (SELECT k, m, CASE WHEN lag(m) OVER w IS NULL
    THEN 'New' WHEN date_diff('month', lag(m) OVER w, m) > 1 THEN 'Reacquired' ELSE 'Repeat' END AS label
    FROM (SELECT DISTINCT o_custkey AS k, date_trunc('month', o_orderdate) AS m FROM orders WHERE o_orderstatus <> 'P')
    WINDOW w AS (PARTITION BY k ORDER BY m)) ON k = o_custkey AND m = date_trunc('month', o_orderdate)
    LEFT JOIN (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS
    DECIMAL(4,2)))) AS DOUBLE) AS net, max(l_shipdate) AS ship FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def b5_order_fact(spark, sf_dir):
    return order_fact(t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem"))


def explode_bundle(
    items: DataFrame, bundles: DataFrame, line: str, product: str, quantity: str, price: str
) -> DataFrame:
    """Bundle lines to component lines, others as they are.

    `bundles` has product, component, units and value (a unit's own price). `price` is the line's price spread over its
    components by units times value (evenly where that is zero). `unit_price` is a component's own price times the
    bundle's unit price over the worth of its components, but never above its own. Quantities are multiplied; component
    numbers start at 1, a plain line has number 0.
    """
    parts = bundles.withColumn("weight", F.col("units") * F.col("value"))
    all_parts = W.partitionBy(product)
    share = F.coalesce(F.try_divide("weight", F.sum("weight").over(all_parts)), 1 / F.count(F.lit(1)).over(all_parts))
    parts = parts.select(
        product, "component", "units", "value", F.sum("weight").over(all_parts).alias("worth"), share.alias("share"),
        F.row_number().over(all_parts.orderBy("component")).alias("number")
    )
    unit = F.try_divide(F.col(price), F.col(quantity))
    own = F.when(F.col("component").isNull(), unit).otherwise(
        F.col("value") * C.least_strict(F.try_divide(unit, F.col("worth")), F.lit(1.0))
    )
    out = items.join(parts, product, "left")
    return out.select(
        line, F.coalesce("component", product).alias("sku"),
        (F.col(quantity) * F.coalesce("units", F.lit(1))).alias("quantity"),
        (F.col(price) * F.coalesce("share", F.lit(1.0))).alias("price"), own.alias("unit_price"),
        F.coalesce("number", F.lit(0)).alias("number")
    )


_BUNDLE = (
    "bundle AS (SELECT p_partkey, component, units, value, units * value AS weight FROM (SELECT p_partkey, component, "
    "units, (SELECT p_retailprice FROM part c WHERE c.p_partkey = component) AS value FROM (SELECT p_partkey, "
    "p_partkey + k AS component, k AS units FROM part, (VALUES (1), (2), (3)) v(k) WHERE p_partkey % 10 = 0 AND "
    "p_partkey + 3 <= (SELECT max(p_partkey) FROM part))))"
)


def _bundles(spark, sf_dir) -> DataFrame:
    part = t(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    parts = (
        part
        .where("p_partkey % 10 = 0")
        .select("p_partkey", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("units"))
        .withColumn("component", F.col("p_partkey") + F.col("units"))
    )
    last = part.agg((F.max("p_partkey") - 3).alias("last"))
    parts = parts.crossJoin(F.broadcast(last)).where("p_partkey <= last")  # with one row
    return parts.join(
        part.select(F.col("p_partkey").alias("component"), F.col("p_retailprice").alias("value")), "component"
    ).select(F.col("p_partkey").alias("l_partkey"), "component", "units", "value")


@query(
    "b6_explode_bundle",
    f"""WITH {_BUNDLE} SELECT coalesce(component, l_partkey) AS sku, sum(l_quantity * coalesce(units, 1)) AS quantity,
    round(sum(l_extendedprice * coalesce(weight / total, 1)), 3) AS price,
    round(sum(CASE WHEN component IS NULL THEN l_extendedprice ELSE l_quantity * units * value * least(l_extendedprice /
    l_quantity / total, 1) END), 3) AS capped, count(*) AS n
    FROM lineitem LEFT JOIN (SELECT *, sum(weight) OVER (PARTITION BY p_partkey) AS total FROM bundle) b ON b.p_partkey
    = l_partkey GROUP BY 1""",
)
def b6_explode_bundle(spark, sf_dir):
    """Quantities and prices by component."""
    rows = explode_bundle(
        items_of(spark, sf_dir), _bundles(spark, sf_dir), "line", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return rows.groupBy("sku").agg(
        F.sum("quantity").alias("quantity"), F.round(F.sum("price"), 3).alias("price"),
        F.round(F.sum(F.col("unit_price") * F.col("quantity")), 3).alias("capped"), F.count(F.lit(1)).alias("n")
    )


def unit_conversion(units: DataFrame, product: str) -> DataFrame:
    """Units of (unit, level, quantity, is_sale) by product: how many base units each holds, the sale unit, and the
    largest unit.
    """
    w = W.partitionBy(product)
    per = F.max("quantity").over(w) / F.col("quantity")
    return units.withColumns(
        {
            "base_units": per, "sale_unit": F.min(F.when(F.col("is_sale"), F.struct("level", "unit"))).over(w)["unit"],
            "largest": F.min_by("unit", F.struct("level", "unit")).over(w)
        }
    ).select(product, "unit", "base_units", "sale_unit", "largest")


@query(
    "b7_unit_conversion",
    """SELECT p_partkey, unit, n / q AS base_units, CASE WHEN p_partkey % 2 = 0 THEN 'pack' ELSE 'piece' END AS
    sale_unit, 'box' AS largest FROM (SELECT p_partkey, p_size * 4.0 AS n, unnest(['box', 'pack', 'piece']) AS unit,
    unnest([1.0, 4.0, p_size * 4.0]) AS q FROM part)""",
)
def b7_unit_conversion(spark, sf_dir):
    """Retail units from JSON."""
    row = lambda unit, level, n, sale: F.struct(
        F.lit(unit).alias("unit"), F.lit(level).alias("level"), n.alias("quantity"), sale.alias("is_sale")
    )
    even, n = F.col("p_partkey") % 2 == 0, F.col("p_size") * F.lit(4.0)
    doc = F.to_json(
        F.array(row("box", 1, F.lit(1.0), F.lit(False)), row("pack", 2, F.lit(4.0), even), row("piece", 3, n, ~even))
    )
    units = t(spark, sf_dir, "part").select(
        "p_partkey",
        F.explode(C.json_array(doc, "struct<unit:string,level:int,quantity:double,is_sale:boolean>")).alias("u")
    ).select("p_partkey", "u.*")
    return unit_conversion(units, "p_partkey")


def strategic_measures(orders: DataFrame, items: DataFrame, grain: Column) -> DataFrame:
    """Measures by period in long form: GMV before and after cancelled orders, NMV (net of discounts and returned
    lines), fulfilled value, backlog, orders and their deliveries (DO: an order's days of shipping).
    """
    money, status = F.col("o_totalprice"), F.col("o_orderstatus")
    n = S.tasks_for(orders, items)
    a = orders.groupBy(grain.alias("period")).agg(
        F.round(F.sum(money), 2).alias("gmv_before_cancel"),
        F.round(F.sum(F.when(status != "P", money)), 2).alias("gmv_after_cancel"),
        F.round(F.sum(F.when(status == "F", money)), 2).alias("fulfilled"),
        F.count_if(status == "O").cast("double").alias("backlog"), F.count(F.lit(1)).cast("double").alias("so_count"),
    )
    sold = orders.where(status != "P").select("o_orderkey", grain.alias("period"))
    lines = items.withColumnRenamed("l_orderkey", "o_orderkey")
    sold = S.in_tasks(sold, n, "o_orderkey").join(S.in_tasks(lines, n, "o_orderkey"), "o_orderkey")
    kept = F.when(F.col("l_returnflag") != "R", exact_net())
    b = sold.groupBy("period").agg(
        F.coalesce(F.sum(kept).cast("double"), F.lit(0.0)).alias("nmv"),
        F.count_distinct("o_orderkey", F.to_date("l_shipdate")).cast("double").alias("do_count"),
    )
    a = a.join(b, "period", "left").na.fill(0.0, ["nmv", "do_count"])
    return R.unpivot(a, ["period"], [c for c in a.columns if c != "period"])


@query(
    "b13_strategic_measures",
    """SELECT period, measure, value FROM (SELECT strftime(o_orderdate, '%Y-%m') AS period, round(sum(o_totalprice), 2)
    AS gmv_before_cancel, round(sum(o_totalprice) FILTER (WHERE o_orderstatus <> 'P'), 2) AS gmv_after_cancel,
    round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS fulfilled, CAST(count(*) FILTER (WHERE
    o_orderstatus = 'O') AS DOUBLE) AS backlog, CAST(count(*) AS DOUBLE) AS so_count FROM orders GROUP BY 1)
    UNPIVOT (value FOR measure IN (gmv_before_cancel, gmv_after_cancel, fulfilled, backlog, so_count))
    UNION ALL SELECT period, measure, value FROM (SELECT period, coalesce(nmv, 0) AS nmv, coalesce(do_count, 0) AS
    do_count FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period FROM orders) LEFT JOIN
    (SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice
    AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END) AS DOUBLE) AS nmv,
    CAST(count(DISTINCT (o_orderkey, CAST(l_shipdate AS DATE))) AS DOUBLE) AS do_count FROM orders JOIN lineitem ON
    l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1) USING (period)) UNPIVOT (value FOR measure IN (nmv,
    do_count))""",
)
def b13_strategic_measures(spark, sf_dir):
    return strategic_measures(
        t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem"), F.date_format("o_orderdate", "yyyy-MM")
    )


def target_vs_actual(targets: list[DataFrame], actual: DataFrame, keys: list[str]) -> DataFrame:
    """Targets of several kinds, tables of (kind, keys, target), as one table, with what was reached, zero where nothing was."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), targets)
    out = rows.join(actual.select("kind", *keys, "actual"), ["kind", *keys], "left")
    return out.withColumn("actual", F.coalesce("actual", F.lit(0.0)))


@query(
    "b14_target_vs_actual",
    """SELECT kind, n_name, round(target, 2) AS target, round(coalesce(actual, 0), 2) AS actual FROM (SELECT 'gmv' AS
    kind, n_nationkey AS k, n_name, n_nationkey * 1000000.0 AS target FROM nation UNION ALL SELECT 'orders',
    n_nationkey, n_name, n_nationkey * 10.0 FROM nation)
    LEFT JOIN (SELECT 'gmv' AS kind, c_nationkey AS k, sum(o_totalprice) AS actual FROM orders JOIN customer ON
    c_custkey = o_custkey GROUP BY ALL UNION ALL SELECT 'orders', c_nationkey, count(*) FROM orders JOIN customer ON
    c_custkey = o_custkey GROUP BY ALL) USING (kind, k)""",
)
def b14_target_vs_actual(spark, sf_dir):
    """Targets of several kinds in one table, with what was reached."""
    nation = t(spark, sf_dir, "nation")
    targets = [
        nation.select(
            F.lit(k).alias("kind"), "n_nationkey", "n_name", (F.col("n_nationkey") * F.lit(x)).alias("target")
        ) for k,
        x in (("gmv", 1e6), ("orders", 10.0))
    ]
    sold = (
        t(spark, sf_dir, "orders")
        .join(t(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.sum("o_totalprice").alias("gmv"), F.count(F.lit(1)).cast("double").alias("orders"))
    )
    actual = sold.unpivot(["n_nationkey"], ["gmv", "orders"], "kind", "actual")
    rows = target_vs_actual(targets, actual, ["n_nationkey"])
    return rows.select("kind", "n_name", F.round("target", 2).alias("target"), F.round("actual", 2).alias("actual"))


def resolve_price(products: DataFrame, sources: dict[str, DataFrame], key: str, base: str) -> DataFrame:
    """The lowest of the base price and each source's, with the winner's name: on ties the first source, and a source
    before the base.
    """
    names = list(sources)
    for n, prices in sources.items():
        products = products.join(prices.groupBy(key).agg(F.min("price").alias(f"_{n}")), key, "left")
    final = F.least(*(F.col(f"_{n}") for n in names), F.col(base))
    return products.withColumns(
        {"final": final, "winner": R.classify([(F.col(f"_{n}") == final, n) for n in names], "base")}
    ).drop(*(f"_{n}" for n in names))


@query(
    "b26_price_resolution",
    """SELECT p_partkey, least(deal, campaign, p_retailprice) AS final, CASE WHEN deal = least(deal, campaign,
    p_retailprice) THEN 'deal' WHEN campaign = least(deal, campaign, p_retailprice) THEN 'campaign' ELSE 'base' END AS
    winner
    FROM part LEFT JOIN (SELECT l_partkey AS d, min(l_extendedprice / l_quantity) AS deal FROM lineitem WHERE l_discount
    >= 0.09 GROUP BY 1) ON d = p_partkey LEFT JOIN (SELECT l_partkey AS c, min(l_extendedprice / l_quantity) AS campaign
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON c = p_partkey""",
)
def b26_price_resolution(spark, sf_dir):
    """Deals and campaigns against the base price."""
    items = t(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        "l_discount", "l_returnflag"
    )
    out = resolve_price(
        t(spark, sf_dir, "part"),
        {"deal": items.where("l_discount >= 0.09"), "campaign": items.where("l_returnflag = 'R'")}, "p_partkey",
        "p_retailprice"
    )
    return out.select("p_partkey", "final", "winner")


def valid_prices(products: DataFrame, offers: DataFrame, key: str, region: str, at: Column) -> DataFrame:
    """The lowest offer that holds for each product row: of its product, of its region or of all (null or '00'), in its
    validity window.

    `offers` has the key, the region, price, start_time and end_time (null: open). The region rule is a union of equal
    joins.
    """
    live = offers.where((F.col("start_time") <= at) & (F.col("end_time").isNull() | (F.col("end_time") >= at)))
    met = R.exact_or_any_join(products.select(key, region).distinct(), live, [key], region)
    return met.groupBy(key, region).agg(F.min("price").alias("price"))


@query(
    "b26_region_prices",
    """WITH shop AS (SELECT p_partkey, r_regionkey AS region, p_retailprice FROM part, region WHERE p_partkey % 5 =
    r_regionkey),
    offer AS (SELECT l_partkey AS k, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '00' ELSE CAST(l_linenumber % 5 AS
    VARCHAR) END AS region, l_extendedprice / l_quantity AS price, l_shipdate AS a,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate + INTERVAL 2 YEAR END AS b FROM lineitem WHERE l_discount >=
    0.05),
    deal AS (SELECT p_partkey, shop.region, min(price) AS deal FROM shop JOIN offer ON k = p_partkey AND (offer.region
    IS NULL OR offer.region = '00' OR offer.region = CAST(shop.region AS VARCHAR))
    WHERE a <= TIMESTAMP '2001-01-01' AND (b IS NULL OR b >= TIMESTAMP '2001-01-01') GROUP BY ALL)
    SELECT p_partkey, least(deal, p_retailprice) AS final, CASE WHEN deal = least(deal, p_retailprice) THEN 'deal' ELSE
    'base' END AS winner FROM shop LEFT JOIN deal USING (p_partkey, region)""",
)
def b26_region_prices(spark, sf_dir):
    """Offers by region or for all, within their window; a part is sold in the region of its number."""
    shops = t(spark, sf_dir, "part").withColumn("region", (F.col("p_partkey") % 5).cast("string"))
    shops = shops.join(
        t(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("region")), "region", "left_semi"
    )
    number = F.col("l_linenumber")
    code = F.when(number == 1, F.lit(None)).when(number == 2, "00").otherwise((number % 5).cast("string"))
    end = F.when(number != 3, F.col("l_shipdate") + F.expr("INTERVAL 2 YEARS"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = t(spark, sf_dir, "lineitem").where("l_discount >= 0.05")
    offers = lines.select(
        F.col("l_partkey").alias("p_partkey"), code.alias("region"), price.alias("price"),
        F.col("l_shipdate").alias("start_time"), end.alias("end_time")
    )
    deals = valid_prices(shops, offers, "p_partkey", "region", F.lit("2001-01-01").cast("timestamp"))
    return resolve_price(
        shops, {"deal": deals.select("p_partkey", "price")}, "p_partkey", "p_retailprice"
    ).select("p_partkey", "final", "winner")


def price_frequency(items: DataFrame, product: str, price: Column, at: str, order: str, band: float = 100) -> DataFrame:
    """Orders by product, price band and month."""
    keys = F.col(product), F.floor(price / band).alias("price_band"), F.date_format(at, "yyyy-MM").alias("month")
    # By month too, so that a product with very many lines isn't one task.
    rows = S.in_tasks(items.select(*keys, order), S.tasks_for(items), product, "month")
    return rows.groupBy(product, "price_band", "month").agg(F.count_distinct(order).alias("orders"))


@query(
    "b27_price_frequency",
    "SELECT l_partkey, CAST(floor(l_extendedprice / l_quantity / 100) AS BIGINT) AS price_band, "
    "strftime(l_shipdate, '%Y-%m') AS month, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY ALL"
)
def b27_price_frequency(spark, sf_dir):
    return price_frequency(
        t(spark, sf_dir, "lineitem"), "l_partkey", F.col("l_extendedprice") / F.col("l_quantity"), "l_shipdate",
        "l_orderkey"
    )


def margin(items: DataFrame, bills: DataFrame, purchases: DataFrame, product: str, at: str) -> DataFrame:
    """Items with a unit cost and where it is from: the item's bill, else the product's purchase order, else its average
    cost of the month before.
    """
    month = F.trunc(F.to_date(at), "month")
    monthly = (
        purchases
        .groupBy(product, F.trunc(F.to_date("cost_at"), "month").alias("_m"))
        .agg(F.avg("cost").alias("_month_cost"))
        .withColumn("_m", F.to_date(F.add_months("_m", 1)))
    )
    same_day = purchases.groupBy(product, F.to_date("cost_at").alias("_d")).agg(F.min("cost").alias("_po_cost"))
    out = (
        items
        .join(bills, "line", "left")
        .withColumns({"_m": month, "_d": F.to_date(at)})
        .join(same_day, [product, "_d"], "left")
        .join(monthly, [product, "_m"], "left")
    )
    source = R.classify(
        [
            (F.col("bill_cost").isNotNull(), "bill"), (F.col("_po_cost").isNotNull(), "purchase"),
            (F.col("_month_cost").isNotNull(), "month before")
        ],
        "none"
    )
    return out.withColumns(
        {"cost": F.coalesce("bill_cost", "_po_cost", "_month_cost"), "cost_from": source}
    ).drop("_m", "_d", "_po_cost", "_month_cost", "bill_cost")


@query(
    "b28_margin",
    """WITH item AS (SELECT *, l_extendedprice / l_quantity * 0.8 AS own FROM lineitem), po AS (SELECT l_partkey AS p,
    CAST(l_shipdate AS DATE) AS d, min(own) AS c FROM item WHERE l_returnflag = 'A' GROUP BY ALL),
    mon AS (SELECT l_partkey AS p, date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS m, avg(own) AS c FROM item
    WHERE l_returnflag = 'A' GROUP BY ALL)
    SELECT cost_from, count(*) AS n, round(sum((price - cost) * l_quantity), 3) AS profit FROM (SELECT l_quantity,
    l_extendedprice / l_quantity AS price, CASE WHEN l_linenumber = 1 THEN own WHEN po.c IS NOT NULL THEN po.c ELSE
    mon.c END AS cost,
    CASE WHEN l_linenumber = 1 THEN 'bill' WHEN po.c IS NOT NULL THEN 'purchase' WHEN mon.c IS NOT NULL THEN 'month before'
    ELSE 'none' END AS cost_from
    FROM item LEFT JOIN po ON po.p = l_partkey AND po.d = CAST(l_shipdate AS DATE) LEFT JOIN mon ON mon.p = l_partkey
    AND mon.m = date_trunc('month', l_shipdate)) GROUP BY 1""",
)
def b28_margin(spark, sf_dir):
    """The cost waterfall and profit."""
    own = F.col("l_extendedprice") / F.col("l_quantity") * 0.8
    items = items_of(spark, sf_dir)
    bills = items.where("l_linenumber = 1").groupBy("line").agg(F.min(own).alias("bill_cost"))
    purchases = items.where("l_returnflag = 'A'").select(
        "l_partkey", F.col("l_shipdate").alias("cost_at"), own.alias("cost")
    )
    rows = margin(items, bills, purchases, "l_partkey", "l_shipdate")
    profit = (F.col("l_extendedprice") / F.col("l_quantity") - F.col("cost")) * F.col("l_quantity")
    return rows.groupBy("cost_from").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(profit), 3).alias("profit"))


def profit_lines(
    rows: DataFrame, rebates: DataFrame, fees: DataFrame, product: str, seller: str, at: str, price: Column,
    quantity: str
) -> DataFrame:
    """margin() lines with the rest of the waterfall: cost less the best rebate that runs on the day, the seller's fee,
    and the profit.

    `rebates` has the product, start, end (null: open) and rate; `fees` has the seller and fee_rate. A line without a
    cost has no profit.
    """
    days = rows.select("line", product, F.to_date(at).alias("_day"))
    best = (
        R.interval_join(days, rebates, [product], "_day", "start", "end")
        .groupBy("line")
        .agg(F.max("rate").alias("rebate_rate"))
    )
    out = (
        rows
        .join(best, "line", "left")
        .join(fees.select(seller, "fee_rate"), seller, "left").na
        .fill(0.0, ["rebate_rate", "fee_rate"])
    )
    cost = F.col("cost") * (1 - F.col("rebate_rate"))
    fee = price * F.col("fee_rate")
    return out.withColumns({"net_cost": cost, "fee": fee, "profit": (price - cost - fee) * F.col(quantity)})


@query(
    "b28_profit_lines",
    """WITH item AS (SELECT *, l_extendedprice / l_quantity AS price FROM lineitem), told AS (SELECT l_orderkey,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, price, price * 0.8 AS cost,
    CASE WHEN l_partkey % 3 = 0 AND CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' THEN 0.05
    ELSE 0 END AS rebate, (l_suppkey % 4) / 100.0 AS fee_rate FROM item)
    SELECT l_orderkey, l_partkey, l_suppkey, round(sum(cost * (1 - rebate) * l_quantity), 6) AS net_cost,
    round(sum(price * fee_rate * l_quantity), 6) AS fee, round(sum((price - cost * (1 - rebate) - price * fee_rate) *
    l_quantity), 6) AS profit FROM told GROUP BY ALL""",
)
def b28_profit_lines(spark, sf_dir):
    """Rebate and seller's fee by line; a bill for each line, a rebate of two years on every third product, fees by
    supplier.
    """
    items = items_of(spark, sf_dir)
    price = F.col("l_extendedprice") / F.col("l_quantity")
    bills = items.groupBy("line").agg(F.min(price * 0.8).alias("bill_cost"))
    purchases = items.select(
        "l_partkey", F.col("l_shipdate").alias("cost_at"), (price * 0.8).alias("cost")
    ).where("false")
    day = lambda d: F.lit(d).cast("date")
    parts = t(spark, sf_dir, "part").where("p_partkey % 3 = 0")
    rebates = parts.select(
        F.col("p_partkey").alias("l_partkey"), day("1997-01-01").alias("start"), day("1998-12-31").alias("end"),
        F.lit(0.05).alias("rate")
    )
    fees = t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), (F.col("s_suppkey") % 4 / 100.0).alias("fee_rate")
    )
    rows = profit_lines(
        margin(items, bills, purchases, "l_partkey", "l_shipdate"), rebates, fees, "l_partkey", "l_suppkey",
        "l_shipdate", price, "l_quantity"
    )
    sums = {
        "net_cost": F.col("net_cost") * F.col("l_quantity"), "fee": F.col("fee") * F.col("l_quantity"),
        "profit": F.col("profit")
    }
    return rows.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(
        *(F.round(F.sum(c), 6).alias(n) for n, c in sums.items())
    )


def net_margin(items: DataFrame, keys: list[str], value: Column, returned: Column) -> DataFrame:
    """Sold and returned value by key (an order, or an order's line), from two aggregates and a full join."""
    sold = items.where(~returned).groupBy(*keys).agg(F.sum(value).cast("double").alias("sold"))
    back = items.where(returned).groupBy(*keys).agg(F.sum(value).cast("double").alias("returned"))
    return sold.join(back, keys, "full").na.fill(0.0, ["returned"])


@query(
    "b29_net_margin",
    """SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS
    DECIMAL(4,2)))) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS sold, coalesce(CAST(sum(CAST(l_extendedprice AS
    DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) FILTER (WHERE l_returnflag = 'R') AS DOUBLE), 0) AS
    returned FROM lineitem GROUP BY ALL""",
)
def b29_net_margin(spark, sf_dir):
    """Sales by line net of returns."""
    return net_margin(
        t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], exact_net(), F.col("l_returnflag") == "R"
    )


def rebate_progress(
    rebates: DataFrame, bought: DataFrame, sold: DataFrame, key: str, at: str, value: str, quantity: str
) -> DataFrame:
    """What was bought and what was sold within each rebate's window, in its unit (value or quantity), and both as a
    percentage of its goal.

    `rebates` has the key, start, end, unit and goal; a rebate without any movement has zeros.
    """
    unit = F.col("unit") == "value"

    def within(rows: DataFrame, name: str) -> DataFrame:
        met = R.interval_join(rows.withColumn("_day", F.to_date(at)), rebates, [key], "_day", "start", "end")
        return met.groupBy(key, "start").agg(F.sum(F.when(unit, F.col(value)).otherwise(F.col(quantity))).alias(name))

    out = rebates.join(
        within(bought, "bought"), [key, "start"], "left"
    ).join(within(sold, "sold"), [key, "start"], "left")
    out = out.na.fill(0.0, ["bought", "sold"])
    return out.withColumns({f"{c}_percent": F.col(c) / F.col("goal") * 100 for c in ("bought", "sold")})


@query(
    "b31_rebate_progress",
    """WITH rebate AS (SELECT s_suppkey AS k, DATE '1998-01-01' + CAST(s_suppkey % 12 AS INTEGER) * 30 AS a, CASE WHEN
    s_suppkey % 2 = 0 THEN 'value' ELSE 'quantity' END AS unit, 1000000.0 AS goal FROM supplier),
    told AS (SELECT k, unit, goal, coalesce(sum(CASE WHEN unit = 'value' THEN l_extendedprice ELSE l_quantity END)
    FILTER (WHERE l_returnflag <> 'R'), 0) AS bought,
    coalesce(sum(CASE WHEN unit = 'value' THEN l_extendedprice ELSE l_quantity END) FILTER (WHERE l_returnflag = 'R'),
    0) AS sold FROM rebate LEFT JOIN lineitem ON l_suppkey = k AND CAST(l_shipdate AS DATE) BETWEEN a AND a + 365 GROUP
    BY ALL)
    SELECT k AS s_suppkey, unit, round(bought, 2) AS bought, round(sold, 2) AS sold, round(bought / goal * 100, 4) AS
    bought_percent, round(sold / goal * 100, 4) AS sold_percent FROM told""",
)
def b31_rebate_progress(spark, sf_dir):
    """Bought and sold within a rebate's window against its goal; returned lines stand for sold ones."""
    start = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("s_suppkey") % 12 * 30).cast("int"))
    unit = F.when(F.col("s_suppkey") % 2 == 0, "value").otherwise("quantity")
    rebates = t(spark, sf_dir, "supplier").select(
        "s_suppkey", start.alias("start"), F.date_add(start, 365).alias("end"), unit.alias("unit"),
        F.lit(1e6).alias("goal")
    )
    items = t(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    rows = rebate_progress(
        rebates, items.where("l_returnflag <> 'R'"), items.where("l_returnflag = 'R'"), "s_suppkey", "l_shipdate",
        "l_extendedprice", "l_quantity"
    )
    rounded = {"bought": 2, "sold": 2, "bought_percent": 4, "sold_percent": 4}
    return rows.select("s_suppkey", "unit", *(F.round(c, n).alias(c) for c, n in rounded.items()))


def voucher_allocation(orders: DataFrame, vouchers: str, order: str, gmv: str) -> DataFrame:
    """An order's value shared among its vouchers by discount, from a JSON array of (code, discount_value); evenly where
    all are zero.
    """
    rows = orders.select(
        order, gmv, F.posexplode(C.json_array(vouchers, "struct<code:string,discount_value:double>")).alias("i", "v")
    ).select(order, gmv, "i", "v.*")
    w = W.partitionBy(order)
    share = F.coalesce(F.try_divide("discount_value", F.sum("discount_value").over(w)), 1 / F.count(F.lit(1)).over(w))
    return rows.select(order, "code", "discount_value", (F.col(gmv) * share).alias("gmv_share"))


_VOUCHER = (
    "voucher AS (SELECT o_orderkey, o_totalprice, concat('V', l_linenumber) AS code, l_tax AS discount_value FROM "
    "orders JOIN lineitem ON l_orderkey = o_orderkey)"
)


def _vouchers(spark, sf_dir) -> DataFrame:
    orders, items = t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem")
    n = S.tasks_for(orders, items)
    orders, items = S.in_tasks(orders, n, "o_orderkey"), S.in_tasks(items, n, "l_orderkey")
    rows = orders.join(items, F.col("l_orderkey") == F.col("o_orderkey"))
    doc = F.to_json(
        F.collect_list(
            F.struct(F.concat(F.lit("V"), "l_linenumber").alias("code"), F.col("l_tax").alias("discount_value"))
        )
    )
    return rows.groupBy("o_orderkey", "o_totalprice", "o_orderdate").agg(doc.alias("vouchers"))


@query(
    "b32_voucher_allocation",
    f"""WITH {_VOUCHER} SELECT code, count(*) AS n, round(sum(o_totalprice * CASE WHEN total = 0 THEN 1.0 / n_v ELSE
    discount_value / total END), 3) AS gmv_share
    FROM (SELECT *, sum(discount_value) OVER (PARTITION BY o_orderkey) AS total, count(*) OVER (PARTITION BY o_orderkey)
    AS n_v FROM voucher) GROUP BY code""",
)
def b32_voucher_allocation(spark, sf_dir):
    """Shares that sum to the order's value."""
    rows = voucher_allocation(_vouchers(spark, sf_dir), "vouchers", "o_orderkey", "o_totalprice")
    return rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("gmv_share"), 3).alias("gmv_share"))


def voucher_usage(issued: DataFrame, used: DataFrame, code: str, order: str) -> DataFrame:
    """Vouchers with how often each was issued (`issued`), used and remains, and its status."""
    n = used.groupBy(code).agg(F.count_distinct(order).alias("used"))
    rows = issued.select(code, "issued").join(n, code, "left").na.fill(0, ["used"])
    status = R.classify([(F.col("used") == 0, "unused"), (F.col("used") >= F.col("issued"), "used up")], "active")
    return rows.withColumns({"remaining": F.col("issued") - F.col("used"), "status": status})


@query(
    "b33_voucher_usage",
    f"""WITH {_VOUCHER} SELECT concat('V', i) AS code, i * 5000 AS issued, coalesce(used, 0) AS used, i * 5000 -
    coalesce(used, 0) AS remaining, CASE WHEN coalesce(used, 0) = 0 THEN 'unused' WHEN coalesce(used, 0) >= i * 5000
    THEN 'used up' ELSE 'active' END AS status
    FROM (SELECT unnest(generate_series(1, 9)) AS i) LEFT JOIN (SELECT code, count(DISTINCT o_orderkey) AS used FROM
    voucher GROUP BY 1) ON code = concat('V', i)""",
)
def b33_voucher_usage(spark, sf_dir):
    """Issued, used and remaining; each code is issued 5,000 times its number."""
    rows = voucher_allocation(_vouchers(spark, sf_dir), "vouchers", "o_orderkey", "o_totalprice")
    issued = spark.range(1, 10).select(F.concat(F.lit("V"), "id").alias("code"), (F.col("id") * 5000).alias("issued"))
    return voucher_usage(issued, rows, "code", "o_orderkey")


def threshold_reached(facts: DataFrame, entity: str, order: list[str], value: str, threshold: float) -> DataFrame:
    """The first row of each entity at which its running sum reaches the threshold."""
    return S.reached(facts, [entity], order, value, threshold)


@query(
    "b34_gamification",
    """WITH eligible AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION (SELECT c_custkey FROM
    customer EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0))
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS completed FROM (SELECT *, sum(o_totalprice) OVER (PARTITION
    BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS running FROM orders)
    WHERE running >= 1000000 AND o_custkey IN (SELECT c_custkey FROM eligible) QUALIFY row_number() OVER (PARTITION BY
    o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def b34_gamification(spark, sf_dir):
    """When a running value first reached the goal, for those eligible."""
    people = t(spark, sf_dir, "customer")
    active, blocked = (
        people
        .where("c_mktsegment = 'BUILDING'")
        .select("c_custkey"), people
        .where("c_acctbal < 0")
        .select("c_custkey")
    )
    eligible = (
        active
        .union(people.select("c_custkey").subtract(blocked))
        .distinct()
        .withColumnRenamed("c_custkey", "o_custkey")
    )
    done = threshold_reached(
        t(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 1e6
    )
    return done.join(eligible, "o_custkey", "left_semi").select("o_custkey", day_text("o_orderdate").alias("completed"))


def seller_performance(
    items: DataFrame, orders: DataFrame, order: str, seller: str, at: str, shipped: str, status: str, since: Column
) -> DataFrame:
    """Orders, fill rate, cancel rate and mean days from order to shipping by seller, over orders after `since`."""
    rows = items.join(orders.where(F.col(at) > since), order)
    rate = lambda s: F.try_divide(F.count_if(F.col(status) == s), F.count(F.lit(1)))
    lead = F.avg(F.datediff(shipped, at)).alias("lead_days")
    return rows.groupBy(seller).agg(
        F.count_distinct(order).alias("orders"), rate("F").alias("fill_rate"), rate("P").alias("cancel_rate"), lead
    )


@query(
    "b46_seller_performance",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, round(count(*) FILTER (WHERE o_orderstatus = 'F') /
    count(*), 6) AS fill_rate, round(count(*) FILTER (WHERE o_orderstatus = 'P') / count(*), 6) AS cancel_rate,
    round(avg(date_diff('day', o_orderdate, l_shipdate)), 6) AS lead_days FROM lineitem JOIN orders ON o_orderkey =
    l_orderkey WHERE o_orderdate > TIMESTAMP '2001-05-03' GROUP BY l_suppkey""",
)
def b46_seller_performance(spark, sf_dir):
    """Rates and lead time over 90 days."""
    items = t(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    since = F.lit("2001-05-03").cast("timestamp")
    rows = seller_performance(
        items, t(spark, sf_dir, "orders"), "o_orderkey", "l_suppkey", "o_orderdate", "l_shipdate", "o_orderstatus",
        since
    )
    return rows.select(
        "l_suppkey", "orders", *(F.round(c, 6).alias(c) for c in ("fill_rate", "cancel_rate", "lead_days"))
    )


#: Products of a block of substitutes().
BLOCK_ROWS = 4_000


def substitutes(products: DataFrame, product: str, alike: list[str], size: str, near: int = 2) -> DataFrame:
    """Each two products that are alike in all the given columns, once, with the kind of relation by size. Choose
    columns that part the products finely: the result has a row for each pair.

    Products of a group are parted into blocks, and each two blocks meet once, in a task of their own. A block is sent as
    one row for each size, with its products: a product of one block meets the sizes of the other, where the relation is
    known, and only the result has a row for each pair. A task's memory holds the products of a block and the rows of one
    product, and its time is that of its blocks' pairs, however large the group is.
    """
    own = products.where(F.col(product).isNotNull()).select(F.col(product).alias("product"), *alike, F.col(size).alias("_size"))
    groups = own.groupBy(*alike).agg(F.count(F.lit(1)).alias("_n")).withColumn("_m", F.ceil(F.col("_n") / BLOCK_ROWS).cast("int"))
    met = groups.agg(F.sum(F.col("_n") * F.col("_n") / 2)).first()[0] or 0
    n = max(1, ceil(met / BLOCK_ROWS**2))
    own = own.join(groups, alike).withColumn("_i", F.pmod(F.xxhash64("product"), "_m").cast("int"))
    sizes = own.groupBy(*alike, "_m", "_i", "_size").agg(F.collect_list("product").alias("_products"))
    first = sizes.select(*alike, "_size", "_products", "_i", F.explode(F.expr("sequence(_i, _m - 1)")).alias("_j"))
    second = sizes.select(
        *alike, F.col("_size").alias("_other_size"), F.col("_products").alias("_others"), F.explode(F.expr("sequence(0, _i)")).alias("_i"),
        F.col("_i").alias("_j")
    )
    cell = [*alike, "_i", "_j"]
    first, second = S.in_tasks(first, n, *cell), S.in_tasks(second, n, *cell)
    first = first.select(*cell, "_size", F.explode("_products").alias("product"))
    gap = F.abs(F.col("_size") - F.col("_other_size"))
    kind = R.classify([(gap == 0, "same size"), (gap <= near, "near size")], "other size")
    # a hash join would keep the rows of all products of one size at once, as Spark runs it in one loop with the first explode
    known = first.join(second.hint("merge"), cell).select("_i", "_j", "product", "_others", kind.alias("relation"))
    pairs = known.select("_i", "_j", "product", F.explode("_others").alias("other"), "relation")
    once = (F.col("_i") < F.col("_j")) | (F.col("product") < F.col("other"))
    low, high = F.least("product", "other"), F.greatest("product", "other")
    return pairs.where(once).select(low.alias("product"), high.alias("other"), "relation")


@query(
    "b47_substitutes",
    """SELECT a.p_partkey AS product, b.p_partkey AS other, CASE WHEN a.p_size = b.p_size THEN 'same size' WHEN
    abs(a.p_size - b.p_size) <= 2 THEN 'near size' ELSE 'other size' END AS relation FROM part a JOIN part b ON
    a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey""",
)
def b47_substitutes(spark, sf_dir):
    """Products of one brand and type, with the kind of relation."""
    return substitutes(t(spark, sf_dir, "part"), "p_partkey", ["p_brand", "p_type"], "p_size")


def substitute_classes(products: DataFrame, product: str, alike: list[str], size: str, near: int = 2) -> DataFrame:
    """Products alike in the given columns as classes of one size, and each class with itself and the others of its kind:
    (alike, size, other_size, relation, n, n_other). A class stands for its products, so a kind of very many products
    gives rows by the square of its sizes, not of its products; join substitute members by class where pairs are asked.

    The relation of a class with itself holds between its different products; a class of one has none.
    """
    classes = products.groupBy(*alike, size).agg(F.count(product).alias("n"))
    other = classes.select(*alike, F.col(size).alias("other_size"), F.col("n").alias("n_other"))
    gap = F.abs(F.col(size) - F.col("other_size"))
    kind = R.classify([(gap == 0, "same size"), (gap <= near, "near size")], "other size")
    rows = classes.join(other, alike).where((F.col(size) < F.col("other_size")) | ((gap == 0) & (F.col("n") > 1)))
    return rows.select(*alike, F.col(size).alias("size"), "other_size", kind.alias("relation"), "n", "n_other")


@query(
    "b47_substitute_classes",
    """WITH c AS (SELECT p_type, p_size, count(*) AS n FROM part GROUP BY ALL) SELECT a.p_type, a.p_size AS size, b.p_size AS
    other_size, CASE WHEN a.p_size = b.p_size THEN 'same size' WHEN abs(a.p_size - b.p_size) <= 2 THEN 'near size' ELSE
    'other size' END AS relation, a.n, b.n AS n_other FROM c a JOIN c b ON a.p_type = b.p_type AND (a.p_size < b.p_size OR
    (a.p_size = b.p_size AND a.n > 1))""",
)
def b47_substitute_classes(spark, sf_dir):
    """Classes of products of one type and size, and how they relate."""
    return substitute_classes(t(spark, sf_dir, "part"), "p_partkey", ["p_type"], "p_size")


def sell_out(
    items: DataFrame, blocked: DataFrame, customer: str, at: str, keys: list[str], quantity: str, at_least: float
) -> DataFrame:
    """Monthly sell-out by key, less blocked customers, of groups over a least quantity."""
    rows = R.not_in(items, blocked, customer)
    sums = rows.groupBy(F.date_format(at, "yyyy-MM").alias("month"), *keys).agg(
        F.count_distinct(customer).alias("customers"), F.sum(quantity).alias("quantity")
    )
    return sums.where(F.col("quantity") > at_least)


def nested_detail(orders: DataFrame, order: str, detail: str) -> DataFrame:
    """One row for each scan of each pick of each item, from JSON of three levels; an item without picks and a pick
    without scans keep one row with nulls.
    """
    kind = "struct<sku:string,picks:array<struct<bin:string,scans:array<struct<code:string,n:long>>>>>"
    rows = orders.select(order, F.explode_outer(C.json_array(detail, kind)).alias("i"))
    rows = rows.select(order, "i.sku", F.explode_outer("i.picks").alias("p")).select(
        order, "sku", "p.bin", F.explode_outer("p.scans").alias("s")
    )
    return rows.select(order, "sku", "bin", "s.code", "s.n")


@query(
    "b51_nested_detail",
    """SELECT l_orderkey AS k, concat('P', l_partkey) AS sku, CASE WHEN l_linenumber % 3 <> 0 THEN concat('B',
    l_suppkey) END AS bin, CASE WHEN l_linenumber % 3 = 1 THEN concat('S', s) END AS code, CASE WHEN l_linenumber % 3 =
    1 THEN s * l_linenumber END AS n
    FROM lineitem, (VALUES (1), (2)) v(s) WHERE l_linenumber % 3 = 1 OR s = 1""",
)
def b51_nested_detail(spark, sf_dir):
    """Picks and scans nested in JSON; every third line has none, every third a pick without scans."""
    number, line = F.col("l_linenumber") % 3, F.col("l_linenumber").cast("long")
    scan = lambda s: F.struct(F.lit(f"S{s}").alias("code"), (line * s).alias("n"))
    scans = F.when(number == 1, F.array(scan(1), scan(2)))
    picks = F.when(number != 0, F.array(F.struct(F.concat(F.lit("B"), "l_suppkey").alias("bin"), scans.alias("scans"))))
    item = F.struct(F.concat(F.lit("P"), "l_partkey").alias("sku"), picks.alias("picks"))
    orders = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.to_json(F.collect_list(item)).alias("detail")
    )
    return nested_detail(orders, "k", "detail")


@query(
    "b51_data_share",
    """SELECT strftime(l_shipdate, '%Y-%m') AS month, p_brand, n_name, count(DISTINCT o_custkey) AS customers,
    sum(l_quantity) AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey =
    o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN part ON p_partkey = l_partkey WHERE o_orderstatus <> 'P' AND l_returnflag <> 'R' AND c_custkey NOT IN (SELECT
    c_custkey FROM customer WHERE c_acctbal < 0) AND l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY ALL HAVING
    sum(l_quantity) > 20""",
)
def b51_data_share(spark, sf_dir):
    """A filtered monthly sell-out."""
    items = t(spark, sf_dir, "lineitem").where(
        (F.col("l_returnflag") != "R") & (F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp"))
    )
    people = t(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    rows = items.join(
        t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    rows = rows.join(
        people.select("o_custkey", F.col("c_nationkey").alias("n_nationkey")), "o_custkey"
    ).join(t(spark, sf_dir, "nation"), "n_nationkey")
    rows = rows.join(t(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return sell_out(
        rows, people.where("c_acctbal < 0"), "o_custkey", "l_shipdate", ["p_brand", "n_name"], "l_quantity", 20
    )


def daily_sales(sources: list[DataFrame]) -> DataFrame:
    """Lines and quantity by product and day over several sources of (product, at, quantity)."""
    rows = reduce(DataFrame.unionByName, (df.select("product", "at", "quantity") for df in sources))
    return rows.groupBy("product", F.to_date("at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )


@query(
    "b56_tender_union",
    """SELECT product, strftime(d, '%Y-%m-%d') AS day, count(*) AS n, round(sum(q), 4) AS quantity FROM (SELECT
    l_partkey AS product, CAST(l_shipdate AS DATE) AS d, l_quantity AS q FROM lineitem
    UNION ALL SELECT user_id, CAST(ts AS DATE), value FROM events WHERE event_type = 'purchase') GROUP BY ALL""",
)
def b56_tender_union(spark, sf_dir):
    """Two sources in one fact, sales by product and day."""
    a = t(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product"), F.col("l_shipdate").alias("at"), F.col("l_quantity").alias("quantity")
    )
    b = t(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias("product"), F.col("ts").alias("at"), F.col("value").alias("quantity")
    )
    return daily_sales([a, b]).select(
        "product", day_text("day").alias("day"), "n", F.round("quantity", 4).alias("quantity")
    )


def attribution(
    items: DataFrame, period: Column, order: str, product: str, value: str, recommended: Column
) -> DataFrame:
    """Orders, products and value by period, in all and of the recommended items alone."""
    own = lambda c: F.when(recommended, F.col(c))
    return items.groupBy(period.alias("period")).agg(
        F.count_distinct(order).alias("orders"), F.count_distinct(own(order)).alias("orders_rcm"),
        F.count_distinct(own(product)).alias("products_rcm"),
        F.sum(value).alias("value"), F.sum(own(value)).alias("value_rcm"),
    )


def recommendation_feeds(
    events: DataFrame, lines: DataFrame, user: str, item: str, at: str, kinds: dict[str, str]
) -> DataFrame:
    """One feed of (user, item, kind, at, weight): views and carts as they come, and completed lines net of what came
    back.

    `kinds` names the events taken, by event_type; `lines` has user, item, at, quantity and returned; a line that came
    back whole is left out.
    """
    kind = R.classify([(F.col("event_type") == k, n) for k, n in kinds.items()])
    seen = events.select(user, item, kind.alias("kind"), at, F.lit(1.0).alias("weight")).where("kind IS NOT NULL")
    left = (F.col("quantity") - F.coalesce("returned", F.lit(0.0))).alias("weight")
    done = lines.select(user, item, F.lit("completed").alias("kind"), at, left).where("weight > 0")
    return seen.unionByName(done)


@query(
    "b50_recommendation_feeds",
    """SELECT user_id, event_id % 100 AS item, CASE event_type WHEN 'view' THEN 'view' ELSE 'cart' END AS kind,
    strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, 1.0 * count(*) AS weight FROM events WHERE event_type IN ('view',
    'click') GROUP BY ALL
    UNION ALL SELECT o_custkey, l_partkey, 'completed', strftime(o_orderdate, '%Y-%m-%d'), count(*), sum(q - r) FROM
    (SELECT l_orderkey, l_partkey, sum(l_quantity) AS q, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0)
    AS r FROM lineitem GROUP BY ALL)
    JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' WHERE q > r GROUP BY ALL""",
)
def b50_recommendation_feeds(spark, sf_dir):
    """Views, carts (clicks) and completed lines net of returns."""
    events = t(spark, sf_dir, "events").select(
        "user_id", (F.col("event_id") % 100).alias("item"), "event_type", F.col("ts").alias("at")
    )
    quantity, back = (
        F.sum("l_quantity")
        .alias("quantity"), F
        .sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")))
        .alias("returned")
    )
    sums = t(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item")
    ).agg(quantity, back)
    live = t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(
        "o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at")
    )
    feed = recommendation_feeds(
        events, sums.join(live, "o_orderkey"), "user_id", "item", "at", {"view": "view", "click": "cart"}
    )
    return feed.groupBy("user_id", "item", "kind", day_text("at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")
    )


@query(
    "b60_recommendation_attribution",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_orderkey) AS orders, count(DISTINCT CASE WHEN
    l_linenumber = 1 THEN o_orderkey END) AS orders_rcm, count(DISTINCT CASE WHEN l_linenumber = 1 THEN l_partkey END)
    AS products_rcm,
    round(sum(l_extendedprice), 2) AS value, round(sum(l_extendedprice) FILTER (WHERE l_linenumber = 1), 2) AS value_rcm
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def b60_recommendation_attribution(spark, sf_dir):
    """Values and counts by source beside the total; line 1 stands for a recommended item."""
    rows = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    told = attribution(
        rows, F.date_format("o_orderdate", "yyyy-MM"), "o_orderkey", "l_partkey", "l_extendedprice",
        F.col("l_linenumber") == 1
    )
    return told.select(
        F.col("period").alias("month"), "orders", "orders_rcm", "products_rcm",
        *(F.round(c, 2).alias(c) for c in ("value", "value_rcm"))
    )


def item_discount_split(items: DataFrame, discounts: DataFrame, order: str, product: str, value: str) -> DataFrame:
    """Each item's discount from an order's JSON map of product (or `all`) to discount: a product's is shared among its
    lines, one for all among all lines, by value.
    """
    given = discounts.select(
        order, F.explode(C.json_keys("discounts")).alias("k", "v")
    ).withColumn("v", F.col("v").cast("double"))
    whole = given.where("k = 'all'").groupBy(order).agg(F.sum("v").alias("_all"))
    single = (
        given
        .where("k <> 'all'")
        .groupBy(order, F.col("k").cast("long").alias(product))
        .agg(F.sum("v").alias("_own"))
    )
    rows = items.join(whole, order, "left").join(single, [order, product], "left")
    share = lambda keys: F.coalesce(R.share_of_total(value, keys), F.lit(0.0))
    return rows.withColumn(
        "discount",
        F.coalesce("_all", F.lit(0.0)) * share([order]) + F.coalesce("_own", F.lit(0.0)) * share([order, product])
    ).drop("_all", "_own")


@query(
    "b62_item_discount_split",
    """SELECT l_orderkey, round(sum(discount), 4) AS discount, count(*) AS n FROM (SELECT l_orderkey, 100.0 *
    l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey)
    + CASE WHEN l_partkey = min(l_partkey) OVER (PARTITION BY l_orderkey) THEN 7.0 * l_extendedprice /
    sum(l_extendedprice) OVER (PARTITION BY l_orderkey, l_partkey) ELSE 0 END AS discount FROM lineitem) GROUP BY 1""",
)
def b62_item_discount_split(spark, sf_dir):
    """Whole-order and product vouchers on items."""
    items = items_of(spark, sf_dir)
    doc = F.to_json(
        F.map_from_arrays(
            F.array(F.lit("all"), F.min("l_partkey").cast("string")), F.array(F.lit("100.0"), F.lit("7.0"))
        )
    )
    items = S.in_tasks(items, S.tasks_for(items), "l_orderkey")
    discounts = items.groupBy("l_orderkey").agg(doc.alias("discounts"))
    rows = item_discount_split(items, discounts, "l_orderkey", "l_partkey", "l_extendedprice")
    return rows.groupBy("l_orderkey").agg(F.round(F.sum("discount"), 4).alias("discount"), F.count(F.lit(1)).alias("n"))
