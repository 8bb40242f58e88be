"""Aggregates that are kept and built upon instead of computed again: mergeable quantiles, distinct counts that roll up,
sums of row hashes that tell where two tables differ, facts kept by contributions, and closures of hierarchies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.sources.io import scratch_folder


def quantile_sketches(df: DataFrame, keys: list[str], value: str | Column, k: int = 800) -> DataFrame:
    """(keys, sketch, low, high): a KLL sketch of each group's known values, of bounded size whatever the group, and
    their exact extremes. A rank told by a sketch is off by some 0.4 % of the group (k = 800), also after merging.
    """
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    return df.where(value.isNotNull() & ~F.isnan(value)).groupBy(*keys).agg(
        F.kll_sketch_agg_double(value, k).alias("sketch"), F.min(value).alias("low"), F.max(value).alias("high")
    )


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups merged to coarser ones, from what is stored, without the rows."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def sketch_quantiles(sketches: DataFrame, ranks: dict[str, float]) -> DataFrame:
    """The named quantiles of each sketch, and how many values it has seen."""
    told = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(rank))) for name, rank in ranks.items()}
    return sketches.withColumns({"n": F.kll_sketch_get_n_double("sketch"), **told}).drop("sketch")


def sketch_distribution(sketches: DataFrame, buckets: int = 100, tail_from: float = 0.95) -> DataFrame:
    """One row for each bucket of each sketch: its number (0 to `buckets`), the value below which that part of the values
    lies, and whether it belongs to the tail. The ends are the exact extremes.
    """
    ranks = F.array(*(F.lit(i / buckets) for i in range(buckets + 1)))
    values = F.kll_sketch_get_quantile_double("sketch", ranks)
    rows = sketches.select(*(c for c in sketches.columns if c != "sketch"), F.posexplode(values).alias("bucket", "value"))
    ends = F.when(F.col("bucket") == 0, F.col("low")).when(F.col("bucket") == buckets, F.col("high")).otherwise(F.col("value"))
    return rows.withColumns({"value": ends, "tail": F.col("bucket") >= F.lit(tail_from * buckets)}).drop("low", "high")


def distinct_bitmaps(df: DataFrame, keys: list[str], ids: str | Column) -> DataFrame:
    """(keys, chunk, bitmap): the distinct ids of each group as bitmaps of 32,768 ids; ids are whole numbers of 1 or more
    (dense ones make full bitmaps), null ids are left out. Stored at the finest grain, they count any coarser one.
    """
    ids = (F.col(ids) if isinstance(ids, str) else ids).cast("long")
    return df.where(ids.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(ids).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bitmap")
    )


def count_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): exact distinct ids of groups as coarse as wished, by OR over the stored bitmaps. A hot group is spread
    over its chunks before it is added up.
    """
    merged = bitmaps.groupBy(*keys, "chunk").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))


def row_hash(columns: list[str]) -> Column:
    """64 bits of a row's columns, in which a null is told from any value and from its place."""
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts)


def checksum_difference(a: DataFrame, b: DataFrame, keys: list[str], buckets: int = 4096) -> DataFrame:
    """Rows of `a` but not of `b` (side `a`) and the other way round, repeats counted, as exceptAll both ways gives them.

    Both tables are first reduced to a count and a sum of row hashes for each bucket of keys; rows are compared only in
    buckets that differ, so equal tables cost one narrow aggregate each and no shuffle of rows. Two different sets of
    rows of a bucket have the same count and sum of 64 bits about once in 2^64.
    """
    columns = a.columns
    b = b.select(*columns)
    bucket = F.pmod(row_hash(keys), F.lit(buckets)).cast("int")
    hashed = row_hash(columns).cast("decimal(20,0)")

    def sums(df: DataFrame, name: str) -> DataFrame:
        return df.select(bucket.alias("_b"), hashed.alias("_h")).groupBy("_b").agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.sum("_h").alias("s")).alias(name)
        )

    both = sums(a, "_x").join(sums(b, "_y"), "_b", "full")
    differ = [r[0] for r in both.where(~F.col("_x").eqNullSafe(F.col("_y"))).select("_b").collect()]  # `buckets` at most
    inside = bucket.isin(differ) if differ else F.lit(False)
    mine, theirs = a.where(inside), b.where(inside)
    return mine.exceptAll(theirs).withColumn("side", F.lit("a")).unionByName(
        theirs.exceptAll(mine).withColumn("side", F.lit("b"))
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """An equal join in which null keys meet; the right side has its keys as _k_key."""
    on = reduce(lambda x, y: x & y, (left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys))
    return left.join(right, on, how)


def contributions(
    rows: DataFrame, keys: list[str], sums: dict[str, Column], least: dict[str, Column], most: dict[str, Column]
) -> DataFrame:
    """The aggregate of source rows that apply_changes() keeps: keys, n, sums (exact decimals stay exact), extremes, and
    for each sum the number of its known values."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(x) for x, c in sums.items()), *(F.count(c).alias(f"n_{x}") for x, c in sums.items()),
        *(F.min(c).alias(x) for x, c in least.items()), *(F.max(c).alias(x) for x, c in most.items()),
    )


def apply_changes(
    fact: DataFrame, before: DataFrame, after: DataFrame, source: DataFrame, keys: list[str], sums: dict[str, Column],
    least: dict[str, Column] | None = None, most: dict[str, Column] | None = None
) -> DataFrame:
    """A fact made by contributions() brought up to date: the old versions of changed rows (`before`; none for an insert)
    are taken off and the new ones (`after`; none for a delete) added. Groups without rows go; null keys are a group.

    Only where an old version held a group's extreme is that group aggregated again from `source`, the table after the
    change. A sum of no known values is 0. Sums of doubles may differ from a full refresh in their last digits;
    use decimals where that matters.
    """
    least, most = least or {}, most or {}
    gone, come = contributions(before, keys, sums, least, most), contributions(after, keys, sums, least, most)
    added = ["n", *sums, *(f"n_{x}" for x in sums)]
    ends = [*((x, F.least, "<=") for x in least), *((x, F.greatest, ">=") for x in most)]
    delta = (
        come.select(*keys, *added, *(F.col(x).alias(f"_new_{x}") for x, _, _ in ends))
        .unionByName(
            gone.select(*keys, *((-F.col(x)).alias(x) for x in added), *(F.col(x).alias(f"_old_{x}") for x, _, _ in ends)),
            allowMissingColumns=True,
        )
        .groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys))
        .agg(
            *(F.sum(x).alias(f"_d_{x}") for x in added), F.lit(True).alias("_met"),
            *(F.max(f"_{w}_{x}").alias(f"_{w}_{x}") for x, _, _ in ends for w in ("new", "old")),
        )
    )
    both = _same(fact, delta, keys, "full")
    key = [F.when(F.col("_met") & F.col("n").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    total = lambda x: (F.coalesce(F.col(x), F.lit(0)) + F.coalesce(F.col(f"_d_{x}"), F.lit(0))).alias(x)
    lost = reduce(
        lambda p, q: p | q,
        (F.coalesce(F.col(f"_old_{x}") <= F.col(x) if sign == "<=" else F.col(f"_old_{x}") >= F.col(x), F.lit(False)) for x, _, sign in ends),
        F.lit(False),
    )
    new = both.select(*key, *map(total, added), *(f(F.col(x), F.col(f"_new_{x}")).alias(x) for x, f, _ in ends), lost.alias("_lost"))
    new = new.where("n > 0")
    if not ends:
        return new.select(*fact.columns)
    stale = new.where("_lost").select(*(F.col(k).alias(f"_k_{k}") for k in keys))
    again = contributions(_same(source, stale, keys, "left_semi"), keys, sums, least, most)
    again = again.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(F.col(x).alias(f"_a_{x}") for x, _, _ in ends))
    new = _same(new, again, keys, "left")
    return new.select(
        *(
            F.when(F.col("_lost"), F.col(f"_a_{c}")).otherwise(F.col(c)).alias(c) if c in [x for x, _, _ in ends] else F.col(c)
            for c in fact.columns
        )
    )


def closure(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, ancestor, depth, cyclic): every node's ancestors of any depth, each at its least depth; `cyclic` says that
    the node is its own ancestor. Edges without a child or a parent are left out; several parents are allowed.

    Pointer doubling: paths of up to 2^k edges and those of exactly 2^k edges give those of up to 2^(k + 1), so a chain
    of a thousand levels takes ten rounds. Each round is written to the shared folder, which cuts the lineage. A cycle
    ends the rounds when 2^k passes the number of edges.
    """
    spark = edges.sparkSession
    root = scratch_folder(spark, "closure")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    one = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).dropna().distinct()
    far = kept(one, "far-0")
    paths = kept(one.withColumn("depth", F.lit(1).cast("long")), "paths-0")
    n, length, k = far.count(), 1, 0
    while n and length <= n and not far.isEmpty():
        k += 1
        step = far.select("child", F.col("ancestor").alias("via"))
        onward = paths.select(F.col("child").alias("via"), "ancestor", (F.col("depth") + length).alias("depth"))
        longer = step.join(onward, "via").select("child", "ancestor", "depth")
        paths = kept(paths.unionByName(longer).groupBy("child", "ancestor").agg(F.min("depth").alias("depth")), f"paths-{k}")
        far = kept(step.join(far.select(F.col("child").alias("via"), "ancestor"), "via").select("child", "ancestor").distinct(), f"far-{k}")
        length *= 2
    loops = paths.where(F.col("child") == F.col("ancestor")).select("child", F.lit(True).alias("_loop"))
    return paths.join(loops, "child", "left").select("child", "ancestor", "depth", F.coalesce("_loop", F.lit(False)).alias("cyclic"))
