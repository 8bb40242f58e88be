"""Joins, aggregations and windows that recur in warehouse models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import range_join


def classify(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first rule that holds."""
    out = reduce(lambda c, r: c.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    return out.otherwise(F.lit(otherwise))


def first_valid(*choices: tuple[Column, Column]) -> Column:
    """The value of the first (value, condition) whose condition holds and whose value isn't null."""
    return F.coalesce(*(F.when(condition, value) for value, condition in choices))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group; the order should be total."""
    return (
        df
        .withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .where(F.col("_n") <= k)
        .drop("_n")
    )


def latest_set(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """All rows of each group that share its newest time."""
    return (
        df
        .withColumn("_n", F.rank().over(Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last())))
        .where("_n = 1")
        .drop("_n")
    )


def latest_value(value: str, at: str, tie: str) -> Column:
    """Aggregate: the value at the newest time, ties by the greatest `tie`."""
    return F.max_by(value, F.struct(at, tie))


def gate_by_newest(df: DataFrame, keys: list[str], order: list[Column], predicate: Column) -> DataFrame:
    """All rows of the groups whose newest row satisfies the predicate."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("_ok", F.first(F.coalesce(predicate, F.lit(False))).over(w)).where("_ok").drop("_ok")


def exact_or_any_join(
    left: DataFrame, right: DataFrame, keys: list[str], optional: str, wildcards: tuple[str, ...] = ("00",)
) -> DataFrame:
    """Inner join on keys and on `optional`, where a null or wildcard on the right matches every left row.

    An OR condition would be a nested loop; the union of two equal joins stays a hash join. A left row may match both
    ways.
    """
    any_value = F.col(optional).isNull() | F.col(optional).isin(*wildcards)
    exact = left.join(right.where(~any_value), [*keys, optional])
    wide = left.join(right.where(any_value).drop(optional), keys)
    return exact.select(*wide.columns).unionByName(wide)


#: Intervals of one key from which on they are joined by blocks of days.
DENSE_INTERVALS = 64


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], at: str, start: str, end: str, how: str = "inner",
    dense: int = DENSE_INTERVALS
) -> DataFrame:
    """Rows of equal keys with `at` in [start, end]; a null end is open, a null start matches nothing.

    Where a key has more than `dense` intervals, inner joins go by scans.range_join, whose rows meet only where they
    match; else an equal join by key compares each row with its key's few intervals.
    """
    if how == "inner":
        most = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if most > dense:
            return range_join(left, right, at, start, end, keys)
    r = right.select("*", *(F.col(k).alias(f"_r_{k}") for k in keys)).drop(*keys)
    on = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_r_{k}") for k in keys))
    inside = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    return left.join(r, on & inside, how).drop(*(f"_r_{k}" for k in keys))


def latest_at_or_after(
    left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, order: list[Column]
) -> DataFrame:
    """Left rows with their key's newest right row, where that is not older than the left time; else nulls."""
    newest = top_k(right, [key], order)
    joined = left.join(newest, key, "left")
    late = F.col(right_at) >= F.col(left_at)
    return joined.select(*left.columns, *(F.when(late, F.col(c)).alias(c) for c in right.columns if c != key))


def until_next(df: DataFrame, keys: list[str], at: str, end: str = "next_at", tie: str | None = None) -> DataFrame:
    """Each row with the time of the next one in its group."""
    order = [at] + ([tie] if tie else [])
    return df.withColumn(end, F.lead(at).over(Window.partitionBy(*keys).orderBy(*order)))


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key isn't among the right's known keys; rows without a key stay."""
    return left.join(right.where(F.col(key).isNotNull()).select(key), key, "left_anti")


def fallback_lookup(df: DataFrame, dim: DataFrame, levels: list[str], key: str, value: str) -> DataFrame:
    """`value` of the dimension for the first of the level columns that it knows."""
    small = dim.select(key, value).dropDuplicates([key])
    for i, level in enumerate(levels):
        df = df.join(
            small.select(F.col(key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}")), F.col(level) == F.col(f"_k{i}"),
            "left"
        )
    n = range(len(levels))
    return df.withColumn(value, F.coalesce(*(F.col(f"_v{i}") for i in n))).drop(*(f"_{c}{i}" for i in n for c in "kv"))


def pivot(df: DataFrame, keys: list[str], column: str, values: list, **aggregates: Column) -> DataFrame:
    return df.groupBy(*keys).pivot(column, values).agg(*(a.alias(n) for n, a in aggregates.items()))


def unpivot(
    df: DataFrame, keys: list[str], columns: list[str], name: str = "measure", value: str = "value"
) -> DataFrame:
    """Columns to rows, without nulls."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def share_of_total(value: str, keys: list[str]) -> Column:
    """The row's part of its group's total; null where that is zero."""
    return F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*keys)))


def islands(df: DataFrame, keys: list[str], order: list[str], changed: Column) -> DataFrame:
    """Rows with `island`, a number that grows where the flag holds; the first row of a group starts one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    marked = df.withColumn("_new", (first | F.coalesce(changed, F.lit(False))).cast("int"))
    return marked.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def change_points(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before in their group, and each group's first."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df
        .withColumns({"_before": before, "_n": n})
        .where((F.col("_n") == 1) | ~F.col(value).eqNullSafe(F.col("_before")))
        .drop("_before", "_n")
    )


def fill_forward(value: str, keys: list[str], order: list[str]) -> Column:
    return F.last(value, ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )


def fill_backward(value: str, keys: list[str], order: list[str]) -> Column:
    return F.first(value, ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    )


def spread(value: str, keys: list[str], order: list[str]) -> Column:
    """The group's first known value, on all its rows."""
    return F.first(value, ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def byte_buckets(df: DataFrame, keys: list[str], order: list[str], text: str, limit: int) -> DataFrame:
    """Rows with `bucket`: a group's texts in order, a new bucket each time the running bytes pass another `limit`."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    size = F.octet_length(F.coalesce(text, F.lit("")))
    return df.withColumn("bucket", F.floor((F.sum(size).over(w) - size) / limit))


def densify(entities: DataFrame, first: str, spine: Column, day: str) -> DataFrame:
    """Each entity with every day of the spine (an array column, so nothing is joined or broadcast) from its first one
    on.
    """
    return entities.withColumn(day, F.explode(F.filter(spine, lambda d: d >= F.col(first))))
