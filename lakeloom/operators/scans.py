"""Running values and as-of joins whose work doesn't depend on how many rows one key has.

A window over a key is one task for that key. Here a key with more than its share of the rows is cut into slices of its
order; each slice is a window of its own and leaves one row of totals, the totals are carried from slice to slice, and
what comes before a slice is added to its rows. All of it is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys of fewer rows than this are never cut.
MIN_ROWS = 10_000
#: Rows of a hot key that are sampled for each of its slices, to place the cuts.
SAMPLED = 32
#: Rows of a task where rows are shuffled by in_tasks().
TASK_ROWS = 200_000


def tasks_for(*frames: DataFrame) -> int:
    """How many tasks of about TASK_ROWS rows the largest of the tables makes."""
    return max(1, *(ceil(df.count() / TASK_ROWS) for df in frames))


def in_tasks(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """The rows shuffled by the keys into n tasks, which Spark doesn't put together again: it would by their compressed
    bytes, so that a task's memory and time grew with how well rows compress and how much is made of each.
    """
    return df.repartition(n, *keys)


def running_sum(value: str | Column) -> tuple[str, str | Column]:
    """The sum of the known values up to the row."""
    return "sum", value


def running_min(value: str | Column) -> tuple[str, str | Column]:
    return "min", value


def running_max(value: str | Column) -> tuple[str, str | Column]:
    return "max", value


def last_known(value: str | Column) -> tuple[str, str | Column]:
    """The row's value, or the last one before it that isn't null."""
    return "last", value


def next_known(value: str | Column) -> tuple[str, str | Column]:
    """The row's value, or the first one after it that isn't null."""
    return "next", value


def row_before(value: str | Column) -> tuple[str, str | Column]:
    """The value of the row before; null in the first row."""
    return "before", value


def row_after(value: str | Column) -> tuple[str, str | Column]:
    """The value of the row after; null in the last row."""
    return "after", value


def _local(kind: str, value: Column, w) -> Column:
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    if kind == "sum":
        return F.sum(value).over(upto)
    if kind == "min":
        return F.min(value).over(upto)
    if kind == "max":
        return F.max(value).over(upto)
    if kind == "last":
        return F.last(value, ignorenulls=True).over(upto)
    if kind == "next":
        return F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return (F.lag if kind == "before" else F.lead)(F.struct(value.alias("v"))).over(w)


def _total(kind: str, value: Column, order: Column) -> Column:
    """What a slice leaves to the slices after it (or, for values that come from below, before it)."""
    if kind in ("sum", "min", "max"):
        return {"sum": F.sum, "min": F.min, "max": F.max}[kind](value)
    if kind in ("last", "next"):
        return (F.max_by if kind == "last" else F.min_by)(value, F.when(value.isNotNull(), order))
    return (F.max_by if kind == "before" else F.min_by)(F.struct(value.alias("v")), order)


def _carried(kind: str, total: str, w) -> Column:
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    if kind in ("sum", "min", "max"):
        return {"sum": F.sum, "min": F.min, "max": F.max}[kind](total).over(before)
    if kind == "last":
        return F.last(total, ignorenulls=True).over(before)
    if kind == "next":
        return F.first(total, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return (F.lag if kind == "before" else F.lead)(total).over(w)


def _combined(kind: str, own: Column, carried: Column) -> Column:
    if kind == "sum":
        return F.coalesce(own + carried, own, carried)
    if kind in ("min", "max"):
        return (F.least if kind == "min" else F.greatest)(own, carried)
    return F.coalesce(own, carried)


class Cuts(NamedTuple):
    """Where the keys with more than a task's share of the rows are cut: (keys, _cuts), or None where no key is."""

    rows: DataFrame | None


def find_cuts(df: DataFrame, keys: list[str], order: list[str], min_rows: int = MIN_ROWS) -> Cuts:
    """Cuts to share between several scans over the same keys and order; scans of fewer rows may use them too."""
    return Cuts(_hot_cuts(df, keys, order, min_rows))


def _hot_cuts(df: DataFrame, keys: list[str], order: list[str], min_rows: int) -> DataFrame | None:
    """(keys, _cuts) of the keys with more rows than a task's share, or null if there are none.

    A share is the rows of the table by the number of shuffle partitions, so there are fewer such keys than partitions,
    and at most that many cuts of all keys together: this is what is collected and sent to all tasks.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    share = max(rows / parts, min_rows)
    if most <= share:
        return None
    hot = counts.where(F.col("_n") > share)
    hot = spark.createDataFrame(hot.collect(), hot.schema)
    sample = _meet(df.select(*keys, F.struct(*order).alias("_place")), F.broadcast(hot), keys)
    fraction = min(1.0, SAMPLED * parts / rows)
    cuts = sample.sample(fraction=fraction, seed=1).groupBy(*keys, "_n").agg(F.sort_array(F.collect_list("_place")).alias("_s"))
    slices = F.ceil(F.col("_n") / share).cast("int")
    picked = F.expr("transform(sequence(1, _m - 1), i -> _s[cast(floor(i * size(_s) / _m) as int)])")
    cuts = cuts.withColumn("_m", slices).where("_m > 1 AND size(_s) > 0").select(*keys, picked.alias("_cuts"))
    return spark.createDataFrame(cuts.collect(), cuts.schema)


def _meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equal join in which null keys meet."""
    other = right.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = reduce(lambda a, b: a & b, (left[k].eqNullSafe(other[f"_k_{k}"]) for k in keys))
    return left.join(F.broadcast(other), on, how).drop(*(f"_k_{k}" for k in keys))


def segmented_scan(
    df: DataFrame, keys: list[str], order: list[str], min_rows: int = MIN_ROWS, cuts: Cuts | None = None,
    **scans: tuple[str, str | Column]
) -> DataFrame:
    """The rows with a column for each scan (running_sum(...), last_known(...), ...), over the rows of equal keys in
    ascending order, nulls first; null keys are a group. The order should be total, or ties are taken as they come.

    One count by key tells whether any key has more than a task's share of the rows. If none has, this is the plain
    window. Else those keys are cut into slices at sampled places of their order; a slice holds about a share. Rows
    with the very same order values stay in one slice. The rows are shuffled once, by keys and slice. `cuts` are those of
    find_cuts(), where several scans share them.
    """
    cuts = (cuts or find_cuts(df, keys, order, min_rows)).rows
    value = {n: F.col(v) if isinstance(v, str) else v for n, (_, v) in scans.items()}
    kind = {n: k for n, (k, _) in scans.items()}
    plain = lambda n, c: c["v"] if kind[n] in ("before", "after") else c
    if cuts is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({n: plain(n, _local(kind[n], value[n], w)) for n in scans})
    at = F.struct(*order)
    rows = _meet(df, cuts, keys, "left")
    rows = rows.withColumns({"_place": at, "_hot": F.col("_cuts").isNotNull(), "_slice": F.lit(0)})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for k in reversed(range(parts.bit_length())):  # how many cuts are at or before the row, by halves; a key has fewer than parts
        more = f"_slice + {1 << k} <= size(_cuts) AND get(_cuts, _slice + {(1 << k) - 1}) <= _place"
        rows = rows.withColumn("_slice", F.expr(f"CASE WHEN {more} THEN _slice + {1 << k} ELSE _slice END"))
    rows = rows.withColumn("_slice", F.expr("CASE WHEN _hot THEN _slice ELSE -1 END")).drop("_cuts")
    # Slices are the tasks: Spark would put some of them together again, to the size of 64 compressed MB.
    rows = in_tasks(rows, 2 * parts, *keys, "_slice")
    # By _hot and not by _slice, which a filter on it would work out once more.
    totals = rows.where("_hot").groupBy(*keys, "_slice").agg(*(_total(kind[n], value[n], F.col("_place")).alias(n) for n in scans))
    over = Window.partitionBy(*keys).orderBy("_slice")
    carried = totals.select(*keys, "_slice", *(_carried(kind[n], n, over).alias(f"_c_{n}") for n in scans))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    own = rows.drop("_place", "_hot").withColumns({f"_o_{n}": _local(kind[n], value[n], w) for n in scans})
    # Slices of hot keys only: no more rows than twice the number of shuffle partitions.
    out = _meet(own, carried, [*keys, "_slice"], "left")
    made = {n: plain(n, _combined(kind[n], F.col(f"_o_{n}"), F.col(f"_c_{n}"))) for n in scans}
    return out.select(*(F.col(c) for c in df.columns if c not in made), *(c.alias(n) for n, c in made.items()))


def fill(df: DataFrame, keys: list[str], order: list[str], min_rows: int = MIN_ROWS, **columns: str) -> DataFrame:
    """The rows with new columns (name=source) filled forward with the last known value."""
    return segmented_scan(df, keys, order, min_rows, **{n: last_known(c) for n, c in columns.items()})


def changes(
    df: DataFrame, keys: list[str], order: list[str], value: str, min_rows: int = MIN_ROWS, cuts: Cuts | None = None
) -> DataFrame:
    """Rows whose value differs from the one before in their group, and each group's first; null is a value."""
    seen = F.struct(F.col(value).alias("x"))
    rows = segmented_scan(df, keys, order, min_rows, cuts, _was=row_before(seen))
    return rows.where(F.col("_was").isNull() | ~F.col("_was.x").eqNullSafe(F.col(value))).drop("_was")


def runs(df: DataFrame, keys: list[str], order: list[str], value: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows with `island`, numbered from 1 in each group, which grows by one wherever the value changes; null is a value.
    """
    seen = F.struct(F.col(value).alias("x"))
    cuts = find_cuts(df, keys, order, min_rows)
    rows = segmented_scan(df, keys, order, cuts=cuts, _was=row_before(seen))
    new = F.col("_was").isNull() | ~F.col("_was.x").eqNullSafe(F.col(value))
    rows = segmented_scan(rows.withColumn("_new", new.cast("int")), keys, order, cuts=cuts, island=running_sum("_new"))
    return rows.drop("_new", "_was")


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, percents: dict[str, int], groups: DataFrame | None = None,
    min_rows: int = MIN_ROWS, times: str | Column | None = None,
) -> DataFrame:
    """The named percentiles of each group's known values, each the least value that has that part of them at or below it;
    null where a group has none. `groups`, one row for each group, is what they are added to; a row
    counts as often as `times` says, or once.

    Equal values are counted first, and the counts are summed up in order of value, in slices where a group has many.
    """
    counts = df.groupBy(*keys, value).agg((F.count(F.lit(1)) if times is None else F.sum(times)).alias("_n"))
    known = counts.where(F.col(value).isNotNull())
    upto = segmented_scan(known, keys, [value], min_rows, _upto=running_sum("_n"))
    all_of = known.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    on = lambda a, b: reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys))
    named = lambda b: b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    right = named(all_of)
    ranked = upto.join(right, on(upto, right)).drop(*(f"_k_{k}" for k in keys))
    reached = lambda p: F.col("_upto") * 100 >= F.col("_all") * p  # noqa: E731  whole numbers, as 0.95 isn't one in binary
    told = named(ranked.groupBy(*keys).agg(*(F.min(F.when(reached(p), F.col(value))).alias(n) for n, p in percents.items())))
    groups = counts.select(*keys).distinct() if groups is None else groups
    return groups.join(told, on(groups, told), "left").drop(*(f"_k_{k}" for k in keys))


def byte_runs(
    df: DataFrame, keys: list[str], order: list[str], text: str, limit: int, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Rows with `bucket`: a group's texts in order, a new bucket each time the bytes before pass another `limit`."""
    size = F.octet_length(F.coalesce(text, F.lit("")))
    rows = segmented_scan(df, keys, order, min_rows, _upto=running_sum(size))
    return rows.withColumn("bucket", F.floor((F.col("_upto") - size) / limit)).drop("_upto")


def reached(
    df: DataFrame, keys: list[str], order: list[str], value: str, threshold: float, min_rows: int = MIN_ROWS
) -> DataFrame:
    """The first row of each group at which its running sum (`running`) reaches the threshold: an aggregate, combined
    before it is shuffled.
    """
    rows = segmented_scan(df, keys, order, min_rows, running=running_sum(value)).where(F.col("running") >= threshold)
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_first"))
    return first.select("_first.*")


def spans(
    df: DataFrame, keys: list[str], order: list[str], start: str = "start", end: str = "end", min_rows: int = MIN_ROWS,
    cuts: Cuts | None = None
) -> DataFrame:
    """Rows with [start, end): the row's own time (the first of `order`) and the next one's; null in a group's last."""
    return segmented_scan(df, keys, order, min_rows, cuts, **{end: row_after(order[0])}).withColumn(start, F.col(order[0]))


def as_of_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_at: str | Column, right_at: str | Column,
    ties: list[str] | None = None, direction: str = "backward", strict: bool = False, how: str = "left",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Left rows with the columns of the one right row of equal keys that is nearest in time: the last at or before the
    left time (`backward`), or the first at or after it (`forward`); `strict` leaves out equal times.

    Rows without a key or a time match nothing. Right rows of one time are told apart by `ties`: backward takes the
    greatest, forward the least. Both sides go into one frame, sorted once by key and time, and the right row is
    carried over the left ones, so the work is linear in the rows, whatever the key. Names that both sides have, other
    than the keys, must be renamed before.
    """
    backward = direction == "backward"
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    both = set(left.columns) & set(right.columns) - set(keys)
    if both:
        raise ValueError(f"both sides have {sorted(both)}")
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    values = [c for c in right.columns if c not in keys]
    # Backward, right rows of the left time come first unless strict; forward, last.
    right_first = backward != strict
    tie = F.struct(*(F.col(c) for c in ties)) if ties else F.lit(0)
    mine, theirs = F.struct(*left.columns), F.struct(*values)
    lone = left.select(*keys, as_column(left_at).alias("_at"), F.lit(1 if right_first else 0).alias("_side"), mine.alias("_left"))
    known = right.select(
        *keys, as_column(right_at).alias("_at"), F.lit(0 if right_first else 1).alias("_side"), tie.alias("_tie"), theirs.alias("_right")
    ).where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in [*keys, "_at"])))
    rows = lone.unionByName(known, allowMissingColumns=True)
    carry = last_known("_right") if backward else next_known("_right")
    rows = segmented_scan(rows, keys, ["_at", "_side", "_tie"], min_rows, _found=carry).where("_left IS NOT NULL")
    usable = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in [*keys, "_at"]))
    rows = rows.withColumn("_found", F.when(usable, F.col("_found")))
    rows = rows if how == "left" else rows.where("_found IS NOT NULL")
    return rows.select("_left.*", *(F.col(f"_found.{c}").alias(c) for c in values))


def between_events(
    events: DataFrame, notes: DataFrame, keys: list[str], at: str, note_at: str, ties: list[str] | None = None,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Notes strictly after an event and before the next one of the same keys, each with that event: an as-of join, in
    which a note at the very time of an event has none.
    """
    found = as_of_join(notes, events, keys, note_at, at, ties, how="inner", min_rows=min_rows)
    return found.where(F.col(at) < F.col(note_at)).select(*events.columns, *(c for c in notes.columns if c not in keys))


#: The first and last day of a calendar, as days since 1970-01-01 (0001-01-01 and 9999-12-31), and how many levels of
#: doubling cover it.
FIRST_DAY, LAST_DAY, LEVELS = -719_162, 2_932_896, 22


def _day(at: str) -> Column:
    day = F.datediff(F.to_date(F.col(at)), F.lit("1970-01-01").cast("date"))
    return (F.least(F.greatest(day, F.lit(FIRST_DAY)), F.lit(LAST_DAY)) - FIRST_DAY).cast("long")


def dyadic_cover(first: Column, last: Column) -> Column:
    """The fewest blocks (level, node) of 2^level days, each beginning at a multiple of its length, that make up the days
    from `first` to `last`: at most two a level, none where `last` is before `first`.

    On each level the whole blocks inside run from a to b; a block whose parent isn't inside is a (where odd) or b
    (where even).
    """
    def level(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        a, b = F.floor((first + size - 1) / size), F.floor((last + 1) / size) - 1
        node = lambda c: F.struct(k.alias("level"), c.alias("node"))
        left = F.when((a <= b) & (a % 2 == 1), node(a))
        right = F.when((a <= b) & (b % 2 == 0) & ((a < b) | (a % 2 == 0)), node(b))
        return F.array_compact(F.array(left, right))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), level))


def range_join(
    left: DataFrame, right: DataFrame, at: str, start: str, end: str, keys: list[str] | None = None
) -> DataFrame:
    """Pairs of rows with `at` in [start, end] and equal keys, if any are named. A null end is open; a null start, a null
    `at`, a null key or an end before the start match nothing.

    An interval of any length is cut into blocks of a power of two days (an open one into some twenty), a point goes once
    to each level that some interval uses, and both meet in an equal join by level, block and keys; the times themselves
    are compared last. So every pair that meets is a match, but for the hours of an interval's first and last day.
    """
    keys = keys or []
    sound = right.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
    last = F.when(F.col(end).isNull(), F.lit(LAST_DAY - FIRST_DAY).cast("long")).otherwise(_day(end))
    blocks = sound.withColumn("_block", F.explode(dyadic_cover(_day(start), last)))
    used = sorted(r[0] for r in blocks.select("_block.level").distinct().collect())  # at most LEVELS + 1 numbers
    if not used:
        used = [0]
    node = F.transform(
        F.array(*(F.lit(k) for k in used)),
        lambda k: F.struct(k.alias("level"), F.call_function("shiftright", F.col("_d"), k).alias("node")),
    )
    points = left.where(F.col(at).isNotNull()).withColumn("_d", _day(at)).withColumn("_block", F.explode(node)).drop("_d")
    points = points.select("*", F.col("_block.level").alias("_level"), F.col("_block.node").alias("_node")).drop("_block")
    blocks = blocks.select("*", F.col("_block.level").alias("_level"), F.col("_block.node").alias("_node")).drop("_block")
    met = points.join(blocks, [*keys, "_level", "_node"]).drop("_level", "_node")
    return met.where((F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) <= F.col(end))))


def range_totals(
    points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, keys: list[str], entity: str, greatest: str
) -> DataFrame:
    """Ranges that some point of equal keys falls into, with its points counted (`n`), their different entities counted
    (`entities`) and the greatest value of `greatest` (`top`); the times are dates. A null end is open; a null start, date or
    key or an end before the start matches nothing, and a null entity isn't counted among the entities.

    No point meets a range: points are added up by blocks of a power of two days, and a range takes the totals of its few
    blocks. An entity is counted on its first day in the range, which is a day with no earlier one from the start on; so a
    block's entities by their day before are summed up in order, and the range reads the sum before its start. The sums
    hold no more rows than keys by pairs of days, whatever the number of points.
    """
    dated = points.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in [*keys, at])))
    low, high = dated.agg(F.min(at), F.max(at)).first()
    first, size = F.lit(low).cast("date"), (high - low).days + 1 if low else 1
    levels = F.array(*(F.lit(k) for k in range(size.bit_length())))
    number = lambda c: F.datediff(c, first).cast("long")
    half = lambda c, k: F.call_function("shiftright", c, k)
    block = [*keys, "_level", "_node"]

    a = F.greatest(number(F.col(start)), F.lit(0).cast("long"))
    b = F.least(F.coalesce(number(F.col(end)), F.lit(size - 1).cast("long")), F.lit(size - 1).cast("long"))
    sound = ranges.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
    sound = sound.withColumns({"_a": a, "_b": b}).where("_a <= _b")
    blocks = sound.select(*keys, "_a", "_b").distinct().withColumn("_block", F.explode(dyadic_cover(F.col("_a"), F.col("_b"))))
    blocks = blocks.select(*keys, "_a", "_b", F.col("_block.level").alias("_level"), F.col("_block.node").alias("_node"))

    days = dated.groupBy(*keys, number(F.col(at)).alias("_d")).agg(F.count(F.lit(1)).alias("n"), F.max(greatest).alias("top"))
    nodes = days.withColumn("_level", F.explode(levels)).withColumn("_node", half(F.col("_d"), F.col("_level")))
    nodes = nodes.groupBy(*block).agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    seen = dated.where(F.col(entity).isNotNull()).select(*keys, entity, number(F.col(at)).alias("_d")).distinct()
    before = F.lag("_d", 1, -1).over(Window.partitionBy(*keys, entity).orderBy("_d"))
    steps = seen.withColumn("_p", before).groupBy(*keys, "_p", "_d").agg(F.count(F.lit(1)).alias("_c"))
    cells = steps.withColumn("_level", F.explode(levels)).withColumn("_node", half(F.col("_d"), F.col("_level")))
    cells = cells.where((F.col("_p") < 0) | (half(F.col("_p"), F.col("_level")) < F.col("_node")))  # else never before a start
    cells = cells.groupBy(*block, "_p").agg(F.sum("_c").alias("_c")).withColumn("_asks", F.lit(False))
    asked = blocks.select(*block, F.col("_a").alias("_p")).distinct().select("*", F.lit(0).cast("long").alias("_c"), F.lit(True).alias("_asks"))
    w = Window.partitionBy(*block).orderBy("_p", F.col("_asks").desc()).rowsBetween(Window.unboundedPreceding, 0)
    fresh = cells.unionByName(asked).withColumn("_new", F.sum("_c").over(w)).where("_asks").select(*block, F.col("_p").alias("_a"), "_new")

    told = blocks.join(nodes, block).join(fresh, [*block, "_a"], "left").groupBy(*keys, "_a", "_b").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum("_new"), F.lit(0)).alias("entities"), F.max("top").alias("top")
    )
    return sound.join(told, [*keys, "_a", "_b"]).drop("_a", "_b")
