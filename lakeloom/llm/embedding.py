"""Embedding near-dedup by collision counting over sorted one-dimensional projections."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written
from .graph import components

#: Cells of more vectors than CELL are compared by blocks of BLOCK vectors.
CELL, BLOCK = 64, 512
TABLE = "key long, at float, cid long"
COLLISIONS = "a long, b long, key long, at float, cid long"
BLOCKS = "block long, home long, core boolean, dims int, cids array<long>, copies array<long>, vectors binary"
#: Angles that add up to less than the threshold's by this much prove a link, whatever the rounding.
SURE = 1e-6
LINKS = "cid long, links long, a long, b long"


@functools.lru_cache(maxsize=16)
def projections(dims: int, tables: int, grids: int, seed: int):
    """Normal directions, `grids` and one more a table, and the grids' offsets in cells: for unit vectors x and y each
    coordinate of the difference is normal with deviation |x - y|.
    """
    import numpy as np

    rng = np.random.default_rng([seed, dims])
    return rng.standard_normal((dims, tables * (grids + 1))), rng.random((tables, grids))


def collision_chance(reach: float, cell: float, grids: int) -> float:
    """The chance that a pair at the threshold collides in one table: its values within the window of `reach`
    deviations, and in one cell of `cell` deviations in each grid.
    """
    same = math.erf(cell / math.sqrt(2)) - 2 / (cell * math.sqrt(2 * math.pi)) * (1 - math.exp(-cell * cell / 2))
    return math.erf(reach / math.sqrt(2)) * same**grids


def layout(largest: int, cosine: float, reach: float, recall: float) -> tuple[int, int, float]:
    """(tables, grids, cell) for labels of up to `largest` vectors.

    The grids are as many and as fine as let a vector collide with one random vector of its label in a table, however
    large the label; the tables are as many as then let a pair at the threshold collide twice with probability `recall`.
    So work grows with the vectors times the tables, which are some 40 for a thousand vectors in a label, 230 for a
    million, 740 for 10**8.
    """
    # a random pair's deviation in those of a pair at the threshold
    far = math.sqrt(2) / math.sqrt(max(2 - 2 * cosine, 1e-6))
    window = math.erf(reach / far / math.sqrt(2))
    grids = max(1, round(math.log(max(largest, 2), 3)) - 1)
    wanted, low, high = min(1 / (largest * window), 0.999), 0.01, 50.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if collision_chance(math.inf, middle / far, grids) < wanted else (low, middle)
    chance, tables = collision_chance(reach, low, grids), 2
    while calibrate(tables, chance, recall) < 2:
        tables += 1
    return tables, grids, low


def calibrate(tables: int, chance: float, recall: float) -> int:
    """The least count of collisions that a pair at the threshold attains with the wanted probability, from the binomial
    (tables, chance).
    """
    missed, count = 0.0, 0
    while (
        missed := missed + math.comb(tables, count) * chance**count * (1 - chance) ** (tables - count)
    ) <= 1 - recall:
        count += 1
    return count


def _vectors(packed: list[bytes], dims: list[int]):
    """Unit vectors of equal length, in double precision."""
    import numpy as np

    x = np.stack(
        [np.frombuffer(p, "<f4" if len(p) == 4 * d else "<f8") for p, d in zip(packed, dims, strict=True)]
    ).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _packed(batches: Iterator) -> Iterator:
    """The nodes with their vectors as bytes: of single precision where that holds them exactly."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        out = []
        for v in batch.column("embedding").to_pylist():
            v = np.array(v, "<f8")
            with np.errstate(over="ignore"):
                short = v.astype("<f4")
            out.append((short if (short == v).all() else v).tobytes())
        columns = [*(batch.column(c) for c in ("cid", "owner", "dims", "copies")), pa.array(out, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["cid", "owner", "dims", "copies", "vector"])


def _cells(x, owner, width: float, cell: float, tables: int, grids: int, seed: int):
    """(keys, values): each vector's cell in each table, as a hash of label, table and grid values; and its value on the
    table's sorted projection.
    """
    import numpy as np

    directions, offsets = projections(x.shape[1], tables, grids, seed)
    p = (x @ directions).reshape(len(x), tables, grids + 1)
    grid = np.floor(p[:, :, 1:] / (cell * width) + offsets).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        key = owner.view(np.uint64)[:, None] + np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for g in range(grids):
            key = (key ^ (grid[:, :, g] + (key >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ (key >> np.uint64(32))).view(np.int64), p[:, :, 0].astype(np.float32)


def _of_one_length(batch, *columns: str) -> Iterator:
    """Rows of a batch by length of their vectors."""
    import numpy as np

    dims = batch.column("dims").to_numpy()
    for d in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == d)
        part = batch.take(rows)
        for k in range(0, part.num_rows, 1000):
            yield part.slice(k, 1000)


def _tables(width: float, cell: float, tables: int, grids: int, seed: int):
    def project(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in _of_one_length(batch):
                x = _vectors(part.column("vector").to_pylist(), part.column("dims").to_pylist())
                keys, at = _cells(x, part.column("owner").to_numpy(), width, cell, tables, grids, seed)
                cid = np.repeat(part.column("cid").to_numpy(), tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(at.ravel()), pa.array(cid)], ["key", "at", "cid"]
                )

    return project


def _windows(width: float, reach: float):
    """Of a partition sorted by cell and value: a pair for each two vectors of a cell within the window around one of
    them; large cells, and those that go on in another partition, as they are.
    """

    def collide(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [x.split()[0] for x in COLLISIONS.split(", ")]

        def work(key, at, cid, first_open: bool, last_open: bool) -> Iterator:
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[starts, len(key)])
            rest = size > CELL
            rest[0] |= first_open
            rest[-1] |= last_open
            ends = np.repeat(starts + np.where(rest, 0, size), size)
            pairs, active, d = [], np.arange(len(key)), 1
            while len(active := active[active + d < ends[active]]):
                # sorted: whoever is past the window stays past it
                active = active[at[active + d] - at[active] <= reach * width * 1.0001]
                pairs.append((cid[active], cid[active + d]))
                d += 1
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
                none = [pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.float32()), pa.nulls(len(a), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *none], names)
            kept = np.repeat(rest, size)
            if kept.any():
                none = [pa.nulls(int(kept.sum()), pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [*none, pa.array(key[kept]), pa.array(at[kept]), pa.array(cid[kept])], names
                )

        held, first = None, True
        for batch in batches:
            new = tuple(batch.column(c).to_numpy() for c in ("key", "at", "cid"))
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            at = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if at == 0 and len(held[0]) > 100 * CELL:  # one cell, and more of it to come
                yield from work(*held, True, True)
                held, first = None, True
            elif at:
                yield from work(*(x[:at] for x in held), first, False)
                held, first = tuple(x[at:] for x in held), False
        if held is not None and len(held[0]):
            yield from work(*held, first, True)

    return collide


def _cored(cosine: float):
    """Whether each member of a home lies within half the threshold's angle of the home's pivot, and its angle: any two
    that do are linked.
    """

    def mark(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        half = (math.acos(cosine) - SURE) / 2
        for batch in batches:
            for part in _of_one_length(batch):
                dims = part.column("dims").to_pylist()
                x, p = (_vectors(part.column(c).to_pylist(), dims) for c in ("vector", "pivot"))
                angle = np.arccos(np.clip(np.einsum("ij,ij->i", x, p), -1, 1))
                kept = part.select(["home", "cid", "dims", "copies", "vector"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(angle <= half), pa.array(angle)], [*kept.schema.names, "core", "angle"]
                )

    return mark


def _class_pairs(cosine: float):
    """Of the cores of two homes: whether their pivots and radii prove that all vectors of one are linked with all of the
    other (1), that none is (-1), or neither (0).
    """

    def judge(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        limit = math.acos(cosine)
        for batch in batches:
            for part in _of_one_length(batch):
                dims = part.column("dims").to_pylist()
                x, y = (_vectors(part.column(c).to_pylist(), dims) for c in ("pivot", "pivot_b"))
                angle = np.arccos(np.clip(np.einsum("ij,ij->i", x, y), -1, 1))
                reach = part.column("radius").to_numpy() + part.column("radius_b").to_numpy()
                said = np.where(angle + reach < limit - SURE, 1, np.where(angle - reach > limit + SURE, -1, 0))
                columns = ["g", "h", "head", "head_b", "total", "total_b"]
                yield pa.RecordBatch.from_arrays(
                    [*part.select(columns).columns, pa.array(said.astype(np.int32))], [*columns, "said"]
                )

    return judge


def _blocks(batches: Iterator) -> Iterator:
    """Blocks of up to BLOCK vectors of one home, those of its core apart from the rest."""
    import pyarrow as pa
    from pyspark import TaskContext

    base, made = TaskContext.get().partitionId() << 32, 0

    def block(of: tuple, rows: list[tuple]):
        nonlocal made
        made += 1
        values = [
            base + made, of[0], of[1], rows[0][3], [r[0] for r in rows], [r[1] for r in rows],
            _vectors([r[2] for r in rows], [r[3] for r in rows]).tobytes()
        ]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in BLOCKS.split(", ")]
        )

    last, rows = None, []
    for batch in batches:
        for home, core, *row in zip(
            *(batch.column(c).to_pylist() for c in ("home", "core", "cid", "copies", "vector", "dims")), strict=True
        ):
            if rows and (last != (home, core) or len(rows) == BLOCK):
                yield block(last, rows)
                rows = []
            last = home, core
            rows.append(row)
    if rows:
        yield block(last, rows)


def _forest(linked):
    """Edges (row, column) that connect what a boolean matrix connects, fewer than rows plus columns."""
    import numpy as np

    left, edges = linked.any(axis=1), []
    while left.any():
        rows = np.array([np.argmax(left)])
        seen = np.zeros(linked.shape[1], bool)
        left[rows] = False
        while len(rows):
            new_columns = []
            for r in rows.tolist():
                own = linked[r] & ~seen
                seen |= own
                new_columns.append(np.flatnonzero(own))
                edges += [(r, c) for c in new_columns[-1].tolist()]
            columns = np.concatenate(new_columns)
            more = linked[:, columns] & left[:, None]
            rows = np.flatnonzero(more.any(axis=1))
            edges += [(r, int(columns[np.argmax(more[r])])) for r in rows.tolist()]
            left[rows] = False
    return edges


def _compare(cosine: float):
    """Of each two blocks: the links of their vectors, as numbers by vector and a forest. What a step holds is bounded by
    two blocks.
    """

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                x, y = (np.frombuffer(row[c]).reshape(-1, row["dims"]) for c in ("vectors", "vectors_b"))
                near = x @ y.T >= cosine
                if row["block"] == row["block_b"]:
                    near = np.triu(near, 1)
                if near.any():
                    out = []
                    for cids, links in (
                        (row["cids"], near @ np.array(row["copies_b"], np.int64)),
                        (row["cids_b"], near.T @ np.array(row["copies"], np.int64))
                    ):
                        out += [(cids[k], int(links[k]), None, None) for k in np.flatnonzero(links).tolist()]
                    out += [(None, None, row["cids"][r], row["cids_b"][c]) for r, c in _forest(near)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["cid", "links", "a", "b"]
                    )

    return compare


def _links(cid=None, links=None, a=None, b=None):
    """The columns of LINKS."""
    null = F.lit(None).cast("long")
    return [(null if c is None else c).cast("long").alias(n) for n, c in (("cid", cid), ("links", links), ("a", a), ("b", b))]


def _crowds(large: DataFrame, packed: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the large cells (key, cid) hold: links as LINKS; each vector's home (cid, home); and the pairs of homes (g, h;
    g <= h) whose vectors have been compared.

    A vector's home is the least of its large cells, so the members of a group of near copies have few homes, however
    many tables they meet in. Two homes that any large cell holds together are a pair; each pair of vectors has one pair
    of homes and is compared once. Of each home, what lies within half the threshold's angle of a pivot is its core: all
    linked, by the triangle inequality, so it is counted without a comparison, as are cores of two homes whose pivots and
    radii prove it. The rest is compared by blocks.
    """
    # A vector lies in no more cells than there are tables.
    placed = written(large.withColumn("home", F.min("key").over(Window.partitionBy("cid"))), "placed")
    homes = placed.where("key = home").select("cid", "home")
    met = placed.groupBy("key").agg(F.array_sort(F.collect_set("home")).alias("all"))
    pairs = met.select(F.explode("all").alias("g"), "all").select("g", F.explode(F.filter("all", lambda h: h >= F.col("g"))).alias("h"))
    pairs = written(pairs.distinct(), "home-pairs")
    members = written(packed.join(homes, "cid").select("home", "cid", "dims", "copies", "vector"), "members")
    pivots = members.groupBy("home").agg(F.min_by("vector", "cid").alias("pivot"))
    marked = members.join(pivots, "home").mapInArrow(
        _cored(cosine), "home long, cid long, dims int, copies long, vector binary, core boolean, angle double"
    )
    marked = written(marked, "marked")
    cores = written(
        marked.where("core").groupBy("home").agg(
            F.sum("copies").alias("total"), F.max("angle").alias("radius"), F.min("cid").alias("head"),
            F.first("dims").alias("dims"), F.min_by("vector", "cid").alias("pivot")  # the least is the pivot itself
        ), "cores"
    )
    as_b = cores.select(F.col("home").alias("h"), *(F.col(c).alias(f"{c}_b") for c in ("total", "radius", "head", "pivot")))
    judged = (
        pairs.where("g < h").join(cores.withColumnRenamed("home", "g"), "g").join(as_b, "h").mapInArrow(
            _class_pairs(cosine), "g long, h long, head long, head_b long, total long, total_b long, said int"
        )
    )
    judged = written(judged, "judged")
    whole = judged.where("said = 1")
    more = whole.select(F.col("g").alias("home"), F.col("total_b").alias("more")).unionByName(
        whole.select(F.col("h").alias("home"), F.col("total").alias("more"))
    ).groupBy("home").agg(F.sum("more").alias("more"))
    core = marked.where("core").select("home", "cid", "copies").join(cores.select("home", "total", "head"), "home").join(
        more, "home", "left"
    )
    counted = core.select(*_links(F.col("cid"), F.col("total") - F.col("copies") + F.coalesce("more", F.lit(0))))
    stars = core.where("cid <> head").select(*_links(a=F.col("head"), b=F.col("cid")))
    bridges = whole.select(*_links(a=F.col("head"), b=F.col("head_b")))

    blocks = written(
        marked.select("home", "core", "cid", "copies", "vector", "dims")
        .repartitionByRange("home", "core", "cid").sortWithinPartitions("home", "core", "cid")
        .mapInArrow(_blocks, BLOCKS), "blocks"
    )
    kinds = lambda *rows: F.array(*(F.struct(F.lit(x).alias("core"), F.lit(y).alias("core_b")) for x, y in rows))
    own = pairs.where("g = h").select("g", "h", F.explode(kinds((False, False), (False, True))).alias("k"))
    cross = pairs.where("g < h").select("g", "h", F.explode(kinds((False, False), (False, True), (True, False))).alias("k"))
    open_cores = judged.where("said = 0").select("g", "h", kinds((True, True))[0].alias("k"))
    wanted = own.unionByName(cross).unionByName(open_cores).select("g", "h", "k.core", "k.core_b")
    other = blocks.select(*(F.col(c).alias(f"{c}_b") for c in ("block", "home", "core", "cids", "copies", "vectors")))
    # Block numbers meet first; the blocks themselves are joined to the pairs that are left.
    name = blocks.select("block", F.col("home").alias("g"), "core")
    name_b = blocks.select(F.col("block").alias("block_b"), F.col("home").alias("h"), F.col("core").alias("core_b"))
    both = wanted.join(name, ["g", "core"]).join(name_b, ["h", "core_b"])
    both = both.where("g < h OR core_b OR block <= block_b").select("block", "block_b")
    compared = (
        both.join(blocks.drop("home", "core"), "block").join(other.drop("home_b", "core_b"), "block_b")
        .repartition("block", "block_b")
        .mapInArrow(_compare(cosine), LINKS)
    )
    return counted.unionByName(stars).unionByName(bridges).unionByName(compared), homes, pairs


def _verify(cosine: float):
    """The pairs that reach the threshold, by cosine in double precision."""

    def verify(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for part in _of_one_length(batch):
                x, y = (
                    _vectors(
                        part.column(c).to_pylist(), part.column("dims").to_pylist()
                    ) for c in ("vector", "vector_b")
                )
                linked = np.flatnonzero(np.einsum("ij,ij->i", x, y) >= cosine)
                yield part.select(["a", "b", "copies", "copies_b"]).take(linked)

    return verify


def embedding_groups(
    vectors: DataFrame, cosine: float = 0.93, reach: float = 2.5, recall: float = 0.999, seed: int = 7
) -> DataFrame:
    """Vectors of equal label linked at `cosine` or more: vec_id, n_links, component_id, kept for every row.

    Equal vectors are one node with a number of copies, found by grouping. For each of several tables the nodes are
    sorted by one projection inside the cells of a few further ones, over all partitions; two nodes of a cell collide
    where one lies in the window of `reach` deviations around the other. Collisions are counted by pair, and pairs that
    reach the count that a pair at the threshold attains with probability `recall` are verified in double precision; a
    pair at a smaller angle collides more often. layout() fits the tables and cells to the size of the largest label, so
    that the work grows little faster than the number of vectors.

    A cell of more than CELL nodes gives no pairs: _crowds() counts its links exactly, each pair of vectors once however
    many cells it shares, and what lies close around a pivot without comparing pairs.

    Null, zero or non-finite vectors, and null labels, link with nothing and stay in their own component. Vectors of
    different length don't link. A null vec_id gets its group's component_id and isn't kept. Repeated rows count as
    vectors; extra columns are left out; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    width = math.sqrt(max(2 - 2 * cosine, 1e-6))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding")
    )
    big = F.lit(float("inf"))
    sound = F.forall(
        "embedding", lambda v: F.coalesce((v > -big) & (v < big), F.lit(False))
    ) & F.exists("embedding", lambda v: v != 0)
    sound = F.coalesce(sound & F.col("label").isNotNull(), F.lit(False))
    nodes = (
        rows
        .where(sound)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    )
    nodes = written(nodes.withColumn("cid", F.monotonically_increasing_id()), "vectors")

    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    tables, grids, cell = layout(largest, cosine, reach, recall)
    count = calibrate(tables, collision_chance(reach, cell, grids), recall)
    owner = F.xxhash64("label", F.size("embedding")).alias("owner")
    packed = nodes.select(
        "cid", owner, F.size("embedding").alias("dims"), "copies", "embedding"
    ).mapInArrow(_packed, "cid long, owner long, dims int, copies long, vector binary")
    sorted_rows = (
        packed
        .mapInArrow(_tables(width, cell, tables, grids, seed), TABLE)
        .repartitionByRange("key", "at")
        .sortWithinPartitions("key", "at")
    )
    collisions = written(sorted_rows.mapInArrow(_windows(width, reach), COLLISIONS), "collisions")

    packed = written(packed, "packed")
    dense, homes, compared = _crowds(collisions.where("key IS NOT NULL").select("key", "cid"), packed, cosine)
    pairs = (
        collisions
        .where("a IS NOT NULL")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= count)
        .select("a", "b")
    )
    own = packed.join(homes, "cid", "left").select("cid", "owner", "dims", "copies", "vector", "home")
    full = pairs.join(own.withColumnRenamed("cid", "a"), "a").join(
        own.select(*(F.col(c).alias("b" if c == "cid" else f"{c}_b") for c in own.columns)), "b"
    )
    full = full.where((F.col("owner") == F.col("owner_b")) & (F.col("dims") == F.col("dims_b"))).withColumns(
        {"g": F.least("home", "home_b"), "h": F.greatest("home", "home_b")}
    )
    one_home = full.where("home IS NULL OR home_b IS NULL")
    full = one_home.unionByName(full.where("home IS NOT NULL AND home_b IS NOT NULL").join(compared, ["g", "h"], "left_anti").select(*full.columns))
    close = full.select("a", "b", "dims", "copies", "copies_b", "vector", "vector_b").mapInArrow(
        _verify(cosine), "a long, b long, copies long, copies_b long"
    )
    single = close.select(F.explode(F.array(
        F.struct(
            F.col("a").alias("cid"), F.col("copies_b").alias("links"), F.lit(None).cast("long").alias("a"),
            F.lit(None).cast("long").alias("b")
        ),
        F.struct(F.col("b").alias("cid"), F.col("copies").alias("links"), F.col("a"), F.col("b")),
    )).alias("x")).select("x.*")
    found = written(dense.unionByName(single), "found")

    links = found.where("cid IS NOT NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.where("a IS NOT NULL").select("a", "b"), "a", "b")
    told = nodes.join(roots, nodes.cid == roots.node, "left").join(links, "cid", "left")
    told = told.select(
        "label", "embedding", "least", F.coalesce("root", "cid").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    told = written(told, "told")
    component = told.groupBy("root").agg(F.min("least").alias("component_id"))
    told = told.join(component, "root").select("label", "embedding", "n_links", "component_id")
    linked = rows.where(sound).join(told, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
