"""Substring dedup: Rabin-Karp hashes of all fixed-length word windows, repeated ones merged into removal intervals."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import has_columns, ship, text_hash, written

#: Odd, so that a product with one loses no bit modulo 2**64; the second round has two hashes of its own.
BASE, BASES = 0x9E3779B97F4A7C15, (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
BLOCK_WORDS, CACHE_WORDS, BUCKET_BYTES = 500_000, 100_000, 64 << 20
PARTS = "bucket int, block long, kind int, a binary, b binary, c binary"
_hashes: dict[bytes, int] = {}
_wide: dict[bytes, bytes] = {}


def word_hashes(words: list[bytes]):
    """XXH64 of each word; a worker remembers up to CACHE_WORDS of them."""
    import numpy as np
    import xxhash

    known, digest = _hashes, xxhash.xxh64_intdigest
    if len(known) > CACHE_WORDS:
        known.clear()
    for w in {w for w in words if w not in known}:
        known[w] = digest(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def wide_hashes(words: list[bytes]):
    """The 128-bit XXH3 of each word, as two columns; a worker remembers up to CACHE_WORDS of them."""
    import numpy as np
    import xxhash

    known, digest = _wide, xxhash.xxh3_128_digest
    if len(known) > CACHE_WORDS:
        known.clear()
    for w in {w for w in words if w not in known}:
        known[w] = digest(w)
    return np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint64).reshape(-1, 2)


def window_hashes(h, n: int, base: int = BASE):
    """The polynomial hash, modulo 2**64, of every n consecutive values, by doubling: window 2k is two windows of k."""
    import numpy as np

    made, have, power, out = h, 1, np.uint64(base), None
    used = 0
    rest, made_power = n, power
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if out is None:
                    out = made
                else:  # windows of `used` values, each followed by one of `have`
                    keep = max(len(h) - used - have + 1, 0)
                    out = out[:keep] * made_power + made[used : used + keep]
                used += have
            rest >>= 1
            if rest:
                keep = max(len(h) - 2 * have + 1, 0)
                made = made[:keep] * made_power + made[have : have + keep]
                made_power = made_power * made_power
                have *= 2
    return out


def round_one(words: list[bytes], n: int):
    """What finds windows that may repeat: one hash, of which the bucket and 32 bits travel."""
    return (window_hashes(word_hashes(words), n),)


def round_two(words: list[bytes], n: int):
    """What tells windows apart for good: 128 bits of two hashes, over other hashes of the words, of which 96 travel."""
    import numpy as np

    h = wide_hashes(words)
    return tuple(window_hashes(np.ascontiguousarray(h[:, k]), n, BASES[k]) for k in (0, 1))


class Block:
    """Documents of one task, in order of (doc_id, reading order), with all their words in one row."""

    def __init__(self, docs: list[tuple]):
        import numpy as np

        docs.sort(key=lambda d: (d[0] is not None, d[0] or 0, d[4]))
        self.doc_ids = np.array([-(1 << 63) if d[0] is None else d[0] for d in docs], np.int64)
        self.text_hashes = np.array([d[1] for d in docs], np.int64)
        self.rows = np.array([d[4] for d in docs], np.int64)
        self.counts = np.array([len(d[2]) for d in docs], np.int64)
        self.firsts = np.r_[0, np.cumsum(self.counts)]
        self.words = [w for d in docs for w in d[2]]
        self.spans = [d[3] for d in docs]

    def windows(self, n: int, hashes):
        """(positions, hashes) of every window that lies within one document, or within its spans where it has some."""
        import numpy as np

        if len(self.words) < n:
            return np.zeros(0, np.int64), (np.zeros(0, np.uint64),) * len(hashes([], n))
        made = hashes(self.words, n)
        ends = np.repeat(self.firsts[1:], self.counts)[: len(made[0])]
        inside = np.arange(len(made[0])) + n <= ends
        if any(s is not None for s in self.spans):
            change = np.zeros(len(self.words) + 1, np.int64)
            for first, spans in zip(self.firsts.tolist(), self.spans, strict=False):
                for x, y in spans or ():
                    change[first + x] += 1
                    change[first + y] -= 1
            inside &= np.cumsum(change)[: len(inside)] > 0
        at = np.flatnonzero(inside)
        return at, tuple(h[at] for h in made)


def bucket_names(spark: SparkSession, n: int) -> list[int]:
    """n numbers that Spark's hash deals to n different partitions, so that equal buckets make equal tasks."""
    numbers = spark.range(40 * n).select(F.col("id").cast("int").alias("id"))
    # n rows at most
    own = numbers.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("id")).collect()
    names = sorted(r.id for r in own)
    return names + [i for i in range(-1, -1 - n + len(names), -1)]


def _packed(ids, counts) -> bytes:
    """Documents of a block in few bytes: gaps of ascending ids, and numbers of words."""
    import numpy as np

    gaps = np.diff(ids, prepend=ids[:1])
    narrow = len(ids) > 0 and 0 <= gaps.min() and gaps.max() < 1 << 32
    return struct.pack(
        "<q?I", int(ids[0]) if len(ids) else 0, narrow, len(ids)
    ) + (gaps.astype("<u4") if narrow else ids.astype("<i8")).tobytes() + counts.astype("<u4").tobytes()


def _unpacked(data: bytes):
    """(ids, first positions) from _packed()."""
    import numpy as np

    first, narrow, n = struct.unpack_from("<q?I", data)
    at = struct.calcsize("<q?I")
    end = at + n * (4 if narrow else 8)
    ids = first + np.cumsum(
        np.frombuffer(data[at:end], "<u4").astype(np.int64)
    ) if narrow else np.frombuffer(data[at:end], "<i8")
    return ids, np.r_[0, np.cumsum(np.frombuffer(data[end:], "<u4").astype(np.int64))]


def _owners(block: Block, at) -> bytes:
    """The documents in which the ascending positions lie: ids, first positions and, where an id stands on several rows,
    places in reading order. No more than there are positions, so a bucket's rows don't grow with the blocks' documents.
    """
    import numpy as np

    own = np.unique(np.searchsorted(block.firsts, at, side="right") - 1)
    ids, rows, firsts = block.doc_ids[own], block.rows[own], block.firsts[own]
    gaps = np.diff(ids, prepend=ids[:1])
    narrow, tied = bool(gaps.min() >= 0 and gaps.max() < 1 << 32), bool(rows.any())
    head = struct.pack("<qI??", int(ids[0]), len(own), narrow, tied)
    told = gaps.astype("<u4") if narrow else ids.astype("<i8")
    return head + told.tobytes() + firsts.astype("<u4").tobytes() + (rows.astype("<i8").tobytes() if tied else b"")


def _owned(data: bytes):
    """(ids, rows, first positions) from _owners()."""
    import numpy as np

    first, n, narrow, tied = struct.unpack_from("<qI??", data)
    at = struct.calcsize("<qI??")
    end = at + n * (4 if narrow else 8)
    ids = first + np.cumsum(np.frombuffer(data[at:end], "<u4").astype(np.int64)) if narrow else np.frombuffer(data[at:end], "<i8")
    firsts = np.frombuffer(data, "<u4", n, end).astype(np.int64)
    return ids, np.frombuffer(data, "<i8", n, end + 4 * n) if tied else np.zeros(n, np.int64), firsts


def _gaps(at) -> bytes:
    """Ascending positions as gaps of one or two bytes; a byte or pair of all ones adds its value without a position."""
    import numpy as np

    gaps = np.diff(at, prepend=0)
    kind, most = ("<u1", 255) if len(at) and at[-1] < 150 * len(at) else ("<u2", 65535)
    more = gaps // most
    out = np.full(int(more.sum()) + len(gaps), most, kind)
    out[np.cumsum(more + 1) - 1] = gaps % most
    return kind[-1].encode() + out.tobytes()


def _places(data: bytes):
    """The positions from _gaps()."""
    import numpy as np

    steps = np.frombuffer(data[1:], "<u" + data[:1].decode())
    return np.cumsum(steps, dtype=np.int64)[steps != (255 if data[:1] == b"1" else 65535)]


def _scan(n: int, names: list[int], exact: bool, bits: int = 64):
    """Of each block: one window of each hash, dealt to buckets by hash; the positions of windows that repeat within the
    block; its documents.

    In the first round all windows that repeat in the block count as repeated; in the exact one only those after the
    first.
    """

    buckets = len(names)

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0

        def parts(docs: list[tuple]) -> Iterator:
            nonlocal made
            block, name = Block(docs), base + made
            made += 1
            at, hashes = block.windows(n, round_two if exact else round_one)
            hashes = hashes if bits == 64 else tuple(h >> np.uint64(64 - bits) << np.uint64(64 - bits) for h in hashes)
            order = np.lexsort(hashes[::-1]) if exact else np.argsort(hashes[0], kind="stable")
            sorted_hashes = [h[order] for h in hashes]
            first = np.ones(len(at), bool)
            first[1:] = np.any([h[1:] != h[:-1] for h in sorted_hashes], axis=0)
            again = ~first if exact else ~first | np.r_[~first[1:], False][: len(first)]
            again, at = np.sort(at[order[again]]), at[order[first]]
            hashes = [h[first] for h in sorted_hashes]
            # The upper 32 bits choose the bucket, the lower ones travel, and in the exact round the whole second hash.
            bucket = ((hashes[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((at, bucket))
            at, bucket = at[order], bucket[order]
            short = hashes[0][order].astype("<u4")
            whole = hashes[1][order].astype("<u8") if exact else None
            cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)] if len(bucket) else [0]
            docs_of_block = _packed(block.doc_ids, block.counts)
            rows = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                own = slice(i, j)
                told = short[own].tobytes() + (whole[own].tobytes() if exact else b"")
                rows.append((names[bucket[i]], name, 0, told, _gaps(at[own]), _owners(block, at[own]) if exact else None))
            rows.append((names[name % buckets], name, 1, _gaps(again), None, None))
            rows.append(
                (names[name % buckets], name, 2, docs_of_block, block.text_hashes.astype("<i8").tobytes(), None)
            )
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                [x.split()[0] for x in PARTS.split(", ")]
            )

        docs, size = [], 0
        for batch in batches:
            spans = batch.column("spans").to_pylist() if exact else [None] * batch.num_rows
            places = batch.column("row").to_pylist() if exact else [0] * batch.num_rows
            for d, t, text, own, row in zip(
                batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), batch.column("text"), spans, places,
                strict=True
            ):
                own = [(s["start"], s["end"]) for s in own] if exact else None
                docs.append((d, t, text.as_buffer().to_pybytes().split() if text.is_valid else [], own, row))
                size += len(docs[-1][2])
                if size >= BLOCK_WORDS:
                    yield from parts(docs)
                    docs, size = [], 0
        if docs:
            yield from parts(docs)

    return scan


FOUND = "block long, kind int, a binary, b binary"


def _found(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.table(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")]
    )


def _parts(group):
    """The windows' rows of a bucket, and what passes through it."""
    group = group.to_pydict()
    windows, rows = [], []
    for block, kind, a, b, c in zip(*(group[x] for x in ("block", "kind", "a", "b", "c")), strict=True):
        if kind:
            rows.append((block, kind, a, b))
        else:
            windows.append((block, a, b, c))
    return windows, rows


def _repeated(h):
    """Which hashes occur more than once."""
    import numpy as np

    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(h), bool)
    return twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h


def _candidates(group):
    """Of one bucket, by block: the positions of windows whose hash several blocks hold."""
    import numpy as np

    windows, rows = _parts(group)
    if windows:
        counts = np.cumsum([0, *(len(a) // 4 for _, a, _, _ in windows)])
        again = _repeated(np.frombuffer(b"".join(a for _, a, _, _ in windows), "<u4"))
        for k, (block, _, b, _) in enumerate(windows):
            own = again[counts[k] : counts[k + 1]]
            if own.any():
                rows.append((block, 1, _gaps(_places(b)[own]), None))
    return _found(rows)


def _later(group):
    """Of one bucket, by block: of each window of several blocks, all positions but the one that starts first."""
    import numpy as np

    windows, rows = _parts(group)
    if windows:
        counts = [len(a) // 12 for _, a, _, _ in windows]
        short = np.concatenate([np.frombuffer(a, "<u4", n) for n, (_, a, _, _) in zip(counts, windows, strict=True)])
        whole = np.concatenate(
            [np.frombuffer(a, "<u8", n, 4 * n) for n, (_, a, _, _) in zip(counts, windows, strict=True)]
        )
        found = np.flatnonzero(_repeated(whole))
        sizes = np.cumsum([0, *counts])
        which = np.searchsorted(sizes, found, side="right") - 1
        doc, row, at = (np.zeros(len(found), np.int64) for _ in range(3))
        for k, (_, _, b, c) in enumerate(windows):
            own = np.flatnonzero(which == k)
            if len(own):
                at[own] = _places(b)[found[own] - sizes[k]]
                ids, places, firsts = _owned(c)
                owner = np.searchsorted(firsts, at[own], side="right") - 1
                doc[own], row[own] = ids[owner], places[owner]
        # a null doc_id stands before all others; rows of one id follow in reading order
        order = np.lexsort((at, row, doc, short[found], whole[found]))
        x, y = short[found][order], whole[found][order]
        gone = order[1:][(x[1:] == x[:-1]) & (y[1:] == y[:-1])]
        for k in np.unique(which[gone]).tolist():
            rows.append((windows[k][0], 1, _gaps(np.sort(at[gone[which[gone] == k]])), None))
    return _found(rows)


def _intervals(n: int):
    """Of one block: the maximal intervals of words that lie in the windows told, by document."""

    def merge(group):
        import numpy as np
        import pyarrow as pa

        group = group.to_pydict()
        at, rows = [], []
        for kind, a, b in zip(*(group[x] for x in ("kind", "a", "b")), strict=True):
            if kind == 1:
                at.append(_places(a))
            else:
                (ids, firsts), hashes = _unpacked(a), np.frombuffer(b, "<i8")
        at = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
        if len(at):
            doc = np.searchsorted(firsts, at, side="right") - 1
            new = np.r_[True, (at[1:] > at[:-1] + n) | (doc[1:] != doc[:-1])]
            starts, ends, owner = at[new], at[np.r_[new[1:], True]] + n, doc[new]
            docs, cuts = np.unique(owner, return_index=True)
            for d, i, j in zip(docs.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(owner)], strict=True):
                rows.append(
                    (
                        None if ids[d] == -(1 << 63) else int(ids[d]), int(hashes[d]), starts[i:j] - firsts[d],
                        ends[i:j] - firsts[d]
                    )
                )
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.table(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            ["doc_id", "text_hash", "starts", "ends"]
        )

    return merge


def _by_document(found: DataFrame, n: int) -> DataFrame:
    return found.groupBy("block").applyInArrow(
        _intervals(n), "doc_id long, text_hash long, starts array<long>, ends array<long>"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of id and text, and numbers in reading order."""
    docs = has_columns(docs, doc_id="long", text="string").withColumn("text_hash", text_hash(F.col("text")))
    return docs.withColumns(
        {"doc_key": F.coalesce("doc_id", F.lit(-(1 << 63))), "row": F.monotonically_increasing_id()}
    )


def removal_intervals(docs: DataFrame, n: int = 20, buckets: int | None = None, hash_bits: int = 64) -> DataFrame:
    """(doc_id, text_hash, starts, ends): the maximal word intervals that hold only windows seen earlier, for documents
    that have any.

    First round: blocks of about half a million words deal one window of each hash to buckets, with 32 bits of it, and
    each bucket tells the blocks which of their windows may stand elsewhere too. Second round: only those windows, with
    96 bits of two other hashes, go to buckets, which keep the one that starts first by (doc_id, reading order, position). A passage
    that a third of all documents share sends one row a block, not one a document. Positions, not texts, return to the
    blocks. There is a bucket for each 64 MB of text, and at least one a shuffle partition, so that a bucket stays as
    large as it is when the table grows. `hash_bits` narrows the first round's hash, which costs time and changes no
    result.
    """
    spark = docs.sparkSession
    ship(spark)
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    # Many buckets spread over the tasks by themselves.
    names = bucket_names(spark, buckets) if buckets <= 1 << 16 else range(buckets)
    keyed = _keyed(docs)
    parts = keyed.select("doc_id", "text", "text_hash").mapInArrow(_scan(n, names, False, hash_bits), PARTS)
    maybe = _by_document(parts.groupBy("bucket").applyInArrow(_candidates, FOUND), n)
    span = F.transform(
        F.arrays_zip("starts", "ends"), lambda s: F.struct(s["starts"].alias("start"), (s["ends"] - n + 1).alias("end"))
    ).alias("spans")
    # Rows equal in id and text have the same windows, so any one's spans do for all.
    maybe = (
        maybe
        .select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_key"), "text_hash", span)
        .groupBy("doc_key", "text_hash")
        .agg(F.max("spans").alias("spans"), F.count(F.lit(1)).alias("rows"))
    )
    # Only ids of several rows need the rows' places to be told apart.
    maybe = written(maybe, "maybe")
    several = maybe.groupBy("doc_key").agg(F.sum("rows").alias("rows")).where("rows > 1").select("doc_key", F.lit(True).alias("tied"))
    maybe = maybe.drop("rows").join(several, "doc_key", "left")
    # columns as in substring_dedup, so that texts are shuffled once
    place = F.when(F.col("tied"), F.col("row") + 1).otherwise(0).alias("row")
    again = keyed.join(maybe, ["doc_key", "text_hash"]).select("doc_id", "text", "text_hash", "spans", place)
    parts = again.mapInArrow(_scan(n, names, True), PARTS)
    return _by_document(parts.groupBy("bucket").applyInArrow(_later, FOUND), n)


def _remove(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for k in range(0, batch.num_rows, 1000):
            part = batch.slice(k, 1000)
            kept, counts, gone = [], [], []
            for text, starts, ends in zip(
                part.column("text"), part.column("starts").to_pylist(), part.column("ends").to_pylist(), strict=True
            ):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                counts.append(len(words))
                left, at = [], 0
                for a, b in zip(starts or (), ends or (), strict=True):
                    left += words[at:a]
                    at = b
                left += words[at:]
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            sums = [hashlib.sha256(x).hexdigest() for x in kept]
            columns = [
                part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(kept, pa.binary()), pa.array(sums)
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def substring_dedup(docs: DataFrame, n: int = 20, buckets: int | None = None, hash_bits: int = 64) -> DataFrame:
    """Removes each word in a window of `n` words whose words also start earlier: in a smaller doc_id or earlier in the
    same one.

    Returns doc_id, n_words, n_removed, kept (the words left, joined by a space), kept_sha256, for every row. Null or
    empty texts have no words. A null doc_id counts as smaller than any other, and rows that share a doc_id count in
    reading order: of rows equal in id and text, the first keeps what the others lose. Extra columns are left out, an
    empty table gives no rows, and texts of any length are searched whole.
    """
    ship(docs.sparkSession)
    keyed = _keyed(docs)
    cuts = removal_intervals(docs, n, buckets, hash_bits).withColumn("doc_key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    size = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    cuts = cuts.groupBy("doc_key", "text_hash").agg(
        F.count(F.lit(1)).alias("cut_rows"), F.min_by(F.struct("starts", "ends"), size).alias("least")
    )
    copies = (
        keyed
        .groupBy("doc_key", "text_hash")
        .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    # Rows equal in id and text: all but the first lose every word, as far as any window of them is long enough.
    told = cuts.join(copies, ["doc_key", "text_hash"], "left")
    none, all_words = F.lit(None), F.struct(
        F.array(F.lit(0).cast("long")).alias("starts"), F.array(F.lit(1 << 40)).alias("ends")
    )
    own = F.when(F.col("cut_rows") == F.coalesce("copies", F.lit(1)), F.col("least")).otherwise(none)
    cut = F.when(F.col("row") > F.col("first"), all_words).otherwise(own)
    out = (
        keyed
        .join(told, ["doc_key", "text_hash"], "left")
        .select("doc_id", "text", cut.alias("cut"))
        .select("doc_id", "text", "cut.starts", "cut.ends")
    )
    return out.mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string"
    ).withColumn("kept", F.col("kept").cast("string"))
