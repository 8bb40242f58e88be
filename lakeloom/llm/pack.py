"""Mixture-controlled packing by deficit round-robin over source queues."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import has_columns, ship, written
from .tokens import load_spec, worker_tokenizer


def running_total(df: DataFrame, value: str, *order: str) -> DataFrame:
    """The rows with `before`: the sum of `value` over all rows that precede them in this order (a total one).

    Rows are range-partitioned and sorted; each partition adds up its own rows in one pass, and only one row a partition
    meets in the sum of the partitions' totals. No group is gathered, however many rows it has.
    """
    ship(df.sparkSession)

    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = total + np.cumsum(values)
            total = int(sums[-1]) if len(sums) else total
            columns = [*batch.columns, pa.array(sums - values), pa.array(np.full(len(values), part, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "in_part", "part"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
    rows = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(add, f"{kinds}, in_part long, part int"),
        "running"
    )
    parts = rows.groupBy("part").agg(F.sum(value).alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    return (
        rows
        .join(parts, "part")
        .withColumn("before", F.col("in_part") + F.col("parts_before"))
        .drop("part", "in_part", "parts_before")
    )


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(uid, doc_id, queue, n, ids): each document's ids with `end_id`, compressed; uid numbers the rows, queue is the
    source.
    """
    import zstandard  # noqa: F401  the tasks need it

    spark = docs.sparkSession
    ship(spark)
    spec = spark.sparkContext.broadcast(load_spec(tokenizer))

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        tok, pack = worker_tokenizer(spec.value), zstandard.ZstdCompressor(level=1).compress
        end, uid = np.array([end_id], dtype=tok.dtype).tobytes(), TaskContext.get().partitionId() << 33
        width = np.dtype(tok.dtype).itemsize
        for batch in batches:
            at = 0
            for ids, counts in tok.encode(batch.column("text")):
                ids, ends = ids.tobytes(), (np.cumsum(counts) * width).tolist()
                packed = [bytes([width]) + pack(ids[a:b] + end) for a, b in zip([0, *ends], ends, strict=False)]
                rows = pa.array(range(uid, uid + len(packed)), pa.int64())
                columns = [
                    rows, *(batch.column(c).slice(at, len(packed)) for c in ("doc_id", "queue")), pa.array(counts + 1),
                    pa.array(packed, pa.binary())
                ]
                yield pa.RecordBatch.from_arrays(columns, ["uid", "doc_id", "queue", "n", "ids"])
                at, uid = at + len(packed), uid + len(packed)

    docs = has_columns(docs, doc_id="long", text="string", source="string").select(
        "doc_id", "text", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("queue")
    )
    return docs.mapInArrow(encode, "uid long, doc_id long, queue string, n long, ids binary")


def _released(window: int, packet: int):
    """Cuts each document where its queue's next packet falls into a later round."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            uid, at, n, share = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "queue_before", "n", "share")
            )
            for k in range(0, len(uid), 2000):
                a, m, p = at[k : k + 2000], n[k : k + 2000], share[k : k + 2000]
                first = a // packet
                count = (a + m - 1) // packet - first + 1
                doc = np.repeat(np.arange(len(a)), count)
                j = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
                # A queue earns window * share tokens a round; packet j goes out once its earnings cover j + 1 packets.
                rounds = np.ceil((j + 1) * (packet / (window * p[doc]))).astype(np.int64)
                new = np.flatnonzero(
                    np.r_[True, (doc[1:] != doc[:-1]) | (rounds[1:] != rounds[:-1])]
                ) if len(doc) else np.zeros(0, np.int64)
                owner = doc[new]
                start = np.maximum(j[new] * packet - a[owner], 0)
                end = np.r_[start[1:], 0]
                end[
                    np.r_[owner[1:] != owner[:-1], True] if len(owner) else slice(0)
                ] = m[owner][np.r_[owner[1:] != owner[:-1], True] if len(owner) else slice(0)]
                queue = batch.column("queue").slice(k, 2000).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uid[k : k + 2000][owner]), queue, pa.array(rounds[new]), pa.array(a[owner] + start),
                        pa.array(start), pa.array(end - start)
                    ],
                    ["uid", "queue", "round", "queue_at", "start", "length"]
                )

    return cut


def _summed(batches: Iterator) -> Iterator:
    """A row for each piece, with the crc32 of its ids as four-byte integers."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    unpack, crc32 = zstandard.ZstdDecompressor().decompress, zlib.crc32
    names = ["start", "length", "sequence_id", "offset"]
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            pieces = part.column("pieces")
            flat, owner = pieces.flatten(), np.repeat(np.arange(len(pieces)), np.diff(pieces.offsets.to_numpy()))
            start, length, sequence, offset = (flat.field(n).to_numpy() for n in names)
            ends, sums = np.searchsorted(owner, np.arange(1, len(pieces) + 1)).tolist(), []
            first = 0
            for packed, last in zip(part.column("ids").to_pylist(), ends, strict=True):
                ids = memoryview(np.frombuffer(unpack(packed[1:]), f"<u{packed[0]}").astype("<u4").tobytes())
                sums += [
                    crc32(ids[4 * a : 4 * (a + n)]) for a,
                    n in zip(start[first:last].tolist(), length[first:last].tolist(), strict=True)
                ]
                first = last
            rows = pa.array(owner)
            columns = [
                part.column("doc_id").take(rows), pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                part.column("n").take(rows), pa.array(sequence), pa.array(offset)
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, packet: int = 128,
    targets: dict[str | None, float] | None = None
) -> DataFrame:
    """Packs all documents into sequences of `window` tokens, every one in the target proportions of the sources.

    Each source is a queue of its documents in doc_id order (null doc_ids first; ties in reading order; a null source is
    a queue too). A round is one window: a queue earns window * share tokens, and sends packets of `packet` tokens as
    its earnings cover them; what is left over, the deficit, stays for later rounds. As a queue always has tokens until
    its end, packet j leaves in round ceil((j + 1) * packet / earnings), so the rounds of all packets follow from
    running totals, and deficits carry over windows and partitions without a sequential pass. The packets of all rounds,
    in order, form one stream that is cut at every `window` tokens: only the last sequence is short.

    `targets` gives positive weights by source (others raise ValueError); a source that it doesn't name gets its own
    share of tokens. By default every source has that share, so that all queues end together. Where targets drain a
    queue early, the others fill the windows on.

    Returns a row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty
    text has `end_id` alone. Repeated rows are packed each; extra columns are left out; an empty table gives no pieces.
    """
    if any(not 0 < w < float("inf") for w in (targets or {}).values()):
        raise ValueError("a target weight must be a positive number")
    spark = docs.sparkSession
    tokens = written(tokenized(docs, tokenizer, end_id), "tokens")
    placed = running_total(tokens.select("queue", "doc_id", "uid", "n"), "n", "queue", "doc_id", "uid")
    queues = placed.groupBy("queue").agg(F.sum("n").alias("tokens"), F.min("before").alias("queue_first"))
    weight = F.col("tokens").cast("double")
    if targets:
        given = spark.createDataFrame(
            [("" if k is None else f"={k}", float(v)) for k, v in targets.items()], "queue string, weight double"
        )
        total = placed.agg(F.sum("n").cast("double")).first()[0] or 1.0
        queues = queues.join(given, "queue", "left").withColumn("weight", F.coalesce("weight", weight / total))
    else:
        queues = queues.withColumn("weight", weight)
    all_weights = queues.agg(F.sum("weight").alias("all_weights"))
    # with one row
    queues = queues.crossJoin(all_weights).select(
        "queue", "queue_first", (F.col("weight") / F.col("all_weights")).alias("share")
    )
    released = placed.join(queues, "queue").select(
        "uid", "queue", "n", "share", (F.col("before") - F.col("queue_first")).alias("queue_before")
    )
    pieces = released.mapInArrow(
        _released(window, packet), "uid long, queue string, round long, queue_at long, start long, length long"
    )
    streamed = running_total(pieces, "length", "round", "queue", "queue_at")

    last = F.floor((F.col("before") + F.col("length") - 1) / window)
    cut = streamed.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("before") / window), last)))
    begin = F.greatest("before", F.col("sequence_id") * window)
    end = F.least(F.col("before") + F.col("length"), (F.col("sequence_id") + 1) * window)
    piece = F.struct(
        (F.col("start") + begin - F.col("before")).alias("start"), (end - begin).alias("length"), "sequence_id",
        (begin - F.col("sequence_id") * window).alias("offset")
    )
    by_document = cut.groupBy("uid").agg(F.collect_list(piece).alias("pieces"))
    joined = tokens.join(by_document, "uid").select("doc_id", "n", "ids", "pieces")
    return joined.mapInArrow(
        _summed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
