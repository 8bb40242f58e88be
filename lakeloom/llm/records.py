"""Token ids as files of length-delimited binary records, with a separate offset index."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import has_columns, new_path, ship, written
from .tokens import load_spec, worker_tokenizer

#: A record: length of the payload (8 bytes), masked crc of those 8, payload, masked crc of the payload, a line feed as
#: record mark.
HEAD, TAIL, MARK = struct.Struct("<QI"), struct.Struct("<I"), b"\n"
#: A payload: doc_id, flags (1: doc_id is null; 2: ids of four bytes, else two), the ids.
DOC = struct.Struct("<qB")
INDEX = "part int, chunk int, path string, record long, offset long, length long, doc_id long, n_tokens long, ids_before long, ids_crc32 long"


#: Fixed value: the constant of masked checksums.
MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    """The data's crc32, rotated right by 15 bits plus a constant, so that a crc of data with crcs inside stays sound.
    """
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    """One record with its mark."""
    payload = DOC.pack(doc_id or 0, (doc_id is None) | wide << 1) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked(length)), payload, TAIL.pack(masked(payload)), MARK))


def unframe(content, at: int) -> tuple[int | None, bytes, bool, int]:
    """doc_id, ids, wide, and where the next record begins; raises ValueError on a damaged record."""
    length, check = HEAD.unpack_from(content, at)
    if masked(bytes(content[at : at + 8])) != check:
        raise ValueError(f"length at {at} is damaged")
    payload = bytes(content[at + HEAD.size : (end := at + HEAD.size + length)])
    if len(payload) != length or TAIL.unpack_from(content, end)[0] != masked(payload) or bytes(content[end + 4 : end + 5]) != MARK:
        raise ValueError(f"record at {at} is damaged")
    doc_id, flags = DOC.unpack_from(payload)
    return (None if flags & 1 else doc_id), payload[DOC.size :], bool(flags & 2), end + 5


def write_records(docs: DataFrame, tokenizer: str, end_id: int, path: str, max_bytes: int = 16 << 20) -> None:
    """Encodes each whole text (null: empty), adds `end_id`, and writes the records in ascending doc_id order under
    `path`.

    A file covers one range of doc_ids and holds `max_bytes` at most, or a single longer record; files are ordered by
    their part number, then by their chunk, and null ids come first. Rows that repeat a doc_id stay, ordered by the hash
    of their text; equal rows may lie in different files, so that no id, nor the rows without one, must meet in one
    task. Spark's own writer commits the files, on any file system that it knows.
    """
    spark = docs.sparkSession
    ship(spark)
    spec = spark.sparkContext.broadcast(load_spec(tokenizer))

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tok = worker_tokenizer(spec.value)
        end, wide, width = (
            np
            .array([end_id], dtype=tok.dtype)
            .tobytes(), tok.dtype == "<u4", np
            .dtype(tok.dtype).itemsize
        )
        made: list[bytes] = []
        size = 0

        def file() -> pa.RecordBatch:
            # The writer adds the last record's mark.
            return pa.RecordBatch.from_arrays([pa.array([b"".join(made)[: -len(MARK)]], pa.binary())], ["file"])

        for batch in batches:
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            for ids, counts in tok.encode(batch.column("text")):
                ids, ends = ids.tobytes(), (np.cumsum(counts) * width).tolist()
                for a, b in zip([0, *ends], ends, strict=False):
                    one = frame(doc_ids[at], ids[a:b] + end, wide)
                    if made and size + len(one) > max_bytes:
                        yield file()
                        made, size = [], 0
                    made.append(one)
                    size += len(one)
                    at += 1
        if made:
            yield file()

    docs = has_columns(docs, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = ("doc_id", "digest", "row")
    docs = docs.withColumns({"digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = ordered.mapInArrow(encode, "file binary").select(F.col("file").cast("string"))
    files.write.option("lineSep", MARK.decode()).option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of all files under `path`, from reading them whole and checking every checksum: one row a
    record.
    """
    ship(spark)

    def scan(batches: Iterator) -> Iterator:
        import re

        import numpy as np
        import pyarrow as pa

        names = [field.split()[0] for field in INDEX.split(", ")]
        kinds = [
            {"int": pa.int32(), "string": pa.string()}.get(field.split()[1], pa.int64()) for field in INDEX.split(", ")
        ]
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                content = memoryview(content.as_buffer())
                part, chunk = map(int, re.search(r"part-(\d+)-.*-c(\d+)", name).groups())
                rows, at, record, before = [], 0, 0, 0
                while at < len(content):
                    doc_id, ids, wide, after = unframe(content, at)
                    ids = np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4")
                    rows.append(
                        (part, chunk, name, record, at, after - at, doc_id, len(ids), before, zlib.crc32(ids.tobytes()))
                    )
                    at, record, before = after, record + 1, before + len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
                    )

    return _files(spark, path).mapInArrow(scan, INDEX)


def read_records(index: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of the index rows given, in any order and number: each file is read once for its chosen records."""
    spark = index.sparkSession
    ship(spark)

    def pick(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for content, offsets in zip(batch.column("content"), batch.column("offsets").to_pylist(), strict=True):
                content = memoryview(content.as_buffer())
                rows = [unframe(content, at)[:3] for at in offsets]
                ids = [np.frombuffer(x, "<u4" if wide else "<u2").astype("int64") for _, x, wide in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _, _ in rows], pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
                    ["doc_id", "ids"]
                )

    chosen = index.groupBy("path").agg(F.collect_list("offset").alias("offsets"))
    return (
        _files(spark, path)
        .join(chosen, "path")
        .select("content", "offsets")
        .mapInArrow(pick, "doc_id long, ids array<long>")
    )


def tokenize_to_records(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Writes the record files and their index (Parquet, `path`-index) and returns the index with `start`, the ids of
    all records before.

    Extra columns are left out; an empty table writes no records and gives an empty index. The running total runs over
    files (one row each), not over documents.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "records")
    write_records(docs, tokenizer, end_id, path)
    index = build_index(spark, path)
    index.write.parquet(f"{path}-index")
    index = spark.read.schema(INDEX).parquet(f"{path}-index")
    files = index.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("n"))
    files = files.select(
        "part", "chunk", (F.sum("n").over(Window.orderBy("part", "chunk")) - F.col("n")).alias("files_before")
    )
    return (
        index
        .join(files, ["part", "chunk"])
        .withColumn("start", F.col("files_before") + F.col("ids_before"))
        .drop("files_before")
    )
