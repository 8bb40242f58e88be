"""Benchmark decontamination with a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import has_columns, ship, text_hash, written

BLOCK_WORDS, BLOCK_DOCS, CANDIDATES = 1_000_000, 100_000, 1_000_000
STORED = "block long, term binary, n int, positions binary, doc_ids array<long>, text_hashes array<long>, firsts array<long>"
MATCHES = "doc_id long, text_hash long, block long, place long, n_words long, n_hit long, windows array<long>, starts array<long>, ends array<long>"
#: A-Z lower-cased; every ASCII character but letters and digits separates words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after A-Z are lower-cased; null has none."""
    return text.translate(_TABLE).split() if text else []


def pack_places(places, first):
    """Ascending positions, list after list (`first` marks where one begins), as gaps in bytes of seven bits, the last
    of each gap marked; and each gap's size in bytes.
    """
    import numpy as np

    gaps = np.diff(places, prepend=0)
    gaps[first] = places[first]
    size = np.searchsorted(np.array([1 << 7, 1 << 14, 1 << 21, 1 << 28]), gaps, side="right") + 1
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        own = np.flatnonzero(size > k)
        out[ends[own] - 1 - k] = gaps[own] >> (7 * k) & 127
    out[ends - 1] |= 128
    return out, size


def unpack_places(data: bytes, counts):
    """The positions of the lists from pack_places(), laid end to end."""
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw & 128)
    size = np.diff(ends, prepend=-1)
    gaps = np.zeros(len(ends), np.int64)
    for k in range(5):  # no text that a row can hold has more than 2**35 words
        own = size > k
        gaps[own] |= (raw[ends[own] - k] & 127).astype(np.int64) << (7 * k)
    sums = np.cumsum(gaps)
    begin = np.cumsum(counts) - counts
    return sums - np.repeat(sums[begin] - gaps[begin], counts) if len(sums) else sums


@dataclass(frozen=True)
class Index:
    """A stored index: `postings` (block, term, n, positions) of all words, `documents` (block, doc_ids, text_hashes,
    firsts).
    """

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame) -> Index:
    """The stored index of the documents: for each block of about a million words, the positions of every word, in a
    byte or two each.

    Whole documents are laid end to end in a block, so that each occurrence of a phrase lies in one block; a document
    longer than a block is a block. It serves any number of benchmarks without the texts. Null ids are kept as the least
    long; a null text has no words; extra columns are left out.
    """
    ship(docs.sparkSession)

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        names = [x.split()[0] for x in STORED.split(", ")]
        kinds = [
            {
                "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())
            }.get(x.split()[1], pa.int64()) for x in STORED.split(", ")
        ]

        def post(ids: list, hashes: list, words: list) -> Iterator:
            nonlocal made
            block = base + made
            made += 1
            firsts = np.cumsum([0, *map(len, words)])
            doc_ids = [-(1 << 63) if i is None else i for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v], k) for v,
                    k in zip((block, None, None, None, doc_ids, hashes, firsts), kinds, strict=True)
                ],
                names
            )
            coded = pa.concat_arrays(words).dictionary_encode()
            code = coded.indices.to_numpy()
            if not len(code):
                return
            count = np.bincount(code)
            place = np.argsort(code, kind="stable")
            first = np.zeros(len(place), bool)
            first[np.cumsum(count) - count] = True
            packed, size = pack_places(place, first)
            offsets = np.r_[0, np.cumsum(np.add.reduceat(size, np.flatnonzero(first)))].astype(np.int32)
            lists = pa.Array.from_buffers(
                pa.binary(), len(count), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed.tobytes())]
            )
            terms = pc.array_sort_indices(coded.dictionary)  # terms in order, so that a scan may skip row groups
            for k in range(0, len(count), 50_000):
                own = terms.slice(k, 50_000)
                none = [pa.nulls(len(own), kind) for kind in kinds[4:]]
                columns = [
                    pa.array(np.full(len(own), block)), coded.dictionary.take(own),
                    pa.array(count.astype(np.int32)).take(own), lists.take(own), *none
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

        ids, hashes, words, size = [], [], [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = pa.array(
                    [t.as_buffer().to_pybytes().translate(_TABLE) if t.is_valid else b"" for t in part.column("text")],
                    pa.binary()
                )
                split = pc.ascii_split_whitespace(texts.cast(pa.string()))
                for doc_id, digest, own in zip(
                    part.column("doc_id").to_pylist(), part.column("text_hash").to_pylist(), split, strict=True
                ):
                    own = own.values
                    blank = pc.equal(own, "") if len(own) and (own[0].as_py() == "" or own[-1].as_py() == "") else None
                    ids.append(doc_id)
                    hashes.append(digest)
                    words.append((own if blank is None else own.filter(pc.invert(blank))).cast(pa.binary()))
                    size += len(words[-1])
                    if size >= BLOCK_WORDS or len(ids) >= BLOCK_DOCS:
                        yield from post(ids, hashes, words)
                        ids, hashes, words, size = [], [], [], 0
        if ids:
            yield from post(ids, hashes, words)

    docs = has_columns(docs, doc_id="long", text="string").withColumn("text_hash", text_hash(F.col("text")))
    stored = written(docs.mapInArrow(scan, STORED), "postings")
    return Index(
        stored.where("term IS NOT NULL").select("block", "term", "n", "positions"),
        stored.where("term IS NULL").select("block", "doc_ids", "text_hashes", "firsts")
    )


def phrase_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(window, terms, item): the items' windows of n consecutive words, or all words of a shorter item that has any;
    `window` numbers the different ones.
    """
    ship(benchmark.sparkSession)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text.encode("utf-8") if text else None)
                for k in range(0, max(len(words) - n, 0) + 1 if words else 0, 1000):
                    windows = [words[i : i + n] for i in range(k, min(k + 1000, max(len(words) - n, 0) + 1))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(windows), pa.string()), pa.array(windows, pa.list_(pa.binary()))],
                        ["item", "terms"]
                    )

    items = has_columns(benchmark, item_id="string", text="string").where("item_id IS NOT NULL")
    cuts = written(items.mapInArrow(cut, "item string, terms array<binary>").distinct(), "cuts")
    numbered = written(cuts.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    return cuts.join(numbered, "terms").select("window", "terms", "item")


def intersect(windows, lengths, rarest, counts, positions, firsts, slop: int = 0):
    """(window, first, last) of each match in one block: lists of terms, shifted by their offsets, intersected from the
    rarest on.

    `windows` holds numbers of terms, padded by -1; `counts` and `positions` the terms' lists; `rarest` the offset of
    each window's rarest term in the corpus; `firsts` the documents' first positions, and the end. A match stands where
    the first word stands at s, and every word k of the window somewhere from s + k - slop to s + k + slop in the same
    document; of several places the nearest counts, of two as near the first. So matches depend on the document alone,
    neither on its block nor on which term is the rarest.
    """
    import numpy as np

    n, total = windows.shape[1], int(firsts[-1])
    begin = np.cumsum(counts) - counts
    stride = total + 2 * slop + 2
    keys = np.repeat(np.arange(len(counts)), counts) * stride + positions
    rank = np.where(windows >= 0, counts[windows], np.iinfo(np.int64).max)
    rank[np.arange(len(windows)), rarest] = -1
    order = np.argsort(rank, axis=1, kind="stable")  # the rarest first; padding last
    anchor = windows[np.arange(len(windows)), rarest]
    load, found, at = np.cumsum(counts[anchor]), [], 0
    while at < len(windows):
        upto = max(
            at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + CANDIDATES // (2 * slop + 1), side="right"))
        )
        own = np.arange(at, upto)
        window = np.repeat(own, counts[anchor[own]])
        place = np.arange(len(window)) - np.repeat(
            np.cumsum(counts[anchor[own]]) - counts[anchor[own]], counts[anchor[own]]
        ) + begin[anchor[window]]
        spot = positions[place]
        doc = np.searchsorted(firsts, spot, side="right") - 1
        shifts = np.tile(np.arange(-slop, slop + 1), len(window))
        window, doc = np.repeat(window, 2 * slop + 1), np.repeat(doc, 2 * slop + 1)
        start = np.repeat(spot, 2 * slop + 1) - rarest[window] + shifts
        keep = (start >= firsts[doc]) & (start < firsts[doc + 1])
        window, doc, start = window[keep], doc[keep], start[keep]
        if slop:  # the first word stands exactly at the start, which several places of the rarest term may tell
            head = windows[window, 0] * stride + start
            keep = keys[np.minimum(np.searchsorted(keys, head), len(keys) - 1)] == head
            window, doc, start = (
                x[0] for x in np.split(np.unique(np.stack([window[keep], doc[keep], start[keep]]), axis=1), 3)
            )
        low, high = start.copy(), start.copy()
        for k in range(n):
            offset = order[window, k]
            term = windows[window, offset]
            want = start + offset
            base = term.astype(np.int64) * stride
            after = np.searchsorted(keys, base + np.clip(want, 0, total))
            last = np.maximum(want - slop, firsts[doc]), np.minimum(want + slop, firsts[doc + 1] - 1)
            before, after = (keys[np.clip(x, 0, len(keys) - 1)] - base for x in (after - 1, after))
            fits_before, fits_after = ((x >= last[0]) & (x <= last[1]) for x in (before, after))
            spot = np.where(fits_before & ~(fits_after & (after - want < want - before)), before, after)
            ok = (term < 0) | fits_before | fits_after
            low, high = np.where(term < 0, low, np.minimum(low, spot)), np.where(term < 0, high, np.maximum(high, spot))
            window, doc, start, low, high = (x[ok] for x in (window, doc, start, low, high))
        found.append((window, low, high))
        at = upto
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _search(n: int, slop: int):
    """Of one block: its documents, with what the windows told for the block hit in each."""

    def search(postings, told):
        import numpy as np
        import pyarrow as pa

        rows = postings.to_pydict()
        head = rows["term"].index(None)
        firsts = np.array(rows["firsts"][head], np.int64)
        total, lists = int(firsts[-1]), [k for k in range(len(rows["term"])) if k != head]
        number = {rows["term"][k]: i for i, k in enumerate(lists)}
        counts = np.array([rows["n"][k] for k in lists], np.int64)
        positions = unpack_places(b"".join(rows["positions"][k] for k in lists), counts)
        told = told.to_pydict()
        names = np.array(told["window"], np.int64)
        windows = np.array(
            [[number.get(t, -2) for t in terms] + [-1] * (n - len(terms)) for terms in told["terms"]], np.int64
        ).reshape(-1, n)
        there = (windows > -2).all(axis=1)  # in this block each of its words occurs
        names, windows, rarest = names[there], windows[there], np.array(told["rarest"], np.int64)[there]
        window, first, last = intersect(windows, (windows >= 0).sum(axis=1), rarest, counts, positions, firsts, slop)
        doc = np.searchsorted(firsts, first, side="right") - 1
        change = np.zeros(total + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, last + 1, -1)
        hit = np.cumsum(change[:-1]) > 0
        edges = np.diff(np.r_[False, hit, False].astype(np.int8))
        inner = firsts[1:-1][(firsts[1:-1] > 0) & (firsts[1:-1] < total)]
        both = inner[hit[inner] & hit[inner - 1]] if total else inner  # runs that touch across two documents
        starts, ends = np.union1d(np.flatnonzero(edges == 1), both), np.union1d(np.flatnonzero(edges == -1), both)
        sums = np.r_[0, np.cumsum(hit)]
        a, b = np.searchsorted(starts, firsts[:-1]), np.searchsorted(starts, firsts[1:])
        m = len(firsts) - 1
        pairs = np.unique(np.stack([doc, names[window]]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
        cuts = np.searchsorted(pairs[0], np.arange(m + 1))
        columns = [
            pa.array([None if i == -(1 << 63) else i for i in rows["doc_ids"][head]], pa.int64()),
            pa.array(rows["text_hashes"][head], pa.int64()),
            pa.array(np.full(m, rows["block"][head])),
            pa.array(np.arange(m)),
            pa.array(np.diff(firsts)),
            pa.array(sums[firsts[1:]] - sums[firsts[:-1]]),
            pa.array([pairs[1][i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int64())),
            pa.array([starts[i:j] - f for i, j, f in zip(a, b, firsts[:-1], strict=True)], pa.list_(pa.int64())),
            pa.array([ends[i:j] - f for i, j, f in zip(a, b, firsts[:-1], strict=True)], pa.list_(pa.int64())),
        ]
        return pa.table(columns, [x.split()[0] for x in MATCHES.split(", ")])

    return search


def search_index(index: Index, benchmark: DataFrame, n: int = 13, slop: int = 0) -> DataFrame:
    """Where the benchmark's phrases of `n` words occur in the indexed documents: one row for every document.

    Returns doc_id, text_hash (tells rows of one doc_id apart), n_words, n_hit (words inside any occurrence), items (ids
    of the items that occur, sorted, as strings), and the maximal hit intervals as `starts` and `ends` in words. With
    slop 0 phrases match exactly; with more, each word may stand up to `slop` places off in the same document, counted
    from the first word, and the interval spans the nearest words found.

    The benchmark stays in partitions: its different words are joined to the postings, each window to its rarest word in
    the corpus and so to the blocks that hold that word; a block then meets only the windows told for it. Items without
    an id or words are no test. A null or wordless text has no words and no hits. Null or repeated doc_ids stay rows of
    their own; an empty table gives no rows, an empty benchmark no hits.
    """
    cuts = written(phrase_windows(benchmark, n), "tests")
    windows = cuts.select("window", "terms").dropDuplicates(["window"])
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    hits = written(index.postings.join(terms, "term"), "hits")
    often = hits.groupBy("term").agg(F.sum("n").alias("often"))
    placed = windows.select("window", F.posexplode("terms").alias("rarest", "term")).join(often, "term")
    told = placed.groupBy("window").agg(
        F.min(F.struct("often", "rarest", "term")).alias("least"), F.count(F.lit(1)).alias("found")
    )
    told = (
        windows
        .join(told, "window")
        .where(F.size("terms") == F.col("found"))
        .select("window", "terms", "least.rarest", "least.term")
    )
    told = told.join(hits.select("term", "block"), "term").select("block", "window", "terms", "rarest")
    heads = index.documents.select(
        "block", F.lit(None).cast("binary").alias("term"), F.lit(None).cast("int").alias("n"),
        F.lit(None).cast("binary").alias("positions"), "doc_ids", "text_hashes", "firsts"
    )
    lists = hits.select(
        "block", "term", "n", "positions",
        *(F.lit(None).cast("array<long>").alias(c) for c in ("doc_ids", "text_hashes", "firsts"))
    )
    found = (
        heads
        .unionByName(lists)
        .groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(_search(n, slop), MATCHES)
    )
    found = written(found, "found")
    named = (
        found
        .where("n_hit > 0")
        .select("block", "place", F.explode("windows").alias("window"))
        .join(cuts.select("window", "item"), "window")
    )
    named = named.groupBy("block", "place").agg(F.sort_array(F.collect_set("item")).alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>")).alias("items")
    return found.join(named, ["block", "place"], "left").select(
        "doc_id", "text_hash", "n_words", "n_hit", items, "starts", "ends"
    )


def find_tests(docs: DataFrame, benchmark: DataFrame, n: int = 13, slop: int = 0) -> DataFrame:
    """search_index() over an index built for these documents."""
    return search_index(build_index(docs), benchmark, n, slop)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, one_in: int = 20) -> DataFrame:
    """find_tests with `contaminated`: some word is hit, and at least one word in `one_in`. Texts are searched whole,
    however long.
    """
    found = find_tests(docs, benchmark, n)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
