"""SimHash near-dedup with a Gray-order hierarchical index of the fingerprints."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import has_columns, ship, text_hash, written
from .graph import components
from .substring import window_hashes, word_hashes

LEAF_CODES, NODE_LEAVES = 256, 64
SHARED = "node_mask array<long>, node_pattern array<long>, mask array<long>, pattern array<long>"
INDEX = f"a long, b long, block long, node long, leaf long, {SHARED}, ids array<long>, codes binary"


def words_of(text: str | bytes | None) -> list[bytes]:
    """Runs of other than ASCII white space after A-Z are lower-cased; of bytes, so that no other character changes or
    splits.
    """
    return (text.encode("utf-8") if isinstance(text, str) else text or b"").lower().split()


def fingerprint_of(text: str | bytes | None, words: int = 3, seed: int = 42) -> int:
    """64 bits, each set where over half of the shingles' XXH64 have it set; repeats count, no words give zero."""
    import numpy as np
    import xxhash

    tokens = words_of(text)
    if not tokens:
        return 0
    joined, n = b" ".join(tokens), len(tokens)
    starts, at = [0] * (n + 1), 0
    for i, token in enumerate(tokens):
        starts[i] = at
        at += len(token) + 1
    starts[n] = at
    digest, view, k = xxhash.xxh64_intdigest, memoryview(joined), min(words, n)
    hashes = np.fromiter(
        (digest(view[starts[i] : starts[i + k] - 1], seed) for i in range(n - k + 1)), np.uint64, n - k + 1
    )
    ones = _ones(hashes.astype(">u8").view(np.uint8).reshape(-1, 8))
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _ones(packed):
    """How many rows have each bit; sums of up to 255 rows fit into bytes, which add up fast."""
    import numpy as np

    ones = np.zeros(8 * packed.shape[1], np.int64)
    for at in range(0, len(packed), 255):
        ones += np.add.reduce(np.unpackbits(packed[at : at + 255], axis=1), axis=0, dtype=np.uint8)
    return ones


def set_fingerprint(text: bytes | None, words: int = 5, bits: int = 512) -> bytes:
    """`bits` bits (a multiple of 64) of the set of shingles, so that fingerprints differ in a share of angle / pi of
    their bits.

    Each distinct shingle is hashed as a window of word hashes, and drawn out to all bits by mixing. A tie goes to the
    least hash; no words give zero.
    """
    import numpy as np

    tokens = words_of(text)
    if not tokens:
        return bytes(bits // 8)
    h = np.unique(window_hashes(word_hashes(tokens), min(words, len(tokens))))
    ones = np.zeros(bits, np.int64)
    steps = np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(0, len(h), 1 << 16):  # so that a very long text takes no more memory
        with np.errstate(over="ignore"):
            z = h[k : k + (1 << 16), None] + steps
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        packed = (z ^ (z >> np.uint64(31))).view(np.uint8)
        if k == 0:
            least = np.unpackbits(packed[0]).astype(bool)
        ones += 2 * _ones(packed)
    return np.packbits((ones > len(h)) | ((ones == len(h)) & least)).tobytes()


def radius(similarity: float, bits: int, deviations: float = 1.0) -> int:
    """In how many bits fingerprints of sets of that Jaccard similarity differ, plus some deviations so that few of them
    are missed.

    Of sets alike in size, similarity s is a cosine of 2 s / (1 + s); sets of other sizes at similarity s lie a little
    closer.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * share + deviations * math.sqrt(bits * share * (1 - share)))


def fingerprints(docs: DataFrame, words: int, seed: int, bits: int) -> DataFrame:
    """(doc_id, text_hash, code) for every row: the 64-bit fingerprint of all shingles, or a wider one of the set of
    shingles.
    """
    ship(docs.sparkSession)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else None for t in batch.column("text"))
            codes = [
                fingerprint_of(t, words, seed).to_bytes(8, "big") if bits == 64 else set_fingerprint(t, words, bits) for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(codes, pa.binary())],
                ["doc_id", "text_hash", "code"]
            )

    docs = has_columns(docs, doc_id="long", text="string").withColumn("text_hash", text_hash(F.col("text")))
    return docs.mapInArrow(scan, "doc_id long, text_hash long, code binary")


def byte_pairs(n_bytes: int, count: int) -> list[tuple[int, int]]:
    """`count` blocks of two bytes of a code: neighbours first, which cover it once, then bytes further apart."""
    pairs = [(i, (i + gap) % n_bytes) for gap in range(1, n_bytes, 2) for i in range(0, n_bytes, 2)]
    return pairs[:count]


def gray_rank(code):
    """The codes' places in Gray order: neighbours in this order differ in one bit."""
    import numpy as np

    for shift in (1, 2, 4, 8, 16, 32):
        code = code ^ (code >> np.uint64(shift))
    return code


def _spread(blocks: list[tuple[int, int]]):
    """A row for each code and block: the block with its bits, and the Gray rank of other bits."""

    def spread(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                for t, (i, j) in enumerate(blocks):
                    others = [b for b in range(code.shape[1]) if b not in (i, j)]
                    turned = np.zeros((len(code), 8), np.uint8)
                    chosen = [
                        others[
                            (
                                others.index((j + 1) % code.shape[1]) if (j + 1) % code.shape[1] in others else 0
                            ) - len(others) + x
                        ] for x in range(min(8, len(others)))
                    ]
                    turned[:, : len(chosen)] = code[:, chosen]
                    rank = gray_rank(turned.view(">u8").ravel().astype(np.uint64)) >> np.uint64(1)
                    block = t << 16 | code[:, i].astype(np.int64) << 8 | code[:, j]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block), pa.array(rank.astype(np.int64)), part.column("id"), part.column("code")],
                        ["block", "rank", "id", "code"]
                    )

    return spread


class Groups:
    """Union-find over the positions of a small list."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _distance(a, b):
    import numpy as np

    out = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.uint16)
    for w in range(a.shape[-1]):
        out += np.bitwise_count(a[..., w] ^ b[..., w])
    return out


def _within(codes, max_bits: int) -> Groups:
    """The groups that a leaf's codes form."""
    import numpy as np

    groups = Groups(len(codes))
    near = _distance(codes[:, None], codes[None, :]) <= max_bits
    seen = np.zeros(len(codes), bool)
    for start in range(len(codes)):  # breadth first: each code is met once, however dense the leaf
        reach = [] if seen[start] else [start]
        seen[start] = True
        while reach:
            i = reach.pop()
            new = np.flatnonzero(near[i] & ~seen)
            seen[new] = True
            for j in new.tolist():
                groups.join(start, j)
            reach += new.tolist()
    return groups


def _shared(codes):
    """The bits on which all codes agree, as a mask, and their values."""
    import numpy as np

    mask = ~np.bitwise_or.reduce(codes ^ codes[0], axis=0)
    return mask.view(np.int64).tolist(), (codes[0] & mask).view(np.int64).tolist()


def _index(max_bits: int):
    """Leaves of a partition that is sorted by block and Gray rank, and the links inside each leaf."""

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        names = [x.split()[0] for x in INDEX.split(", ")]
        kinds = [
            {
                "binary": pa.binary(), "array<long>": pa.list_(pa.int64())
            }.get(x.split()[1], pa.int64()) for x in INDEX.split(", ")
        ]

        def rows(out: list[tuple]):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
            )

        def work(block, ids, codes, first_open: bool, last_open: bool) -> Iterator:
            """Whole blocks; an open one goes on in another run or partition, so that its leaves must meet others."""
            nonlocal made
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            sizes = np.diff(np.r_[starts, len(block)])
            place = np.arange(len(block)) - np.repeat(starts, sizes)
            cuts = np.flatnonzero(place % LEAF_CODES == 0)
            ends = np.r_[cuts[1:], len(block)]
            # Leaves of a few codes, which most are, are compared all at once; larger ones one by one.
            end = np.repeat(ends, ends - cuts)
            small = np.repeat(ends - cuts <= 16, ends - cuts)
            left, right = [], []
            active, d = np.flatnonzero(small), 1
            while len(active := active[active + d < end[active]]):
                near = active[_distance(codes[active], codes[active + d]) <= max_bits]
                left.append(near)
                right.append(near + d)
                d += 1
            out = [
                (a, b) for a,
                b in zip(ids[np.concatenate(left)].tolist(), ids[np.concatenate(right)].tolist(), strict=True)
            ] if left else []
            for a, b in zip(cuts.tolist(), ends.tolist(), strict=True) if not small.all() else ():
                if b - a > 16:
                    groups = _within(codes[a:b], max_bits)
                    out += [(int(ids[a + i]), int(ids[a + r])) for i in range(b - a) if (r := groups.find(i)) != i]
            if out:
                yield rows([(*x, *[None] * 9) for x in out])
            wanted = sizes > LEAF_CODES
            wanted[0] |= first_open
            wanted[-1] |= last_open
            for a, n in zip(starts[wanted].tolist(), sizes[wanted].tolist(), strict=True):
                for top in range(a, a + n, LEAF_CODES * NODE_LEAVES):
                    upto = min(a + n, top + LEAF_CODES * NODE_LEAVES)
                    above, node = _shared(codes[top:upto]), base + (made := made + 1)
                    out = []
                    for x in range(top, upto, LEAF_CODES):
                        y = min(upto, x + LEAF_CODES)
                        out.append(
                            (
                                None, None, int(block[x]), node, base + (made := made + 1), *above,
                                *_shared(codes[x:y]), ids[x:y].tolist(), codes[x:y].tobytes()
                            )
                        )
                    yield rows(out)

        held, first = None, True
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            new = (batch.column("block").to_numpy(), batch.column("id").to_numpy(), code)
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            block = held[0]
            at = int(np.searchsorted(block, block[-1])) if len(block) else 0
            if at == 0 and len(block) >= LEAF_CODES * NODE_LEAVES:  # one block, and more of it to come
                at = len(block) // (LEAF_CODES * NODE_LEAVES) * LEAF_CODES * NODE_LEAVES
                yield from work(*(x[:at] for x in held), True, True)
                held, first = tuple(x[at:] for x in held), True
            elif at:
                yield from work(*(x[:at] for x in held), first, False)
                held, first = tuple(x[at:] for x in held), False
        if held is not None and len(held[0]):
            yield from work(*held, first, True)

    return build


def _across(max_bits: int):
    """One link for each two groups, of two leaves, that hold a pair within max_bits."""

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            left, right = [], []
            for row in batch.to_pylist():
                (p, x), (q, y) = (
                    (
                        row[f"ids{s}"], np.frombuffer(row[f"codes{s}"], np.uint64).reshape(len(row[f"ids{s}"]), -1)
                    ) for s in ("", "_b")
                )
                i, j = np.nonzero(_distance(x[:, None], y[None, :]) <= max_bits)
                if len(i):
                    own, other = (
                        np.array([g.find(k) for k in range(len(g.up))]) for g in (
                            _within(x, max_bits), _within(y, max_bits)
                        )
                    )
                    for a, b in np.unique(np.column_stack([own[i], other[j]]), axis=0).tolist():
                        left.append(p[a])
                        right.append(q[b])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return search


def hamming_links(codes: DataFrame, max_bits: int = 3, n_bits: int = 64, blocks: int = 4) -> DataFrame:
    """Links (a, b) between the `id`s of distinct `code`s within `max_bits` bits of each other that agree on one of the
    blocks.

    A block is two bytes of the code. Where max_bits is less than the n_bits / 16 blocks that cover a code once, each
    pair within max_bits agrees on one of them, so that the links connect exactly those pairs. For each block the codes
    are sorted by that block, then by Gray rank of other bits, over all partitions alike, and cut into leaves of 256; up
    to 64 leaves make a node. A node factors out the bits (mask and pattern) on which all its codes agree, a leaf those
    on which its own do. Nodes of equal block are paired and pruned by the differences of their shared bits, then their
    leaves by the accumulated differences; only leaves that survive are compared code by code. Links are reported
    between groups that are linked inside their leaves already, never as all pairs.
    """
    spark = codes.sparkSession
    ship(spark)
    rows = codes.select("id", "code").mapInArrow(
        _spread(byte_pairs(n_bits // 8, blocks)), "block long, rank long, id long, code binary"
    )
    sorted_rows = (
        rows
        .repartitionByRange("block", "rank")
        .sortWithinPartitions("block", "rank")
        .select("block", "id", "code")
    )
    index = written(sorted_rows.mapInArrow(_index(max_bits), INDEX), "gray-index")

    def differ(p: str, q: str, *masks: str):
        both = F.zip_with(p, q, lambda x, y: x.bitwiseXOR(y))
        for m in masks:
            both = F.zip_with(both, m, lambda x, y: x.bitwiseAND(y))
        return F.aggregate(both, F.lit(0), lambda n, x: n + F.bit_count(x))

    leaves = index.where("leaf IS NOT NULL").drop("a", "b")
    nodes = leaves.select("block", "node", "node_mask", "node_pattern").dropDuplicates(["node"])
    right = nodes.select("block", *(F.col(c).alias(f"{c}_b") for c in ("node", "node_mask", "node_pattern")))
    pairs = (
        nodes
        .join(right, "block")
        .where("node <= node_b")
        .withColumn("differ", differ("node_pattern", "node_pattern_b", "node_mask", "node_mask_b"))
        .where(F.col("differ") <= max_bits)
    )
    pairs = pairs.select(
        "node", "node_b", "differ",
        F.zip_with("node_mask", "node_mask_b", lambda x, y: F.bitwise_not(x.bitwiseAND(y))).alias("open")
    )
    own = leaves.select("node", "leaf", "mask", "pattern", "ids", "codes")
    pairs = (
        pairs
        .join(own, "node")
        .join(own.select(*(F.col(c).alias(f"{c}_b") for c in own.columns)), "node_b")
        .where("leaf < leaf_b")
    )
    more = differ("pattern", "pattern_b", "mask", "mask_b", "open")
    across = (
        pairs
        .where(F.col("differ") + more <= max_bits)
        .select("ids", "codes", "ids_b", "codes_b")
        .mapInArrow(_across(max_bits), "a long, b long")
    )
    return index.where("a IS NOT NULL").select("a", "b").unionByName(across)


def simhash_groups(
    docs: DataFrame, words: int = 3, seed: int = 42, max_bits: int = 3, bits: int = 64, blocks: int = 4
) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash, kept) for every row: documents linked by fingerprints within
    `max_bits` bits.

    With 64 bits the fingerprint is that of all shingles, repeats included; more bits (a multiple of 64) fingerprint the
    set of shingles, for the wide radius of a given similarity (`near_duplicates`).

    Documents of equal fingerprint are one node of the graph, so copies add no links. A null or wordless text has
    fingerprint zero and links like any other. component_id is the least doc_id reachable; null doc_ids get their
    group's, which is null only where all are. `kept` marks one document of each group: that of the least doc_id (null
    last) and, of those, of the least text hash; all its copies in id and text are marked. Repeated rows get their
    result each time; other columns are left out; whole texts count, however long; an empty table gives no rows.
    """
    marked = written(fingerprints(docs, words, seed, bits), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    codes = marked.groupBy("code").agg(F.min(first).alias("first"))
    codes = written(codes.withColumn("id", F.monotonically_increasing_id()), "codes")
    roots = components(hamming_links(codes.select("id", "code"), max_bits, bits, blocks), "a", "b")
    joined = codes.join(roots, codes.id == roots.node, "left").select(
        "code", "first", F.coalesce("root", "id").alias("root")
    )
    component = joined.groupBy("root").agg(F.min("first").alias("least"))
    by_code = joined.join(component, "root").select("code", "least")
    kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    out = marked.join(by_code, "code")
    return out.select(
        "doc_id", F.lower(F.hex("code")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"), "text_hash",
        kept.alias("kept")
    )


def near_duplicates(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, bits: int = 512, blocks: int = 48, deviations: float = 1.0
) -> DataFrame:
    """simhash_groups at the radius of a Jaccard similarity of the documents' shingle sets.

    512 bits tell the similarity to about 0.04, so that the radius lies one deviation outside the given similarity. A
    pair at 0.8 agrees on one of 48 blocks of two bytes with probability 0.97, one at 0.85 with 0.996; by its distance
    it's linked with probability 0.84 and 0.99. For over some 10**8 documents take more blocks of more bytes, as chance
    meetings in blocks grow with the square of their number.
    """
    return simhash_groups(docs, words, max_bits=radius(similarity, bits, deviations), bits=bits, blocks=blocks)
