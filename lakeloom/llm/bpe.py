"""Byte-level BPE as a monoid: any cut of a text is encoded on its own, and two encodings of neighbours join.

A token sequence is the encoding of its bytes exactly if each two neighbours in it are the encoding of their own bytes:
the first merge over a boundary would be the first in those two tokens alone as well. So a join encodes the two tokens
at the seam anew and stops as soon as the new window's first and last tokens stand beside the tokens outside; else the
window grows. The pattern that splits a text before the merges joins in the same way: a match that ends three
characters before a cut can't see it, and two scans that share a boundary agree from there on.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import has_columns, ship, text_hash

#: Characters of a leaf; matches that a node keeps at either end; characters behind a match that may decide its end.
LEAF_CHARS, EDGE, LOOK = 1024, 16, 3
#: Longer texts are cut into rows of so many characters, encoded by different tasks.
PART_CHARS = 1 << 20
#: Entries of a worker's caches of seams and halves, which are emptied when full; that of matches holds a third more and
#: becomes the older one, from which matches still in use return. Longer matches aren't cached.
CACHE, CACHED_CHARS, HALF_BYTES = 150_000, 48, 6
#: What stands for a character when only its class matters.
_LIKE = {"letter": "a", "number": "0", "space": "\t", "other": "§"}
#: Rows whose ids leave a worker at once.
ROWS = 256
_NEVER = 1 << 62
_workers: dict[int, Bpe] = {}


class Node(NamedTuple):
    """The encoding of one stretch of text: its first matches with their ids, the ids between, its last matches.

    A short stretch has all its matches in `head` and nothing behind (`cut` is False).
    """

    head: list[str]
    head_ids: list[bytes]
    middle: list[bytes]
    tail: list[str]
    tail_ids: list[bytes]
    cut: bool

    def ids(self) -> bytes:
        return b"".join((*self.head_ids, *self.middle, *self.tail_ids))


def node(matches: list[str], ids: list[bytes]) -> Node:
    if len(matches) <= 2 * EDGE:
        return Node(matches, ids, [], [], [], False)
    return Node(matches[:EDGE], ids[:EDGE], [b"".join(ids[EDGE:-EDGE])], matches[-EDGE:], ids[-EDGE:], True)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file with one base64 token and its rank a line."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def class_exceptions() -> dict[int, str]:
    """Code points that the installed `regex` puts in another class than the installed `tiktoken` (they follow different
    versions of Unicode), each with a character of the class that tiktoken gives it.
    """
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    kinds: dict[str, set] = {}
    moved: set[str] = set()
    for kind, pattern in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("space", r"\s")):
        theirs = tiktoken.Encoding(kind, pat_str=pattern, mergeable_ranks=single, special_tokens={})
        kinds[kind] = set(theirs.decode(theirs.encode_ordinary(every)))
        moved |= kinds[kind] ^ set(regex.findall(pattern, every))
    return {ord(c): _LIKE[next((k for k, held in kinds.items() if c in held), "other")] for c in moved}


class Bpe:
    """Encodes texts by ranks, each match of `pattern` by itself. The pattern must match every character, must not look
    back, nor further than LOOK characters ahead of a match's end, and two scans of it must soon meet, as those of
    patterns made of runs of letters, digits, spaces and other signs do at the end of the first run of letters or digits.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, exceptions: dict[int, str]):
        import regex

        self.ranks = ranks
        self.spelled = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.exceptions = exceptions
        points = sorted(exceptions)
        self.lowest = points[0] if points else 0
        first = [c for c, b in zip(points, [-2, *points], strict=False) if c != b + 1]
        last = [c for c, b in zip(points, [*points, -2][1:], strict=True) if c != b - 1]
        found = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True))
        self.odd = re.compile(f"[{found}]") if found else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seams: dict[tuple, tuple] = {}
        self.halves: dict[bytes, tuple] = {}

    def plain(self, data: bytes) -> tuple[int, ...]:
        """The merges by definition, lowest rank first, then leftmost."""
        if len(data) > 32:
            return self.plain_long(data)
        ranks, parts = self.ranks, [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            found = [ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]  # noqa: B905
            best = min(found)
            if best == _NEVER:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def plain_long(self, data: bytes) -> tuple[int, ...]:
        """The same by a heap of possible merges, for windows of many bytes."""
        n, ranks = len(data), self.ranks
        ends, before = list(range(1, n + 1)), list(range(-1, n))  # by start: where a part ends; by end: the part before
        starts = [True] * n
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapify(heap)
        while heap:
            _, a, c = heappop(heap)
            if not starts[a] or (b := ends[a]) >= n or not starts[b] or ends[b] != c:
                continue  # one of the two parts has been merged since
            starts[b], ends[a] = False, c
            if c < n:
                before[c] = a
                if (r := ranks.get(data[a : ends[c]])) is not None:
                    heappush(heap, (r, a, ends[c]))
            if a and (r := ranks.get(data[before[a] : c])) is not None:
                heappush(heap, (r, before[a], c))
        return tuple(ranks[data[k : ends[k]]] for k in range(n) if starts[k])

    def seam(self, a: int, b: int) -> tuple[int, ...]:
        """The encoding of two tokens' bytes."""
        made = self.seams.get((a, b))
        if made is None:
            if len(self.seams) >= CACHE:
                self.seams.clear()
            made = self.seams[a, b] = self.plain(self.spelled[a] + self.spelled[b])
        return made

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours' bytes from their encodings."""
        i, j, step, spelled, seams = len(left) - 1, 1, 1, self.spelled, self.seams
        made = seams.get((left[i], right[0])) or self.seam(left[i], right[0])
        while True:
            # Tokens that the window leaves as they were stand beside those outside already.
            before = i == 0 or made[0] == left[i] or self.seam(left[i - 1], made[0]) == (left[i - 1], made[0])
            after = j == len(right) or made[-1] == right[j - 1] or self.seam(made[-1], right[j]) == (made[-1], right[j])
            if before and after:
                return (*left[:i], *made, *right[j:])
            i, j, step = max(0, i - step * (not before)), min(len(right), j + step * (not after)), 2 * step
            made = self.plain(b"".join(map(spelled.__getitem__, (*left[i:], *right[:j]))))

    def merge(self, data: bytes) -> tuple[int, ...]:
        """The encoding of one match: halves by recursion down to what is a token by itself."""
        if (made := self.halves.get(data)) is not None:
            return made
        rank = self.ranks.get(data)
        if rank is not None and self.plain(data) == (rank,):
            made = (rank,)
        else:
            half = len(data) // 2
            made = self.join(self.merge(data[:half]), self.merge(data[half:]))
        if len(data) <= HALF_BYTES:
            if len(self.halves) >= CACHE:
                self.halves.clear()
            self.halves[data] = made
        return made

    def match_ids(self, match: str) -> bytes:
        """A match's ids, four bytes each; a match that is a token is that token, as in the library."""
        made = self.known.get(match)
        if made is None:
            made = self.older.get(match)
            if made is None:
                data = match.encode()
                rank = self.ranks.get(data)
                made = pack_ids(self.merge(data) if rank is None else (rank,))
            if len(match) <= CACHED_CHARS:
                if len(self.known) >= 4 * CACHE // 3:
                    self.known, self.older = {}, self.known
                self.known[match] = made
        return made

    def matches(self, text: str) -> list[str]:
        if self.odd is None or text.isascii() or self._plain_latin(text) or not self.odd.search(text):
            return self.pattern.findall(text)
        return [text[slice(*m.span())] for m in self.pattern.finditer(text.translate(self.exceptions))]

    def _plain_latin(self, text: str) -> bool:
        """Whether all characters lie below the first exception, by a test that costs a copy."""
        if self.lowest < 256:
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def leaf(self, text: str) -> Node:
        matches = self.matches(text)
        ids = list(map(self.known.get, matches))
        if None in ids:
            ids = [self.match_ids(m) if i is None else i for m, i in zip(matches, ids, strict=True)]
        return node(matches, ids)

    def tree(self, text: str) -> Node:
        """The encoding of a text: halves by recursion, joined."""
        if len(text) <= LEAF_CHARS:
            return self.leaf(text)
        half = len(text) // 2
        return self.join_nodes(self.tree(text[:half]), self.tree(text[half:]))

    def join_nodes(self, a: Node, b: Node) -> Node:
        if not b.head:
            return a
        if not a.head:
            return b
        left, left_ids = (a.tail, a.tail_ids) if a.cut else (a.head, a.head_ids)
        i, unsure = len(left), 0
        while i and unsure < LOOK:
            i -= 1
            unsure += len(left[i])
        new, upto = self._rescan(left[i:], b)
        ids = [self._over(m, left, left_ids, b) if k == 0 else self.match_ids(m) for k, m in enumerate(new)]
        # A long match that both sides share isn't encoded again, but joined.
        matches, made = left[:i] + new + b.head[upto:], left_ids[:i] + ids + b.head_ids[upto:]
        if not (a.cut or b.cut):
            return node(matches, made)
        if a.cut and b.cut:
            return Node(a.head, a.head_ids, [*a.middle, b"".join(made), *b.middle], b.tail, b.tail_ids, True)
        if a.cut:
            inner, keep = b"".join(made[:-EDGE]), slice(-EDGE, None)
            return Node(a.head, a.head_ids, [*a.middle, inner], matches[keep], made[keep], True)
        return Node(matches[:EDGE], made[:EDGE], [b"".join(made[EDGE:]), *b.middle], b.tail, b.tail_ids, True)

    def _rescan(self, last: list[str], b: Node) -> tuple[list[str], int]:
        """The matches from the first unsure one of the left side to where they meet a boundary of the right side, and
        the number of the right side's matches that they replace.
        """
        taken = 2
        while True:
            taken = min(taken * 2, len(b.head))
            text = "".join((*last, *b.head[:taken]))
            end = len(text) - (LOOK if b.cut or taken < len(b.head) else 0)
            bounds, at = {}, sum(map(len, last))
            for k in range(taken):
                at += len(b.head[k])
                bounds[at] = k + 1
            new, at = [], 0
            for m in self.matches(text):
                at += len(m)
                new.append(m)
                if at > end:
                    break
                if at in bounds:
                    return new, bounds[at]
            if taken == len(b.head):
                raise ValueError(f"two scans of the pattern don't meet within {EDGE} matches")

    def _over(self, match: str, left: list[str], left_ids: list[bytes], b: Node) -> bytes:
        """The first new match's ids; a long one made of the left side's last match and the right side's first is joined
        from their ids.
        """
        if len(match) > CACHED_CHARS and match == left[-1] + b.head[0] and match.encode() not in self.ranks:
            sides = [
                unpack_ids(ids) if len(ids) > 4 else self.merge(m.encode())
                for m, ids in ((left[-1], left_ids[-1]), (b.head[0], b.head_ids[0]))
            ]
            return pack_ids(self.join(*sides))
        return self.match_ids(match)

    def decode(self, ids: tuple[int, ...]) -> bytes:
        """The bytes of ids: those of the first half, then those of the second."""
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.spelled.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def pack_ids(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def unpack_ids(data: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(data) // 4}I", data)


def _few(batches: Iterator) -> Iterator:
    """The batches in slices of some hundred rows, so that a worker holds few texts and their ids at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def worker_bpe(shared) -> Bpe:
    """One encoder with its caches for each Python worker and set of ranks."""
    key = hash((shared.value[0], shared.value[1]))
    if key not in _workers:
        lines, pattern, exceptions = shared.value
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}
        _workers[key] = Bpe(ranks, pattern, exceptions)
    return _workers[key]


def _shared(docs: DataFrame, ranks: str, pattern: str):
    """The rank file's bytes (some MB, whatever the table), the pattern and the exceptions, for the tasks."""
    ship(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast((Path(ranks).read_bytes(), pattern, class_exceptions()))


_EDGE = "array<struct<text: string, ids: binary>>"


def bpe_encode(docs: DataFrame, ranks: str, pattern: str, part_chars: int = PART_CHARS) -> DataFrame:
    """(doc_id, text_hash, n_tokens, ids) of every row; ids are unsigned 32-bit integers, little-endian, end to end.

    `ranks` is a file of base64 tokens and ranks, `pattern` splits texts before the merges. Texts are not shuffled; only
    one of more than `part_chars` characters is cut into rows, which any task may encode, and its parts are joined
    pairwise as a tree, each with its first and last matches and the ids between. Null and empty texts have no ids;
    rows that repeat a doc_id or have none stay one each; extra columns are left out.
    """
    shared = _shared(docs, ranks, pattern)
    rows = has_columns(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), text_hash(F.col("text")).alias("text_hash")
    )
    long = F.char_length("text") > part_chars
    kinds = "doc_id long, text_hash long, n_tokens long, ids binary"

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = worker_bpe(shared)
        for batch in _few(batches):
            ids = [bpe.tree(text).ids() for text in batch.column("text").to_pylist()]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), counts, pa.array(ids, pa.binary())],
                ["doc_id", "text_hash", "n_tokens", "ids"],
            )

    def encode_parts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = worker_bpe(shared)
        edge = pa.list_(pa.struct([("text", pa.string()), ("ids", pa.binary())]))
        for batch in batches:
            nodes = [bpe.tree(text) for text in batch.column("text").to_pylist()]
            heads = [[{"text": t, "ids": i} for t, i in zip(n.head, n.head_ids, strict=True)] for n in nodes]
            tails = [[{"text": t, "ids": i} for t, i in zip(n.tail, n.tail_ids, strict=True)] for n in nodes]
            middle, cut = [b"".join(n.middle) for n in nodes], [n.cut for n in nodes]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["row", "doc_id", "text_hash", "part"]).columns, pa.array(heads, edge),
                    pa.array(middle, pa.binary()), pa.array(tails, edge), pa.array(cut),
                ],
                ["row", "doc_id", "text_hash", "part", "head", "middle", "tail", "cut"],
            )

    def join_parts(table):
        import pyarrow as pa

        bpe = worker_bpe(shared)
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        nodes = [
            Node(
                [x["text"] for x in r["head"]], [x["ids"] for x in r["head"]], [r["middle"]],
                [x["text"] for x in r["tail"]], [x["ids"] for x in r["tail"]], r["cut"],
            )
            for r in rows
        ]
        while len(nodes) > 1:
            nodes = [bpe.join_nodes(*nodes[k : k + 2]) if k + 1 < len(nodes) else nodes[k] for k in range(0, len(nodes), 2)]
        ids = nodes[0].ids()
        return pa.table({
            "doc_id": pa.array([rows[0]["doc_id"]], pa.int64()), "text_hash": pa.array([rows[0]["text_hash"]], pa.int64()),
            "n_tokens": pa.array([len(ids) // 4], pa.int64()), "ids": pa.array([ids], pa.binary()),
        })

    part = F.posexplode(F.sequence(F.lit(0), (F.char_length("text") - 1).cast("int"), F.lit(part_chars)))
    parts = (
        rows.where(long)
        .withColumn("row", F.monotonically_increasing_id())
        .select("*", part.alias("part", "at"))
        .select("row", "doc_id", "text_hash", "part", F.expr(f"substring(text, at + 1, {part_chars})").alias("text"))
        .repartition("row", "part")
        .mapInArrow(
            encode_parts,
            f"row long, doc_id long, text_hash long, part int, head {_EDGE}, middle binary, tail {_EDGE}, cut boolean",
        )
    )
    return rows.where(~long).mapInArrow(encode, kinds).unionByName(parts.groupBy("row").applyInArrow(join_parts, kinds))


def bpe_decode(encoded: DataFrame, ranks: str, pattern: str = "") -> DataFrame:
    """The rows of bpe_encode() with `decoded`: the bytes that their ids stand for. Null ids decode to null."""
    shared = _shared(encoded, ranks, pattern)
    kinds = ", ".join(f"{name} {kind}" for name, kind in encoded.dtypes)

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = worker_bpe(shared)
        for batch in _few(batches):
            ids = batch.column("ids").to_pylist()
            made = pa.array([None if x is None else bpe.decode(unpack_ids(x)) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(decode, f"{kinds}, decoded binary")
