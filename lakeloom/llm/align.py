"""Alignment of two tokenizers: which of their tokens overlap in each text, counted over the corpus by an inverted index of
pair bitmaps.

Documents are numbered inside blocks. For each block and pair of ids the index holds a compressed bitmap of the documents
in which the two are linked, and planes for multiplicities: bit k of (links in the document - 1) lies in plane k. A bitmap
is a sorted list of 16-bit numbers or, where that is longer, 65,536 bits. Blocks hold different documents, so the OR over
blocks is their bitmaps side by side, and its popcount the sum of theirs.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import has_columns, ship, text_hash, written
from .tokens import _PLAIN, _SPACE, _UNSAFE, load_spec

#: Texts are aligned in steps of about so many bytes; a block closes at so many bytes or documents. A cache has two
#: generations of so many units; longer units aren't cached.
STEP_BYTES, BLOCK_BYTES, BLOCK_DOCS, CACHE, CACHED_CHARS = 2 << 20, 8 << 20, 1 << 16, 80_000, 48
#: Bytes of a bitmap as bits, and how many documents make that the shorter form.
DENSE_BYTES = BLOCK_DOCS // 8
DENSE = DENSE_BYTES // 2
#: The level of the bitmap of all documents; planes count from 0.
PRESENT = -1
STORED = (
    "block long, doc int, doc_id long, text_hash long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "a int, b int, level int, n int, bitmap binary"
)
_workers: dict[int, Aligner] = {}


def byte_level() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others by
    number from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Links tokens of A (byte-level BPE of the tokenizers library) to tokens of B (a SentencePiece model that puts a space
    before a text) in a space and the text.

    A text is cut before a space where both tokenizers start a token; what lies between cuts is a unit, and each distinct
    unit is aligned once.
    """

    def __init__(self, spec: str, model: bytes):
        import re

        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        code = byte_level()
        named = {i: t for t, i in self.a.get_vocab().items()}
        spelled = {i: all(c in code for c in t) for i, t in named.items()}
        self.a_bytes = [
            bytes(code[c] for c in named[i]) if spelled.get(i) else named.get(i, "").encode() for i in range(max(named) + 1)
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.space = self.b.piece_to_id("▁")
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a, self.size_b = len(self.a_bytes), len(self.b_bytes)
        self.kind = np.uint32 if self.size_a * self.size_b < 1 << 32 else np.uint64
        self.width_a, self.width_b = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        top = max(self.size_a, self.size_b)
        digits = np.array([f"{i}" for i in range(top)], f"S{len(str(top - 1)) + 1}")
        self.digits = digits.view(np.uint8).reshape(top, -1)
        self.n_digits = np.char.str_len(digits).astype(np.int64)
        self.words: dict[str, list[int]] = {}
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def units(self, units: list[str]) -> list[tuple]:
        """(codes of the linked pairs, groups as text, tokens of A, tokens of B, groups) of each unit, a text that begins
        with the added space; an empty tuple where B's bytes aren't the unit's.
        """
        import numpy as np

        ours = self._ours(units)
        theirs = self.b.encode([u[1:] for u in units], num_threads=1)
        for k, unit in enumerate(units):
            if len(unit) == 1:
                theirs[k] = [self.space]
        out: list[tuple] = [()] * len(units)
        sound = list(range(len(units)))
        if not self._same(units, ours, self.a_bytes, self.width_a) or not self._same(units, theirs, self.b_bytes, self.width_b):
            told = [(u.encode(), b"".join(map(self.b_bytes.__getitem__, x))) for u, x in zip(units, theirs, strict=True)]
            sound = [
                k for k, (data, x) in enumerate(told) if data == x == b"".join(map(self.a_bytes.__getitem__, ours[k]))
            ]
            ours, theirs = ([x[k] for k in sound] for x in (ours, theirs))
        if not sound:
            return out
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ours, theirs))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (ours, theirs))
        end_a, end_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        ends = np.sort(np.r_[end_a, end_b], kind="stable")  # two sorted runs
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]]  # a stretch between two lies in one token of A and of B: a link
        in_a, in_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        codes = (a[in_a] * self.size_b + b[in_b]).astype(self.kind)
        both = ends[(end_a[in_a] == ends) & (end_b[in_b] == ends)]
        stops = end_a[np.cumsum(n_a) - 1]
        links, groups = np.searchsorted(ends, stops, side="right"), np.searchsorted(both, stops, side="right")
        text, places = self._told(a, b, np.searchsorted(both, end_a), np.searchsorted(both, end_b))
        places = places[np.cumsum(n_a) + np.cumsum(n_b)]
        codes, width, n_groups = codes.tobytes(), codes.itemsize, np.diff(np.r_[0, groups]).tolist()
        links, places, n_a, n_b = ((np.r_[0, x]).tolist() for x in (links, places, n_a, n_b))
        for k, at in enumerate(sound):
            out[at] = (
                codes[width * links[k] : width * links[k + 1]], text[places[k] : places[k + 1]], n_a[k + 1], n_b[k + 1],
                n_groups[k],
            )
        return out

    def _ours(self, units: list[str]) -> list[list[int]]:
        """A's ids of each unit; words of ASCII letters and the signs after them, which A never joins, on their own."""
        made, rare, words = [], [], self.words
        for k, unit in enumerate(units):
            ids = None
            if plain := _PLAIN.fullmatch(unit):
                word, signs = plain.groups()
                ids = words.get(word) or self._word(word)
                if signs:
                    ids = ids + (words.get(signs) or self._word(signs))
            else:
                rare.append(k)
            made.append(ids)
        for k, e in zip(rare, self.a.encode_batch_fast([units[k] for k in rare], add_special_tokens=False), strict=True):
            made[k] = e.ids
        return made

    def _word(self, word: str) -> list[int]:
        """The ids of letters (maybe with a space before) or of signs by the library's model, in which U+0120 is a space."""
        ids = [t.id for t in self.a.model.tokenize(word.replace(" ", "\u0120"))]
        if len(word) <= CACHED_CHARS:
            if len(self.words) >= CACHE:
                self.words.clear()
            self.words[word] = ids
        return ids

    def _same(self, units: list[str], ids: list[list[int]], spelled: list[bytes], width) -> bool:
        """Whether the tokens' bytes are each unit's."""
        import numpy as np

        flat, n = list(chain.from_iterable(ids)), np.fromiter(map(len, ids), np.int64, len(ids))
        if not n.all() or b"".join(map(spelled.__getitem__, flat)) != "".join(units).encode():
            return False
        held = np.add.reduceat(width[np.array(flat)], np.cumsum(n) - n)
        return held.tolist() == [len(u) if u.isascii() else len(u.encode()) for u in units]

    def _told(self, a, b, group_a, group_b) -> tuple:
        """All groups as `a1,a2|b1;a3|b2,b3;`, and where the text of each token begins (and the end)."""
        import numpy as np

        where_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        where_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        ids, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[where_a], ids[where_b] = a, b
        sign[where_a[np.r_[group_a[1:] != group_a[:-1], True]]] = ord("|")
        sign[where_b[np.r_[group_b[1:] != group_b[:-1], True]]] = ord(";")
        n, rows = self.n_digits[ids], self.digits[ids]
        rows[np.arange(len(ids)), n] = sign
        kept = np.arange(rows.shape[1]) <= n[:, None]
        return rows[kept].tobytes(), np.r_[0, np.cumsum(n + 1)]

    def _known(self, units: list[str]) -> list[tuple]:
        made = list(map(self.known.get, units))
        missing = [k for k, x in enumerate(made) if x is None]
        rare = []
        for k in missing:
            made[k] = self.older.get(units[k])
            if made[k] is None:
                rare.append(k)
        for k, x in zip(rare, self.units([units[k] for k in rare]) if rare else [], strict=True):
            made[k] = x
        if len(self.known) + len(missing) > CACHE:
            self.known, self.older = {}, self.known
        self.known.update((units[k], made[k]) for k in missing if len(units[k]) <= CACHED_CHARS)
        return made

    def align(self, texts) -> tuple:
        """For an Arrow array of texts: tokens of A, of B, groups and links by text, the groups as text, and the codes of
        all links end to end.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        whole = pc.match_substring_regex(texts, rf"^{_SPACE}|  | \z|{_UNSAFE}").to_numpy(zero_copy_only=False)
        whole = whole.copy() if self.cuts else np.ones(len(texts), bool)
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        whole &= ~empty
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        flat = split.flatten().dictionary_encode()
        made = self._known([f" {p}" for p in flat.dictionary.to_pylist()])
        index = flat.indices.to_numpy()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        sound = np.array([bool(x) for x in made], bool)
        broken = np.zeros(len(texts), bool)
        if not sound.all():
            broken = np.diff(np.r_[0, np.cumsum(~sound[index])][bounds]) > 0
        alone = np.flatnonzero((whole | broken) & ~empty)
        by_text = {}
        for k in alone.tolist():
            by_text[k] = self.units([f" {texts[k].as_py()}"])[0]
        none = (b"", b"", 0, 0, 0)
        made = [x or none for x in made]
        counts = np.stack([np.fromiter((x[c] for x in made), np.int64, len(made)) for c in (2, 3, 4)], axis=1)
        sums = np.cumsum(np.r_[np.zeros((1, 3), np.int64), counts[index]], axis=0)[bounds]
        told = np.diff(sums, axis=0)
        codes = np.frombuffer(b"".join(x[0] for x in made), self.kind)
        width = np.array([len(x[0]) for x in made], np.int64) // codes.itemsize
        starts = np.cumsum(width) - width
        length = width[index]
        length[np.repeat((whole | broken | empty), np.diff(bounds))] = 0
        stop = np.cumsum(length)
        taken = codes[np.repeat(starts[index] - (stop - length), length) + np.arange(int(length.sum()))]
        links = np.diff(np.r_[0, stop][bounds])
        parts, pieces, order = [], [x[1] for x in made], index.tolist()
        for k, (i, j) in enumerate(zip(bounds, bounds[1:], strict=False)):
            x = by_text.get(k)
            alone_or_none = k in by_text or empty[k]
            parts.append((x[1] if x else b"")[:-1] if alone_or_none else b"".join(map(pieces.__getitem__, order[i:j]))[:-1])
        told[empty] = 0
        runs = None
        for k, x in by_text.items():
            told[k] = x[2:] if x else 0
            if x:
                runs = np.split(taken, np.cumsum(links)[:-1]) if runs is None else runs
                runs[k] = np.frombuffer(x[0], self.kind)
        if runs is not None:
            taken, links = np.concatenate(runs), np.array(list(map(len, runs)), np.int64)
        return (*told.T, links, pa.array(parts, pa.binary()).cast(pa.string()), taken)


def bitmaps(codes, docs) -> tuple:
    """(code, level, n, bitmap) of a block's links: one entry for each pair and level, from the links' codes and documents.
    """
    import numpy as np
    import pyarrow as pa

    links = codes.astype(np.uint64)
    links <<= np.uint64(16)
    links |= docs
    links.sort()  # in place, as a block's links are the largest arrays here
    first = np.flatnonzero(np.r_[True, links[1:] != links[:-1]]) if len(links) else np.zeros(0, np.int64)
    more = np.diff(np.r_[first, len(links)]) - 1  # links of the pair in the document beyond the first
    held = links[first]
    entries, levels = [held], [np.zeros(len(held), np.int64)]
    for plane in range(int(more.max(initial=0)).bit_length()):
        some = held[more >> plane & 1 == 1]
        entries.append(some)
        levels.append(np.full(len(some), plane + 1))
    entries, levels = np.concatenate(entries), np.concatenate(levels)
    order = np.lexsort((entries, levels))
    entries, levels = entries[order], levels[order]
    code, doc = entries >> np.uint64(16), (entries & np.uint64(0xFFFF)).astype("<u2")
    start = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (levels[1:] != levels[:-1])]) if len(code) else np.zeros(0, np.int64)
    n = np.diff(np.r_[start, len(code)])
    size = np.where(n > DENSE, DENSE_BYTES, 2 * n)
    place = np.r_[0, np.cumsum(size)]
    out = np.zeros(int(place[-1]) // 2, "<u2")
    listed = np.repeat(n <= DENSE, n)
    out[(np.repeat(place[:-1] // 2 - start, n) + np.arange(len(doc)))[listed]] = doc[listed]
    for k in np.flatnonzero(n > DENSE).tolist():
        bits = np.zeros(BLOCK_DOCS, np.uint8)
        bits[doc[start[k] : start[k] + n[k]]] = 1
        out[place[k] // 2 : place[k + 1] // 2] = np.packbits(bits, bitorder="little").view("<u2")
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(place), pa.py_buffer(out)])
    return code[start], levels[start] - 1, n, made.cast(pa.binary())


def members(n, bitmap) -> tuple:
    """(entry, document) of all documents of an Arrow array of bitmaps with popcounts `n`."""
    import numpy as np
    import pyarrow as pa

    bitmap = bitmap.cast(pa.large_binary())
    place = np.frombuffer(bitmap.buffers()[1], np.int64)[bitmap.offset : bitmap.offset + len(bitmap) + 1]
    held = np.frombuffer(bitmap.buffers()[2] or b"", np.uint8)
    listed = np.flatnonzero(n <= DENSE)
    entry, docs = [], []
    if len(listed):
        m = n[listed]
        at = np.repeat(place[listed] - 2 * (np.cumsum(m) - m), m) + 2 * np.arange(int(m.sum()))
        entry.append(np.repeat(listed, m))
        docs.append(held[at].astype(np.int64) | held[at + 1].astype(np.int64) << 8)
    for k in np.flatnonzero(n > DENSE).tolist():
        found = np.flatnonzero(np.unpackbits(held[place[k] : place[k + 1]], bitorder="little"))
        entry.append(np.full(len(found), k))
        docs.append(found)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *entry]), np.concatenate([none, *docs])


def worker_aligner(shared) -> Aligner:
    """One aligner and cache for each Python worker."""
    key = hash(shared.value)
    if key not in _workers:
        _workers[key] = Aligner(*shared.value)
    return _workers[key]


def pair_index(
    docs: DataFrame, a: str, b: str, keep: dict[str, Column] | None = None, block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """The stored alignment: a row a document (doc_id, text_hash, n_a, n_b, n_groups, n_links, groups; `a` is null) and the
    bitmaps of each block (a, b, level, n, bitmap; doc_id is null), in one table, as texts are read once.

    `a` is a file of the tokenizers library, `b` a SentencePiece model. `keep` says what is kept of a document's columns
    beside its numbers: by default the groups as text, else columns made of them. Null and empty texts, and those whose
    bytes B doesn't give back, have no tokens. Rows that repeat an id, or have none, are documents of their own. A block
    holds `block_docs` documents (65,536 at most) or some BLOCK_BYTES of text.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((load_spec(a), Path(b).read_bytes()))

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        aligner, names = worker_aligner(shared), [x.split()[0] for x in STORED.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        kinds = {x.split()[0]: kinds[x.split()[1]] for x in STORED.split(", ")}
        block, docs, size, codes, owner = TaskContext.get().partitionId() << 32, 0, 0, [], []

        def rows(count: int, **columns) -> pa.RecordBatch:
            made = [columns.get(x, None) for x in names]
            made = [
                pa.nulls(count, kinds[x]) if c is None else c if isinstance(c, pa.Array) else pa.array(c, kinds[x])
                for x, c in zip(names, made, strict=True)
            ]
            return pa.RecordBatch.from_arrays(made, names)

        def index() -> Iterator:
            code, level, n, bitmap = bitmaps(np.concatenate(codes), np.concatenate(owner))
            for k in range(0, len(n), 100_000):
                some = slice(k, k + 100_000)
                yield rows(
                    len(n[some]), block=np.full(len(n[some]), block), a=code[some] // aligner.size_b,
                    b=code[some] % aligner.size_b, level=level[some], n=n[some], bitmap=bitmap[some],
                )

        for batch in (b.slice(k, 1_000) for b in batches for k in range(0, b.num_rows, 1_000)):
            texts, at = batch.column("text"), 0
            ends = np.cumsum([len(x.as_buffer()) for x in texts])
            while at < len(texts):
                if docs >= block_docs or size >= BLOCK_BYTES:
                    yield from index()
                    block, docs, size, codes, owner = block + 1, 0, 0, [], []
                before = int(ends[at - 1]) if at else 0
                upto = int(np.searchsorted(ends, before + STEP_BYTES, side="right"))
                upto = min(max(at + 1, upto), at + block_docs - docs)
                n_a, n_b, n_groups, n_links, groups, linked = aligner.align(texts.slice(at, upto - at))
                places = np.arange(docs, docs + upto - at)
                yield rows(
                    upto - at, block=np.full(upto - at, block), doc=places,
                    doc_id=batch.column("doc_id").slice(at, upto - at),
                    text_hash=batch.column("text_hash").slice(at, upto - at),
                    n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, groups=groups,
                )
                codes.append(linked)
                owner.append(np.repeat(places, n_links).astype(np.uint16))
                docs, size, at = docs + upto - at, size + int(ends[upto - 1]) - before, upto
        if codes:
            yield from index()

    rows = has_columns(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), text_hash(F.col("text")).alias("text_hash")
    )
    kept = {"groups": F.col("groups")} if keep is None else keep
    stored = rows.mapInArrow(build, STORED)
    own = [F.when(F.col("a").isNull(), c).alias(name) for name, c in kept.items()]
    return written(stored.select(*(c for c in stored.columns if c != "groups"), *own), "alignment")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): in how many documents and how often each pair is linked in the whole corpus, and
    whether no other pair of the same `b` is linked more often. A written table.
    """
    held = index.where("a is not null")
    weight = F.when(F.col("level") == PRESENT, 1).otherwise(F.expr("shiftleft(1L, level)"))
    counts = held.groupBy("a", "b").agg(
        F.sum(F.when(F.col("level") == PRESENT, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(weight * F.col("n")).alias("n_links")
    )
    counts = written(counts, "pair-counts")
    # One row for each token of B: bounded by its vocabulary.
    most = F.broadcast(counts.groupBy("b").agg(F.max("n_links").alias("most")))
    return counts.join(most, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def pair_documents(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, doc_id, text_hash, n_links) of all documents in which one of `pairs` (a, b) is linked."""
    ship(index.sparkSession)

    def spread(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n, level = (batch.column(x).to_numpy().astype(np.int64) for x in ("n", "level"))
            entry, doc = members(n, batch.column("bitmap"))
            rows = pa.array(entry)
            weight = np.where(level == PRESENT, 1, 1 << np.maximum(level, 0))[entry]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x).take(rows) for x in ("a", "b", "block")), pa.array(doc, pa.int32()), pa.array(weight)],
                ["a", "b", "block", "doc", "n"],
            )

    found = index.where("a is not null").join(pairs.select("a", "b").distinct(), ["a", "b"], "left_semi")
    found = found.select("a", "b", "block", "level", "n", "bitmap").mapInArrow(spread, "a int, b int, block long, doc int, n long")
    found = found.groupBy("a", "b", "block", "doc").agg(F.sum("n").alias("n_links"))
    docs = index.where("a is null").select("block", "doc", "doc_id", "text_hash")
    return found.join(docs, ["block", "doc"]).select("a", "b", "doc_id", "text_hash", "n_links")


def align_tokenizers(
    docs: DataFrame, a: str, b: str, keep: dict[str, Column] | None = None, block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """(doc_id, text_hash, n_a, n_b, n_groups, n_links, n_best, count_sum, and what `keep` names) of every row of `docs`.

    A space and the text are encoded by both tokenizers, without special tokens. Byte offsets where a token of both ends
    cut the text into groups; tokens whose bytes overlap are linked. A link's count is how often its pair of ids is
    linked in the corpus: count_sum adds them up, n_best counts the links whose count is the highest of their B id.
    Null and empty texts, and those whose bytes B doesn't give back, have no tokens and only zeros; extra columns are
    left out; an empty table gives no rows.

    The index is read for the counts; the counts meet the pairs of each block (one narrow row a pair and block, so no pair
    has more rows than there are blocks) and go to the blocks, where the postings add their scores to the documents.
    Bitmaps are shuffled once. A block holds some BLOCK_BYTES of text at most, or one longer text.
    """
    index = pair_index(docs, a, b, keep, block_docs)
    held = index.where("a is null").drop("a", "b", "level", "n", "bitmap")
    counts = pair_counts(index).select("a", "b", F.col("n_links").alias("count"), "best")
    postings = index.where("a is not null").select("a", "b", "block", "level", "n", "bitmap")
    scores = postings.where(F.col("level") == PRESENT).select("a", "b", "block").join(counts, ["a", "b"])
    told = postings.unionByName(scores, allowMissingColumns=True).withColumnRenamed("block", "in_block")
    kinds = ", ".join(f"{name} {kind}" for name, kind in held.dtypes) + ", n_best long, count_sum long"

    def score(ours, told):
        import numpy as np
        import pyarrow as pa

        pair = told.column("a").to_numpy().astype(np.int64) << 32 | told.column("b").to_numpy()
        known = told.column("count").is_valid().to_numpy()
        scores, postings = told.filter(pa.array(known)), told.filter(pa.array(~known))
        order = np.argsort(pair[known])
        at = order[np.searchsorted(pair[known], pair[~known], sorter=order)]
        count = scores.column("count").to_numpy().astype(np.int64)[at]
        best = scores.column("best").to_numpy().astype(np.int64)[at]
        n, level = (postings.column(x).to_numpy().astype(np.int64) for x in ("n", "level"))
        weight = np.where(level == PRESENT, 1, 1 << np.maximum(level, 0))
        top = int(np.max(ours.column("doc").to_numpy(), initial=-1)) + 1
        n_best, total = np.zeros(top, np.int64), np.zeros(top, np.int64)
        entry, doc = members(n, postings.column("bitmap").combine_chunks())
        np.add.at(n_best, doc, (best * weight)[entry])
        np.add.at(total, doc, (count * weight)[entry])
        place = ours.column("doc").to_numpy()
        return ours.append_column("n_best", pa.array(n_best[place])).append_column("count_sum", pa.array(total[place]))

    scored = held.groupBy("block").cogroup(told.groupBy("in_block")).applyInArrow(score, kinds)
    names = [c for c in held.columns if c not in ("block", "doc")]
    return scored.select(*names, "n_best", "count_sum")
