"""Token ids of whole texts by a tokenizer of the tokenizers library, each distinct piece of text encoded once."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are encoded in steps of about so many bytes. A cache has two generations of so many pieces: a full one becomes
#: the older
#: one, from which pieces still in use return, so that a worker's memory is bounded. Longer pieces aren't cached.
STEP_BYTES, CACHE_PIECES, PIECE_CHARS = 8 << 20, 200_000, 48
#: What Unicode takes for white space, as a class of RE2.
_SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Splitting before a space is safe unless white space stands on both sides of it, or before it at the text's end.
_UNSAFE = rf"{_SPACE} (?:{_SPACE}|\z)"
#: A word of ASCII letters with signs after it that every supported pattern takes together, as most pieces are.
_PLAIN = re.compile(r"( ?[A-Za-z]+)([.,;:!?%&*#$)|]*)")
_workers: dict[str, PieceTokenizer] = {}


def load_spec(path: str) -> str:
    """The tokenizer's JSON, read on the driver; it travels with the tasks, so executors need no file."""
    return Path(path).read_text(encoding="utf-8")


def worker_tokenizer(spec: str) -> PieceTokenizer:
    """One tokenizer and cache for each Python worker."""
    key = str(hash(spec))
    if key not in _workers:
        _workers[key] = PieceTokenizer(spec)
    return _workers[key]


class PieceTokenizer:
    """encode(texts) gives the same ids as the library's encode on whole texts with add_special_tokens=False.

    A text is cut where no token can span the cut: at ASCII white space where the tokenizer drops it, else before a
    space that stands between a word and a word. Cutting, finding the distinct pieces and laying their ids end to end
    are vectorised; only pieces that this worker hasn't seen go to the library. Texts that hold a special token's text,
    or white space around a space, and all texts of tokenizers of another build, are encoded whole by the library.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        said = json.loads(spec)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t["content"] for t in said["added_tokens"]]
        normal, pre = said["normalizer"], said["pre_tokenizer"]
        steps = [s["type"] for s in (normal or {}).get("normalizers", [])]
        parts = [p["type"] for p in (pre or {}).get("pretokenizers", [])]
        self.kind = "whole"
        if normal is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.kind = "spaces kept"
        elif steps == [
            "NFC", "Replace", "Lowercase"
        ] and parts == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["invert"]:
            self.kind = "spaces dropped"
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[tuple]:
        """(ids, counts) for one run of texts after the other: the ids of the run laid end to end, and their number by
        text; null is empty.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + STEP_BYTES, side="right")))
            yield self._run(texts.slice(at, upto - at))
            at = upto

    def _run(self, texts: pa.Array) -> tuple:
        whole = self._whole(texts)
        safe = texts if not whole.any() else pc.if_else(pa.array(whole), "", texts)
        ids, counts = self._cut(safe) if self.kind != "whole" else (
            np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        )
        if not whole.any():
            return ids, counts
        runs = np.split(ids, np.cumsum(counts)[:-1])
        for k in np.flatnonzero(whole).tolist():
            runs[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, self.dtype)
        return np.concatenate(runs), np.array([len(r) for r in runs], np.int64)

    def _whole(self, texts: pa.Array):
        """Which texts must not be cut."""
        if self.kind == "whole":
            return np.ones(len(texts), bool)
        found = np.zeros(len(texts), bool)
        for sign in self.special:
            found |= pc.match_substring(texts, sign).to_numpy(zero_copy_only=False)
        if self.kind == "spaces kept":
            found |= pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        return found

    def _cut(self, texts: pa.Array) -> tuple:
        kept = self.kind == "spaces kept"
        split = pc.split_pattern(texts, " ") if kept else pc.ascii_split_whitespace(texts)
        places, flat = split.offsets.to_numpy() - split.offsets[0].as_py(), split.flatten()
        coded = flat.dictionary_encode()
        index = coded.indices.to_numpy().copy()
        pieces = coded.dictionary.to_pylist()
        if kept:  # each piece but a text's first stands for itself with a space before it
            first = flat.take(pa.array(places[:-1])).dictionary_encode()
            index[places[:-1]] = len(pieces) + first.indices.to_numpy()
            pieces = [" " + p for p in pieces] + first.dictionary.to_pylist()
        made = self._known(pieces)
        table = np.frombuffer(b"".join(made), self.dtype)
        width = np.fromiter(map(len, made), np.int64, len(made)) // table.itemsize
        begin = np.cumsum(width) - width
        length = width[index]
        ends = np.cumsum(length)
        # The ids of the pieces one after another: a place in the table, plus one for each id until the piece ends.
        small = np.int32 if max(len(table), int(length.sum())) < 1 << 31 else np.int64
        take = np.repeat((begin[index] - (ends - length)).astype(small), length)
        take += np.arange(len(take), dtype=small)
        counts = np.diff(np.r_[0, ends][places])
        return table[take], counts

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of each distinct piece."""
        made = list(map(self.pieces.get, pieces))
        missing = [k for k, ids in enumerate(made) if ids is None]
        if not missing:
            return made
        rare, older = [], self.older.get
        for k in missing:
            ids = older(p := pieces[k])
            if ids is None and (plain := _PLAIN.fullmatch(p)):
                word, signs = plain.groups()
                ids = (self.words.get(word) or self._word(word)) + (
                    (self.words.get(signs) or self._word(signs)) if signs else b""
                )
            if ids is None:
                rare.append(k)
            else:
                made[k] = ids
        code = "H" if self.dtype == "<u2" else "I"  # tasks run on little-endian machines, as Arrow does
        for k, e in zip(
            rare, self.tokenizer.encode_batch_fast([pieces[k] for k in rare], add_special_tokens=False), strict=True
        ):
            made[k] = array(code, e.ids).tobytes()
        if len(self.pieces) + len(missing) > CACHE_PIECES:
            self.pieces, self.older = {}, self.pieces
        self.pieces.update((pieces[k], made[k]) for k in missing if len(pieces[k]) <= PIECE_CHARS)
        return made

    def _word(self, word: str) -> bytes:
        """Ids of ASCII letters, or of signs, by the library's model; byte-level BPE writes a space as U+0120."""
        spelled = word.replace(" ", "Ġ") if self.kind == "spaces kept" else word.lower()
        ids = np.array([t.id for t in self.model.tokenize(spelled)], self.dtype).tobytes()
        if len(word) <= PIECE_CHARS:
            if len(self.words) >= CACHE_PIECES:
                self.words.clear()
            self.words[word] = ids
        return ids
