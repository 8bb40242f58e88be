"""CRC-32 of many byte spans at once, from a table of what a byte adds by its distance from the span's end.

CRC-32 is affine over bits: the checksum is the XOR of one contribution a byte, which depends on the byte and on the
number of bytes after it, and of one constant of the length.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: The reversed CRC-32 polynomial and its start value.
POLYNOMIAL, ONES = 0xEDB88320, 0xFFFFFFFF
#: Bytes of the position table; longer spans are folded in blocks of so many.
BLOCK = 64
#: Spans are expanded in slices of about so many bytes.
SLICE_BYTES = 4 << 20


def _shift(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The states after one zero byte more."""
    return (state >> np.uint32(8)) ^ table[state & np.uint32(255)]


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, constant, jump): place[256 * d + b] is what byte b adds with d bytes after it; constant[n] what the
    length n adds; jump[k][b] the state with byte b in place k after BLOCK zero bytes.
    """
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    place, start = [one], [np.array([ONES], np.uint32)]
    for _ in range(BLOCK):
        place.append(_shift(place[-1], one))
        start.append(_shift(start[-1], one))
    jump = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(BLOCK):
        jump = _shift(jump, one)
    return np.concatenate(place[:BLOCK]), np.concatenate(start) ^ np.uint32(ONES), jump


def _added(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The XOR of the bytes' contributions, for spans of 1 to BLOCK bytes."""
    place, _, _ = tables()
    ends = np.cumsum(lengths)
    begin = ends - lengths
    at = np.arange(ends[-1] if len(ends) else 0)
    index = (np.repeat(ends, lengths) - 1 - at) << 8
    at += np.repeat(starts - begin, lengths)
    index += data[at]
    return np.bitwise_xor.reduceat(place[index], begin)


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The unsigned CRC-32 of data[start:end] for each span, as zlib.crc32 gives it; spans may overlap or be empty."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero((lengths > 0) & (lengths <= BLOCK))
    _, constant, _ = tables()
    filled = np.cumsum(lengths[short])
    at = 0
    while at < len(short):
        upto = max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        some = short[at:upto]
        out[some] = _added(data, starts[some], lengths[some]) ^ constant[lengths[some]]
        at = upto
    long = np.flatnonzero(lengths > BLOCK)
    if len(long):
        out[long] = _folded(data, starts[long], lengths[long])
    return out


def _folded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For long spans: the state of a head of 1 to BLOCK bytes, moved on by a block and joined with it, block after
    block; all spans that still have blocks move together.
    """
    _, constant, jump = tables()
    head = (lengths - 1) % BLOCK + 1
    blocks = (lengths - head) // BLOCK
    state = _added(data, starts, head) ^ constant[head] ^ np.uint32(ONES)
    order = np.argsort(-blocks, kind="stable")
    starts, state, blocks = (starts + head)[order], state[order], blocks[order]
    for k in range(int(blocks[0])):
        live = int(np.searchsorted(-blocks, -k, side="left"))
        s = state[:live]
        moved = jump[0][s & 255] ^ jump[1][s >> 8 & 255] ^ jump[2][s >> 16 & 255] ^ jump[3][s >> 24]
        state[:live] = moved ^ _added(data, starts[:live] + k * BLOCK, np.full(live, BLOCK))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(ONES)
    return out
