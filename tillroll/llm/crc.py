"""CRC-32 of many byte spans at once, from position tables.

The checksum is affine over bits: apart from a constant of the length, it is the exclusive or of one
contribution per byte, which depends on the byte and on its distance from the span's end.  The
contributions of all bytes up to ``REACH`` from the end are computed once; a span's checksum is then
a gather and one ``bitwise_xor.reduceat``.  Longer spans are cut, from their end, into blocks of ``REACH``
bytes whose sums are folded pairwise, the left one moved on by the right one's length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tillroll.llm.spans import places

# the reversed polynomial of CRC-32 (a fixed value of the format)
POLYNOMIAL = 0xEDB88320
REACH = 64
# span bytes gathered at once
GATHER = 4 << 20


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), t >> np.uint32(1))
    return t


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """(distance, byte): what a byte adds that ``distance`` bytes of the span follow."""
    step = _byte_table()
    out = np.empty((REACH, 256), np.uint32)
    out[0] = step
    for d in range(1, REACH):
        out[d] = (out[d - 1] >> np.uint32(8)) ^ step[out[d - 1] & np.uint32(255)]
    return out


@lru_cache(maxsize=64)
def _moved_table(k: int) -> np.ndarray:
    """(place, byte): what a register byte becomes when 2**k zero bytes follow."""
    if k == 0:
        step = _byte_table()
        byte = np.arange(256, dtype=np.uint32)
        return np.stack([step, byte, byte << np.uint32(8), byte << np.uint32(16)])
    half = _moved_table(k - 1)
    return _through(half, half)


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (table[0][x & np.uint32(255)] ^ table[1][x >> np.uint32(8) & np.uint32(255)]
            ^ table[2][x >> np.uint32(16) & np.uint32(255)] ^ table[3][x >> np.uint32(24)])


def moved(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The register ``x`` after ``by`` further zero bytes, both arrays."""
    x, by = np.array(x, np.uint32), np.asarray(by, np.int64)
    for k in range(int(by.max(initial=0)).bit_length()):
        at = np.flatnonzero(by >> k & 1)
        x[at] = _through(_moved_table(k), x[at])
    return x


@lru_cache(maxsize=1)
def _short_constants() -> np.ndarray:
    n = np.arange(REACH + 1)
    return moved(np.full(len(n), 0xFFFFFFFF, np.uint32), n) ^ np.uint32(0xFFFFFFFF)


def length_constants(size: np.ndarray) -> np.ndarray:
    """The part of the checksum that a span's length alone decides: that of as many zero bytes."""
    if int(size.max(initial=0)) <= REACH:
        return _short_constants()[size]
    return moved(np.full(len(size), 0xFFFFFFFF, np.uint32), size) ^ np.uint32(0xFFFFFFFF)


def _sums(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Exclusive or of the contributions of spans of at most ``REACH`` bytes."""
    out = np.zeros(len(start), np.uint32)
    full = np.flatnonzero(size)
    ends = np.cumsum(size[full])
    first, table = 0, position_table().reshape(-1)
    while first < len(full):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + GATHER, side="right")))
        some = full[first:last]
        s, n = start[some], size[some]
        at = places(s, n)
        distance = np.repeat(s + n - 1, n) - at
        out[some] = np.bitwise_xor.reduceat(table[distance * 256 + raw[at]], np.cumsum(n) - n)
        first = last
    return out


def crc32_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of every span ``raw[start[j]:end[j]]`` of the byte array; spans may be empty or overlap."""
    start, size = np.asarray(start, np.int64), np.asarray(end, np.int64) - np.asarray(start, np.int64)
    out = np.zeros(len(start), np.uint32)
    short = np.flatnonzero(size <= REACH)
    out[short] = _sums(raw, start[short], size[short])
    for j in np.flatnonzero(size > REACH).tolist():
        blocks = -(-int(size[j]) // REACH)
        stop = start[j] + size[j] - REACH * np.arange(blocks)[::-1]
        begin = np.maximum(stop - REACH, start[j])
        x = _sums(raw, begin, stop - begin)
        k = REACH.bit_length() - 1
        while len(x) > 1:
            if len(x) % 2:  # zeros in front add nothing
                x = np.concatenate((np.zeros(1, np.uint32), x))
            x = _through(_moved_table(k), x[0::2]) ^ x[1::2]
            k += 1
        out[j] = x[0]
    return out ^ length_constants(size)


def joined(first: np.ndarray, second: np.ndarray, second_size: np.ndarray) -> np.ndarray:
    """Checksums of two parts together, from those of the parts and the second one's length."""
    return moved(first, second_size) ^ second
