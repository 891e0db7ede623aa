"""Word arrays of a batch of texts: splitting, lower-casing and hashing without per-word Python.

A word is a maximal run of characters other than space and U+0009-U+000D; only A-Z are
lower-cased.  Everything here works on one Arrow batch inside a Spark task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library
    _LIBC = None

# bytes of text handled at once inside a task; bounds the temporary arrays, not the result
CHUNK_BYTES = 2 << 20


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks and stages, next to the executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into row ranges of about ``limit`` bytes of text (a longer text stays whole)."""
    col = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, offsets, vocabulary): the words of all texts as codes into the distinct words.

    The words of text i are ``codes[offsets[i]:offsets[i + 1]]``; a null text has none.
    """
    t = pc.fill_null(texts, "").cast(pa.large_string())
    t = t.take(pa.array(np.arange(len(t))))  # a slice's own copy: ascii_lower misreads the offsets of a slice
    if lower:
        t = pc.ascii_lower(t)
    parts = pc.ascii_split_whitespace(t)
    flat = parts.values
    bounds = parts.offsets.to_numpy()
    keep = pc.greater(pc.binary_length(flat), 0)
    running = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False))))
    coded = flat.filter(keep).dictionary_encode()
    return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), running[bounds].astype(np.int64),
            coded.dictionary)


def hash_strings(vocabulary: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each string."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, seed) for w in vocabulary.to_pylist()), dtype=np.uint64, count=len(vocabulary))


# a random number for each byte value; fixed, so that all tasks hash alike
_BYTE_NUMBERS = np.random.default_rng(64).integers(0, 1 << 64, 256, dtype=np.uint64)


def hash_words(vocabulary: pa.Array) -> np.ndarray:
    """64-bit hash of each non-empty string, from all their bytes at once."""
    t = vocabulary.cast(pa.large_string())
    if not len(t):
        return np.zeros(0, np.uint64)
    if t.offset:
        t = t.take(pa.array(np.arange(len(t))))
    edges = np.frombuffer(t.buffers()[1], np.int64, len(t) + 1)
    size = np.diff(edges)
    data = np.frombuffer(t.buffers()[2], np.uint8, edges[-1])[edges[0]:]
    start = edges[:-1] - edges[0]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(size.max()), 0xD6E8FEB86659FD93, np.uint64))
        total = np.add.reduceat(_BYTE_NUMBERS[data] * power[np.arange(len(data)) - np.repeat(start, size)], start)
        return mix64(total + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(codes: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its k-word shingles.

    A text of fewer than k words has its whole sequence as its only shingle; one without words has none.
    """
    w = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(w)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, n - k + 1), np.uint64)
        for j in range(k):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + w[j:j + len(rolled)]
        rolled = mix64(rolled)
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a >= k:
                out.append(np.unique(rolled[a:b - k + 1]))
            elif b > a:
                h = np.uint64(b - a)
                for x in w[a:b]:
                    h = h * np.uint64(0x9E3779B97F4A7C15) + x
                out.append(mix64(np.array([h], np.uint64) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
