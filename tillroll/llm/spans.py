"""Word spans of a batch of texts, found on the UTF-8 bytes of the whole batch at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z: digits, a-z, and every byte of other characters
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[128:] = True
_LATIN = np.zeros(256, bool)
_LATIN[97:123] = _LATIN[0xC3] = True


@dataclass
class Spans:
    """Word j of the batch is ``raw[start[j]:end[j]]``; text i has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def strings(self, which: np.ndarray | None = None) -> pa.Array:
        """The words (or those at the places ``which``) as strings."""
        start, end = (self.start, self.end) if which is None else (self.start[which], self.end[which])
        size = end - start
        ends = np.concatenate(([0], np.cumsum(size)))
        return pa.Array.from_buffers(pa.large_string(), len(size), [
            None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(self.raw[places(start, size)].tobytes())])


def places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for ``size[0]`` numbers, then the same for the next start."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size)


def _spans(texts: pa.Array, latin: bool) -> Spans:
    t = pc.fill_null(texts, "").cast(pa.large_string())
    t = t.take(pa.array(np.arange(len(t))))  # a slice's own copy
    edges = np.frombuffer(t.buffers()[1], np.int64, len(t) + 1) if len(t) else np.zeros(1, np.int64)
    held = t.buffers()[2] if len(t) else None
    raw = _LOWER[np.frombuffer(held, np.uint8, edges[-1])] if held is not None and edges[-1] else np.zeros(0, np.uint8)
    n = len(raw)
    if latin:  # a-z, and U+00C0 to U+00FF: the byte C3 and the one that follows it
        inside = _LATIN[raw]
        inside[1:] |= raw[:-1] == 0xC3
    else:
        inside = _ALNUM[raw]
    front = np.zeros(n + 1, bool)
    front[edges] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | front[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | front[1:n]
    at = np.flatnonzero(start)
    return Spans(raw, at, np.flatnonzero(end) + 1, np.searchsorted(at, edges))


def alnum_spans(texts: pa.Array) -> Spans:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the texts with A-Z lower-cased; a null text has none."""
    return _spans(texts, latin=False)


def latin_spans(texts: pa.Array) -> Spans:
    r"""Runs ``[A-Za-zÀ-ÿ]+`` with only A-Z lower-cased; a null text has none."""
    return _spans(texts, latin=True)
