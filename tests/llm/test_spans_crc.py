"""Word spans against regular expressions, and checksums of spans against zlib."""

import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import crc
from tillroll.llm.spans import alnum_spans, latin_spans

LOWER = {i: i + 32 for i in range(65, 91)}
odd = st.text(alphabet=st.sampled_from(list("abzAZ09 .,-_'\n\t\x00\x7f\x80\xa0ÀÿĀßéÉ×÷日😀")), max_size=30)


@given(st.lists(st.one_of(st.none(), odd), max_size=6))
@settings(max_examples=120, deadline=None)
def test_spans_are_the_runs_of_the_patterns(texts):
    for spans, pattern in ((alnum_spans, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (latin_spans, r"[A-Za-zÀ-ÿ]+")):
        got = spans(pa.array(["cut", *texts], pa.string()).slice(1))
        names = got.strings().to_pylist()
        assert [names[a:b] for a, b in zip(got.bounds[:-1], got.bounds[1:])] == [
            re.findall(pattern, (t or "").translate(LOWER)) for t in texts]


@given(st.binary(max_size=1200), st.lists(st.tuples(st.integers(0, 1200), st.integers(0, 1200)), max_size=12))
@settings(max_examples=150, deadline=None)
def test_checksums_of_spans_equal_zlib(raw, cuts):
    spans = [(min(a, b, len(raw)), min(max(a, b), len(raw))) for a, b in cuts]
    got = crc.crc32_spans(np.frombuffer(raw, np.uint8), np.array([a for a, _ in spans], np.int64),
                          np.array([b for _, b in spans], np.int64))
    assert got.tolist() == [zlib.crc32(raw[a:b]) for a, b in spans]


def test_checksums_of_a_very_long_span_and_of_joined_parts():
    raw = np.random.default_rng(1).integers(0, 256, 1_000_003).astype(np.uint8)
    assert crc.crc32_spans(raw, [0, 5, 7], [1_000_003, 5, 70]).tolist() == [
        zlib.crc32(raw.tobytes()), 0, zlib.crc32(raw[7:70].tobytes())]
    parts = [(b"12:", b"word"), (b"", b"x"), (b"-9", b""), (b"7:", bytes(5000))]
    first, second = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    assert crc.joined(first, second, np.array([len(p[1]) for p in parts])).tolist() == [zlib.crc32(a + b) for a, b in parts]
