"""Small parts that need no Spark: tokens, packing plans, targets, Feistel, sketches of text, models."""

import collections
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import lm, mixing, packing, pii, quality, topk
from tillroll.llm.queries import tokenizer_path
from tillroll.llm.tokens import word_ids
from tillroll.llm.words import chunks, words

KEY = b"a key of the tests"


def replaced(text):
    return pii.replaced(text, KEY)


@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_are_runs_without_ascii_white_space(texts):
    import re
    codes, offsets, vocab = words(pa.array(texts, pa.string()))
    names = vocab.to_pylist()
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        want = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        assert [names[c] for c in codes[a:b]] == want


def test_chunks_cover_all_rows_of_a_slice():
    texts = ["é" * n for n in (0, 5, 5000, 3, 1, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]).slice(1)
    got = [t for part in chunks(batch, limit=8) for t in part.column(0).to_pylist()]
    assert got == texts[1:]


@given(st.lists(st.text(alphabet=st.sampled_from(list("abcXYZ .,!?'ß é ñ9 0\n\t ́日本İ")), max_size=40), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_ids_equal_whole_text_encoding(texts):
    path = tokenizer_path("word_bpe_49k.json")
    encoder = word_ids(path)
    ids, bounds = encoder.encode(pa.array(texts))
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_once_near_the_bound(seed):
    rng = random.Random(seed)
    lengths = [min(4096, max(1, int(rng.lognormvariate(6, 1.2)))) for _ in range(3000)]
    histogram = dict(collections.Counter(lengths))
    groups = packing.plan(histogram, 4096)
    held = collections.Counter()
    for repeats, runs in groups:
        assert repeats > 0 and sum(n * t for n, t in runs) <= 4096
        for n, t in runs:
            held[n] += repeats * t
    assert held == histogram
    bound = -(-sum(lengths) // 4096)
    assert sum(r for r, _ in groups) <= bound * 1.01 + 2


def test_plan_of_nothing_and_of_full_sequences():
    assert packing.plan({}, 4096) == []
    assert packing.plan({4096: 3}, 4096) == [(3, [(4096, 1)])]


def test_non_negative_fit_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    cols = rng.integers(1, 12, (40, 3))
    target = rng.integers(0, 50, 13).astype(float)
    weights = np.arange(13, dtype=float)
    x = packing.non_negative_fit(cols, weights, target)
    a = np.stack([np.bincount(c, minlength=13) for c in cols], axis=1).astype(float)
    slope = a.T @ (weights ** 2 * (target - a @ x))
    assert (x >= 0).all() and slope.max() < 1e-3 * np.abs(a.T @ (weights ** 2 * target)).max()
    assert np.abs(slope[x > 0]).max() < 1e-3 * np.abs(a.T @ (weights ** 2 * target)).max()


def test_targets_stop_at_twice_and_reshare():
    aim = mixing.targets([100, 10, 50], [3, 1, 2], Fraction(3, 2), 2)
    assert sum(aim) == 240 and aim[1] == 20 and aim[0] <= 200 and aim[2] <= 100
    assert mixing.targets([0, 0], [3, 1], Fraction(3, 2), 2) == [0, 0]
    assert mixing.targets([], [], Fraction(3, 2), 2) == []


def test_split_tree_quotas_are_exact_disjoint_and_the_same_in_any_task():
    quota = np.array([17, 0, 5, 1000])
    whole = mixing.split_tree(quota, 13, 3, range(13))
    for s in range(4):
        turns = sorted(t for f, n in whole.values() for t in range(f[s], f[s] + n[s]))
        assert turns == list(range(quota[s]))
    sizes = [int(n.sum()) for _, n in whole.values()]
    assert max(sizes) - min(sizes) <= 4
    for leaf in range(13):
        f, n = mixing.split_tree(quota, 13, 3, [leaf])[leaf]
        assert (f == whole[leaf][0]).all() and (n == whole[leaf][1]).all()


@given(st.integers(2, 5000), st.binary(min_size=1, max_size=8))
@settings(max_examples=25, deadline=None)
def test_feistel_is_a_permutation_without_fixed_points(n, key):
    f = pii.Feistel(n, key, "t")
    got = [f.encrypt(x) for x in range(min(n, 300))]
    assert len(set(got)) == len(got) and all(0 <= y < n for y in got)
    assert all(f.decrypt(y) == x != y for x, y in enumerate(got))


@pytest.mark.parametrize("value,kind", [
    ("und.34@mail7.example.com", "email"), ("4111 1111 1111 1111", "card"), ("9807915762804490", "card"),
    ("+1 (017) 555-7713", "phone"), ("555-123-4567", "phone"), ("123-45-6789", "social"), ("97.51.17.173", "ipv4"),
    ("1984-02-29", "date"), ("31.12.1999", "date"), ("12 March 1990", "date"), ("Mar 5, 2001", "date"),
    ("DE89 3704 0044 0532 0130 00", "iban"), ("b44e15e09fd311c3cf3163b66d5a9875b883d8ce", "secret"), ("123456789", "number")])
def test_pseudonyms_keep_their_format_and_stay_linked(value, kind):
    one, found = replaced(f"a {value}, b")
    two, _ = replaced(f"{value}!! and more of it; {value}")
    assert [(k, s, n) for k, s, n, _ in found] == [(kind, 2, len(value))]
    new = found[0][3]
    assert new != value and one == f"a {new}, b" and two == f"{new}!! and more of it; {new}"
    again = [k for k, *_ in pii.find(new, KEY)]
    assert again == [kind]
    if kind == "card" and pii.luhn_digit("411111111111111") == "1" and value.startswith("4111"):
        digits = new.replace(" ", "")
        assert pii.luhn_digit(digits[:-1]) == digits[-1]


@pytest.mark.parametrize("text", ["version 2.0.", "CC BY-NC 4.0", "2023-02-30", "300.1.1.1", "", "no values", "1999", "000-12-3456"])
def test_texts_without_valid_values_stay(text):
    assert replaced(text) == (text, [])


def test_dual_coordinate_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1, -1)
    w, b = quality.dual_coordinate_descent([np.arange(5)] * 60, list(x), y, 5, 1.0, 2000, 1)

    def loss(w, b):
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - y * (x @ w + b)).sum()
    best = loss(w, b)
    for _ in range(300):
        assert best <= loss(w + 0.02 * rng.normal(size=5), b + 0.02 * rng.normal()) + 1e-3


def test_features_of_odd_texts():
    f = quality.features(pa.array([None, "", "a", "a a a a", "b " * 10]))
    assert f[0].tolist() == f[1].tolist() == [0] and len(f[2]) >= 2 and len(f[3]) > len(f[2])
    assert quality.features(pa.array(["a a a a"]))[0].tolist() == f[3].tolist()


def test_tables_are_normalised_and_contexts_stop_at_texts():
    s = lm.Settings(classes=40, suffix_classes=8, dimensions=6)
    rng = np.random.default_rng(0)
    m = lm.Model(s, {}, {}, np.zeros(8), 1, 1, *(rng.normal(size=(40, 6)).astype(np.float32) for _ in range(2)),
                 rng.normal(size=(2, 6)).astype(np.float32), rng.normal(size=40).astype(np.float32))
    a, b, z = lm.log_tables(m)
    p = np.exp(a[3] + b[7] - z[3, 7])
    assert abs(p.sum() - 1) < 1e-4
    direct = m.q @ (m.c[0] * m.r[3] + m.c[1] * m.r[7]) + m.b
    assert np.allclose(p, np.exp(direct) / np.exp(direct).sum(), rtol=1e-3)
    one, two = lm._contexts(np.array([5, 6, 7, 0, 8, 0, 0]), np.array([0, 4, 6]), 0)
    assert one.tolist() == [0, 5, 6, 7, 0, 8, 0] and two.tolist() == [0, 0, 5, 6, 0, 0, 0]


def test_threshold_search_equals_sorting_and_stops_early():
    rng = np.random.default_rng(4)
    mat = np.maximum(0, rng.integers(-200, 60, (4000, 8)))
    mat[10:300] = mat[10]
    ids = rng.permutation(4000) * 7
    queries = rng.integers(-5, 6, (20, 8))
    queries[0] = 0
    qids = ids[:20]
    got, scored = topk.threshold_search(ids, mat, qids, queries, 5)
    for q, qid, (at, best) in zip(queries, qids, got):
        s = mat @ q
        want = sorted((-s[i], ids[i]) for i in range(4000) if ids[i] != qid)[:5]
        assert [(-b, ids[a]) for a, b in zip(at, best)] == want
    assert scored < 20 * 4000


def test_suffix_class_agrees_with_spark(spark):
    from pyspark.sql import functions as F
    names = ["a", "abc", "über", "été", "x日本"]
    rows = spark.createDataFrame([(w,) for w in names], "word string").select(
        "word", F.pmod(F.crc32(F.encode(F.right("word", F.lit(2)), "UTF-8")), F.lit(128)).alias("k")).collect()
    assert {r.word: r.k for r in rows} == {w: lm.suffix_class(w, 128) for w in names}
    assert zlib.crc32(b"a") % 128 == lm.suffix_class("a", 128)


@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab é.!? \n\t\x0b日")), max_size=40)), max_size=6))
@settings(max_examples=80, deadline=None)
def test_units_over_bytes_equal_units_of_each_text(texts):
    from tillroll.llm import passages
    u = passages.split_units(pa.array(texts, pa.string()))
    want = [(i, j, a, b) for i, t in enumerate(texts) for j, (a, b) in enumerate(passages.units(t or ""))]
    assert list(zip(u.row.tolist(), u.part.tolist(), u.start.tolist(), u.end.tolist())) == want
    assert u.text.to_pylist() == [texts[i][a:b] for i, _, a, b in want]
    seq = [tuple(t.split()) for t in u.text.to_pylist()]
    ids = u.ids().tolist()
    assert len(set(ids)) == len(set(seq)) and all((x == y) == (p == q) for x, p in zip(ids, seq) for y, q in zip(ids, seq))


def longest_same(a, b):
    best = run = 0
    for x, y in zip(a, b):
        run = run + 1 if x == y else 0
        best = max(best, run)
    return best


@pytest.mark.parametrize("n", [500, 512, 1024, 10_000])
def test_long_values_change_everywhere(n):
    rng = random.Random(n)
    secret = "".join(rng.choice("0123456789abcdef") for _ in range(n))
    mail = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n))
    for value, kind in ((secret, "secret"), (mail + "@example.org", "email")):
        one, found = replaced(f"see {value} there")
        assert [k for k, *_ in found] == [kind] and len(one) == len(f"see {value} there")
        own = one[4:4 + n]
        assert longest_same(own, value[:n]) <= 8  # a chance below 1e-5 for the longest
        assert replaced(f"see {value} there")[0] == one
        flipped = value[:n - 1] + ("0" if value[n - 1] != "0" else "1") + value[n:] if kind == "secret" else "z" + value[1:]
        if flipped != value:
            assert longest_same(replaced(f"see {flipped} there")[0][4:4 + n], own) <= 8


@pytest.mark.parametrize("size", [10 ** 300 + 7, 16 ** 700, 26 ** 900])
def test_large_permutations_turn_back(size):
    f = pii.Feistel(size, b"key", "t")
    rng = random.Random(1)
    for x in [0, 1, size - 1, *(rng.randrange(size) for _ in range(5))]:
        assert f.encrypt(x) != x and f.decrypt(f.encrypt(x)) == x


def test_mixed_radix_places_by_halves():
    rng = random.Random(2)
    for n in (1, 31, 33, 700):
        sizes = [rng.choice([10, 26, 31]) for _ in range(n)]
        values = [rng.randrange(s) for s in sizes]
        x, total = pii._mixed(values, sizes)
        want = 0
        for v, s in zip(values, sizes):
            want = want * s + v
        assert x == want and total == math.prod(sizes) and pii._places(x, sizes) == values


def test_pseudonyms_need_a_key():
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymised(None, b"")


def test_word_hashes_part_words_and_ignore_where_they_stand():
    from tillroll.llm.words import hash_words
    names = [f"{a}{b}" for a in ("", "x", "é", "zz") for b in range(3000)] + ["a", "b", "ab", "ba", "aa", "aaa", "日本"]
    h = hash_words(pa.array(names))
    assert len(np.unique(h)) == len(names)
    assert (hash_words(pa.array(["cut", *names]).slice(1)) == h).all() and len(hash_words(pa.array([], pa.string()))) == 0
    assert hash_words(pa.array(["日本", "a"])).tolist() == [h[-1], h[len(names) - 7]]
