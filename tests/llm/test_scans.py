"""Licence scans, spelling variants and importance resampling against brute force over small tables."""

import bisect
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import importance, licenses, variants

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = licenses.parsed()


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def table(spark, rows):
    """(doc_id, text) rows with further columns whose names an operator uses itself."""
    return spark.createDataFrame([(d, t, 1, "x", 2.0, 3) for d, t in rows],
                                 "doc_id long, text string, n long, word string, score double, rank int")


# --- licence scans --------------------------------------------------------------------------------

def test_rules_are_many_and_gated_by_their_keywords():
    assert len(RULES) >= 200
    for rule in RULES:
        assert rule.keyword.strip() and 1 <= rule.priority <= 5 and 0 < rule.strength < 100


@pytest.mark.parametrize("chunk", range(4))
def test_every_match_of_a_rule_holds_its_keyword(chunk):
    rng = random.Random(chunk)
    for rule in RULES[chunk::4]:
        for text in samples(rule.pattern, rng):
            assert rule.expression.fullmatch(f" {text} ".encode()[:-1] + b" ", 0) or rule.expression.search(f" {text} ".encode()), rule
            assert rule.keyword in f" {text}".encode(), (rule, text)


def samples(pattern, rng, n=12):
    """Some texts that the expression matches, drawn from its own parse."""
    from re import _constants as c
    from re import _parser

    def draw(items):
        out = ""
        for op, arg in items:
            if op is c.LITERAL:
                out += chr(arg)
            elif op is c.IN:
                kind, value = arg[0]
                out += chr(value if kind is c.LITERAL else value[0]) if kind is not c.CATEGORY else "7"
                if kind is c.LITERAL and len(arg) > 1:
                    pick = rng.choice([a for a in arg if a[0] is c.LITERAL])
                    out = out[:-1] + chr(pick[1])
            elif op is c.SUBPATTERN:
                out += draw(arg[-1])
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                low, high, inner = arg
                out += "".join(draw(inner) for _ in range(rng.randint(low, min(int(high), low + 2))))
            elif op is c.BRANCH:
                out += draw(rng.choice(arg[1]))
            else:
                raise AssertionError(f"unknown part {op}")
        return out
    tree = _parser.parse(pattern)
    return [re.sub(r"\s+", " ", draw(tree)) for _ in range(n)]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 12), st.integers(0, len(RULES) - 1)), max_size=14))
@settings(max_examples=200, deadline=None)
def test_containment_and_priority(draws):
    found = sorted({(s, s + n, r) for s, n, r in draws})

    def beats(x, y):
        inside = x[0] <= y[0] and y[1] <= x[1] and x != y
        px, py = RULES[x[2]].priority, RULES[y[2]].priority
        return inside and (px > py or px == py and (x[:2] != y[:2] or x[2] < y[2]))
    want = [y for y in found if not any(beats(x, y) for x in found)]
    assert licenses.resolved(found, RULES) == want


def brute_scan(text):
    words = words_of(text)
    base = sorted(((label, i) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
                   if words[i:i + len(phrase.split())] == phrase.split()), key=lambda p: (p[1], p[0]))
    line = " " + "".join(w + " " for w in words)
    at = [m.start() for m in re.finditer(r"(?<= )\S", line)]
    found = [(m.start() + 1, m.end(), r) for r, rule in enumerate(RULES)
             for m in re.finditer(f" (?:{rule.pattern})(?= )", line, re.ASCII)]
    kept = [(RULES[r].label, r, bisect.bisect_left(at, s), line[s:e]) for s, e, r in licenses.resolved(found, RULES)]
    return len(words), base, kept


LICENCE_TEXTS = [
    (1, "Licensed under CC BY-NC 4.0.\nAll rights reserved."), (2, "This work is licensed under the GNU General Public License, version 3."),
    (3, "Released under the MIT License. Released under the MIT License."), (4, "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;"),
    (5, None), (6, ""), (7, " \n.,;"), (8, "cc by cc by CC-BY, cc_by ccby cc  by"), (9, "café " * 3000 + "© 2020 Tous droits réservés"),
    (10, "https://creativecommons.org/licenses/by-sa/4.0/ and http://www.apache.org/licenses/LICENSE-2.0"),
    (11, "the general public, license to none; a cat by cc"), (11, "all\x00rights reserved all rights reserved"), (None, "BSD 3-Clause License"),
    (12, "lorem GPL " * 2000), (13, "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: neither the name of the Big Company nor others may be used to endorse or promote products"),
]


def test_scan_equals_brute_force(spark):
    rows = licenses.scanned(table(spark, LICENCE_TEXTS)).collect()
    got = collections.Counter((r.doc_id, r.n_words, tuple((p.label, p.first_word) for p in r.phrases),
                               tuple((x.label, x.rule, x.first_word, x.matched) for x in r.detections)) for r in rows)
    want = collections.Counter()
    for d, t in LICENCE_TEXTS:
        n, base, kept = brute_scan(t)
        want[d, n, tuple(base), tuple(kept)] += 1
    assert got == want
    for r in rows:
        assert 0 <= r.score < 1 and (r.score > 0) == bool(r.phrases or r.detections)
        assert all(x.n_words == len(x.matched.split()) for x in r.detections)


def test_scan_digest(spark):
    rows = {(r.doc_id, r.n_words): r for r in licenses.digest(licenses.scanned(table(spark, LICENCE_TEXTS))).collect()}
    by = {d: r for (d, _), r in rows.items()}
    assert (by[1].n_base, by[1].first_word, by[1].last_word, by[1].base_labels, by[1].labels) == (
        2, 2, 7, "cc-by,reserved", "cc-by,cc-by-nc-4.0,reserved")
    assert by[2].labels == "gpl,gpl-3.0" and by[3].labels == "mit" and by[4].labels == "gpl-2.0-or-later"
    assert (by[5].n_base, by[5].first_word, by[5].base_labels, by[5].labels, by[5].score) == (0, None, "", "", 0.0)
    assert by[8].n_base == 5 and by[10].labels == "apache-2.0,cc-by-sa" and by[None].labels == "bsd-3-clause"


def test_scan_of_nothing(spark):
    assert licenses.digest(licenses.scanned(table(spark, []))).collect() == []


# --- spelling variants ----------------------------------------------------------------------------

def brute_words(rows, least_chars=7, least_count=2, drop=None):
    count = collections.Counter()
    for d, t in rows:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if drop and h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= least_chars and n >= least_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_groups(count, factor=10):
    near = {w: [x for x in count if one_edit(w, x)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= factor * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count.get(form[w])))
    return out


def misspelt(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice("abéÿ") + word[i:], word[:i] + rng.choice("abc×") + word[i + 1:]])


@pytest.mark.parametrize("drop", [None, 3])
def test_variants_equal_brute_force(spark, drop):
    rng = random.Random(12)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 10))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "abababab"]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.randint(5, 60)):
            word = stems[int(rng.random() ** 4 * len(stems))]
            while rng.random() < .35:
                word = misspelt(rng, word)
            text.append(rng.choice([word, word.title(), word.upper()]))
        rows.append((d, rng.choice([" ", ", ", "9"]).join(text)))
    rows += [(None, rows[0][1]), (3, rows[3][1]), (70, None), (71, ""), (72, "short w"), (73, "abcdefg" * 400 + " " + "abcdefg" * 400),
             (74, "abcdefg" * 400 + "x " + "ÀÉÿ÷×ßab " * 3), (75, "é" * 7 + " " + "é" * 7 + " " + "é" * 8 + " " + "é" * 8)]
    got = collections.Counter(tuple(r) for r in variants.spelling_variants(table(spark, rows), drop=drop).select(
        "word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == collections.Counter(brute_groups(brute_words(rows, drop=drop)))
    if drop is None:  # a chain of forms is followed to its end
        assert any(root not in (word, form) for word, form, root, *_ in brute_groups(
            {"abcdefgh": 1000, "abcdefg": 100, "bcdefgh": 3, "bcdefg": 2, "abcdef": 4}))


def test_chains_of_forms(spark):
    count = {"abcdefgh": 10_000, "abcdefghi": 1000, "abcdefghij": 100, "abcdefghijk": 10, "abcdefghijkl": 1, "zzzzzzzz": 5}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    got = {tuple(r) for r in variants.grouped(words).collect()}
    assert got == brute_groups(count)
    assert {r[2] for r in got} == {"abcdefgh", "zzzzzzzz"}


@given(st.lists(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 50)), min_size=5, max_size=5, unique_by=lambda x: x[0]), min_size=1,
                max_size=5))
@settings(max_examples=60, deadline=None)
def test_pivots_are_the_cheapest_disjoint_choice(rows):
    import itertools
    place = np.array([[p for p, _ in sorted(r)] for r in rows])
    cost = np.array([[c for _, c in sorted(r)] for r in rows])
    for picks, width in ((2, 2), (3, 2)):
        def best(i):
            return min((sum(cost[i][list(c)]) for c in itertools.combinations(range(5), picks)
                        if all(place[i][b] - place[i][a] >= width for a, b in zip(c, c[1:]))), default=None)
        able = [i for i in range(len(rows)) if best(i) is not None]
        if able:
            mark = variants.pivots(place[able], cost[able], picks, width)
            for i, m in zip(able, mark):
                at = place[i][m]
                assert m.sum() == picks and (np.diff(at) >= width).all() and cost[i][m].sum() == best(i)


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(table(spark, [])).collect() == []
    assert variants.spelling_variants(table(spark, [(1, None), (2, "a few words")])).collect() == []
    with pytest.raises(ValueError, match="code points"):
        variants.spelling_variants(table(spark, []), least_chars=3)


# --- importance resampling ------------------------------------------------------------------------

def brute_draw(docs, target, least, most, buckets, percent, min_words):
    def features(t):
        w = words_of(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(least, most + 1) for i in range(len(w) - n + 1)]
    s = collections.Counter(b for _, t in docs for b in features(t))
    t = collections.Counter(b for x in target for b in features(x))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows = []
    for d, x in docs:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        f = features(x)
        weight = sum(gain[b] for b in f)
        rows.append((d, len(words_of(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    return collections.Counter(r + (i + 1 if i < drawn else None,) for i, r in enumerate(able)) + collections.Counter(
        r + (None,) for r in rows if r[1] < min_words)


@pytest.mark.parametrize("least, most, buckets, percent", [(1, 1, 10_000, 10), (1, 3, 97, 60), (2, 2, 50, 100)])
def test_draws_equal_brute_force(spark, least, most, buckets, percent):
    rng = random.Random(most)
    vocab = ["".join(rng.choice("abcé9Ü") for _ in range(rng.randint(1, 9))) for _ in range(80)] + ["x" * 200]
    docs = [(d, rng.choice([" ", "--", "\n"]).join(rng.choices(vocab, k=rng.randint(0, 60)))) for d in range(120)]
    docs += [(200, None), (201, ""), (202, "a " * 19), (203, "a b " * 4000), (5, docs[5][1]), (None, docs[6][1]), (-1, docs[7][1])]
    target = [" ".join(rng.choices(vocab[:20], k=30)) for _ in range(20)] + [None, ""]
    got = collections.Counter(tuple(r) for r in importance.resampled(
        table(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), least, most, buckets, percent).collect())
    assert got == brute_draw(docs, target, least, most, buckets, percent, 20)


def test_draws_without_documents_or_target(spark):
    none, some = table(spark, []), table(spark, [(1, "word " * 30), (2, "other " * 30)])
    assert importance.resampled(none, some).collect() == []
    got = collections.Counter(tuple(r) for r in importance.resampled(some, none, percent=50).collect())
    assert got == brute_draw([(1, "word " * 30), (2, "other " * 30)], [], 1, 1, 10_000, 50, 20)


def test_rows_that_are_alike_share_the_ranks(spark):
    same = table(spark, [(7, "one text of words " * 10)] * 40).withColumn("text", F.col("text"))
    rows = importance.resampled(same, same, percent=50).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 21)) and len(rows) == 40


def test_buckets_of_a_slice():
    texts = pa.array(["zero", "One two", None, "two-ONE two"]).slice(1)
    bucket, owner, n = importance.buckets_of(texts, 1, 2, 1 << 31)
    want = ["one", "two", "two", "one", "two", "one two", "two one", "one two"]
    assert bucket.tolist() == [zlib.crc32(w.encode()) % (1 << 31) for w in want] and n.tolist() == [2, 0, 3]
    assert owner.tolist() == [0, 0, 2, 2, 2, 0, 2, 2]
