"""Near-duplicate documents and repeated passages against brute force over small tables."""

import collections
import random
import re

import numpy as np
import pytest

from tillroll.llm import minhash, near, passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(sets, percent):
    keys = sorted(sets)
    up = {k: k for k in keys}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(keys):
        for b in keys[:i]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def corpus(n_groups=6, seed=1):
    """Groups of copies edited more and more, an exact group, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    out = []
    for g in range(n_groups):
        base = [word() for _ in range(60 + 20 * g)]
        for _ in range(1 + 4 * g):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    out += ["same TEXT here"] * 3 + ["Same text\there"] + [None, None, "", " \n", "one", "One", "two words", "x " * 5000]
    rng.shuffle(out)
    return list(enumerate(out, 10))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    rows = corpus()
    got = {r.doc_id: r for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
    sets = {d: shingles(t, k) for d, t in rows}
    want = components(sets, percent)
    assert {d: r.component_id for d, r in got.items()} == want
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_large_family_is_compared_across_blocks(spark, monkeypatch):
    """A family of many blocks: links between blocks that the centre doesn't make are found too."""
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 300)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows, d = [], 0
    chain = list(base)
    for _ in range(30):  # a chain: neighbours are alike, its ends are not
        d += 1
        rows.append((d, " ".join(chain)))
        for _ in range(2):
            chain[rng.randrange(120)] = f"n{rng.random()}"
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == components({d: shingles(t, 3) for d, t in rows}, 85)


def test_null_ids_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(1, "a b c d e f", 7), (1, "a b c d e f", 8), (2, "a b c d e f", 9), (None, "a b c d e f", 1), (None, None, 1), (3, None, 2)],
        "doc_id long, text string, id long").withColumnRenamed("id", "component_id")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, False), (1, 1, True), (2, 1, False), (3, 3, True), (None, 1, False), (None, None, True)]
    left = minhash.deduplicated(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 3, None]


def test_different_texts_under_one_id(spark):
    """Rows are compared and go one by one, whatever their doc_id."""
    one, two = ("alpha beta gamma delta epsilon zeta " * 3 + x for x in "ab")
    texts = [(1, "one " + one), (2, "one " + one), (2, "two " * 9 + two[20:]), (3, "three " * 7), (3, "four five six seven eight nine ten")]
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(texts)], "doc_id long, text string, _row int")
    assert sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()) == [
        (1, 1, True), (2, 1, False), (2, 2, True), (3, 3, True), (3, 3, True)]
    left = minhash.deduplicated(df)
    assert left.columns == df.columns and sorted(r._row for r in left.collect()) == [0, 2, 3, 4]
    # a near copy under an id with other texts, before and after them
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words), " ".join([*words[:59], "other"])]
    for d in (0, 9):
        rows = [(5, "own text of the document here", 0), (5, near[0], 1), (5, "another text of its own kind", 2), (d, near[1], 3)]
        kept = {r.i for r in minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, i int")).collect()}
        assert kept == {0, 2, 3 if d == 0 else 1}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []
    assert passages.repeated_passages(empty).collect() == []


def test_bands_miss_no_more_than_asked():
    for threshold, rows, miss in [(0.85, 5, 1e-6), (0.8, 2, 5e-3)]:
        b = near.bands_for(threshold, rows, miss)
        assert (1 - threshold ** rows) ** b <= miss < (1 - threshold ** rows) ** (b - 1)


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    b = np.concatenate((a[:2000], rng.integers(0, 1 << 63, 1000, dtype=np.uint64)))
    m = near.minima([a, np.unique(b)], near.hash_family(400, 3))
    assert abs((m[0] == m[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.08


def expected_passages(texts, percent=80, k=5, least=passages.PASSAGE_WORDS):
    listed = []
    for d in sorted(texts):
        for j, (a, b) in enumerate(passages.units(texts[d] or "")):
            n = len(WORD.findall(texts[d][a:b]))
            listed.append((d, j, a, b, n, shingles(texts[d][a:b], k) if n >= passages.LEAST_WORDS else None))
    keys = {}
    for u in listed:
        if u[5] is not None:
            keys.setdefault(u[5], len(keys))
    comp = components({i: s for s, i in keys.items()}, percent)
    held = collections.defaultdict(list)
    for u in listed:
        if u[5] is not None:
            held[comp[keys[u[5]]]].append(u[:2])
    out = set()
    for d in texts:
        runs, last = [], -1
        for u in (u for u in listed if u[0] == d):
            at = held[comp[keys[u[5]]]] if u[5] is not None else None
            kind = last if at is None else -1 if len(at) < 2 else 2 if at[0] == u[:2] else 1
            if not runs or kind != last:
                runs.append((kind, []))
            runs[-1][1].append(u)
            last = kind
        for kind, run in runs:
            while run and run[-1][5] is None:
                run.pop()
            n = sum(u[4] for u in run)
            if kind > 0 and n >= least:
                out.add((d, run[0][2], run[-1][3] - run[0][2], n, kind == 2))
    return out


def passage_corpus():
    rng = random.Random(3)
    sentence = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)).capitalize() + "."
    shared = [sentence(14) for _ in range(5)]
    edited = [s[:-1] + "q." if i == 2 else s for i, s in enumerate(shared)]
    texts = {}
    for d in range(1, 16):
        own = [sentence(rng.randint(4, 25)) for _ in range(6)]
        at = rng.randrange(6)
        if d <= 4:
            own[at:at] = shared
        elif d == 5:
            own[at:at] = edited
        elif d == 6:  # too short a repeat
            own[at:at] = shared[:1]
        text = " ".join(own)
        texts[d] = text.replace(". ", ".\n", 2) if d % 2 else text
    texts[20], texts[21], texts[22] = None, "", "\n \n"
    return texts


def test_passages_equal_brute_force(spark):
    texts = passage_corpus()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = passages.repeated_passages(df)
    rows = got.collect()
    assert {(r.doc_id, r.start, r.length, r.n_words, r.kept) for r in rows} == expected_passages(texts)
    hit = {r.doc_id for r in rows}
    assert hit == {1, 2, 3, 4, 5}
    cleaned = {r.doc_id: r.text for r in passages.without_repeats(df, got).collect()}
    for d, t in texts.items():
        want = t
        for _, s, n, _, _ in sorted((x for x in expected_passages(texts) if x[0] == d and not x[4]), reverse=True):
            want = want[:s] + want[s + n:]
        assert cleaned[d] == want


def test_confirmed_links_leave_no_texts_staged(spark):
    import glob

    from tillroll.llm.jobs import ensure_checkpoint_dir
    from tillroll.llm.near import confirmed_links

    root = ensure_checkpoint_dir(spark).split(":", 1)[-1]
    before = set(glob.glob(f"{root}/tillroll-members-*"))
    text = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(1, text), (2, text + " end")], "id long, text string")
    links = spark.createDataFrame([(2, 1)], "a long, b long")
    sizes = spark.createDataFrame([(1, 38), (2, 39)], "id long, n_shingles long")
    found = confirmed_links(links, lambda bitmap: items, sizes, 3, 85)
    assert [tuple(r) for r in found.collect()] == [(2, 1)]
    assert set(glob.glob(f"{root}/tillroll-members-*")) == before
