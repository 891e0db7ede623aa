"""The Spark operators against brute force over small tables: odd texts, ties, repeats, clashes, empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import fingerprint, lm, mixing, packing, pii, quality, tokencount, topk
from tillroll.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
TOKENIZER = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    out = {d: " ".join(word() for _ in range(rng.randint(1, 200))).replace(" a", ".\nA") for d in range(1, 41)}
    out |= {50: None, 51: "", 52: " \t\n", 53: "é" * 10, 54: "long " * 6000, 55: out[1], 56: out[1], -7: "negative id"}
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, f"s{d % 4}" if d % 9 else None, "en", len(t or ""), 1) for d, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, length int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


# --- packing -------------------------------------------------------------------------------------

def expected_pieces(texts, capacity):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    out = collections.Counter()
    for d, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), capacity):
            cut = ids[s:s + capacity]
            out[d, s // capacity, s, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    return out


@pytest.mark.parametrize("capacity", [4096, 256])
def test_packing_places_every_piece_once(spark, docs, texts, capacity):
    twice = docs.unionByName(docs.where("doc_id in (3, 54)")).unionByName(
        docs.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")))
    rows = packing.pack(twice, TOKENIZER, capacity).collect()
    given = [*texts.items(), (3, texts[3]), (54, texts[54]), (None, texts[2])]
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected_pieces(given, capacity)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    bound = -(-sum(r.length for r in rows) // capacity)
    assert len(by) <= bound + max(2, bound // 8)


def test_packing_of_nothing(empty):
    assert packing.pack(empty, TOKENIZER).collect() == []


def test_pieces_do_not_depend_on_the_text_handled_at_once(docs):
    cut = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want, got = (sorted(packing.pieces(docs, TOKENIZER, 64, chunk=n).select(*cut).collect(), key=str) for n in (4 << 20, 100))
    assert got == want
    # next to what the pipeline's earlier stages hold, packing takes less at once
    assert corpus_pipeline.PACKING_CHUNK < packing.TOKEN_CHUNK


# --- token counts ---------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [1 << 20, 64, 5])
def test_token_counts_equal_the_tokenizer(spark, docs, texts, block):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    ids = [d for d in texts if block > 5 or d != 54]
    some = docs.where(F.col("doc_id").isin(ids)).unionByName(
        docs.where("doc_id in (2, 50)").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(docs.where("doc_id = 51"))
    got = collections.Counter((r.doc_id, r.n_tokens) for r in tokencount.document_tokens(some, TOKENIZER, block).collect())
    count = lambda x: len(t.encode(x or "", add_special_tokens=False).ids)
    want = collections.Counter((d, count(texts[d])) for d in ids) + collections.Counter(
        [(None, count(texts[2])), (None, 0), (51, 0)])
    assert got == want


def test_flat_files_of_others(spark, tmp_path):
    """32-bit files without headers, an open last document, an empty file, and a torn one."""
    np.array([5, 6, 9, 9, 7, 9, 1, 2, 3], "<u4").tofile(tmp_path / "a")
    (tmp_path / "b").write_bytes(b"")
    for block in (1, 2, 4, 100):
        rows = tokencount.count_tokens(spark, str(tmp_path), end=9, width=4, block_tokens=block).orderBy("document").collect()
        assert [(r.document, r.start, r.n_tokens, r.closed) for r in rows] == [
            (0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, True), (3, 6, 3, False)]
    (tmp_path / "c").write_bytes(b"abc")
    with pytest.raises(Exception, match="multiple"):
        tokencount.count_tokens(spark, str(tmp_path), end=9, width=4).collect()


def test_token_counts_of_nothing(empty):
    assert tokencount.document_tokens(empty, TOKENIZER).collect() == []


# --- mixing ---------------------------------------------------------------------------------------

def test_mix_meets_its_targets_and_reruns_agree(spark, docs, texts):
    size = {d: len(WORD.findall(t or "")) for d, t in texts.items()}
    some = docs.where("doc_id <> 54")
    rows = mixing.taken_words(some, block_words=50, shard_words=400).collect()
    assert {r.doc_id: r.size for r in rows} == {d: n for d, n in size.items() if d != 54}
    source = {r.doc_id: r.source for r in some.select("doc_id", "source").collect()}
    by = collections.defaultdict(lambda: [0, 0])
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        by[source[r.doc_id]][0] += r.size
        by[source[r.doc_id]][1] += r.taken
    names = sorted((s for s in by if s is not None)) + [None]
    aim = mixing.targets([by[s][0] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], mixing.Fraction(3, 2), 2)
    for s, t in zip(names, aim):
        assert abs(by[s][1] - t) <= max(size[d] for d in source if source[d] == s)
    for r in rows:
        assert (r.source_size, r.target) == (by[source[r.doc_id]][0], pytest.approx(float(aim[names.index(source[r.doc_id])])))
    again = mixing.taken_words(some.repartition(7), block_words=50, shard_words=400).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mix_shards_are_even_and_documents_follow(spark, docs):
    some = docs.where("doc_id <> 54")
    m = mixing.mix(some, block_words=50, shard_words=400)
    drawn = m.drawn.collect()
    shards = collections.Counter(r.shard for r in drawn)
    assert len(shards) == m.shards > 5
    for s in shards:
        assert sorted(r.position for r in drawn if r.shard == s) == list(range(shards[s]))
    out = mixing.mixed_documents(some, block_words=50, shard_words=400)
    assert out.columns == some.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(r.doc_id for r in drawn)


def test_mix_of_repeated_rows_null_ids_and_nothing(spark, empty):
    df = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (None, "d e", None), (None, None, None), (2, "f g h i", "y")],
                               "doc_id long, text string, source string")
    rows = mixing.taken_words(df).collect()
    assert len(rows) == 5 and sorted(r.size for r in rows) == [0, 2, 3, 3, 4]
    assert len({r.taken for r in rows if r.doc_id == 1}) == 1
    assert mixing.taken_words(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


# --- fingerprints ---------------------------------------------------------------------------------

PART = re.compile(r"[^\n]{120,400}?[.!?](?=[ \t\n\x0b\f\r])|[^\n]{1,400}")


def paragraphs(text):
    return {p.strip(" ") for p in PART.findall(text)} - {""}


def test_fingerprints_equal_brute_force(spark, docs, texts):
    rows = fingerprint.edited_fingerprints(docs.unionByName(
        docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 1
    ids = sorted(texts, reverse=True)
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, d in enumerate(ids):
        t, n = texts[d] or "", texts[ids[(i + 1) % len(ids)]] or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + n[:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(paragraphs(t), paragraphs(edited)))
        assert r.near_next == pytest.approx(like(paragraphs(t), paragraphs(n)))
    assert got[1].fingerprint == got[55].fingerprint == got[56].fingerprint != got[2].fingerprint
    assert got[None].fingerprint == got[5].fingerprint and got[None].near_next is None


def test_peeling_recovers_the_difference_and_larger_sketches_the_rest(spark):
    rng = random.Random(1)
    pairs = []
    for i in range(30):
        common = [rng.getrandbits(63) for _ in range(200)]
        a, b = [rng.getrandbits(63) for _ in range(3 * i)], [rng.getrandbits(63) for _ in range(2 * i)]
        pairs.append((i, common + a, common + b))
    df = spark.createDataFrame(pairs, "id long, a array<long>, b array<long>")
    for r in fingerprint.likeness(df, ["id"]).collect():
        assert (r.plus, r.minus) == (3 * r.id, 2 * r.id) and r.near == pytest.approx(200 / (200 + 5 * r.id))
    rows = df.where("id = 4").select("id", F.lit(16).cast("long").alias("w"), F.inline(F.concat(
        F.transform("a", lambda d: F.struct(F.lit(1).cast("long").alias("sign"), d.alias("digest"))),
        F.transform("b", lambda d: F.struct(F.lit(-1).cast("long").alias("sign"), d.alias("digest"))))))
    found = fingerprint.peel(fingerprint.sketch(rows, ["id"]), ["id"]).collect()
    assert {(r.key, r.cnt) for r in found if r.cell == -1} == {(d, 1) for d in pairs[4][1][200:]} | {(d, -1) for d in pairs[4][2][200:]}


def test_fingerprints_of_one_and_of_nothing(spark, docs, empty):
    [r] = fingerprint.edited_fingerprints(docs.where("doc_id = 3")).collect()
    assert r.near_next == 1.0
    assert fingerprint.edited_fingerprints(empty).collect() == []


# --- pseudonyms -----------------------------------------------------------------------------------

def test_pseudonyms_over_a_table(spark, empty):
    df = spark.createDataFrame([(1, "mail a.b1@x.org, a.b1@x.org"), (2, "A.B1@X.ORG and a.b1@x.org"), (2, None), (None, "none"),
                                (3, ""), (4, "x" * 100_000 + " 4111111111111111")], "doc_id long, text string").withColumn(
        "pii", F.lit(1)).withColumn("kind", F.lit("k"))
    out = pii.pseudonymised(df, b"key")
    assert out.columns == ["doc_id", "text", "kind", "pii"]
    rows = out.collect()
    one = next(r for r in rows if r.doc_id == 1)
    new = one.pii[0]["pseudonym"]
    assert one.text == f"mail {new}, {new}" and new != "a.b1@x.org"
    two = next(r.text for r in rows if r.doc_id == 2 and r.text)
    assert two.endswith(new) and two.split(" ")[0].lower().split("@")[0] == new.split("@")[0]
    assert sorted(len(r.pii) for r in rows) == [0, 0, 0, 1, 2, 2]
    assert [r.text for r in rows if r.doc_id is None] == ["none"] and len(rows) == 6
    assert pii.pseudonymised(empty, b"key").collect() == []


# --- quality --------------------------------------------------------------------------------------

def test_classifier_learns_held_out_rows_and_odd_tables(spark, empty):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 7)))
    rows = []
    for d in range(240):
        w = [word() for _ in range(rng.randint(10, 80))]
        if d % 3 == 0:
            w = [x + "###" for x in w] if d % 2 else [w[0]] * len(w)
        rows.append((d, " ".join(w), int(d % 3 != 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality.train(df.select("doc_id", "text"), df.where("doc_id % 5 <> 1").select("doc_id", "label"), sample=60)
    docs = df.unionByName(spark.createDataFrame([(None, None, 1), (999, "", 0), (3, rows[3][1], 0)], df.schema)).withColumn("score", F.lit("x"))
    got = quality.scored(docs, model).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id % 5 == 1 and r.doc_id < 900]
    assert sum(r.predicted == r.label for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got) and len(got) == 243
    flat = quality.train(df.select("doc_id", "text"), df.where("label = 1").select("doc_id", "label"))
    assert {r.score for r in quality.scored(docs, flat).collect()} == {0.5}
    none = quality.train(empty.select("doc_id", "text"), df.where("false").select("doc_id", "label"))
    assert quality.scored(empty, none).collect() == []


# --- language model -------------------------------------------------------------------------------

def test_scores_equal_brute_force_and_are_probabilities(spark, docs, texts, empty):
    settings = lm.Settings(classes=64, suffix_classes=16, common=100, dimensions=8, noise=8)
    train = docs.where("doc_id % 5 <> 1").select("text")
    model, counts = lm.train(train, settings)
    twice = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))
    rows = lm.scored(twice, model, counts).collect()
    assert len(rows) == len(texts) + 2
    tokens = {d: WORD.findall((t or "").translate(LOWER)) + [lm.END] for d, t in texts.items()}
    c = collections.Counter(w for d, ws in tokens.items() if d % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    a, b, z = (x.astype(float) for x in lm.log_tables(model))
    first = settings.classes - settings.suffix_classes
    mass = collections.defaultdict(lambda: 0.5)
    kind = lambda w: model.word_class.get(w, first + lm.suffix_class(w, settings.suffix_classes))
    for w in c:
        if w not in model.word_class:
            mass[kind(w)] += c[w] + 0.5
    for r in rows:
        ws = tokens[6 if r.doc_id is None else r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        ks, score = [kind(w) for w in ws], 0.0
        for i, (w, k) in enumerate(zip(ws, ks)):
            one, two = ks[i - 1] if i else 0, ks[i - 2] if i > 1 else 0
            score += (a[one, k] + b[two, k] - z[one, two]) / math.log(10)
            if k >= first:
                score += math.log10((c[w] + 0.5) / mass[k])
        assert r.score == pytest.approx(score, rel=1e-5)
    model, counts = lm.train(empty.select("text"), settings)
    assert lm.scored(empty, model, counts).collect() == []
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in lm.scored(docs, model, counts).collect())


def test_training_beats_the_unigram_where_context_tells(spark):
    rng = random.Random(6)
    langs = [[f"{x}{i}" for i in range(40)] for x in "abcd"]
    rows = [(d, " ".join(rng.choice(langs[d % 4]) for _ in range(120))) for d in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts = lm.train(df.where("doc_id % 5 <> 1"), lm.Settings(classes=200, suffix_classes=16, dimensions=8, batch=256))
    held = lm.scored(df.where("doc_id % 5 = 1"), model, counts).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (held[0] - held[1]) / held[2] > 0.2  # 0.6 is what knowing the language gives


# --- top-k ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [4096, 37])
def test_top_k_equals_sorting(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)]
    rows += [(2000, None), (2001, [1.0] * 5 + [float("nan")]), (2002, [1.0] * 5 + [None]), (2003, [float("inf")] + [0.0] * 5),
             (2004, []), (2005, [1.0, 2.0]), (2010, [1.0, 1.0]), (None, rows[0][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = topk.top_k(df, df.where("vec_id % 5 = 0")).collect()
    usable = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            usable[i] = [math.floor(256 * x) for x in e]
    want = set()
    for q in (i for i in usable if i % 5 == 0):
        s = sorted((-sum(x * y for x, y in zip(usable[q], usable[i])), i) for i in usable if i != q and len(usable[i]) == len(usable[q]))
        want |= {(q, r, i, -v) for r, (v, i) in enumerate(s[:5], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.where("false"), df.where("false")).collect() == []


def test_top_k_sends_queries_in_parts(spark, monkeypatch):
    """Queries' blocks are not copied for each group of vectors in a broadcast join: no more than SENT_BYTES go at once."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "SENT_BYTES", 1 << 13)
    rng = np.random.default_rng(6)
    vectors = rng.integers(-9, 10, (600, 6))
    df = spark.createDataFrame([(i, (x / 256).tolist()) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    sizes, real = [], type(spark.sparkContext).broadcast

    def send(self, value):
        sizes.append(sum(len(m) for _, _, m in value))
        return real(self, value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", send)
    got = topk.top_k(df, df.where("vec_id % 2 = 0"))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().toString()
    want = set()
    for i in range(0, 600, 2):
        s = vectors @ vectors[i]
        want |= {(i, r, j, int(s[j])) for r, j in enumerate(sorted((j for j in range(600) if j != i), key=lambda j: (-s[j], j))[:5], 1)}
    assert {tuple(r) for r in got.collect()} == want
    assert len(sizes) > 1 and max(sizes) <= 1 << 13 and sum(sizes) == 300 * 6 * 8


def test_stored_fingerprints_subtract(spark):
    """Two stored fingerprints give back what only one text holds, and the likeness of the digests."""
    texts = {1: ["alpha beta", "gamma", "delta"], 2: ["alpha beta", "gamma", "epsilon"], 3: [], 4: [f"line {i}" for i in range(900)]}
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "id long, text string")
    digests = df.select("id", fingerprint.paragraph_digests(F.col("text")).alias("digests"))
    stored = {r.id: r.fingerprint for r in fingerprint.fingerprints(digests, ["id"]).collect()}
    own = {r.id: set(r.digests) for r in digests.collect()}
    pairs = spark.createDataFrame([(a, b, stored[a], stored[b]) for a in texts for b in texts], "a long, b long, x string, y string")
    for r in fingerprint.difference(pairs, ["a", "b"], "x", "y").collect():
        if r.whole:
            assert (set(r.plus), set(r.minus)) == (own[r.a] - own[r.b], own[r.b] - own[r.a])
        else:
            assert 4 in (r.a, r.b)
        assert r.whole or r.a != r.b
    with pytest.raises(Exception, match="no fingerprint"):
        fingerprint.decoded(spark.createDataFrame([("text",)], "fingerprint string"), []).collect()


def test_counts_above_four_digits_are_stored_whole(spark):
    value = spark.createDataFrame([(70_000,), (15,), (-1,)], "n long")
    assert [r[0] for r in value.select(fingerprint._hex(F.col("n"), 4)).collect()] == ["11170", "000f", "f" * 16]
    many = spark.range(300_000).groupBy(F.lit(1).alias("id")).agg(F.collect_list(F.xxhash64("id")).alias("digests"))
    stored = fingerprint.fingerprints(many, ["id"])
    back = fingerprint.decoded(stored, ["id"]).where("cell >= 0").agg(F.sum("cnt"), F.count("*")).first()
    assert tuple(back) == (900_000, 48)


def test_fingerprints_of_rows_that_share_an_id(spark):
    rows = [(7, "first text"), (7, "second text here"), (7, None), (3, "third")]
    got = fingerprint.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got) == [(3, 5), (7, 0), (7, 10), (7, 16)]
    assert len({r.fingerprint for r in got}) == 4 and all(r.near_next is not None for r in got)


@pytest.mark.parametrize("n", [1, 3, 40, 250, 10_000])
def test_commonest_words_are_cut_before_they_are_sorted(spark, n):
    rng = random.Random(n)
    held = [(f"w{i}", rng.choice([1] * 60 + [2] * 9 + [3, 5, 1023, 1024, 1100, 10 ** 6, 10 ** 12])) for i in range(3000)]
    got = [r.c for r in lm.commonest(spark.createDataFrame(held, "word string, c long"), n).collect()]
    assert got == sorted((c for _, c in held), reverse=True)[:n]


def test_sampled_ids_are_those_of_the_smallest_hash(spark):
    rows = spark.range(5000).select((F.col("id") % 4000).alias("id"))
    want = {r.id for r in rows.distinct().orderBy(F.xxhash64(F.lit(5), "id")).limit(50).collect()}
    assert {r.id for r in quality._sampled_ids(rows, 5000, 50, 5).collect()} == want
    hot = spark.range(20_000).select((F.col("id") % 60).alias("id"))  # few ids, many rows: the cut is widened
    assert quality._sampled_ids(hot, 20_000, 50, 5).count() == 50
    assert quality._sampled_ids(rows.where("id < 3"), 3, 50, 5).count() == 3
