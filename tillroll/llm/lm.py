"""Log-bilinear language model trained by noise-contrastive estimation (operator 2)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.jobs import write_stage
from tillroll.llm.words import chunks, words

# the end of a text as a token; words hold no white space, so none equals it
END = " "
# classes that the model predicts: the commonest words each alone, all others by their last two characters
CLASSES, SUFFIX_CLASSES = 2_048, 128
# the commonest words, whose counts travel with the model; counts of rarer ones are joined
COMMON_WORDS = 131_072
DIMENSIONS, NOISE, BATCH, RATE = 24, 32, 4_096, 0.15
CONTEXT = 2
_TABLES: dict = {}


@dataclass
class Settings:
    classes: int = CLASSES
    suffix_classes: int = SUFFIX_CLASSES
    common: int = COMMON_WORDS
    dimensions: int = DIMENSIONS
    noise: int = NOISE
    batch: int = BATCH
    rate: float = RATE
    seed: int = 2


@dataclass
class Model:
    """Parameters and the counts that travel with them.

    The prediction for a context is the sum of its words' vectors ``r``, each scaled by its place's
    ``c``; a class scores its vector ``q`` times the prediction plus its bias ``b``.
    """

    settings: Settings
    word_class: dict[str, int]
    common: dict[str, int]
    class_mass: np.ndarray  # per suffix class: log10 of the counts + 0.5 of its words and of one unseen word
    tokens: int
    types: int
    r: np.ndarray
    q: np.ndarray
    c: np.ndarray
    b: np.ndarray


def suffix_class(word: str, n: int) -> int:
    return zlib.crc32(word[-2:].encode()) % n


def classes_of(vocab: list[str], model: Model) -> np.ndarray:
    first = model.settings.classes - model.settings.suffix_classes
    known = model.word_class
    return np.fromiter((known[w] if w in known else first + suffix_class(w, model.settings.suffix_classes)
                        for w in vocab), np.int64, len(vocab))


def _sequence(codes: np.ndarray, offsets: np.ndarray, values: np.ndarray, end: int) -> np.ndarray:
    """Per text its words' values and then ``end``, all texts in a row."""
    n = len(offsets) - 1
    out = np.full(len(codes) + n, end, np.int64)
    if len(codes):
        doc = np.repeat(np.arange(n), np.diff(offsets))
        out[np.arange(len(codes)) + doc] = values[codes]
    return out


def _contexts(seq: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The one and two tokens before each token; ends stand before a text's first."""
    one = np.empty_like(seq)
    one[1:], one[:1] = seq[:-1], end
    one[starts] = end
    two = np.empty_like(seq)
    two[2:], two[:2] = seq[:-2], end
    two[starts] = end
    second = starts + 1
    two[second[second < len(seq)]] = end
    return one, two


def _gather(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and their summed gradients."""
    order = np.argsort(rows, kind="stable")
    srt = rows[order]
    at = np.flatnonzero(np.concatenate(([True], srt[1:] != srt[:-1])))
    return srt[at], np.add.reduceat(grads[order], at, axis=0)


def nce_pass(batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], params: dict[str, np.ndarray],
             noise_p: np.ndarray, s: Settings, seed: int) -> int:
    """One pass of noise-contrastive estimation with per-row Adagrad over (class, one before, two before).

    All tokens of a batch share the same noise classes, drawn from the unigram distribution, so the
    scores of noise are one matrix product.  Returns the number of tokens.
    """
    rng = np.random.default_rng(seed)
    cum = np.cumsum(noise_p)
    log_kp = np.log(s.noise * noise_p).astype(np.float32)
    grown = {k: np.full(len(v) if k != "c" else len(v), 1e-2, np.float32) for k, v in params.items()}
    r, q, c, b = (params[k] for k in ("r", "q", "c", "b"))
    seen = 0

    def step(name, rows, grad):
        size = (grad * grad).mean(axis=1) if grad.ndim > 1 else grad * grad
        grown[name][rows] += size
        rate = s.rate / np.sqrt(grown[name][rows])
        params[name][rows] += (rate[:, None] if grad.ndim > 1 else rate) * grad

    for w, one, two in batches:
        for a in range(0, len(w), s.batch):
            t, x, y = w[a:a + s.batch], one[a:a + s.batch], two[a:a + s.batch]
            n = len(t)
            drawn = np.minimum(np.searchsorted(cum, rng.random(s.noise) * cum[-1]), len(cum) - 1)
            rx, ry, qt, qn = r[x], r[y], q[t], q[drawn]
            hat = c[0] * rx + c[1] * ry
            good = np.einsum("ij,ij->i", qt, hat) + b[t] - log_kp[t]
            bad = hat @ qn.T + (b[drawn] - log_kp[drawn])
            gain = 1 / (1 + np.exp(np.clip(good, -30, 30)))  # 1 - sigmoid
            loss = -1 / (1 + np.exp(-np.clip(bad, -30, 30)))  # -sigmoid
            scale = np.float32(1 / math.sqrt(n))
            g_hat = gain[:, None] * qt + loss @ qn
            step("c", np.arange(2), np.stack([(g_hat * rx).sum(0), (g_hat * ry).sum(0)]) * scale * np.float32(0.1))
            rows, grads = _gather(np.concatenate((x, y)), np.concatenate((c[0] * g_hat, c[1] * g_hat)))
            step("r", rows, grads * scale)
            rows, grads = _gather(np.concatenate((t, drawn)), np.concatenate((gain[:, None] * hat, loss.T @ hat)))
            step("q", rows, grads * scale)
            rows, grads = _gather(np.concatenate((t, drawn)), np.concatenate((gain, loss.sum(0)))[:, None])
            step("b", rows, grads[:, 0] * scale * np.float32(0.1))
            seen += n
    return seen


def log_tables(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A, B, Z): log P(w | one, two) = A[one, w] + B[two, w] - Z[one, two], natural logarithm, float32.

    The score is a sum over the context's places, so the normaliser of every pair of context classes
    comes from a product of two matrices of exponentials.
    """
    a = (model.r * model.c[0]) @ model.q.T + model.b
    b = (model.r * model.c[1]) @ model.q.T
    ma, mb = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
    z = np.log(np.maximum(np.exp(a - ma) @ np.exp(b - mb).T, 1e-37))
    return a - ma, b - mb, z


def commonest(counts: DataFrame, n: int) -> DataFrame:
    """``n`` rows of ``counts (word, c)`` with the largest counts, in order of count and word.

    A histogram of the counts (a few thousand numbers) gives the count where the n-th word lies; what lies
    below it is dropped before anything is sorted, and of the words right at it a part by their hash that
    surely holds enough.  So one task never sees more than about five times ``n`` rows.
    """
    level = F.when(F.col("c") < 1024, F.col("c")).otherwise(F.floor(F.log2("c") * 64) + 384).cast("long")
    held = {r["level"]: r["words"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()}
    above, cut = 0, None
    for at in sorted(held, reverse=True):
        if above + held[at] >= n:
            cut = at
            break
        above += held[at]
    if cut is None:
        return counts.orderBy(F.desc("c"), "word")
    part = min(1.0, (4 * (n - above) + 100) / held[cut])
    least = F.xxhash64(F.lit(17), "word") <= F.lit(min((1 << 63) - 1, int(part * (1 << 64)) - (1 << 63)))
    return counts.where((level > cut) | ((level == cut) & least)).orderBy(F.desc("c"), "word").limit(n)


def train(texts: DataFrame, settings: Settings | None = None) -> tuple[Model, DataFrame]:
    """The model of ``texts (text)`` and its counts ``(word, c)`` as a stored table.

    Word counts, their total and the class masses are taken over all texts in Spark; only the
    commonest words (a fixed number) reach the driver.  Every partition then makes one pass of
    noise-contrastive estimation over all its tokens from the same start, and the parameters are
    averaged by tokens in Spark, element by element.
    """
    s = settings or Settings()
    spark = texts.sparkSession

    def tally(batches):
        for batch in batches:
            for part in chunks(batch, limit=16 << 20):
                codes, offsets, vocab = words(part.column(0))
                n = np.bincount(codes, minlength=len(vocab))
                names = pa.concat_arrays([vocab.cast(pa.string()), pa.array([END])])
                yield pa.RecordBatch.from_arrays([names, pa.array(np.append(n, len(offsets) - 1))], names=["word", "c"])

    counts = write_stage(texts.select("text").mapInArrow(tally, "word string, c long")
                         .groupBy("word").agg(F.sum("c").alias("c")), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                       F.sum(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    top = commonest(counts, s.common).toArrow()
    common = dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist()))
    if total["ends"] is not None:  # travels even where there are too few texts for it to be common
        common[END] = total["ends"]
    first = s.classes - s.suffix_classes
    own = [w for w in list(common) if w != END][:first - 1]
    word_class = {END: 0} | {w: i for i, w in enumerate(own, 1)}
    listed = spark.createDataFrame([(w,) for w in word_class], "word string")
    rest = counts.join(F.broadcast(listed), "word", "left_anti")  # at most s.classes words
    suffix = F.pmod(F.crc32(F.encode(F.right("word", F.lit(2)), "UTF-8")), F.lit(s.suffix_classes))
    mass, tokens = np.full(s.suffix_classes, 0.5), np.zeros(s.suffix_classes)
    for r in rest.groupBy(suffix.alias("k")).agg(F.sum(F.col("c") + 0.5).alias("m"), F.sum("c").alias("c")).collect():
        mass[r["k"]] += r["m"]
        tokens[r["k"]] += r["c"]
    seen = np.concatenate(([common.get(w, 0) for w in word_class], np.zeros(first - len(word_class)), tokens))
    p = (seen + 0.5) / (seen + 0.5).sum()
    rng = np.random.default_rng(s.seed)
    model = Model(s, word_class, common, np.log10(mass), int(total["n"]), int(total["v"]),
                  rng.normal(0, 0.1, (s.classes, s.dimensions)).astype(np.float32),
                  rng.normal(0, 0.1, (s.classes, s.dimensions)).astype(np.float32),
                  np.ones((2, s.dimensions), np.float32), np.log(p).astype(np.float32))
    shared = spark.sparkContext.broadcast((model, p))
    shapes = [("r", model.r.shape), ("q", model.q.shape), ("c", model.c.shape), ("b", model.b.shape)]

    def learn(batches):
        m, noise = shared.value
        params = {k: getattr(m, k).copy() for k, _ in shapes}

        def triples():
            for batch in batches:
                for part in chunks(batch):
                    codes, offsets, vocab = words(part.column(0))
                    seq = _sequence(codes, offsets, classes_of(vocab.to_pylist(), m), 0)
                    starts = offsets[:-1] + np.arange(len(offsets) - 1)
                    yield seq, *_contexts(seq, starts, 0)

        n = nce_pass(triples(), params, noise, m.settings, m.settings.seed)
        if n:
            flat = np.concatenate([params[k].ravel() for k, _ in shapes]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * n), pa.array(np.full(len(flat), n, np.int64))],
                names=["place", "value", "n"])

    got = (texts.select("text").mapInArrow(learn, "place long, value double, n long").groupBy("place")
           .agg((F.sum("value") / F.sum("n")).alias("value")).toArrow())
    if got.num_rows:
        flat = np.zeros(sum(math.prod(x) for _, x in shapes), np.float32)
        flat[got.column("place").to_numpy()] = got.column("value").to_numpy()
        at = 0
        for k, x in shapes:
            setattr(model, k, flat[at:at + math.prod(x)].reshape(x))
            at += math.prod(x)
    return model, counts


def _tables(key, model: Model):
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = log_tables(model)
    return _TABLES[key]


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs``.

    Tokens are the text's words (A-Z lower-cased) and one end.  ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) with the training counts; ``score`` is the model's log10
    probability of the text: the class of each token given the two before it, and for a word of a
    suffix class its share c + 0.5 of that class, where one unseen word has 0.5.

    Null and empty texts are the end alone.  Repeated rows and null ids are scored row by row; with no
    training text every count is 0.  Other columns are ignored.
    """
    s = model.settings
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    key = f"{spark.sparkContext.applicationId}-{id(shared)}-{shared._jbroadcast.id()}"
    first = s.classes - s.suffix_classes

    def run(batches):
        m = shared.value
        a, b, z = _tables(key, m)
        for batch in batches:
            for part in chunks(batch):
                codes, offsets, vocab = words(part.column(1))
                names = vocab.to_pylist()
                kinds = classes_of(names, m)
                n = len(offsets) - 1
                c = np.fromiter((m.common.get(w, -1) for w in names), np.int64, len(names))
                end_c = m.common.get(END, 0)
                seq = _sequence(codes, offsets, kinds, 0)
                one, two = _contexts(seq, offsets[:-1] + np.arange(n), 0)
                logp = (a[one, seq].astype(np.float64) + b[two, seq] - z[one, two]) / math.log(10)
                ends = offsets[1:] + np.arange(1, n + 1)
                starts = ends - np.diff(offsets) - 1
                model_part = np.add.reduceat(logp, starts) if n else np.zeros(0)
                # per distinct word: its share of its class where its count travels along
                known = c >= 0
                base_w = np.where(known, np.log10(np.maximum(c, 0) + 0.5), 0.0)
                share_w = np.where(kinds >= first, base_w - m.class_mass[np.maximum(kinds - first, 0)], 0.0)
                doc = np.repeat(np.arange(n), np.diff(offsets))
                base = np.bincount(doc, base_w[codes] if len(codes) else None, n) if len(codes) else np.zeros(n)
                share = np.bincount(doc, share_w[codes], n) if len(codes) else np.zeros(n)
                hits = np.bincount(doc, (c[codes] > 0).astype(float), n).astype(np.int64) if len(codes) else np.zeros(n, np.int64)
                # words whose counts are joined: per text its distinct ones with their number
                rare = np.flatnonzero(~known[codes]) if len(codes) else np.zeros(0, np.int64)
                pair, times = np.unique(doc[rare] * len(names) + codes[rare] if len(rare) else rare, return_counts=True)
                owner = pair // max(1, len(names))
                word = vocab.take(pa.array(pair % max(1, len(names))))
                cuts = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
                asked = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                    [word.cast(pa.string()), pa.array(times.astype(np.int64))], names=["word", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets) + 1), pa.array(hits + (end_c > 0)),
                     pa.array(base + math.log10(end_c + 0.5)), pa.array(model_part + share), asked],
                    names=["doc_id", "n_tokens", "hits", "base", "own", "asked"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, hits long, base double, own double, asked array<struct<word:string,n:long>>")
    rows = write_stage(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    asked = rows.select("row", F.inline("asked")).join(counts, "word", "left")
    extra = asked.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("met"))
    whole = math.log10(model.tokens + 0.5 * (model.types + 1))
    return rows.drop("asked").join(extra, "row", "left").select(
        "doc_id", "n_tokens", (F.col("hits") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("own") + F.coalesce("more", F.lit(0.0))).alias("score"))
