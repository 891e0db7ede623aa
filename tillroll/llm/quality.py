"""Quality classifier: naive Bayes features and a linear support vector machine (operator 5)."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.jobs import id_filter, maybe_in, write_stage
from tillroll.llm.words import chunks, hash_strings, mix64, words

# hashed n-gram features
FEATURE_BITS = 18
# labelled rows of each class that the linear model is fitted on (the log-count ratios use all of them)
SAMPLE_PER_CLASS = 2_000
# text handled at once; a text's feature arrays take many times its bytes
FEATURE_CHUNK = 1 << 20
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


@dataclass
class Model:
    """score = sigmoid(slope * (weights over the features present / sqrt(their number) + bias) + offset)"""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, features: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[f].sum() / np.sqrt(max(1, len(f))) + self.bias for f in features])

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        z = np.clip(self.slope * self.margins(features) + self.offset, -35, 35)
        return 1 / (1 + np.exp(-z))


def shape(word: str) -> str:
    """A word's form: its case and its letters and digits as runs, other characters as they are."""
    case = "U" if len(word) > 1 and word.isupper() else "T" if word[:1].isupper() else "l"
    return case + _DIGITS.sub("9", _LETTERS.sub("a", word))


def features(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct feature numbers of each text.

    N-grams of one and two words (lower-cased), and of one to three word shapes, where a word equal
    to the one before it has the shape "same".  A text without words has the one feature "empty".
    """
    codes, offsets, vocab = words(texts, lower=False)
    names = vocab.to_pylist()
    low: dict[str, int] = {}
    same_word = np.fromiter((low.setdefault(w.lower(), len(low)) for w in names), np.int64, len(names))
    by_word = hash_strings(pa.array(list(low), pa.string()), 1)
    shapes: dict[str, int] = {}
    same_shape = np.fromiter((shapes.setdefault(shape(w), len(shapes)) for w in names), np.int64, len(names))
    by_shape = hash_strings(pa.array(list(shapes), pa.string()), 2)
    w = same_word[codes] if len(codes) else np.zeros(0, np.int64)
    n = len(w)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    again = np.zeros(n, bool)
    again[1:] = (w[1:] == w[:-1]) & ~first[1:]
    hw = by_word[w] if n else np.zeros(0, np.uint64)
    hs = by_shape[same_shape[codes]] if n else np.zeros(0, np.uint64)
    hs = np.where(again, np.uint64(0xA5A5_5A5A_1234_9876), hs)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    bits = np.uint64(64 - FEATURE_BITS)
    found = []

    def add(hashes, place):
        found.append(doc[place] << FEATURE_BITS | (mix64(hashes) >> bits).astype(np.int64))

    with np.errstate(over="ignore"):
        p3, p5 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        every = np.arange(n)
        two = every[1:][~first[1:]]
        three = two[two >= 2]
        three = three[~first[three - 1]]
        add(hw, every)
        add(hw[two - 1] * p3 + hw[two], two)
        add(hs + p5, every)
        add((hs[two - 1] * p5 + hs[two]) * p3, two)
        add(((hs[three - 2] * p3 + hs[three - 1]) * p5 + hs[three]) * p3, three)
    keys = np.unique(np.concatenate(found))
    bounds = np.searchsorted(keys, np.arange(len(offsets)) << FEATURE_BITS)
    mask = (1 << FEATURE_BITS) - 1
    return [keys[a:b] & mask if b > a else np.zeros(1, np.int64)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float,
                            epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias minimising ||w||^2 / 2 + cost * sum of hinge losses, one dual variable at a time.

    ``rows`` and ``values`` are the examples' features; y is -1 or 1.  The bias is a constant feature.
    """
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    diagonal = np.array([(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            slope = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / diagonal[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost:
            break
    return w, bias


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid that fits the margins best (Newton steps, lightly damped)."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = np.array([((p - t) * margin).sum() + 1e-3 * (a - 1), (p - t).sum() + 1e-3 * b])
        d = p * (1 - p) + 1e-9
        h = np.array([[(d * margin * margin).sum() + 1e-3, (d * margin).sum()], [(d * margin).sum(), d.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def _sampled_ids(rows: DataFrame, n: int, sample: int, seed: int) -> DataFrame:
    """``(id, place)``: of the ids of ``n`` rows the ``sample`` ones whose hash ``place`` is smallest.

    Ids are cut by their hash before they are sorted, so that about four times ``sample`` are, at any
    number of rows; where ids repeat so often that too few are left, the cut is widened.
    """
    ids = rows.select("id").withColumn("place", F.xxhash64(F.lit(seed), "id")).distinct()
    part = min(1.0, 4 * sample / max(1, n))
    while True:
        cut = ids.where(F.col("place") <= F.lit(min((1 << 63) - 1, int(part * (1 << 64)) - (1 << 63))))
        few = write_stage(cut.orderBy("place").limit(sample), "sample")
        if part >= 1.0 or few.count() >= sample:
            return few
        part = min(1.0, 16 * part)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_CLASS, cost: float = 1.0, epochs: int = 40,
          smoothing: float = 1.0, seed: int = 5) -> Model:
    """Fit on the texts of ``docs`` whose doc_id has a 0/1 label in ``labels (doc_id, label)``.

    Log-count ratios: over all labelled rows, each feature's share of the documents of class 1 against
    class 0, from counts added up in Spark.  Linear model: the texts of at most ``sample`` ids of each class, those
    with the smallest hash (of several texts under an id the smallest); only their ids are sorted, their texts
    are joined afterwards.  Rows with a null id or label are left out; a doc_id labelled
    twice counts twice in the ratios; with one class or none the model scores 0.5 everywhere.
    """
    size = 1 << FEATURE_BITS
    marks = labels.where("doc_id is not null and label in (0, 1)").select(
        F.col("doc_id").cast("long").alias("id"), F.col("label").cast("int").alias("label"))
    bitmap = id_filter(marks.select("id"))

    def held(batches):
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bitmap.value, batch.column(0).to_numpy(zero_copy_only=False))))

    texts = (docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
             .mapInArrow(held, "id long, text string"))
    rows = write_stage(texts.join(marks, "id"), "labelled")

    def count(batches):
        pos, neg, n = np.zeros(size, np.int64), np.zeros(size, np.int64), [0, 0]
        for batch in batches:
            for part in chunks(batch, limit=FEATURE_CHUNK):
                for f, y in zip(features(part.column(1)), part.column(2).to_pylist()):
                    (pos if y else neg)[f] += 1
                    n[y] += 1
        at = np.flatnonzero(pos + neg)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1]), pa.array([*pos[at].tolist(), n[1]]),
                                          pa.array([*neg[at].tolist(), n[0]])], names=["feature", "pos", "neg"])

    counts = (rows.select("id", "text", "label").mapInArrow(count, "feature long, pos long, neg long")
              .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow())
    at = counts.column("feature").to_numpy()
    totals = {c: np.zeros(size + 1) for c in ("pos", "neg")}
    for c, v in totals.items():
        v[at] = counts.column(c).to_numpy()
    n_pos, n_neg = totals["pos"][-1], totals["neg"][-1]
    if not n_pos or not n_neg:
        return Model(np.zeros(size), 0.0, 1.0, 0.0)
    pos, neg = ((totals[c][:-1] + smoothing) / (totals[c][-1] + 2 * smoothing) for c in ("pos", "neg"))
    ratio = np.log(pos / neg)

    picked: list[np.ndarray] = []
    y: list[int] = []

    def numbers(batches):
        for batch in batches:
            for part in chunks(batch, limit=FEATURE_CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f.astype(np.int32) for f in features(part.column(1))], pa.list_(pa.int32()))],
                    names=["place", "f"])
    for label, n in ((0, n_neg), (1, n_pos)):
        ids = _sampled_ids(rows.where(F.col("label") == label), int(n), sample, seed)
        chosen = (rows.where(F.col("label") == label).join(F.broadcast(ids), "id")  # at most ``sample`` ids
                  .groupBy("place").agg(F.min("text").alias("text")))
        got = chosen.select("place", "text").mapInArrow(numbers, "place long, f array<int>").toArrow().sort_by("place")
        for x in got.column("f").combine_chunks() if got.num_rows else []:
            picked.append(x.values.to_numpy().astype(np.int64))
            y.append(1 if label else -1)
    signs = np.array(y)
    values = [ratio[f] / np.sqrt(len(f)) for f in picked]
    w, bias = dual_coordinate_descent(picked, values, signs, size, cost, epochs, seed)
    model = Model(ratio * w, float(bias), 1.0, 0.0)
    model.slope, model.offset = _platt(model.margins(picked), signs)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (chance of label 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts score by their one feature "empty".  Columns of these names are replaced;
    all others and repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def work(texts):
        out = []
        rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["text"])
        for part in chunks(rows, limit=FEATURE_CHUNK):
            out.append(shared.value.scores(features(part.column(0))))
        import pandas as pd
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    names = [c for c in docs.columns if c not in ("score", "predicted")]
    return (docs.select(*names).withColumn("score", work(F.coalesce("text", F.lit(""))))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
