"""Spelling variants of a corpus' words, joined by pivotal grams (operator 12)."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.crc import crc32_spans, joined
from tillroll.llm.jobs import drop_stage, write_stage
from tillroll.llm.spans import Spans, latin_spans
from tillroll.llm.words import chunks

# one edit: two pivots without a common character, and a prefix of 2 * 1 + 1 bigrams that always holds two such
GRAM, EDITS = 2, 1
PREFIX = GRAM * EDITS + 1
# characters of words: a-z and U+00C0 to U+00FF, so there are at most LETTERS ** 2 bigrams
LETTERS = 90
WORD_CHUNK = 4 << 20


def _code_points(s: Spans) -> np.ndarray:
    follow = np.concatenate(([0], np.cumsum((s.raw & 0xC0) == 0x80)))
    return s.end - s.start - (follow[s.end] - follow[s.start])


def counted_words(docs: DataFrame, least_chars: int = 7, least_count: int = 2, drop: int | None = None) -> DataFrame:
    """``(word, n)``: runs ``[A-Za-zÀ-ÿ]+`` of all texts (A-Z lower-cased) of the least length and count.

    With ``drop``, runs are misspelt on purpose before they are counted: where it divides h, the CRC-32 of
    ``<doc_id>:<run>``, the run loses its code point h modulo its length.  Runs are counted per chunk of
    texts, then per partition, then over all.  Null texts have no runs; a null doc_id is written as nothing.
    """
    def run(batches):
        for batch in batches:
            for part in chunks(batch, limit=WORD_CHUNK):
                found = latin_spans(part.column(1))
                long_enough = np.flatnonzero(_code_points(found) >= least_chars)
                coded = found.strings(long_enough).dictionary_encode()
                names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                if not len(code):
                    continue
                owner = np.searchsorted(found.bounds, long_enough, side="right") - 1
                pair, times = np.unique(owner * len(names) + code, return_counts=True)
                owner, code = pair // len(names), pair % len(names)
                out: Counter = Counter()
                if drop:
                    edges = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1)
                    sums = crc32_spans(np.frombuffer(names.buffers()[2], np.uint8, edges[-1]), edges[:-1], edges[1:])
                    heads = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in part.column(0).to_pylist()],
                                     np.uint32)
                    h = joined(heads[owner], sums[code], np.diff(edges)[code])
                    hit = h % np.uint32(drop) == 0
                    for x, c, t in zip(h[hit].tolist(), code[hit].tolist(), times[hit].tolist()):
                        word = names[c].as_py()
                        at = x % len(word)
                        if len(word) > least_chars:
                            out[word[:at] + word[at + 1:]] += t
                    times = np.where(hit, 0, times)
                n = np.bincount(code, weights=times, minlength=len(names)).astype(np.int64)
                kept = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([names.take(pa.array(kept)).cast(pa.string()), pa.array(list(out), pa.string())]),
                     pa.concat_arrays([pa.array(n[kept]), pa.array(list(out.values()), pa.int64())])], names=["word", "n"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letter numbers of all words in a row, each word's length)."""
    names = words.to_pylist()
    points = np.frombuffer("".join(names).encode("utf-32-le"), "<u4").astype(np.int64)
    return np.where(points < 128, points - 97, points - 0xC0 + 26), np.array([len(w) for w in names], np.int64)


def _bigrams(words: pa.Array) -> np.ndarray:
    letter, size = _letters(words)
    last = np.cumsum(size) - 1
    inside = np.ones(max(0, len(letter)), bool)
    inside[last[size > 0]] = False
    at = np.flatnonzero(inside)
    return letter[at] * LETTERS + letter[at + 1]


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often each bigram stands in the distinct words: at most ``LETTERS`` squared numbers."""
    def run(batches):
        held = np.zeros(LETTERS ** 2, np.int64)
        for batch in batches:
            held += np.bincount(_bigrams(batch.column(0)), minlength=len(held))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["gram", "n"])

    rows = (words.select("word").mapInArrow(run, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(LETTERS ** 2, np.int64)
    out[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return out


def pivots(place: np.ndarray, cost: np.ndarray, picks: int, width: int) -> np.ndarray:
    """For each row of places (ascending) the ``picks`` places at least ``width`` apart that cost least.

    Dynamic programming over the places from left to right: the best choice of j among the first i either
    leaves the i-th out, or takes it and the best j - 1 among those that end before it.  The result marks
    the chosen places; every row must allow such a choice.
    """
    m, s = place.shape
    row = np.arange(m)
    best = np.full((picks + 1, s + 1, m), np.inf)
    best[0] = 0
    taken = np.zeros((picks + 1, s + 1, m), bool)
    before = np.zeros((s + 1, m), np.int64)
    for i in range(1, s + 1):
        before[i] = (place[:, :i - 1] <= place[:, i - 1:i] - width).sum(axis=1)
        for j in range(1, picks + 1):
            own = best[j - 1, before[i], row] + cost[:, i - 1]
            taken[j, i] = own < best[j, i - 1]
            best[j, i] = np.where(taken[j, i], own, best[j, i - 1])
    out = np.zeros((m, s), bool)
    at, left = np.full(m, s), np.full(m, picks)
    for i in range(s, 0, -1):
        here = (at == i) & (left > 0)
        mine = here & taken[left, i, row]
        out[:, i - 1] = mine
        at = np.where(mine, before[i], np.where(here, i - 1, at))
        left = left - mine
    return out


def grams(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """``(word, n, last, letters, pivot, rank, place, size)``: the bigrams that a word is found by.

    Bigrams are ranked by how rare they are.  A word's prefix is its ``PREFIX`` rarest ones and all that
    tie with the last of them, whose rank is ``last``; its pivots are the two cheapest of the prefix that
    share no character.  ``letters`` is a bit set of the word's characters.
    """
    rank_of = np.empty(len(counts), np.int64)
    rank_of[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    tables = words.sparkSession.sparkContext.broadcast((rank_of, counts))

    def run(batches):
        rank_of, counts = tables.value
        for batch in batches:
            letter, size = _letters(batch.column(0))
            first = np.cumsum(size) - size
            held = []
            for length in np.unique(size).tolist():
                rows = np.flatnonzero(size == length)
                own = letter[first[rows][:, None] + np.arange(length)]
                gram = own[:, :-1] * LETTERS + own[:, 1:]
                rank = rank_of[gram]
                order = np.argsort(rank * length + np.arange(length - 1), axis=1)[:, :PREFIX]
                last = np.take_along_axis(rank, order[:, -1:], axis=1)
                place = np.sort(order, axis=1)
                chosen = np.zeros(rank.shape, bool)
                np.put_along_axis(chosen, place, pivots(
                    place, counts[np.take_along_axis(gram, place, axis=1)], EDITS + 1, GRAM), axis=1)
                bits = np.bitwise_or.reduce(np.uint64(1) << (own % 64).astype(np.uint64), axis=1).view(np.int64)
                r, p = np.nonzero(rank <= last)
                held.append((rows[r], last[r, 0], bits[r], chosen[r, p], rank[r, p], p, np.full(len(r), length)))
            if held:
                row, last, bits, chosen, rank, place, length = (np.concatenate(x) for x in zip(*held))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(last), pa.array(bits),
                     pa.array(chosen), pa.array(rank), pa.array(place.astype(np.int64)), pa.array(length.astype(np.int64))],
                    names=["word", "n", "last", "letters", "pivot", "rank", "place", "size"])

    return words.select("word", "n").mapInArrow(
        run, "word string, n long, last long, letters long, pivot boolean, rank long, place long, size long")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``: every two of the distinct ``words (word, n)`` one edit apart, each pair once.

    An edit spoils at most one of a word's two pivots, so the other stands in the second word as well:
    within that word's prefix, if that word is the one whose prefix reaches further in the ranking.  Pivots
    therefore meet prefixes only, and only at places that one edit can bring about: what stands before
    the bigram and what stands behind it may differ by one character together.  What meets is verified.
    """
    found = write_stage(grams(words, gram_counts(words)), "grams")
    place, size = (lambda by: F.col("place") + by), (lambda by: F.col("size") + by)
    key = lambda p, s: F.struct("rank", p.alias("place"), s.alias("size"))
    # shifts of the characters before and behind: none, one before, or one behind
    moves = F.array(*[key(place(front), size(front + back)) for front, back in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))])
    left = found.where("pivot").select(key(F.col("place"), F.col("size")).alias("key"), F.struct("word", "n", "last", "letters").alias("x"))
    right = found.select(F.explode(moves).alias("key"), F.struct("word", "n", "last", "letters").alias("y"))
    met = left.join(right, "key").where(
        "(x.last < y.last or (x.last = y.last and x.word < y.word)) and bit_count(x.letters ^ y.letters) <= 2")
    return (met.where("levenshtein(x.word, y.word, 1) = 1")
            .select(F.col("x.word").alias("a"), F.col("x.n").alias("a_n"), F.col("y.word").alias("b"), F.col("y.n").alias("b_n"))
            .distinct())


def grouped(words: DataFrame, factor: int = 10, max_rounds: int = 40) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per row of ``words (word, n)``.

    Two words are near if one inserted, deleted or replaced code point turns one into the other.  A word's
    form is its near word of the largest n (ties: the smallest in code-point order) if that is at least
    ``factor`` (2 or more) times its own; ``root`` follows forms to the last one.  Words must be distinct,
    of at least four code points, over a-z and U+00C0 to U+00FF.  An empty table gives no rows.
    """
    if factor < 2:
        raise ValueError("a form must be commoner than its variant")
    spark = words.sparkSession
    pairs = write_stage(near_pairs(words), "pairs")
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))))
    near = write_stage(both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
        .select("word", "n_near", F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best.other")).alias("form"),
                F.when(-F.col("best.m") >= factor * F.col("n"), -F.col("best.m")).alias("form_n")), "near")
    # roots by doubling: each round follows the path that the last one found
    roots = write_stage(near.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if roots.join(onward, "root", "left_semi").isEmpty():
            break
        old, roots = roots, write_stage(roots.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root")), "roots")
        drop_stage(spark, old)
    else:
        raise RuntimeError(f"roots did not settle in {max_rounds} rounds")
    return (words.select("word", "n").join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def spelling_variants(docs: DataFrame, least_chars: int = 7, least_count: int = 2, factor: int = 10,
                      drop: int | None = None) -> DataFrame:
    """``grouped`` over the words of ``docs (doc_id, text)``; see ``counted_words`` for what a word is.

    Null and empty texts hold no words; a text row that is repeated counts as often; very long words are
    words like others; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    if least_chars <= GRAM * EDITS + 1:
        raise ValueError(f"words need more than {GRAM * EDITS + 1} code points")
    return grouped(write_stage(counted_words(docs, least_chars, least_count, drop), "words"), factor)
