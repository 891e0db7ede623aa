"""Licence statements in texts: ordered signature rules behind a keyword prefilter (operator 11)."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.license_rules import RULES
from tillroll.llm.spans import Spans, alnum_spans, places
from tillroll.llm.words import chunks

# phrases that are always reported, every place of them
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
PHRASE_STRENGTH = 80

_PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType())])
_FOUND = T.StructType([T.StructField("label", T.StringType()), T.StructField("rule", T.IntegerType()),
                       T.StructField("priority", T.IntegerType()), T.StructField("first_word", T.LongType()),
                       T.StructField("n_words", T.LongType()), T.StructField("matched", T.StringType())])
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                       T.StructField("phrases", T.ArrayType(_PLACE)), T.StructField("detections", T.ArrayType(_FOUND)),
                       T.StructField("score", T.DoubleType())])


@dataclass(frozen=True)
class Rule:
    """A signature: ``pattern`` covers whole words of a text whose words are one space apart."""

    label: str
    priority: int
    strength: int
    keyword: bytes
    pattern: str

    @property
    def expression(self) -> re.Pattern[bytes]:
        # the space before belongs to the match, the one behind does not: neighbours may share it
        return re.compile(b" (?:" + self.pattern.encode() + b")(?= )")


@lru_cache(maxsize=8)
def parsed(table: str = RULES) -> tuple[Rule, ...]:
    """The rules of a table of lines ``label | priority | strength | keyword | regular expression``."""
    out = []
    for line in filter(str.strip, table.splitlines()):
        label, priority, strength, keyword, pattern = line.split(" | ", 4)
        out.append(Rule(label, int(priority), int(strength), f" {keyword}".encode(), pattern))
    return tuple(out)


@lru_cache(maxsize=8)
def _gates(rules: tuple[Rule, ...]) -> tuple[dict[bytes, list[int]], list[re.Pattern[bytes]]]:
    by_keyword: dict[bytes, list[int]] = {}
    for i, rule in enumerate(rules):
        by_keyword.setdefault(rule.keyword, []).append(i)
    return by_keyword, [rule.expression for rule in rules]


def resolved(found: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """The detections (start, end, rule) that no stronger one contains, in text order.

    A detection goes where its interval lies within that of one of higher priority, or of its own priority
    that is longer or, of the same interval, stands earlier in the rules.  What overlaps in part stays.
    """
    kept: list[tuple[int, int, int]] = []
    for priority in sorted({rules[r].priority for _, _, r in found}, reverse=True):
        own = [d for d in found if rules[d[2]].priority == priority]
        # by start, the longest first: what contains an interval comes before it; kept ones win equal intervals
        line = sorted([(s, -e, 0, r) for s, e, r in kept] + [(s, -e, 1, r) for s, e, r in own])
        reach = -1
        for s, e, mine, r in line:
            if mine and -e > reach:
                kept.append((s, -e, r))
            reach = max(reach, -e)
    return sorted(kept)


class _Page:
    """The texts of a chunk as one byte string: per text a space, its words each followed by a space, a line end."""

    def __init__(self, words: Spans):
        size = words.end - words.start
        n_words = np.diff(words.bounds)
        self.bounds = words.bounds
        owner = np.repeat(np.arange(len(n_words)), n_words)
        behind = np.concatenate(([0], np.cumsum(size + 1)))
        self.word = behind[:-1] + 2 * owner + 1
        self.text = np.concatenate((behind[words.bounds[:-1]] + 2 * np.arange(len(n_words)),
                                    [behind[-1] + 2 * len(n_words)]))
        raw = np.full(int(self.text[-1]), 32, np.uint8)
        raw[self.text[1:] - 1] = 10
        raw[places(self.word, size)] = words.raw[places(words.start, size)]
        self.raw = raw.tobytes()

    def text_of(self, at: int) -> int:
        return int(np.searchsorted(self.text, at, side="right")) - 1

    def texts_with(self, keyword: bytes) -> list[int]:
        """The texts that hold the keyword."""
        out = []
        at = self.raw.find(keyword)
        while at >= 0:
            out.append(self.text_of(at))
            at = self.raw.find(keyword, int(self.text[out[-1] + 1]))
        return out

    def word_at(self, text: int, at: int | list[int]) -> np.ndarray:
        """Number within the text of the word that starts at this place."""
        return np.searchsorted(self.word, at) - self.bounds[text]

    def phrase_places(self, phrase: str) -> dict[int, list[int]]:
        """Per text the numbers of the words where the phrase's words stand in a row."""
        needle = f" {phrase} ".encode()
        hits = []
        at = self.raw.find(needle)
        while at >= 0:
            hits.append(at + 1)
            at = self.raw.find(needle, at + 1)
        out: dict[int, list[int]] = {}
        if hits:
            text = np.searchsorted(self.text, hits, side="right") - 1
            word = np.searchsorted(self.word, hits) - self.bounds[text]
            for t, w in zip(text.tolist(), word.tolist()):
                out.setdefault(t, []).append(w)
        return out


def find(texts: pa.Array, rules: tuple[Rule, ...], phrases: dict[str, str]) -> list[tuple[int, list, list]]:
    """Per text (number of words, [(label, word) of phrases], [(rule, first word, words, matched text)])."""
    page = _Page(alnum_spans(texts))
    by_keyword, expressions = _gates(rules)
    asked: dict[int, list[int]] = {}
    for keyword, numbers in by_keyword.items():
        for t in page.texts_with(keyword):
            asked.setdefault(t, []).extend(numbers)
    places_of: dict[int, list] = {}
    for phrase, label in phrases.items():
        for t, at in page.phrase_places(phrase).items():
            places_of.setdefault(t, []).extend((label, w) for w in at)
    out = []
    for t in range(len(texts)):
        matches: list = []
        if t in asked:
            start, stop = int(page.text[t]), int(page.text[t + 1])
            found = [(m.start() + 1, m.end(), r) for r in asked[t] for m in expressions[r].finditer(page.raw, start, stop)]
            for s, e, r in resolved(found, rules):
                first, last = page.word_at(t, [s, e]).tolist()
                matches.append((r, first, last - first, page.raw[s:e].decode()))
        out.append((int(page.bounds[t + 1] - page.bounds[t]), sorted(places_of.get(t, ()), key=lambda p: (p[1], p[0])), matches))
    return out


def scanned(docs: DataFrame, table: str = RULES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """``(doc_id, n_words, phrases, detections, score)``, one row per row of ``docs``.

    Words are ASCII letters and digits (A-Z lower-cased) and characters beyond ASCII.  ``phrases`` lists every
    place where a phrase's words stand in a row (label, first_word).  ``detections`` are the matches of the
    rules of ``table`` that no stronger match contains (label, rule number, priority, first_word, n_words,
    matched words).  A rule's expression runs only on texts that hold its keyword, and on their whole
    length.  ``score`` is the chance that the text states a licence: one minus the product, over its labels,
    of the chance that the strongest match of the label is none.

    Null and empty texts have no words, empty lists and score 0; a null doc_id stays null; repeated rows come
    back as often; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    rules = parsed(table)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                rows = []
                for d, (n, base, matches) in zip(part.column(0).to_pylist(), find(part.column(1), rules, phrases)):
                    chance: dict[str, int] = {}
                    for label, strength in [(label, PHRASE_STRENGTH) for label, _ in base] + [
                            (rules[r].label, rules[r].strength) for r, *_ in matches]:
                        chance[label] = max(chance.get(label, 0), strength)
                    none = 1.0
                    for label in sorted(chance):
                        none *= 1 - chance[label] / 100
                    rows.append((d, n, [{"label": x, "first_word": w} for x, w in base],
                                 [{"label": rules[r].label, "rule": r, "priority": rules[r].priority, "first_word": first,
                                   "n_words": length, "matched": matched} for r, first, length, matched in matches], 1.0 - none))
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("phrases", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))),
    ("detections", pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()),
                                       ("first_word", pa.int64()), ("n_words", pa.int64()), ("matched", pa.string())]))),
    ("score", pa.float64())])


def digest(scan: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of ``scanned`` rows."""
    word, base = F.col("phrases.first_word"), F.col("phrases.label")
    return scan.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"), F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("detections.label"))), ",").alias("labels"), "score")
