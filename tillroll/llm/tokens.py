"""Token ids of texts with a public tokenizer, one encoding per distinct word of a worker's cache.

The tokenizer's own rules never join characters across ASCII white space (its normaliser keeps the
white space and its pre-tokenizer drops it), so a text's ids are the ids of its words in order.
``tests/llm/test_tokens.py`` compares this with encoding whole texts.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np
import pyarrow as pa

from tillroll.llm.words import words

# distinct words that a worker keeps; with more, the latest ones stay
CACHE_WORDS = 120_000
_CACHES: dict[str, "WordIds"] = {}
# plain words: Latin letters, then ASCII marks; their two parts are what a pre-tokenizer of letter and mark runs yields
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|]*)")
_PROBES = ["a", "The", "été,", "HERE!!", "straße.", "Ñandú", "thorough|", "pneumonoultramicroscopic", "x", "Ý?!"]


class WordIds:
    """Ids of words as little-endian 32-bit bytes, kept per known word."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in [*range(33, 127), *range(0xC0, 0x100)]}
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.four = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        # the short way holds for lower-casing byte-level tokenizers that part letters from marks
        self.short = all(self._plain(w) == x for w, x in zip(_PROBES, self._whole(_PROBES)))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, word: str) -> bytes | None:
        """Ids of a plain word through the model alone; None where the word is not plain."""
        m = _PLAIN.fullmatch(word)
        if not m:
            return None
        out = b""
        for part in (m[1].lower(), m[2]):
            ids = self.parts.get(part)
            if ids is None:
                # ASCII stands for itself among the shown bytes
                shown = part if part.isascii() else part.translate(self.shown)
                ids = self.parts[part] = b"".join([self.four[t.id] for t in self.model.tokenize(shown)])
            out += ids
        return out

    def _ids(self, fresh: list[str]) -> list[bytes]:
        """Ids of each word, in order."""
        if len(self.parts) > CACHE_WORDS:
            self.parts = {"": b""}
        got = [self._plain(w) for w in fresh] if self.short else [None] * len(fresh)
        full = [i for i, g in enumerate(got) if g is None]
        for i, ids in zip(full, self._whole([fresh[i] for i in full])):
            got[i] = ids
        return got

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ``ids[bounds[i]:bounds[i + 1]]``; a null text has none.

        Any number of distinct words may come at once: their ids are held for this call, and the cache
        keeps as many as it has room for.
        """
        codes, offsets, vocab = words(texts, lower=False)
        names = vocab.to_pylist()
        got = [self.known.get(w) for w in names]
        missing = [i for i, ids in enumerate(got) if ids is None]
        if missing:
            fresh = [names[i] for i in missing]
            learnt = self._ids(fresh)
            for i, ids in zip(missing, learnt):
                got[i] = ids
            if len(self.known) + len(fresh) > CACHE_WORDS:  # no room: this call's words stay, then older ones
                old, self.known = self.known, dict(zip(names[:CACHE_WORDS], got))
                self.known.update(islice(old.items(), CACHE_WORDS - len(self.known)))
            else:
                self.known.update(zip(fresh, learnt))
        held = pa.array(got, pa.large_binary())
        row = held.take(pa.array(codes))
        ends = np.frombuffer(row.buffers()[1], np.int64, len(codes) + 1, 8 * row.offset) if len(codes) else np.zeros(1, np.int64)
        ids = np.frombuffer(row.buffers()[2], "<u4", ends[-1] // 4) if len(codes) and ends[-1] else np.zeros(0, "<u4")
        return ids, ends[offsets] // 4


def word_ids(path: str) -> WordIds:
    """The worker's cache for this tokenizer file."""
    if path not in _CACHES:
        _CACHES[path] = WordIds(path)
    return _CACHES[path]
