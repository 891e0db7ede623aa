"""Token ids of words: more distinct words than the worker's cache holds."""

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import tokens
from tillroll.llm.queries import tokenizer_path

TOKENIZER = tokenizer_path("word_bpe_49k.json")


def whole(texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]


def by_text(got):
    ids, bounds = got
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


@pytest.mark.parametrize("room", [1, 50, 1000])
def test_small_caches_cold_and_warm(monkeypatch, room):
    monkeypatch.setattr(tokens, "CACHE_WORDS", room)
    rng = np.random.default_rng(room)
    texts = [" ".join(f"w{int(x)}{'!' * int(x % 3)} Été{int(x) % 7}" for x in rng.integers(0, 400, 150)) for _ in range(12)]
    cache = tokens.WordIds(TOKENIZER)
    want = whole(texts)
    for _ in range(2):  # the second round starts with what the first one left
        for i in range(0, 12, 3):
            assert by_text(cache.encode(pa.array(texts[i:i + 3]))) == want[i:i + 3]
            assert len(cache.known) <= room
    assert by_text(cache.encode(pa.array([None, "", texts[0]]))) == [[], [], want[0]]


def test_twice_as_many_words_as_the_cache_holds():
    cache = tokens.WordIds(TOKENIZER)
    known = " ".join(f"a{i:x}" for i in range(1000))
    many = " ".join(f"a{i:x}" for i in range(2 * tokens.CACHE_WORDS))
    assert by_text(cache.encode(pa.array([known]))) == whole([known])
    got = by_text(cache.encode(pa.array([many, known])))  # with a warm cache
    assert got == whole([many, known])
    assert len(cache.known) <= tokens.CACHE_WORDS
    assert by_text(tokens.WordIds(TOKENIZER).encode(pa.array([many]))) == got[:1]  # with a cold one


def test_a_full_cache_keeps_the_words_in_use(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 12)
    cache = tokens.WordIds(TOKENIZER)
    cache.encode(pa.array(["the of and " + " ".join(f"x{i}" for i in range(7))]))
    text = "the of and " + " ".join(f"y{i}" for i in range(7))
    assert by_text(cache.encode(pa.array([text]))) == whole([text])
    assert len(cache.known) <= 12
    assert {"the", "of", "and", "y0", "y6"} <= set(cache.known)
