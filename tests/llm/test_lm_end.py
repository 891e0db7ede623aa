"""The end of a text counts exactly, however few texts there are."""

import math

import pytest

from tillroll.llm import lm


def test_end_is_counted_among_few_long_texts(spark):
    words = [f"w{i}" for i in range(40)]
    train = spark.createDataFrame([(" ".join(words * 5),), (" ".join(words * 4),)], "text string")
    model, counts = lm.train(train, lm.Settings(classes=24, suffix_classes=8, common=20, dimensions=4, noise=4))
    row = lm.scored(spark.createDataFrame([(1, "w1 new")], "doc_id long, text string"), model, counts).first()
    whole = 9 * 40 + 2 + 0.5 * 42
    assert model.common[lm.END] == 2
    assert (row.n_tokens, row.n_known) == (3, 2)
    assert row.base_score == pytest.approx(sum(math.log10((c + 0.5) / whole) for c in (9, 0, 2)))
