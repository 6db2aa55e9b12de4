"""One-pass word counts against a search per word."""

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from opsloom.functions import corpus, matcher

WORDS = ["aa", "a", "aba", "gpu", "nvidia.com/gpu", "sk"]


@given(st.text(st.sampled_from("aAbB gGpPuUsSkK./\u212a\u017f"), max_size=60))
def test_counts_equal_a_search_per_word(text):
    small = text.translate(str.maketrans(matcher.LETTERS, matcher.FOLDED))
    found = matcher.counts_in(small, matcher.build(WORDS), [len(w) for w in WORDS])
    assert found == [len(re.findall(re.escape(w), small)) for w in WORDS]


def test_column_equals_the_native_count(spark):
    texts = ["Nvidia.com/GPU gpu", "aaaa AbAbA", "\u212aS sK \u017fk", "nvidiaXcom/gpu", "", None, "gp\u00dc ß"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    native = frame.select(*[corpus.keyword_count("text", w).alias(f"w{n}") for n, w in enumerate(WORDS)], "i")
    wanted = {r["i"]: [r[f"w{n}"] or 0 for n in range(len(WORDS))] for r in native.collect()}
    found = dict(frame.select("i", matcher.word_counts("text", WORDS)).collect())
    assert found == wanted


@pytest.mark.parametrize("words", [[], ["a", "A"], [""], ["é"]])
def test_words_that_cannot_be_counted_are_an_error(words):
    with pytest.raises(ValueError):
        matcher.word_counts("text", words)
