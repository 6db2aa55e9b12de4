"""Counting many words in one pass over a text, by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions.common import col

# characters that a case-insensitive pattern takes for an ASCII letter: A-Z, and the Kelvin sign, the
# long s, the dotted capital and the dotless small i
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZKſİı"
FOLDED = "abcdefghijklmnopqrstuvwxyzksii"


def folded(text: Column | str) -> Column:
    """Each character that stands for an ASCII letter as its small one; the length stays."""
    return F.translate(col(text), LETTERS, FOLDED)


def build(words: Sequence[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for place, word in enumerate(words):
        automaton.add_word(word, place)
    automaton.make_automaton()
    return automaton


def counts_in(text: str, automaton: ahocorasick.Automaton, lengths: Sequence[int]) -> list[int]:
    """Occurrences of each word, from left to right and apart from others of the same word."""
    counts, free = [0] * len(lengths), [0] * len(lengths)
    for end, place in automaton.iter(text):
        if end + 1 - lengths[place] >= free[place]:
            counts[place] += 1
            free[place] = end + 1
    return counts


def word_counts(text: Column | str, words: Sequence[str]) -> Column:
    """Array of the occurrences of each word (ASCII, not empty, each once) in any letter case.

    One pass over the text, whatever the number of words; words may lie in or over each other.
    A null text has none.
    """
    plain = [w.lower() for w in words]
    if not plain or len(set(plain)) < len(plain) or not all(w and w.isascii() for w in plain):
        raise ValueError("words must be ASCII, not empty and each given once")
    lengths = [len(w) for w in plain]
    built: list[ahocorasick.Automaton] = []

    @F.arrow_udf("array<bigint>")
    def count(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(build(plain))
        none = [0] * len(plain)
        return pa.array(
            [counts_in(t, built[0], lengths) if t else none for t in texts.to_pylist()], pa.list_(pa.int64())
        )

    return count(folded(text))
