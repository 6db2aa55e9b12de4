"""Line-first cleaning: rules judge each line, failed lines go, and documents that lose too much go.

A line fails if it is navigation (separators between a few words), boilerplate (a fixed phrase in
a short line), shouted or broken up by symbols, is long but without any closing punctuation, or
repeats an earlier line. A document is kept if it passes the whole-text rules and the lines left
hold enough of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opsloom.llm.common import id_and_text, id_type, raw, slices

SYMBOLS = b"#*$%&|<>"
SEPARATORS = "|»›·•>"
CLOSING = tuple(".!?…:;\"'”’»)]}。！？")
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "we use cookies", "accept cookies", "enable javascript", "click here", "read more", "sign in",
    "log in", "sign up", "subscribe to", "share this", "back to top", "skip to content",
    "lorem ipsum",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; documents keep their place if they lose at most ``most_lost`` words."""

    min_words: int = 50             # whole text
    repeat_percent: int = 50        # whole text: words in repeated three-word windows
    separator_share: float = 0.2    # navigation: separators to words, from two separators on
    symbol_share: float = 0.2       # symbols to words
    capital_share: float = 0.6      # shouted: capitals among at least 20 letters
    open_words: int = 12            # lines of so many words need punctuation behind some word
    boilerplate_words: int = 12     # boilerplate is looked for in lines of at most so many words
    most_lost: float = 0.5


def line_fault(line: str, rules: LineRules = LineRules()) -> str | None:
    """Name of the first rule a line breaks, None if it passes; blank lines pass."""
    words = line.split()
    if not words:
        return None
    separators = sum(line.count(s) for s in SEPARATORS)
    if separators >= 2 and separators >= rules.separator_share * len(words):
        return "navigation"
    if len(words) <= rules.boilerplate_words:
        lower = line.lower()
        if any(phrase in lower for phrase in BOILERPLATE):
            return "boilerplate"
    symbols = sum(line.count(s) for s in "#*$%&<>")
    if symbols > max(2, rules.symbol_share * len(words)):
        return "symbols"
    capitals = len(CAPITAL.findall(line))
    if capitals >= 12:
        letters = sum(map(str.isalpha, line))
        if letters >= 20 and capitals > rules.capital_share * letters:
            return "shouted"
    if len(words) >= rules.open_words and not any(w.endswith(CLOSING) for w in reversed(words)):
        return "punctuation"
    return None


CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, number, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[number] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= twice
    return int(covered.sum())


def cleaned(text: str, rules: LineRules = LineRules()) -> tuple[list[str], int, int]:
    """Lines that pass, how many words they hold, and how many lines repeat an earlier one."""
    seen: set[str] = set()
    lines, words, repeats = [], 0, 0
    for line in text.split("\n"):
        content = line.encode().split()
        if content:
            if line in seen:
                repeats += 1
                continue
            seen.add(line)
            if line_fault(line, rules):
                continue
            words += len(content)
        lines.append(line)
    return lines, words, repeats


def judged(text: bytes, rules: LineRules) -> tuple:
    words = text.split()
    decoded = text.decode()
    lines, left, repeats = cleaned(decoded, rules)
    in_words = sum(map(len, words))
    repeated = repeated_words(words)
    failed = len(words) < rules.min_words or 100 * repeated > rules.repeat_percent * len(words)
    kept = not failed and left >= (1 - rules.most_lost) * len(words)
    return (
        len(words), len(decoded) - (len(text) - in_words),
        len(text) - len(text.translate(None, SYMBOLS)), repeats, repeated, failed, kept,
        "\n".join(lines),
    )


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, cleaned string"
)


def clean_lines(
    docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: whole-text counts, the verdict, and the text of the lines left.

    Words are what lies between ASCII white space. A null or empty text has no words and is not
    kept. Repeated rows give repeated rows; other columns are not read.
    """
    names = [id_col, *[c.split()[0] for c in COLUMNS.split(", ")]]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, data = raw(part.column("text"))
                content = data.tobytes()
                rows = zip(*[judged(content[a:b], rules) for a, b in zip(offsets, offsets[1:])])
                kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *[pa.array(c, k) for c, k in zip(rows, kinds)]], names=names
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        judge, f"`{id_col}` {id_type(docs, id_col)}, {COLUMNS}"
    )
