"""License scans by patience alignment.

Words that are unique in both a stretch of text and a template are anchors; the longest run of
anchors in the same order is kept, and the gaps between them are aligned in the same way. The share
of template words that align is the coverage. Stretches are taken around the template's words that
are rarest in the text: a match may lack some words, but not all of that many.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opsloom.llm.common import id_and_text, id_type, slices, strings

WORD = re.compile(r"[^\W_]+")
LONG = 64

# fixed values: notices by name
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}

SPDX = re.compile(
    r"SPDX-License-Identifier:[ \t]*"
    r"(\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*)*)"
)


@cache
def common_templates() -> dict[str, str]:
    """The short notices, and full texts and standard headers of common licenses."""
    texts = (f for f in resources.files("opsloom.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt"))
    return TEMPLATES | {f.name[:-4]: f.read_text(encoding="utf-8") for f in sorted(texts, key=lambda f: f.name)}


def spdx_lines(text: str) -> list[tuple[str, float, int, int]]:
    """SPDX license lines, named by their expression."""
    if "SPDX-License-Identifier:" not in text:
        return []
    return [(f"spdx {' '.join(m[1].split())}", 1.0, m.start(), m.end()) for m in SPDX.finditer(text)]


def longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by the first number, that rises in the second too."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            piles.append(i)
        else:
            tops[pile], piles[pile] = y, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs (place in text, place in template) of words that align."""
    out, waiting = [], [(0, len(text), 0, len(template))]
    while waiting:
        a, b, c, d = waiting.pop()
        while a < b and c < d and text[a] == template[c]:       # equal beginnings of a gap
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:       # and equal ends
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        seen, known = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if known[w] == 1}
        anchors = longest_rise(
            [(i, place[w]) for i, w in enumerate(text[a:b], a) if seen[w] == 1 and w in place]
        )
        ends = [(a - 1, c - 1), *anchors, (b, d)]
        out += anchors
        if anchors:
            waiting += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(ends, ends[1:])]
    return sorted(out)


class Template(list):
    """Words of a template with their counts."""

    def __init__(self, words: list[str]):
        super().__init__(words)
        self.counts = Counter(words)


def stretches(words: list[str], places: dict[str, list[int]], template: list[str], lacking: int) -> set[tuple[int, int]]:
    """Begin and end of the stretches of text that a match may lie in.

    Around each rare word a wide stretch, and for a notice that follows itself, whose words occur
    twice there, the template's length from each start that the word allows.
    """
    size, out = len(template), set()
    if size > LONG:     # windows that overlap so far that each match lies in one
        step = size // 8
        width = size + 2 * lacking + step
        known = set(template)
        seen = np.concatenate([[0], np.cumsum([w in known for w in words])])
        for begin in range(0, max(len(words) - width, 0) + step, step):
            end = min(begin + width, len(words))
            if end > begin and seen[end] - seen[begin] > size - lacking:
                out.add((begin, end))
        return out
    rare = sorted(set(template), key=lambda w: (len(places.get(w, ())), w))[:lacking]
    reach = size + lacking
    for word in rare:
        at = [j for j, w in enumerate(template) if w == word]
        for centre in places.get(word, ()):
            out.add((max(0, centre - reach), centre + reach + 1))
            out |= narrow({centre - j for j in at}, size, lacking)
    return out


def narrow(starts: set[int], size: int, lacking: int) -> set[tuple[int, int]]:
    out = set()
    for start in starts:
        for begin, end in ((start, start + size), (start, start + size + lacking), (start - lacking, start + size)):
            out.add((max(0, begin), max(0, end)))
    return out


def best_apart(hits: dict[tuple[int, int], float]) -> list[tuple[int, int, float]]:
    """The spans apart from each other that cover most in all, the shortest of equal ones."""
    spans = sorted(hits, key=lambda h: (h[1], h[0]))
    stops = [stop for _, stop in spans]
    best = [(0.0, 0)]
    before = []
    for i, (start, stop) in enumerate(spans):
        before.append(bisect_right(stops, start, 0, i))
        total, length = best[before[i]]
        best.append(max(best[i], (round(total + hits[start, stop], 9), length - (stop - start))))
    out, i = [], len(spans)
    while i:
        if best[i] == best[i - 1]:
            i -= 1
        else:
            out.append((*spans[i - 1], hits[spans[i - 1]]))
            i = before[i - 1]
    return out[::-1]


def closest(found: list[tuple[str, float, int, int]], sizes: dict[str, int]) -> list[tuple[str, float, int, int]]:
    """Without hits of like templates: of two that share over half of both spans the one that aligns more."""
    out: list[tuple[int, int, str, float]] = []     # by start
    for name, cover, start, end in sorted(found, key=lambda h: (-round(h[1] * sizes[h[0]]), -h[1], h[0], h[2:])):
        size = end - start
        # over half of both is shared: the starts are less than this hit's size apart
        near = out[bisect_left(out, (start - size,)):bisect_left(out, (end,))]
        if all(o[2] == name or 2 * (min(o[1], end) - max(o[0], start)) <= max(o[1] - o[0], size) for o in near):
            insort(out, (start, end, name, cover))
    return [(name, cover, start, end) for start, end, name, cover in out]


def scan(text: str, templates: dict[str, list[str]], least: float) -> list[tuple[str, float, int, int]]:
    """(name, coverage, start, end) of every notice, in characters; overlaps keep the best of a name."""
    lower = text.lower()
    if len(lower) != len(text):     # lower case that changes lengths would move the spans
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    words = WORD.findall(lower)
    present = Counter(words)
    out, spots = [], None
    for name, template in templates.items():
        lacking = int((1 - least) * len(template) + 1e-9) + 1
        missing = 0
        for word, count in (template.counts if isinstance(template, Template) else Counter(template)).items():
            missing += max(0, count - present.get(word, 0))
            if missing >= lacking:
                break
        if missing >= lacking:
            continue
        if spots is None:
            spots = [m.span() for m in WORD.finditer(lower)]
            places: dict[str, list[int]] = {}
            for i, word in enumerate(words):
                places.setdefault(word, []).append(i)
        hits: dict[tuple[int, int], float] = {}
        waiting, met = stretches(words, places, template, lacking), set()
        while waiting:
            met |= waiting
            starts = set()
            for begin, end in waiting:
                pairs = align(words[begin:end], template)
                coverage = len(pairs) / len(template)
                if coverage >= least:
                    span = spots[begin + pairs[0][0]][0], spots[begin + pairs[-1][0]][1]
                    hits[span] = max(hits.get(span, 0.0), coverage)
                    starts.add(begin + pairs[0][0] - pairs[0][1])
            waiting = narrow(starts, len(template), lacking) - met if len(template) > LONG and len(met) < len(words) else set()
        out += [(name, coverage, start, stop) for start, stop, coverage in best_apart(hits)]
    out = closest(out, {name: len(t) for name, t in templates.items()})
    return sorted(out, key=lambda h: (h[2], h[0]))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: how many notices it holds and each with coverage and span.

    Without ``templates`` the common ones are taken, and SPDX lines count as notices.
    ``least`` is the share of a template's words that must align. Spans are code points, the end
    exclusive. A null or empty text has none; repeated rows give repeated rows; other columns are
    not read.
    """
    known = {name: Template(WORD.findall(t.lower())) for name, t in (templates or common_templates()).items()}
    spdx = spdx_lines if templates is None else lambda _: []
    hit = pa.list_(pa.struct([("name", pa.string()), ("coverage", pa.float64()),
                              ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [
                    sorted(scan(text, known, least) + spdx(text), key=lambda h: (h[2], h[0]))
                    for text in strings(part.column("text"))
                ]
                found = [[dict(zip(("name", "coverage", "start", "end"), h)) for h in r] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(r) for r in rows], pa.int64()), pa.array(found, hit)],
                    names=[id_col, "n_notices", "notices"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, n_notices long, "
        "notices array<struct<name:string,coverage:double,start:bigint,end:bigint>>"
    )
