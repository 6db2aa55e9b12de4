"""HTML character references as one column expression.

Text is split at ampersands, and each part is decoded at its beginning by the rules of HTML 5:
names with a semicolon from a literal map, names that need none by their longest beginning,
numbers by arithmetic. The names are those of Python's ``html.entities.html5``. The expression
is SQL text, which is parsed in one call, while building it from columns takes hundreds.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that HTML 5 reads as characters of Windows-1252, and the others
# that stand for another character.
REPLACED = {0x00: "�", 0x0D: "\r"} | {
    point: bytes([point]).decode("cp1252") if point not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(point)
    for point in range(0x80, 0xA0)
}

_CLOSED = r"^[^\t\n\x0c <&#;]{1,32};"
_NUMBER = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
_COMMON = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": "\xa0"}


def _table(entries: dict, kind: str = "string") -> str:
    """A literal map: one folded constant, however many entries it has."""
    content = json.dumps(entries).replace("'", r"\u0027")     # raw literals hold no quote
    return f"from_json(r'{content}', 'map<string,{kind}>')"


def _let(name: str, value: str, body: str) -> str:
    """``body`` of a value that is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _numbered() -> str:
    """Text of the reference ``number``, such as ``#233;`` or ``#xE9``."""
    replaced = _table({str(k): v for k, v in REPLACED.items()})
    point = _let("digits", "regexp_extract(number, r'^#[xX]?0*([0-9a-fA-F]*)', 1)", """CASE
        WHEN digits = '' THEN 0L WHEN char_length(digits) > 7 THEN 1114112L
        WHEN number RLIKE '^#[xX]' THEN CAST(conv(digits, 16, 10) AS BIGINT)
        ELSE CAST(digits AS BIGINT) END""")
    # left out are controls and what is no character
    return _let("point", point, f"""CASE
        WHEN point IN (0, 13) OR point BETWEEN 128 AND 159 THEN {replaced}[CAST(point AS STRING)]
        WHEN point BETWEEN 55296 AND 57343 OR point > 1114111 THEN '�'
        WHEN point BETWEEN 1 AND 8 OR point = 11 OR point BETWEEN 14 AND 31 OR point = 127
            OR point BETWEEN 64976 AND 65007 OR point & 65534 = 65534 THEN ''
        ELSE decode(unhex(lpad(hex(point), 8, '0')), 'UTF-32') END""")


@lru_cache
def _decoder() -> str:
    """A lambda from a text to the decoded text."""
    closed: dict[str, dict[str, str]] = {}      # by first letter, for short searches
    for name, text in html5.items():
        if name.endswith(";"):
            closed.setdefault(name[0], {})[name] = text
    opened = {name: text for name, text in html5.items() if not name.endswith(";")}
    longest_first = "|".join(sorted(opened, key=lambda n: (-len(n), n)))
    # the names that nearly all texts use are found without the table
    common = " ".join(
        f"WHEN startswith(part, '{name}') THEN concat('{text}', substr(part, {len(name) + 1}))"
        for name, text in _COMMON.items()
    )
    number = _let("number", f"regexp_extract(part, r'{_NUMBER}', 0)", f"""CASE
        WHEN number = '' THEN concat('&', part)
        ELSE concat({_numbered()}, substr(part, char_length(number) + 1)) END""")
    by_beginning = _let("name", f"regexp_extract(part, '^(?:{longest_first})', 0)", f"""CASE
        WHEN name = '' THEN concat('&', part)
        ELSE concat({_table(opened)}[name], substr(part, char_length(name) + 1)) END""")
    by_name = _let("name", f"regexp_extract(part, r'{_CLOSED}', 0)", _let(
        "found", f"{_table(closed, 'map<string,string>')}[substr(name, 1, 1)][name]", f"""CASE
        WHEN found IS NULL THEN {by_beginning}
        ELSE concat(found, substr(part, char_length(name) + 1)) END"""))
    part = f"""CASE {common} WHEN startswith(part, '#') THEN {number}
        WHEN part RLIKE '^[A-Za-z]' THEN {by_name} ELSE concat('&', part) END"""
    return "text -> " + _let("parts", "split(text, '&', -1)", f"""concat(
        parts[0], array_join(transform(slice(parts, 2, size(parts)), part -> {part}), ''))""")


def unescape(text: Column) -> Column:
    """Text with its character references decoded as ``html.unescape`` does; null stays null."""
    decoded = F.call_function("transform", F.array(text), F.expr(_decoder()))[0]
    return F.when(text.contains("&"), decoded).otherwise(text)
