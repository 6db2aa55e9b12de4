"""Shared column helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whitespace as Unicode text handling understands it: a character class (to be used under
# the (?U) flag, plain \s is ASCII only), patterns built from it, and the characters.
SPACE = r"[\s\x1c-\x1f]"
SPACES = f"(?U){SPACE}+"
NON_SPACES = r"(?U)[\S&&[^\x1c-\x1f]]+"
SPACE_CHARS = "".join(
    map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once, where they are written.

    A filter on a plain derived column is pushed below its projection, which copies (and
    evaluates again) everything the column is made of. Costly columns come out of a one-row
    generator instead, which filters do not pass.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True if ``text`` holds any of ``words`` (case-sensitive; null text gives null)."""
    return any_of(text.contains(word) for word in words)


def first_match(cases: Iterable[tuple[Column, Column | str]], default) -> Column:
    """``CASE WHEN`` over ordered (condition, value) pairs."""
    result = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(default)


def lookup(key: Column, table: Mapping, default=None) -> Column:
    """Value of ``key`` in a small literal table, else ``default``."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = entries[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def strip(text: Column | str) -> Column:
    """Text without leading and trailing Unicode whitespace."""
    return F.btrim(col(text), F.lit(SPACE_CHARS))


def blank_to_null(text: Column | str) -> Column:
    return F.when(strip(text) != "", col(text))


def squeeze(text: Column | str) -> Column:
    """Every run of whitespace becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(col(text), SPACES, " "))


def uniform(key: Column, seed: int) -> Column:
    """A repeatable number in [0, 1) from the md5 of key and seed.

    The same row gets the same draw on every run, partitioning and retry.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def shuffle_key(key: Column, seed: int) -> Column:
    """A repeatable random-looking sort key."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
