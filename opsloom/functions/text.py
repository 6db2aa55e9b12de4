"""Question-and-answer text columns: cleaning, metrics, signatures, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions import rules
from opsloom.functions.common import NON_SPACES, col, first_match, squeeze
from opsloom.functions.entities import unescape


def clean_html(text: Column | str) -> Column:
    """Tags become spaces, entities are decoded, whitespace is squeezed; null becomes ''."""
    stripped = F.regexp_replace(F.coalesce(col(text), F.lit("")), "<[^>]+>", " ")
    return squeeze(unescape(stripped))


def tag_list(tags: Column | str) -> Column:
    """``<a><b>`` -> ['a', 'b']."""
    return F.regexp_extract_all(F.coalesce(col(tags), F.lit("")), F.lit("<([^>]+)>"), F.lit(1))


def code_blocks(text: Column | str) -> Column:
    """Fenced and inline code passages, in order of appearance."""
    return F.regexp_extract_all(col(text), F.lit(rules.CODE_BLOCK), F.lit(0))


def mask_code(text: Column | str) -> Column:
    """Text with each code passage replaced by a marker."""
    return squeeze(F.regexp_replace(col(text), rules.CODE_BLOCK, " [CODE] "))


def clean_text(text: Column | str, remove_code: bool = False) -> Column:
    """URLs become a marker, code is dropped on request, whitespace is squeezed."""
    out = F.coalesce(col(text), F.lit(""))
    out = F.regexp_replace(out, f"https?://{NON_SPACES}", "[URL]")
    if remove_code:
        out = F.regexp_replace(out, rules.FENCED_CODE, "")
        out = F.regexp_replace(out, rules.INLINE_CODE, "")
    return squeeze(out)


def word_count(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(col(text), F.lit("")), F.lit(NON_SPACES))


def code_count(text: Column | str) -> Column:
    text = F.coalesce(col(text), F.lit(""))
    return F.when(
        text.contains("`"), F.regexp_count(text, F.lit(rules.CODE_BLOCK))
    ).otherwise(0)


def text_metrics(text: Column | str) -> Column:
    """Struct of character, word, sentence and code-passage counts."""
    text = F.coalesce(col(text), F.lit(""))
    return F.struct(
        F.char_length(text).alias("char_count"),
        word_count(text).alias("word_count"),
        F.regexp_count(text, F.lit("[.!?]+")).alias("sentence_count"),
        code_count(text).alias("code_block_count"),
    )


def _names_found(text: Column, patterns: dict[str, str]) -> Column:
    return F.array_compact(
        F.array(*[F.when(text.rlike(f"(?iu){p}"), F.lit(name)) for name, p in patterns.items()])
    )


def error_signatures(text: Column | str) -> Column:
    """Names of the error patterns found, in rule order."""
    return _names_found(col(text), rules.ERROR_SIGNATURES)


def infra_components(text: Column | str) -> Column:
    """Names of the infrastructure parts mentioned, in rule order."""
    return _names_found(col(text), rules.INFRA_COMPONENTS)


def question_type(text: Column | str) -> Column:
    lowered = F.lower(col(text))
    return first_match(
        [(lowered.rlike(pattern), name) for name, pattern in rules.QUESTION_TYPES],
        F.lit("general"),
    )


def complexity(text: Column | str) -> Column:
    words, blocks = word_count(text), code_count(text)
    return first_match(
        [((words < 50) & (blocks == 0), "simple"), ((words < 200) | (blocks <= 1), "moderate")],
        F.lit("complex"),
    )


def quality_score(score: Column, answer_score: Column, views: Column,
                  question: Column, answer: Column) -> Column:
    """Ranking score of a pair from votes, views, length and code."""
    return F.round(
        score * 2.0
        + answer_score * 3.0
        + views * 0.001
        + F.least(word_count(question) / 50, F.lit(2.0))
        + F.least(word_count(answer) / 100, F.lit(3.0))
        + code_count(answer) * 0.5,
        2,
    )
