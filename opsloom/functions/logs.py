"""System-log columns: severity, event type, labels, timestamps, sampling hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions import rules
from opsloom.functions.common import (
    SPACES, blank_to_null, col, contains_any, first_match, lookup, strip,
)


def linux_severity(message: Column | str) -> Column:
    """ERROR words win over WARN words; anything else is INFO."""
    text = F.lower(col(message))
    return first_match(
        [(contains_any(text, rules.LINUX_ERROR_WORDS), "ERROR"),
         (contains_any(text, rules.LINUX_WARN_WORDS), "WARN")],
        F.lit("INFO"),
    )


def hpc_severity(state: Column | str, flag: Column | str, message: Column | str) -> Column:
    """Alert flag, node state and message together decide the severity."""
    state, text = F.lower(col(state)), F.lower(col(message))
    failed = (
        (strip(flag) == "1")
        | contains_any(state, rules.HPC_ERROR_STATE_WORDS)
        | contains_any(text, rules.HPC_ERROR_WORDS)
    )
    warned = contains_any(state, rules.HPC_WARN_STATE_WORDS) | contains_any(
        text, rules.HPC_WARN_WORDS
    )
    return first_match([(failed, "ERROR"), (warned, "WARN")], F.lit("INFO"))


def level_severity(level: Column | str, message: Column | str, system: str) -> Column:
    """A known log level decides; otherwise the system's own keyword lists do."""
    text = F.lower(col(message))
    mapped = lookup(F.upper(strip(level)), rules.LEVEL_SEVERITY)
    by_words = first_match(
        [(contains_any(text, rules.LEVEL_ERROR_WORDS[system]), "ERROR"),
         (contains_any(text, rules.LEVEL_WARN_WORDS[system]), "WARN")],
        F.lit("INFO"),
    )
    return F.coalesce(mapped, by_words)


def event_type(message: Column | str, template: Column | str, severity: Column | str) -> Column:
    """First matching keyword rule over message and template, then the severity rule.

    A null message or template makes the combined text null, so only the severity rule
    applies to such rows.
    """
    return event_type_of(labelled_text(message, template), severity)


def labelled_text(message: Column | str, template: Column | str) -> Column:
    return F.lower(F.concat(col(message), F.lit(" "), col(template)))


def event_type_of(text: Column | str, severity: Column | str) -> Column:
    """The event type of an already combined, lower-cased text."""
    text = col(text)
    cases = [(contains_any(text, words), name) for name, words in rules.EVENT_TYPE_RULES]
    cases.append((col(severity) == "INFO", "normal_ops"))
    return first_match(cases, F.lit("unknown"))


def template_label(template: Column | str) -> Column:
    """Label forced by template keywords, or null."""
    text = F.lower(col(template))
    cases = [(contains_any(text, words), F.lit(n)) for n, words in rules.TEMPLATE_LABEL_RULES]
    return first_match(cases, F.lit(None).cast("int"))


def event_label(kind: Column | str, template: Column | str) -> Column:
    """Integer class of an event: template keywords first, then the event type."""
    by_type = lookup(col(kind), rules.EVENT_TYPE_LABELS, 0)
    return F.coalesce(template_label(template), by_type).cast("bigint")


def event_number(event_id: Column | str) -> Column:
    """``E55`` -> 55, anything without an E-number -> null."""
    digits = F.nullif(F.regexp_extract(col(event_id), r"E(\d+)", 1), F.lit(""))
    return digits.try_cast("bigint")


def clean_part(value: Column | str) -> Column:
    """Null and NaN become the empty string; other values are trimmed text."""
    text = strip(col(value).cast("string"))
    return F.when(F.lower(text) == "nan", "").otherwise(F.coalesce(text, F.lit("")))


def join_timestamp(*parts: Column | str) -> Column:
    """Join the non-blank parts of a timestamp with single spaces."""
    return F.concat_ws(" ", *[blank_to_null(col(p).cast("string")) for p in parts])


def time_bucket(timestamp: Column | str, system: Column | str) -> Column:
    """Minute-like bucket cut out of the raw timestamp text, per log system.

    Null timestamps share the bucket text ``None``.
    """
    system = col(system)
    text = F.coalesce(strip(timestamp), F.lit("None"))
    words = F.split(text, SPACES)
    hdfs = F.when(
        F.array_size(words) == 2, F.concat(words[0], F.lit(" "), F.left(words[1], F.lit(4)))
    ).otherwise(F.left(text, F.lit(9)))
    clock = F.substring_index(text, " ", -1)
    day = F.substring(text, F.lit(1), F.char_length(text) - F.char_length(clock) - 1)
    minute = F.substring_index(F.replace(clock, F.lit(","), F.lit(".")), ":", 2)
    return (
        F.when(system == "hpc", F.left(text, F.lit(7)))
        .when(system == "hdfs", hdfs)
        .when(text.contains(" "), F.concat(day, F.lit(" "), minute))
        .otherwise(F.left(text, F.lit(10)))
    )


EPOCH_FORM = r"^\d+$"
LINUX_FORM = r"^[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}$"


def timestamp_form(timestamp: Column | str) -> Column:
    """Which family a timestamp text belongs to: epoch, linux or standard."""
    text = col(timestamp)
    return (
        F.when(strip(text).rlike(EPOCH_FORM), "epoch")
        .when(text.rlike(LINUX_FORM), "linux")
        .otherwise("standard")
    )


def parse_timestamp(timestamp: Column | str) -> Column:
    """Timestamp of a log line in any of the five source formats, or null.

    Digits are epoch seconds. The syslog form carries no year, so it lands in 1970. Each text
    is tried with the one format its shape allows: a failed attempt costs far more than a
    look at the text.
    """
    text = strip(timestamp)
    form = timestamp_form(timestamp)
    epoch = F.timestamp_seconds(F.when(form == "epoch", text).try_cast("bigint"))
    linux = F.try_to_timestamp(F.regexp_replace(text, r"\s+", " "), F.lit("MMM d HH:mm:ss"))
    standard = (
        F.when(text.contains(","), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss,SSS")))
        .when(text.contains("-"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))
        .when(text.contains("/"), F.try_to_timestamp(text, F.lit("yy/MM/dd HH:mm:ss")))
        .otherwise(F.try_to_timestamp(text, F.lit("yyMMdd HHmmss")))
    )
    return F.when(form == "epoch", epoch).when(form == "linux", linux).otherwise(standard)


def stable_hash_mod(value: Column, modulus: int) -> Column:
    """The md5 of ``value`` read as one 128-bit integer, modulo ``modulus``.

    Folds the digest as four 32-bit words, so it stays in BIGINT arithmetic.
    """
    if not 0 < modulus < 2**31:
        raise ValueError("modulus must lie between 1 and 2^31 - 1")
    digest = F.md5(value)
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    word_mod = 2**32 % modulus
    result = words[0] % modulus
    for word in words[1:]:
        result = (result * word_mod + word) % modulus
    return result


def in_sample(system: Column | str, raw_id: Column | str, percent: int = 10) -> Column:
    """True for the rows of the repeatable ``percent`` sample of ``system:raw_id``."""
    return stable_hash_mod(F.concat(col(system), F.lit(":"), col(raw_id)), 100) < percent
