"""Cluster-trace columns: utilisation tokens, state tokens and sequence labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions import rules
from opsloom.functions.common import col, first_match, lookup

CPU_BASE, MEMORY_BASE = 100, 200


def decile_token(percent: Column, base: int) -> Column:
    """0-100 utilisation -> one of ten tokens from ``base``; out-of-range values clip."""
    decile = F.floor(percent / 10)
    return F.when(
        decile.isNotNull(), F.least(F.greatest(decile, F.lit(0)), F.lit(9)) + base
    ).cast("bigint")


def cpu_token(percent: Column | str) -> Column:
    return decile_token(col(percent).cast("double"), CPU_BASE)


def memory_token(percent: Column | str) -> Column:
    return decile_token(col(percent).cast("double"), MEMORY_BASE)


def planned_memory_token(fraction: Column | str) -> Column:
    """Planned memory is a fraction of the machine, not a percentage."""
    return decile_token(col(fraction).cast("double") * 100, MEMORY_BASE)


def status_token(status: Column | str) -> Column:
    return lookup(col(status), rules.STATUS_TOKENS, rules.STATUS_TOKENS["Unknown"]).cast("bigint")


def event_token(kind: Column | str) -> Column:
    return lookup(col(kind), rules.EVENT_TOKENS, rules.EVENT_TOKENS["unknown"]).cast("bigint")


def usage_label(cpu: Column, memory: Column) -> Column:
    return F.when((memory >= 207) | (cpu >= 208), 1).otherwise(0).cast("bigint")


def task_label(status: Column, cpu: Column, memory: Column) -> Column:
    return first_match(
        [((status == "Failed") & (cpu <= 103), F.lit(2)),
         ((status == "Terminated") & (memory >= 207), F.lit(1)),
         (status.isin("Failed", "Waiting"), F.lit(4))],
        F.lit(0),
    ).cast("bigint")


def machine_event_label(kind: Column) -> Column:
    return F.when(kind == "failure", 3).otherwise(0).cast("bigint")


def fit_length(values: Column | str, length: int = rules.MAX_SEQUENCE_LENGTH) -> Column:
    """Keep the last ``length`` values, or pad with zeros at the end to that length."""
    values = col(values)
    missing = F.greatest(F.lit(length) - F.array_size(values), F.lit(0))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), missing)
    return F.when(F.array_size(values) > length, F.slice(values, -length, length)).otherwise(
        F.concat(values, zeros)
    )
