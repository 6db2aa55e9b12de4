"""Declarative data-quality checks: any number of them in one pass over the table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named check. ``violations`` is an aggregate column that is 0 when it holds and null
    when its column does not exist; ``distinct_of`` marks a uniqueness check instead."""

    name: str
    violations: Column | None = None
    distinct_of: str | None = None


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _on_column(df: DataFrame, name: str, column: str, violations) -> Check:
    if column not in df.columns:
        return Check(name, F.lit(None).cast("bigint"))
    return Check(name, violations(F.col(column)))


def columns_present(df: DataFrame, required: Sequence[str]) -> Check:
    missing = [c for c in required if c not in df.columns]
    return Check("columns_present", F.lit(len(missing)).cast("bigint"))


def no_nulls(df: DataFrame, columns: Sequence[str]) -> list[Check]:
    return [
        _on_column(df, f"no_nulls_{c}", c, lambda x: _count(x.isNull())) for c in columns
    ]


def value_range(df: DataFrame, column: str, min_val=None, max_val=None) -> Check:
    """Values below ``min_val`` or above ``max_val``; nulls pass, an absent bound is open."""
    def outside(x: Column) -> Column:
        bad = F.lit(False)
        if min_val is not None:
            bad = bad | (x < min_val)
        if max_val is not None:
            bad = bad | (x > max_val)
        return _count(bad)

    return _on_column(df, f"range_{column}", column, outside)


def _disallowed(x: Column, allowed: Sequence[Any]) -> Column:
    listed = x.isin([a for a in allowed if a is not None])
    return ~F.coalesce(listed, F.lit(None in list(allowed)))


def allowed_values(df: DataFrame, column: str, allowed: Sequence[Any]) -> Check:
    """Rows with a value outside the list; null must be listed to pass."""
    return _on_column(
        df, f"allowed_{column}", column, lambda x: _count(_disallowed(x, allowed))
    )


def row_count(min_rows: int = 0, max_rows: int | None = None) -> Check:
    n = F.count("*")
    bad = n < min_rows if max_rows is None else (n < min_rows) | (n > max_rows)
    return Check("row_count", F.when(bad, 1).otherwise(0).cast("bigint"))


def no_empty_strings(df: DataFrame, columns: Sequence[str]) -> list[Check]:
    return [
        _on_column(df, f"no_empty_{c}", c, lambda x: _count(F.octet_length(x) == 0))
        for c in columns
    ]


def unique(df: DataFrame, column: str) -> Check:
    """Rows beyond the first of each value; null counts as a value."""
    if column not in df.columns:
        return Check(f"unique_{column}", F.lit(None).cast("bigint"))
    return Check(f"unique_{column}", distinct_of=column)


def regex_match(df: DataFrame, column: str, pattern: str, name: str | None = None) -> Check:
    """Values the pattern is not found in; nulls are ignored."""
    return _on_column(
        df, name or f"regex_{column}", column, lambda x: _count(~x.rlike(pattern))
    )


def short_text(df: DataFrame, column: str, min_bytes: int, name: str) -> Check:
    return _on_column(df, name, column, lambda x: _count(F.octet_length(x) < min_bytes))


def _flatten(checks: Iterable) -> list[Check]:
    return [c for item in checks for c in (item if isinstance(item, list) else [item])]


def run_checks(df: DataFrame, checks: Iterable) -> DataFrame:
    """One row per check: (check, success, violations).

    All plain checks share a single aggregate over the table. Uniqueness checks, which must
    bring equal values together, count per value instead and run beside it.
    """
    checks = _flatten(checks)
    plain = [c for c in checks if c.distinct_of is None]
    frames = []
    if plain:
        counted = df.agg(*[c.violations.alias(f"c{i}") for i, c in enumerate(plain)])
        rows = [
            F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("violations"))
            for i, c in enumerate(plain)
        ]
        frames.append(counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for c in checks:
        if c.distinct_of is not None:
            per_value = df.groupBy(c.distinct_of).agg(F.count("*").alias("n"))
            extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
            frames.append(per_value.agg(extra).select(F.lit(c.name).alias("check"), "violations"))
    return reduce(DataFrame.unionByName, frames).select(
        "check", F.col("violations").eqNullSafe(F.lit(0)).alias("success"), "violations"
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """One row: total, passed, failed, success_rate, all_passed."""
    passed = F.count_if(F.col("success"))
    total = F.count("*")
    return results.agg(
        total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"),
        F.coalesce(F.try_divide(passed, total), F.lit(1.0)).alias("success_rate"),
        (passed == total).alias("all_passed"),
    )


def schema_checks(df: DataFrame, schema: Mapping[str, Any]) -> DataFrame:
    """Checks from a plain description of a table.

    Keys, all optional: required_columns, not_null_columns, column_value_sets (nulls pass),
    row_count_range, numeric_ranges (a column without values fails). Rules on absent columns
    are skipped; only required_columns reports them.
    """
    checks = [
        Check(f"column_exists_{c}", F.lit(0 if c in df.columns else 1).cast("bigint"))
        for c in schema.get("required_columns", [])
    ]
    checks += no_nulls(df, [c for c in schema.get("not_null_columns", []) if c in df.columns])
    for c, allowed in schema.get("column_value_sets", {}).items():
        if c in df.columns:
            outside = ~F.col(c).isin([a for a in allowed if a is not None])
            checks.append(Check(f"values_in_set_{c}", _count(outside)))
    if schema.get("row_count_range"):
        low, high = schema["row_count_range"]
        checks.append(Check("row_count_range", row_count(low, high).violations))
    for c, (low, high) in schema.get("numeric_ranges", {}).items():
        if c in df.columns:
            inside = F.coalesce((F.min(c) >= low) & (F.max(c) <= high), F.lit(False))
            outside = _count((F.col(c) < low) | (F.col(c) > high))
            checks.append(Check(
                f"range_{c}", F.when(inside, 0).otherwise(F.greatest(outside, F.lit(1)))
            ))
    return run_checks(df, checks)


def disallowed_values(df: DataFrame, column: str, allowed: DataFrame | Sequence[Any]) -> DataFrame:
    """Distinct values of ``column`` that the allowed set lacks, with their row counts.

    ``allowed`` is a list, or a one-column table when the set is itself large.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    if isinstance(allowed, DataFrame):
        known = allowed.select(F.col(allowed.columns[0]).alias("known")).distinct()
        return counts.join(known, counts["value"].eqNullSafe(known["known"]), "left_anti")
    return counts.filter(_disallowed(F.col("value"), allowed))


def field_differences(fields: DataFrame, required: Sequence[str],
                      known: Sequence[str] | None = None) -> DataFrame:
    """Required fields that no record has and fields that are not known: (kind, column).

    ``fields`` has one row per field that the records hold, with the column ``field``, as schema
    inference over their text gives it. Fields other than ``known`` (by default the required ones)
    are extra.
    """
    wanted = fields.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in required]).cast("array<string>")).alias("column"),
        F.lit(0).alias("present"),
    )
    met = fields.select(F.col("field").alias("column"), F.lit(1).alias("present")).unionByName(wanted)
    expected = F.col("column").isin([*required, *(known or required)])
    kind = F.when(F.col("present") == 0, "missing").when(~expected, "extra")
    return met.groupBy("column").agg(F.max("present").alias("present")).select(
        kind.alias("kind"), "column"
    ).where("kind IS NOT NULL")
