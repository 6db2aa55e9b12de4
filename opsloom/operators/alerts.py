"""Alert rows and their bounded history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _alert(kind: str, severity: Column, title: str, message: Column, pipeline: str,
           details: Column) -> list[Column]:
    return [
        F.lit(kind).alias("type"), severity.alias("severity"), F.lit(title).alias("title"),
        message.alias("message"), F.lit(pipeline).alias("pipeline"), details.alias("details"),
    ]


def anomaly_alert(anomalies: DataFrame, pipeline: str, kind_column: str,
                  many: int = 10, named: int | None = None) -> DataFrame:
    """One alert row if there are anomalies; more than ``many`` make it an error.

    All kinds are named, or the first ``named`` in order. There is one row per kind by then.
    """
    counts = anomalies.groupBy(F.col(kind_column).alias("kind")).agg(F.count("*").alias("n"))
    kinds = F.array_sort(F.collect_list("kind"))
    if named is not None:
        kinds = F.slice(kinds, 1, named)
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), kinds.alias("kinds"))
    severity = F.when(F.col("n") > many, "error").otherwise("warning")
    details = F.to_json(F.struct(
        F.col("n").alias("anomaly_count"), F.array_join("kinds", ", ").alias("types")
    ))
    text = F.format_string(f"Found %d anomalies in {pipeline}", F.col("n"))
    return row.filter(F.col("n") > 0).select(
        *_alert("anomaly_detected", severity, "Data anomalies", text, pipeline, details)
    )


def validation_alert(checks: DataFrame, pipeline: str) -> DataFrame:
    """One error row if checks failed, with their names; ``checks`` has check and success."""
    failed = checks.filter(~F.col("success")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list("check")).alias("names")
    )
    details = F.to_json(F.struct(
        F.array_join("names", ", ").alias("failed_checks"), F.col("n").alias("total_failures")
    ))
    text = F.format_string(f"Data validation failed with %d check(s) in {pipeline}", F.col("n"))
    return failed.filter(F.col("n") > 0).select(*_alert(
        "validation_failure", F.lit("error"), "Data validation failed", text, pipeline, details
    ))


def quality_alert(rates: DataFrame, pipeline: str, max_percent: float) -> DataFrame:
    """One warning per column whose null share exceeds the limit; ``rates`` has column, null_pct."""
    text = F.format_string("%s is missing in %.2f %% of the rows", F.col("column"), F.col("null_pct"))
    details = F.to_json(F.struct("column", "null_pct"))
    return rates.filter(F.col("null_pct") > max_percent).select(*_alert(
        "data_quality_issue", F.lit("warning"), "Data quality issue", text, pipeline, details
    ))


def bias_alert(bias: DataFrame, pipeline: str) -> DataFrame:
    """One alert row if slices are biased; any of high severity makes it an error.

    ``bias`` has one row per slice with ``is_biased`` and ``severity``.
    """
    row = bias.filter("is_biased").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in ("high", "medium", "low")],
    )
    severity = F.when(F.col("high") > 0, "error").otherwise("warning")
    details = F.to_json(F.struct("high", "medium", "low"))
    text = F.format_string(f"Bias in %d slices of {pipeline}", F.col("n"))
    return row.filter(F.col("n") > 0).select(
        *_alert("bias_detected", severity, "Data bias", text, pipeline, details)
    )


def append_history(history: DataFrame, alerts: DataFrame, at: Column, keep: int = 1000
                   ) -> DataFrame:
    """History plus new alerts, newest ``keep`` rows only."""
    return latest(history.unionByName(alerts.withColumn("timestamp", at)), keep)


def latest(history: DataFrame, keep: int = 1000, time: str = "timestamp") -> DataFrame:
    rest = [c for c in history.columns if c != time]
    return history.orderBy(F.desc(time), *rest).limit(keep)
