"""Token-sequence table (sequence_ids, label): statistics, validation, imbalance, anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions import rules
from opsloom.functions.common import lookup
from opsloom.operators.profile import share_of_values


def label_name(label: Column | str = "label") -> Column:
    label = F.col(label) if isinstance(label, str) else label
    return lookup(label, rules.SEQUENCE_LABELS)


def _tokens_between(low: int, high: int) -> Column:
    return F.array_size(F.filter("sequence_ids", lambda t: t.between(low, high)))


def sequence_statistics(sequences: DataFrame) -> DataFrame:
    """Tidy (metric, value): labels, lengths, token families and quality counters.

    One pass: a sequence leaves one mark for its label and one for each token it holds; both are
    counted together, and all figures come from those few counts.
    """
    sums = {
        "total_tokens": F.col("size"), "cpu_tokens": F.col("cpu"), "memory_tokens": F.col("memory"),
        "empty_sequences": (F.col("size") == 0).cast("int"),
        "invalid_labels": (~F.col("value").between(0, 4)).cast("int"),
        "missing_fields": (F.col("size").isNull() | F.col("value").isNull()).cast("int"),
    }
    shape = "array<struct<is_label: boolean, value: bigint, size: int, cpu: int, memory: int>>"
    own = F.array(F.struct(
        F.lit(True), F.col("label").cast("bigint"), F.array_size("sequence_ids"),
        _tokens_between(100, 109), _tokens_between(200, 209),
    )).cast(shape)
    none = F.lit(None).cast("int")
    held = F.transform(
        F.array_distinct(F.array_compact("sequence_ids")),
        lambda t: F.struct(F.lit(False), t.cast("bigint"), none, none, none),
    ).cast(shape)
    marks = sequences.select(F.inline(F.concat(own, F.coalesce(held, F.array().cast(shape)))))
    counted = marks.groupBy("is_label", "value").agg(
        F.count("*").alias("n"), F.count("size").alias("sized"),
        F.min("size").alias("length_min"), F.max("size").alias("length_max"),
        *[F.sum(v).alias(k) for k, v in sums.items()],
    )
    of_labels = {k: F.when(F.col("is_label"), F.col(k)) for k in ("n", "sized", *sums)}
    row = counted.agg(
        F.coalesce(F.sum(of_labels["n"]), F.lit(0)).alias("total_sequences"),
        F.min("length_min").alias("length_min"), F.max("length_max").alias("length_max"),
        F.round(F.try_divide(F.sum(of_labels["total_tokens"]), F.sum(of_labels["sized"])), 2).alias("length_mean"),
        *[F.sum(of_labels[k]).alias(k) for k in ("total_tokens", "cpu_tokens", "memory_tokens")],
        *[F.coalesce(F.sum(of_labels[k]), F.lit(0)).alias(k)
          for k in ("empty_sequences", "invalid_labels", "missing_fields")],
        F.count_if(~F.col("is_label")).alias("unique_tokens"),
        F.collect_list(F.when(F.col("is_label"), F.struct("value", "n"))).alias("labels"),
    )
    figures = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in row.columns if c != "labels"
    ])
    labels = F.transform("labels", lambda x: F.struct(
        F.concat(F.lit("label_"), F.coalesce(label_name(x["value"]), x["value"].cast("string"))).alias("metric"),
        x["n"].cast("double").alias("value"),
    ))
    return row.select(F.inline(F.concat(figures, labels)))


def sequence_errors(sequences: DataFrame) -> DataFrame:
    """One row per broken rule of a row: the row's columns plus ``error``."""
    tokens = F.col("sequence_ids")
    rules_broken = F.array_compact(F.array(
        F.when(tokens.isNull(), "sequence_ids is missing"),
        F.when(F.array_size(tokens) == 0, "sequence_ids is empty"),
        F.when(F.coalesce(~F.col("label").between(0, 4), F.lit(True)), "invalid label"),
        F.when(F.exists(tokens, lambda t: t.isNull()), "non-integer token"),
    ))
    return sequences.withColumn("error", F.explode(rules_broken))


def label_imbalance(sequences: DataFrame, limit: float = 70.0) -> DataFrame:
    """Share of each label and whether the normal class outweighs the limit."""
    shares = share_of_values(sequences, "label").select(
        F.col("value").alias("label"), label_name("value").alias("label_name"), "count", "pct"
    )
    return shares.withColumn("bias_detected", (F.col("label") == 0) & (F.col("pct") > limit))


def anomalous_sequences(sequences: DataFrame) -> DataFrame:
    """Every sequence that is not normal, with its label name."""
    return sequences.filter(F.col("label") != 0).withColumn("label_name", label_name())


def critical_sequences(sequences: DataFrame) -> DataFrame:
    """Resource exhaustion and system crash only."""
    return anomalous_sequences(sequences).filter(F.col("label").isin(1, 2))


def anomaly_breakdown(sequences: DataFrame) -> DataFrame:
    return anomalous_sequences(sequences).groupBy("label_name").agg(F.count("*").alias("count"))
