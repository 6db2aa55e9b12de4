"""Function-call chat operators: features, chat records, slices, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions import chats, rules
from opsloom.functions.common import computed
from opsloom.operators import quality
from opsloom.operators.qa import message

SLICE_COLUMNS = [
    "complexity_tier", "turn_bucket", "call_bucket",
    "has_error_handling", "has_parallel", "has_defined_functions",
]


def call_features(raw: DataFrame) -> DataFrame:
    """(system, chat) -> the fifteen feature columns; rows without chat text are dropped.

    Calls are parsed once into an array column; every call feature is read from it. The array
    itself is kept as ``calls`` for the operators that follow.
    """
    words = chats.error_words("chat")
    parsed = computed(
        raw.filter(F.col("chat") != "").select("system", "chat"),
        calls=chats.function_calls("chat"),
        signature=chats.function_signature("system"),
        words=words,
    )
    calls, signature = F.col("calls"), F.col("signature")
    defined = signature.isNotNull()
    names = F.when(defined, F.to_json(F.array(signature["name"]))).otherwise("[]")
    return parsed.select(
        "system", "chat",
        chats.user_turns("chat").alias("num_turns"),
        F.array_size(calls).alias("num_calls"),
        chats.complexity_tier(calls).alias("complexity_tier"),
        (F.array_size(calls) > 1).alias("has_parallel"),
        chats.has_malformed(calls).alias("has_malformed"),
        chats.calls_json(calls).alias("function_calls"),
        defined.cast("int").alias("num_defined_functions"),
        names.alias("defined_function_names"),
        chats.signatures_json(signature).alias("function_signatures"),
        (F.array_size("words") > 0).alias("has_error_handling"),
        chats.has_function_error("chat").alias("has_function_error_response"),
        chats.has_conditional_error("chat").alias("has_conditional_error"),
        F.to_json("words").alias("error_keywords_found"),
        "calls",
    )


def chat_messages(features: DataFrame, system_prompt: str = rules.SYSTEM_PROMPT) -> DataFrame:
    """Feature rows -> system, user and assistant messages.

    Good calls become workflow steps; without calls, or with a malformed one, the assistant
    turn carries the reply and no steps.
    """
    step = lambda c: F.concat(
        F.lit('{"tool":'), chats.quote_json(c["name"]), F.lit(',"params":'), c["arguments"],
        F.lit("}"),
    )
    steps = F.array_join(F.transform("calls", step), ",")
    with_steps = F.concat(F.lit('{"workflow":{"steps":['), steps, F.lit("]}}"))
    reply = chats.first_assistant_text("chat")
    without = F.concat(
        F.lit('{"workflow":{"steps":[]},"message":'), chats.quote_json(reply), F.lit("}")
    )
    usable = (F.array_size("calls") > 0) & ~F.col("has_malformed")
    tools = F.concat(F.lit(f"{system_prompt}\nAvailable Tools: "), F.col("function_signatures"))
    return features.select(
        F.array(
            message("system", tools),
            message("user", chats.first_user_text("chat")),
            message("assistant", F.when(usable, with_steps).otherwise(without)),
        ).alias("messages"),
        "complexity_tier", "has_error_handling", "num_turns", "num_calls",
    )


def add_slice_features(features: DataFrame) -> DataFrame:
    """Add turn bucket, call bucket and whether a function is defined."""
    return (
        features.withColumn("turn_bucket", chats.turn_bucket("num_turns"))
        .withColumn("call_bucket", chats.call_bucket("num_calls"))
        .withColumn("has_defined_functions", F.col("num_defined_functions") > 0)
    )


def slice_summary(features: DataFrame, columns: list[str] = SLICE_COLUMNS,
                  threshold: float = 0.05) -> DataFrame:
    """Counts and averages of every value of every slice column, from one aggregation.

    The rows are those of any one slice column's values, so the total needs no second pass.
    """
    first = F.when(F.col("slice_column") == columns[0], F.col("count"))
    total = F.sum(first).over(Window.partitionBy(F.lit(0)))     # of one row per slice value
    pairs = F.array(*[
        F.struct(F.lit(c).alias("slice_column"), F.col(c).cast("string").alias("slice_value"))
        for c in columns
    ])
    grouped = (
        features.select(
            F.explode(pairs).alias("s"), "num_turns", "num_calls", "has_malformed",
            "has_error_handling",
        )
        .groupBy(F.col("s.slice_column").alias("slice_column"),
                 F.col("s.slice_value").alias("slice_value"))
        .agg(
            F.count("*").alias("count"), F.avg("num_turns").alias("avg_turns"),
            F.avg("num_calls").alias("avg_calls"),
            F.count_if("has_malformed").alias("malformed_count"),
            F.avg(F.col("has_error_handling").cast("double")).alias("error_handling_pct"),
        )
    )
    share = F.col("_share")
    return grouped.withColumn("_share", F.col("count") / total).withColumns({
        "is_underrepresented": share < threshold, "proportion": F.round(share, 4)
    }).drop("_share")


def representation_findings(summary: DataFrame, high_below: float = 0.01) -> DataFrame:
    """Under-represented slice values with severity and remedy."""
    severity = F.when(F.col("proportion") < high_below, "high").otherwise("medium")
    return summary.filter("is_underrepresented").select(
        "slice_column", "slice_value", "proportion", "count", severity.alias("severity"),
        F.when(severity == "high", "oversample").otherwise("collect_more").alias("strategy"),
    )


def processing_summary(features: DataFrame) -> DataFrame:
    """One row: records, average turns and calls, malformed records."""
    return features.agg(
        F.count("*").alias("total_records"), F.avg("num_turns").alias("avg_turns"),
        F.avg("num_calls").alias("avg_calls"),
        F.count_if("has_malformed").alias("malformed_calls"),
    )


def threshold_checks(features: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Six health checks from one aggregate: (check, value, threshold, is_anomaly)."""
    limits = {**rules.CALL_THRESHOLDS, **(thresholds or {})}
    n = F.count("*")

    def share(condition: Column) -> Column:
        return F.try_divide(F.count_if(condition), n)

    low_is_bad = {"record_count", "defined_functions_coverage"}
    values = {
        "malformed_rate": share(F.col("has_malformed")),
        "none_complexity_rate": share(F.col("complexity_tier") == "none"),
        "record_count": n,
        "avg_turns": F.avg("num_turns"),
        "avg_calls": F.avg("num_calls"),
        "defined_functions_coverage": share(F.col("num_defined_functions") > 0),
    }
    row = features.agg(*[v.cast("double").alias(name) for name, v in values.items()])
    rows = []
    for name in values:
        limit, value = F.lit(float(limits[name])), F.col(name)
        bad = value < limit if name in low_is_bad else value > limit
        rows.append(F.struct(
            F.lit(name).alias("check"), F.round(value, 4).alias("value"),
            limit.alias("threshold"), bad.alias("is_anomaly"),
        ))
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def call_suite(features: DataFrame, min_rows: int = 3000, max_rows: int | None = None
               ) -> DataFrame:
    """The standard check suite of the feature table; no upper bound of rows unless given."""
    return quality.run_checks(features, [
        quality.columns_present(features, rules.CALL_COLUMNS),
        quality.no_nulls(features, ["chat", "num_turns", "num_calls", "complexity_tier"]),
        quality.allowed_values(features, "complexity_tier", rules.COMPLEXITY_TIERS),
        quality.value_range(features, "num_turns", 0, 50),
        quality.value_range(features, "num_calls", 0, 20),
        quality.value_range(features, "num_defined_functions", 0, 20),
        quality.row_count(min_rows, max_rows),
        quality.short_text(features, "chat", 10, "chat_not_empty"),
    ])
