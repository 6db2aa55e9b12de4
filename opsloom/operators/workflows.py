"""Generated-workflow operators: prompt queue, pairing, schema check, chat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions import chats
from opsloom.functions.common import col, let
from opsloom.operators.qa import message

SYSTEM_PROMPT = "You are an MLOps remediation engine."
PARAM_KEYS = ["deployment", "replicas", "pod"]


def unprocessed(prompts: DataFrame, processed: DataFrame) -> DataFrame:
    """Prompts whose id is not among the processed ids."""
    return prompts.join(processed.select("id"), "id", "left_anti")


def mark_processed(processed: DataFrame, ids: DataFrame) -> DataFrame:
    """The processed-id table with new ids added once."""
    return processed.select("id").union(ids.select("id")).distinct()


def pair_workflows(prompts: DataFrame, workflows: DataFrame) -> DataFrame:
    """Prompts with their generated workflow; prompts without one are left out."""
    generated = workflows.filter(F.col("workflow_json").isNotNull())
    return prompts.join(generated.select("id", "workflow_json"), "id")


def _is_whole_number(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    text = value.cast("string")
    return (kind == "BIGINT") | (kind == "BOOLEAN") | (
        (kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "STRING"))
        & text.rlike(r"^[+-]?\d+(\.0+)?$")
    )


def workflow_valid(text: Column | str) -> Column:
    """True if the JSON text is a workflow: a list of steps, each with a whole-number id, a
    tool name and parameters of the closed set (all optional, null allowed)."""
    text = col(text)
    parsed = F.try_parse_json(F.when(chats.json_object(text).isNotNull(), text))

    def field(value: Column, path: str) -> Column:
        return F.variant_get(value, path, "variant")

    def bad(step: Column) -> Column:
        kind = F.schema_of_variant(step)
        number, tool, params = (field(step, f"$.{k}") for k in ("step_id", "tool", "params"))
        keys = F.json_object_keys(F.to_json(params))
        deployment, replicas, pod = (field(params, f"$.{k}") for k in PARAM_KEYS)

        def optional(value: Column, fits: Column) -> Column:
            return value.isNull() | F.is_variant_null(value) | fits

        good = (
            kind.startswith("OBJECT")
            & F.coalesce(_is_whole_number(number), F.lit(False))
            & F.coalesce(F.schema_of_variant(tool) == "STRING", F.lit(False))
            & F.coalesce(F.schema_of_variant(params).startswith("OBJECT"), F.lit(False))
            & F.coalesce(
                F.array_size(F.array_except(keys, F.array(*[F.lit(k) for k in PARAM_KEYS]))) == 0,
                F.lit(False),
            )
            & optional(deployment, F.schema_of_variant(deployment) == "STRING")
            & optional(replicas, _is_whole_number(replicas))
            & optional(pod, F.schema_of_variant(pod) == "STRING")
        )
        return ~F.coalesce(good, F.lit(False))

    return let(
        F.try_variant_get(parsed, "$.steps", "array<variant>"),
        lambda steps: steps.isNotNull() & ~F.coalesce(F.exists(steps, bad), F.lit(True)),
    )


def workflow_records(pairs: DataFrame, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """(user_intent, tool_context, workflow_json) -> chat messages."""
    tools = F.concat(
        F.lit(f"{system_prompt} Available Tools: "), F.coalesce("tool_context", F.lit(""))
    )
    reply = F.concat(F.lit('{"workflow":'), F.col("workflow_json"), F.lit("}"))
    return pairs.select(
        "id",
        F.array(
            message("system", tools), message("user", "user_intent"),
            message("assistant", reply),
        ).alias("messages"),
    )


def chat_errors(records: DataFrame) -> DataFrame:
    """Add ``errors``: structural rules a chat record breaks (empty if it conforms)."""
    size = F.coalesce(F.array_size("messages"), F.lit(-1))
    missing = chats.roles_missing("messages")
    return records.withColumn("errors", F.array_compact(F.array(
        F.when(F.col("messages").isNull(), "missing 'messages'"),
        F.when(F.col("messages").isNotNull() & (size < 3), "fewer than 3 messages"),
        F.when((size >= 3) & (F.array_size(missing) > 0), "missing a required role"),
    )))


def chat_anomalies(records: DataFrame) -> DataFrame:
    """One row per anomaly of a chat record: the record's columns plus ``anomaly``."""
    size = F.coalesce(F.array_size("messages"), F.lit(-1))
    enough = size >= 3
    replies = F.filter("messages", lambda m: m["role"] == "assistant")
    # the last message of a role is the one that counts
    reply = F.element_at(F.transform(replies, lambda m: m["content"]), F.lit(-1))
    has_reply = F.when(F.array_size(replies) > 0, reply)
    found = F.concat(
        F.array_compact(F.array(
            F.when(F.col("messages").isNull(), "missing 'messages'"),
            F.when(F.col("messages").isNotNull() & ~enough, "missing messages"),
        )),
        F.when(
            enough,
            F.transform(chats.roles_missing("messages"),
                        lambda r: F.concat(F.lit("missing role "), r)),
        ).otherwise(F.array().cast("array<string>")),
        F.array_compact(F.array(F.when(
            enough & (F.coalesce(has_reply, F.lit("")) != "") & ~chats.is_json(has_reply),
            "assistant content is not valid JSON",
        ))),
    )
    return records.withColumn("anomaly", F.explode(found))


def chat_statistics(records: DataFrame) -> DataFrame:
    """One row: records, blank intents, records without at least three messages."""
    few = F.coalesce(F.array_size("messages"), F.lit(-1)) < 3
    intents = (
        F.count_if(F.coalesce(F.col("user_intent"), F.lit("")) == "")
        if "user_intent" in records.columns else F.lit(0).cast("bigint")
    )
    return records.agg(
        F.count("*").alias("row_count"), intents.alias("missing_user_intent"),
        F.count_if(few).alias("records_missing_valid_messages"),
    )


JSON_TYPES = ["array", "boolean", "null", "number", "object", "string"]


def json_fields(lines: DataFrame, column: str) -> DataFrame:
    """Schema and missing fields of JSON objects, from their text: one row per top-level field.

    ``types`` are the JSON types met, in order and joined by ``|``; ``present`` counts the records
    that have the field, ``nulls`` those where it is null, ``missing`` the valid records without
    it. Lines that are no JSON object count nowhere. One pass: every record also leaves one mark of
    its own, whose count is the number of records.
    """
    raw = F.col("_field.value")
    first = F.left(F.ltrim(raw), F.lit(1))
    kind = (
        F.when(raw.isNull() | (raw == "null"), "null").when(first == "{", "object")
        .when(first == "[", "array").when(raw.isin("true", "false"), "boolean")
        .when(raw.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), "number").otherwise("string")
    )
    known = lines.select(chats.json_object(F.col(column)).alias("_object")).where(
        F.col("_object").isNotNull()
    )
    mark = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit("").alias("value")))
    marks = known.select(F.explode(F.concat(mark, F.map_entries("_object"))).alias("_field"))
    counted = marks.groupBy(F.col("_field.key").alias("field")).agg(
        F.count("*").alias("present"), F.count_if(kind == "null").alias("nulls"),
        *[F.count_if(kind == t).alias(f"_{t}") for t in JSON_TYPES],
    )
    types = F.array_compact(F.array(*[F.when(F.col(f"_{t}") > 0, t) for t in JSON_TYPES]))
    records = F.max(F.when(F.col("field").isNull(), F.col("present"))).over(
        Window.partitionBy(F.lit(0))        # of one row per field
    )
    return counted.select(
        "field", F.array_join(types, "|").alias("types"), "present", "nulls",
        (records - F.col("present")).alias("missing"), records.alias("records"),
    ).where(F.col("field").isNotNull())
