"""Cluster-trace operators: utilisation windows, task and machine-event sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions import traces
from opsloom.operators.ordering import with_row_index

TIES = ("machine_id", "cpu_util_percent", "mem_util_percent")


def usage_windows(usage: DataFrame, window_size: int = 5,
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Every ``window_size`` consecutive readings in time order -> one token sequence.

    Windows tumble; an incomplete last window is dropped. By default the order is global, as
    with a single trace file; ``partition_by=['machine_id']`` keeps machines apart.
    """
    keys = list(partition_by)
    slim = usage.select(
        *dict.fromkeys([*keys, "time_stamp", "machine_id", "cpu_util_percent", "mem_util_percent"])
    )
    order = ["time_stamp", *[c for c in TIES if c not in keys]]
    tokens = with_row_index(slim, order, keys).select(
        *keys,
        F.floor(F.col("row_index") / window_size).alias("window"),
        F.struct(
            "row_index",
            traces.cpu_token("cpu_util_percent").alias("cpu"),
            traces.memory_token("mem_util_percent").alias("mem"),
        ).alias("reading"),
    )
    readings = F.sort_array(F.col("readings"))
    last = F.element_at(readings, -1)
    return (
        tokens.groupBy(*keys, "window")
        .agg(F.collect_list("reading").alias("readings"))
        .filter(F.array_size("readings") == window_size)
        .select(
            *keys, "window",
            F.flatten(F.transform(readings, lambda r: F.array(r["cpu"], r["mem"])))
            .alias("sequence_ids"),
            traces.usage_label(last["cpu"], last["mem"]).alias("label"),
        )
    )


def fill_task_defaults(tasks: DataFrame) -> DataFrame:
    """Tasks with an unknown status or type marked as such."""
    return tasks.withColumn("status", F.coalesce("status", F.lit("Unknown"))).withColumn(
        "task_type", F.coalesce("task_type", F.lit(-1)).cast("int")
    )


def task_sequences(tasks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Batch-task rows -> [cpu, memory, status] tokens and a label; ``keep`` passes columns on."""
    status = F.coalesce(F.col("status"), F.lit("Unknown"))
    cpu = traces.cpu_token("plan_cpu")
    memory = traces.planned_memory_token("plan_mem")
    return tasks.select(
        *keep,
        F.array(cpu, memory, traces.status_token(status)).alias("sequence_ids"),
        traces.task_label(status, cpu, memory).alias("label"),
    )


def machine_event_sequences(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Machine-event rows -> [event, cpu, memory] tokens and a label."""
    kind = F.lower(F.coalesce(F.col("event_type"), F.lit("unknown")))
    return events.select(
        *keep,
        F.array(
            traces.event_token(kind), traces.cpu_token("plan_cpu"),
            traces.planned_memory_token("plan_mem"),
        ).alias("sequence_ids"),
        traces.machine_event_label(kind).alias("label"),
    )
