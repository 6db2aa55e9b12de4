"""The log aggregates over an event stream, with event-time windows and late-data limits.

The batch forms are in operators.logs; labelling is shared with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opsloom.functions import logs
from opsloom.operators.logs import label_event_types


def timed_events(events: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Labelled events with a parsed event time and its watermark."""
    timed = label_event_types(events).withColumn(
        "event_time", logs.parse_timestamp("timestamp")
    )
    return timed.withWatermark("event_time", lateness)


def windowed_counts(events: DataFrame, window: str = "1 minute",
                    lateness: str = "10 minutes") -> DataFrame:
    """Events, errors and error rate per window, system and event type."""
    grouped = timed_events(events, lateness).groupBy(
        F.window("event_time", window).alias("window"), "system", "event_type"
    )
    counts = grouped.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("severity") == "ERROR").alias("error_count"),
    )
    return counts.select(
        F.col("window.start").alias("window_start"), "system", "event_type", "total",
        "error_count", F.round(F.col("error_count") / F.col("total"), 4).alias("error_rate"),
    )


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows to a Parquet table; stops when the input is used up."""
    return (
        counts.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
