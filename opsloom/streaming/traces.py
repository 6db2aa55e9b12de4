"""Utilisation windows over a stream: every ``n`` consecutive readings of a machine, in time order.

The batch form is operators.traces.usage_windows. Readings come in any order, so each machine
holds those that the watermark has not passed; when it has, no earlier reading can come any more
(later arrivals with such a time are dropped), and windows are cut from the sorted readings. Held per
machine are the readings of the allowed lateness and fewer than ``n`` before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from opsloom.functions import traces

READING = "millis bigint, cpu_util_percent double, mem_util_percent double"
WINDOW = f"machine_id string, window bigint, readings array<struct<{READING}>>"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def cut(readings: list[tuple], watermark: int, size: int) -> tuple[list[list[tuple]], list[tuple]]:
    """(complete windows, readings to hold) of one machine; readings before the watermark are final."""
    readings = sorted(readings, key=_order)
    final = sum(r[0] < watermark for r in readings)
    whole = final - final % size
    return [readings[i:i + size] for i in range(0, whole, size)], readings[whole:]


def _order(reading: tuple) -> tuple:
    """By time, then value; no value comes first."""
    return reading[0], *[(v is not None, v if v is not None else 0.0) for v in reading[1:]]


def _plain(value: float) -> float | None:
    return None if pd.isna(value) else float(value)


class CountWindows(StatefulProcessor):
    """Windows of ``size`` readings of one machine; state is its held readings and window number."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", READING)
        self.number = handle.getValueState("number", "number bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        readings = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        for frame in rows:
            values = zip(frame["millis"], frame["cpu_util_percent"], frame["mem_util_percent"])
            readings += [(int(m), _plain(c), _plain(u)) for m, c, u in values]
        yield from self._emitted(key, readings, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        readings = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        yield from self._emitted(key, readings, timerValues.getCurrentWatermarkInMs())

    def _emitted(self, key, readings: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        windows, held = cut(readings, watermark, self.size)
        first = self.number.get()[0] if self.number.exists() else 0
        self.number.update((first + len(windows),))
        if held:
            self.held.put(held)
            waiting = [r[0] for r in held if r[0] >= watermark]
            if waiting:
                self.handle.registerTimer(min(waiting) + 1)     # always ahead of the watermark
        else:
            self.held.clear()
        if windows:
            names = [c.split()[0] for c in READING.split(", ")]
            yield pd.DataFrame({
                "machine_id": [key[0]] * len(windows), "window": range(first, first + len(windows)),
                "readings": [[dict(zip(names, r)) for r in w] for w in windows],
            })

    def close(self) -> None:
        pass


def machine_windows(usage: DataFrame, size: int = 5, lateness: str = "10 minutes") -> DataFrame:
    """(machine_id, window, sequence_ids, label) of a stream of readings; ``time_stamp`` in seconds.

    Windows tumble by machine and appear once the watermark has passed their last reading. Readings
    that come later than ``lateness`` are dropped, readings without a time or a machine as well.
    """
    timed = usage.where("time_stamp IS NOT NULL AND machine_id IS NOT NULL").select(
        "machine_id", F.timestamp_seconds("time_stamp").alias("event_time"),
        (F.col("time_stamp") * 1000).cast("bigint").alias("millis"),
        F.col("cpu_util_percent").cast("double"), F.col("mem_util_percent").cast("double"),
    ).withWatermark("event_time", lateness)
    windows = timed.groupBy("machine_id").transformWithStateInPandas(
        CountWindows(size), WINDOW, outputMode="append", timeMode="eventTime"
    )
    cpu, mem = (lambda r: traces.cpu_token(r["cpu_util_percent"])), (lambda r: traces.memory_token(r["mem_util_percent"]))
    last = F.element_at("readings", -1)
    return windows.select(
        "machine_id", "window",
        F.flatten(F.transform("readings", lambda r: F.array(cpu(r), mem(r)))).alias("sequence_ids"),
        traces.usage_label(cpu(last), mem(last)).alias("label"),
    )


def write_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished windows to a Parquet table until the input is used up; states are in RocksDB."""
    conf = windows.sparkSession.conf
    before = conf.get(STORE)
    conf.set(STORE, ROCKSDB)
    try:
        return (
            windows.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        conf.set(STORE, before)
