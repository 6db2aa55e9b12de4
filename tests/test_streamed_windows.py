"""Streamed count windows against the batch operator, late readings, and several batches."""

import random

import pytest

from opsloom.operators import traces as batch
from opsloom.streaming import traces

SCHEMA = "time_stamp bigint, machine_id string, cpu_util_percent double, mem_util_percent double"


def run(spark, tmp_path, rows, name="run", size=3, lateness="0 seconds"):
    """One more batch of an input folder; all windows so far."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    windows = traces.machine_windows(stream, size, lateness)
    traces.write_windows(windows, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / name)).collect()
    return {(r["machine_id"], r["window"]): (list(r["sequence_ids"]), r["label"]) for r in found}


def expected(spark, rows, size=3):
    frame = batch.usage_windows(spark.createDataFrame(rows, SCHEMA), size, ["machine_id"])
    return {(r["machine_id"], r["window"]): (list(r["sequence_ids"]), r["label"]) for r in frame.collect()}


def test_batches_in_any_order_equal_the_batch_operator(spark, tmp_path):
    rng = random.Random(3)
    rows = [
        (t, f"m{rng.randrange(4)}", rng.choice([None, 95.0, rng.uniform(0, 100)]), rng.uniform(0, 100))
        for t in rng.sample(range(1000), 200)
    ]
    end = [(5000, "m9", 1.0, 1.0)]
    run(spark, tmp_path, rows[:90], lateness="1000 seconds")
    run(spark, tmp_path, rows[90:], lateness="1000 seconds")
    found = run(spark, tmp_path, end, lateness="1000 seconds")
    assert found == expected(spark, rows)
    assert len(found) > 60


def test_late_readings_are_dropped_and_open_windows_kept(spark, tmp_path):
    first = [(t, "a", float(t), 0.0) for t in (10, 20, 30, 40, 50)]
    assert set(run(spark, tmp_path, first)) == {("a", 0)}          # 50 is not passed yet
    late = [(15, "a", 99.0, 99.0), (60, "a", 60.0, 0.0), (70, "a", 70.0, 0.0)]
    found = run(spark, tmp_path, late)
    assert found == expected(spark, [r for r in first + late if r[0] != 15 and r[0] < 70])
    assert set(found) == {("a", 0), ("a", 1)}


def test_empty_and_null_readings(spark, tmp_path):
    assert run(spark, tmp_path, [(None, "a", 1.0, 1.0), (5, None, 1.0, 1.0)]) == {}


@pytest.mark.parametrize("n", [0, 1, 3, 7])
def test_cut(n):
    readings = [(t, None if t % 2 else 1.0, 2.0) for t in range(n)]
    windows, held = traces.cut(readings[::-1], 5, 3)
    assert [r for w in windows for r in w] + held == readings
    assert len(windows) == min(n, 5) // 3
