"""Ordering, quantiles, balancing and splitting, also with a key that holds most rows."""

import hashlib
import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsloom.operators import balance, ordering, selection, traces
from opsloom.operators.corpus import first_by_key


@pytest.fixture(scope="module")
def skewed(spark):
    """9000 rows; one key has two thirds of them, half of those are exact copies."""
    return spark.range(9000).select(
        F.when(F.col("id") < 6000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("v"),
    ).repartition(6)


def test_row_index_is_a_dense_order(skewed):
    rows = ordering.with_row_index(skewed, ["v", "k"]).orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(9000))
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)


def test_row_index_per_group(skewed):
    rows = ordering.with_row_index(skewed, ["v"], ["k"]).collect()
    hot = sorted(r["row_index"] for r in rows if r["k"] == "hot")
    assert hot == list(range(6000))
    assert all(r["row_index"] == 0 for r in rows if r["k"] != "hot")


def test_copies_are_spread_over_partitions(spark, skewed):
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, False)  # small test data would otherwise be merged into one
    try:
        placed = ordering._placed(skewed, ["k"])
        sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    finally:
        spark.conf.unset(option)
    assert len(sizes) > 4 and max(sizes) < 3000


def test_exact_quantiles_match_numpy(skewed):
    values = np.array([r["v"] for r in skewed.collect()], dtype=float)
    row = selection.exact_quantiles(skewed, ["v"], {
        "lin": (0.37, "linear"), "near": (0.37, "nearest"), "med": (0.5, "linear"),
        "top": (1.0, "nearest"), "low": (0.0, "linear"),
    }).collect()[0]
    assert row["lin"] == pytest.approx(np.quantile(values, 0.37))
    assert row["near"] == np.sort(values)[int(np.floor(0.37 * 8999 + 0.5))]
    assert row["med"] == np.median(values) and row["top"] == values.max()
    assert row["low"] == values.min() and row["n"] == 9000


def test_quantiles_per_group_leave_out_nulls(spark):
    frame = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0), (None, 7.0)], "g string, x double")
    out = {r["g"]: (r["n"], r["median"])
           for r in selection.exact_quantiles(frame, ["x"], by=["g"]).collect()}
    assert out == {"a": (2, 1.5), "b": (1, 5.0), None: (1, 7.0)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_quantiles_of_any_list(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x int")
    row = selection.exact_quantiles(frame, ["x"], {"m": (0.5, "linear")}).collect()[0]
    assert row["m"] == np.median(values)


def test_usage_windows_drop_the_remainder(spark):
    rows = [(t, "m", float(t * 10), 95.0 if t == 4 else 5.0) for t in range(7)]
    usage = spark.createDataFrame(
        rows, "time_stamp long, machine_id string, cpu_util_percent double, mem_util_percent double")
    out = traces.usage_windows(usage.repartition(3), 5).collect()
    assert len(out) == 1
    assert out[0]["sequence_ids"] == [100, 200, 101, 200, 102, 200, 103, 200, 104, 209]
    assert out[0]["label"] == 1


@pytest.mark.parametrize("status, cpu, mem, tokens, label", [
    ("Terminated", 25.0, 0.25, [102, 202, 300], 0), ("Terminated", 25.0, 0.75, [102, 207, 300], 1),
    ("Failed", 25.0, 0.25, [102, 202, 301], 2), ("Failed", 85.0, 0.25, [108, 202, 301], 4),
    ("Waiting", 25.0, 0.25, [102, 202, 302], 4), (None, 500.0, -1.0, [109, 200, 304], 0),
])
def test_task_sequences(spark, status, cpu, mem, tokens, label):
    tasks = spark.createDataFrame([(status, cpu, mem)],
                                  "status string, plan_cpu double, plan_mem double")
    row = traces.task_sequences(tasks).collect()[0]
    assert (row["sequence_ids"], row["label"]) == (tokens, label)


def labelled(spark, **sizes):
    rows = [(f"{label}-{i}", int(label[1:])) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "key string, label long")


def counts(frame):
    return {r["label"]: r["count"] for r in frame.groupBy("label").count().collect()}


def test_balance_sizes_are_exact(spark):
    out = balance.balance_classes(labelled(spark, l0=100, l1=5, l2=2, l4=4), "key")
    assert counts(out) == {0: 15, 1: 5, 2: 5, 4: 5}


def test_balance_is_independent_of_partitioning(spark):
    data = labelled(spark, l0=60, l1=7, l3=3)
    first = sorted(map(tuple, balance.balance_classes(data, "key").collect()))
    second = sorted(map(tuple, balance.balance_classes(data.repartition(5), "key").collect()))
    assert first == second


def test_balance_without_failures_returns_everything(spark):
    assert counts(balance.balance_classes(labelled(spark, l0=9), "key")) == {0: 9}


def test_repeat_rows_across_blocks(spark):
    frame = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1)], "k string, n long")
    out = balance.repeat_rows(frame, "n", block=3).collect()
    assert sorted(r["copy"] for r in out if r["k"] == "a") == list(range(7))
    assert [r["copy"] for r in out if r["k"] == "c"] == [0]
    assert not [r for r in out if r["k"] == "b"]


@pytest.mark.parametrize("n, ratio", [(100, 0.2), (37, 0.2), (10, 0.33), (1, 0.2)])
def test_split_sizes(spark, n, ratio):
    out = balance.train_test_split(spark.range(n), "id", ratio)
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes.get("train", 0) == int(n * (1 - ratio)) and sum(sizes.values()) == n


def test_split_with_one_hot_key_keeps_every_row(skewed):
    out = balance.train_test_split(skewed, "k", 0.2)
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 7200, "test": 1800}


def test_stratified_split(spark):
    frame = spark.range(100).withColumn("t", F.col("id") % 4)
    out = balance.train_test_split(frame, "id", 0.2, stratify_by=["t"])
    sizes = out.filter("split = 'train'").groupBy("t").count().collect()
    assert [r["count"] for r in sizes] == [20] * 4


def test_first_by_key_keeps_the_first_of_a_hot_key(skewed):
    out = {r["k"]: r["v"] for r in first_by_key(skewed, "k", ["v"]).collect()}
    assert len(out) == 3001 and out["hot"] == 1 and out["8000"] == 8000


def test_small_slices_grow_to_twice_their_rows(spark):
    rows = [(i, ["rare"] if i < 4 else ["common"], [], []) for i in range(40)]
    frame = spark.createDataFrame(rows, "question_id long, tags array<string>, "
                                        "error_signatures array<string>, infra_components array<string>")
    wanted = spark.createDataFrame(
        [("tag_rare", "data_augmentation", "high"), ("tag_common", "data_augmentation", "high"),
         ("tag_x", "data_augmentation", "low")], "slice string, strategy string, priority string")
    out = balance.oversample_slices(frame, wanted, "question_id")
    assert out.count() == 48 and out.filter("question_id < 4").count() == 12


def test_cap_keeps_about_the_ratio(spark):
    frame = spark.range(2000).select(
        "id", F.when(F.col("id") < 1600, "big").otherwise("small").alias("c"))
    kept = balance.cap_class_share(frame, "c", "id", 40.0).groupBy("c").count().collect()
    sizes = {r["c"]: r["count"] for r in kept}
    assert sizes["small"] == 400 and 720 <= sizes["big"] <= 880


def test_weights(spark):
    frame = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "quality_score double")
    assert sorted(r["sample_weight"] for r in balance.quality_weights(frame).collect()) == [
        0.5, 1.0, 1.5]
    same = spark.createDataFrame([(2.0,), (2.0,)], "quality_score double")
    assert {r["sample_weight"] for r in balance.quality_weights(same).collect()} == {1.0}


def plan_of(frame):
    frame.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return frame._jdf.queryExecution().executedPlan().toString()
    finally:
        frame.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def moved(frame):
    """Exchanges of the plan that are no broadcast."""
    return [line for line in plan_of(frame).splitlines() if "Exchange " in line and "BroadcastExchange" not in line]


def test_balancing_and_splitting_move_no_rows(spark):
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 100 == 0, F.col("id") % 3).otherwise(0).alias("label")
    )
    balanced = balance.balance_classes(rows, "id")
    assert moved(balanced) == [] and "Sort" not in plan_of(balanced)
    sizes = dict(balanced.groupBy("label").count().collect())
    had = dict(rows.groupBy("label").count().collect())
    largest = max(n for label, n in had.items() if label)
    assert sizes == {label: min(n, 3 * largest) if label == 0 else largest for label, n in had.items()}
    assert moved(balance.train_test_split(rows, "id", 0.2)) == []
    assert moved(balance.train_test_split(rows, "id", 0.2, stratify_by=["label"])) == []


def test_split_takes_the_first_hashes(spark):
    rows = spark.range(500).withColumn("k", F.col("id") % 7)
    out = balance.train_test_split(rows, "id", 0.3, 5, stratify_by=["k"]).collect()
    for k in range(7):
        order = sorted((hashlib.md5(f"{r['id']}:5".encode()).hexdigest(), r["split"]) for r in out if r["k"] == k)
        cut = int(len(order) * 0.7)
        assert [s for _, s in order] == ["train"] * cut + ["test"] * (len(order) - cut)


def test_copies_at_the_cut_are_dealt_exactly(spark):
    rows = spark.createDataFrame([("hot", i % 3) for i in range(3000)] + [("x", 5)] * 10, "k string, v int").repartition(4)
    for ratio in (0.2, 0.5, 0.9):
        out = balance.train_test_split(rows, "k", ratio)
        sizes = dict(out.groupBy("split").count().collect())
        assert sizes == {"train": int(3010 * (1 - ratio)), "test": 3010 - int(3010 * (1 - ratio))}
    again = [sorted(map(tuple, balance.train_test_split(rows.repartition(n), "k", 0.5).collect())) for n in (2, 7)]
    assert again[0] == again[1]


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf,
         -math.inf, 1.0, 0.9999999999999999, 1.0000000000000002, 8.0, 7.999999999999999, 0.1, 1e22, 2.0 ** -1000]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=200))
def test_image_keeps_bits_and_order(spark, values):
    values = [*values, *EDGES, *[2.0 ** e for e in range(-60, 60)], *[math.nextafter(2.0 ** e, 0) for e in range(-60, 60)]]
    frame = spark.createDataFrame([(v,) for v in values], "x double").withColumn("image", selection.order_image(F.col("x")))
    for x, image, back in frame.withColumn("back", selection.double_of(F.col("image"))).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert image == (-bits if x < 0 else bits) and back == x
    nan = spark.createDataFrame([(math.nan,)], "x double").select(selection.order_image(F.col("x"))).first()[0]
    assert nan > frame.agg(F.max("image")).first()[0]


def test_quantiles_neither_sort_nor_checkpoint(spark, monkeypatch):
    draw = np.random.default_rng(2)
    values = np.concatenate([draw.lognormal(0, 3, 9000), -draw.lognormal(0, 2, 4000), np.repeat(3.25, 9000)])
    frame = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(values)], "x double, g int")
    monkeypatch.setattr(type(frame), "checkpoint", None)
    monkeypatch.setattr(selection, "FEW", 50)
    for by in ([], ["g"]):
        out = selection.exact_quantiles(frame, ["x"], {
            "q1": (0.01, "linear"), "median": (0.5, "linear"), "q90": (0.9, "nearest"),
        }, by=by)
        assert "rangepartitioning" not in plan_of(out)
        for row in out.collect():
            own = np.sort(values[np.arange(len(values)) % 2 == row["g"]] if by else values)
            assert row["n"] == len(own) and row["median"] == np.median(own)
            assert row["q1"] == pytest.approx(np.quantile(own, 0.01), rel=1e-12)
            assert row["q90"] == own[int(np.floor(0.9 * (len(own) - 1) + 0.5))]


def test_weighted_quantiles(spark):
    frame = spark.createDataFrame([("a", 5, 3), ("a", 1, 1), ("a", 9, 10_000_000_000), ("b", 2, 1), ("b", 4, 1)], "g string, x int, w long")
    out = {r["g"]: (r["n"], r["median"]) for r in selection.exact_quantiles(frame, ["x"], by=["g"], weight="w").collect()}
    assert out == {"a": (10_000_000_004, 9.0), "b": (2, 3.0)}


def test_unknown_labels_pass_once(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([0, 0, 1, 1, 2, 9, None])], "k int, label int")
    out = balance.balance_classes(rows, "k")
    assert sorted(r["k"] for r in out.where("label = 9 or label is null").collect()) == [5, 6]


def test_stratified_split_is_exact_in_every_stratum(spark):
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") < 990, "most").when(F.col("id") < 997, "few").alias("kind")
    )
    out = balance.train_test_split(rows, "id", 0.2, stratify_by=["kind"])
    sizes = {(r["kind"], r["split"]): r["count"] for r in out.groupBy("kind", "split").count().collect()}
    assert sizes == {("most", "train"): 792, ("most", "test"): 198, ("few", "train"): 5, ("few", "test"): 2,
                     (None, "train"): 2, (None, "test"): 1}
