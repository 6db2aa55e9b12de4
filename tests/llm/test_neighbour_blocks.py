"""Nearest neighbours: what reaches the driver and the disk, and blocks against a plain search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.llm import neighbours


def table(spark, count=1200, partitions=40):
    draw = np.random.default_rng(3)
    rows = [(n % 1000, v) for n, v in enumerate(draw.normal(size=(count, 8)).tolist())]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(partitions)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_driver_gets_the_sample_and_not_one_of_each_partition(spark, monkeypatch):
    """A sorted limit that the driver collects sends it that many rows of every partition."""
    frame = table(spark)
    plans, rows, kind = [], [], type(frame)
    real_pandas, real_collect = kind.toPandas, kind.collect

    def to_pandas(self):
        plans.append(plan(self))
        out = real_pandas(self)
        rows.append(len(out))
        return out

    def collect(self):
        out = real_collect(self)
        rows.append(len(out))
        return out

    monkeypatch.setattr(kind, "toPandas", to_pandas)
    monkeypatch.setattr(kind, "collect", collect)
    neighbours.nearest_neighbours(frame, F.col("vec_id") % 50 == 0, sample=100)
    assert plans and not any("vector" in p and "TakeOrdered" in p for p in plans)
    assert max(rows) <= 1 << neighbours.PREFIX


@pytest.mark.parametrize("sample", [1, 100, 1200, 5000])
def test_sample_has_the_rows_whose_ids_hash_lowest(spark, sample):
    frame = table(spark).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    hashed = F.xxhash64("id")
    counts = frame.groupBy(neighbours.prefix_of(hashed).alias("prefix")).agg(F.count("*").alias("n"))
    got = neighbours.lowest(frame, counts, sample).collect()
    rows = frame.withColumn("hash", hashed).collect()
    want = sorted(rows, key=lambda r: (r["hash"], r["id"], r["vector"]))[:sample]
    assert sorted(r["vector"] for r in got) == sorted(r["vector"] for r in want)


def test_pairs_of_blocks_are_not_shuffled(spark):
    found = neighbours.nearest_neighbours(table(spark), F.col("vec_id") % 3 == 0, block=64, query_block=16)
    assert "CartesianProduct" in plan(found) and "SortMergeJoin" not in plan(found)
    assert found.count() == 334 * 10


def plain(blocks, asked, model, nearest):
    """The nearest rows of each block, whose radius grows for itself, merged."""
    out = {}
    for name, vector in asked:
        code, met = model.codes(vector[None])[0], []
        for names, vectors in blocks:
            far, radius = neighbours.hamming(model.codes(vectors), code), model.radius
            while True:
                rows = np.flatnonzero((far <= radius) & (names != name))
                if len(rows) >= nearest or radius >= 64:
                    break
                radius += 2
            with np.errstate(over="ignore"):
                score = np.sqrt(((vectors[rows] - vector) ** 2).sum(axis=1))
            met += sorted(zip(score.tolist(), names[rows].tolist()))[:nearest]
        out[name] = sorted(met)[:nearest]
    return out


@pytest.mark.parametrize("kind", ["even", "clusters", "far off", "huge", "tiny", "copies", "wide", "few"])
def test_blocks_against_a_plain_search(kind):
    draw = np.random.default_rng(7)
    width = {"wide": 100}.get(kind, 24)
    vectors = draw.normal(size=(900, width))
    if kind == "clusters":
        vectors = draw.normal(size=(9, width))[draw.integers(0, 9, 900)] * 9 + vectors * 0.05
    vectors = {"far off": vectors + 1e8, "huge": vectors * 1e160, "tiny": vectors * 1e-170}.get(kind, vectors)
    if kind == "copies":
        vectors[100:700] = vectors[5]
    names = np.arange(900) % 800                     # some ids twice
    model = neighbours.learn(vectors[:500] if kind != "huge" else vectors[:500] / 1e160, 64, 5, 10, 0.98)
    step = 6 if kind == "few" else 200
    blocks = [(names[a:a + step], vectors[a:a + step]) for a in range(0, 900 if step > 6 else 30, step)]
    asked = neighbours.Asked(names[:90], vectors[:90], model.codes(vectors[:90]), 10)
    with np.errstate(all="ignore"):
        for own_names, own in blocks:
            asked.meet(neighbours.StoredBlock(own_names, own, model.codes(own), model.centre), model)
    rows, got = asked.rows().to_pydict(), {}
    for name, found, score in zip(*rows.values()):
        got.setdefault(name, []).append((score, found))
    assert got == plain(blocks, list(zip(names[:90].tolist(), vectors[:90])), model, 10)
    assert all(math.isfinite(s) for v in got.values() for s, _ in v) or kind == "huge"
