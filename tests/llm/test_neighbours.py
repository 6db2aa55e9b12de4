"""Nearest neighbours against brute force."""

import math

import llm_data
import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.llm import neighbours, queries


def brute(names, vectors, asked, nearest=10):
    out = {}
    for name in asked:
        own = vectors[names.index(name)]
        rows = sorted(
            (math.sqrt(sum((a - b) ** 2 for a, b in zip(own, v))), n)
            for n, v in zip(names, vectors) if n != name
        )
        out[name] = rows[:nearest]
    return out


def answers(frame):
    out = {}
    for row in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(row["query_id"], []).append((row["score"], row["vec_id"]))
        assert row["rank"] == len(out[row["query_id"]])
    return out


def recall(got, want):
    hits = [len({n for _, n in got.get(q, [])} & {n for _, n in rows}) for q, rows in want.items()]
    return sum(hits) / sum(map(len, want.values()))


@pytest.mark.parametrize("folder", [llm_data.SMALL, "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    names = [r["vec_id"] for r in rows]
    vectors = [list(r["embedding"]) for r in rows]
    want = brute(names, vectors, [n for n in names if n % 100 == 0])
    got = answers(queries.queries()["op1_nearest_vectors"](spark, folder))
    assert recall(got, want) >= 0.9
    place = dict(zip(names, vectors))
    for asked, found in got.items():
        assert len(found) == 10 and found == sorted(found)
        for score, name in found:
            assert math.isclose(score, math.dist(place[asked], place[name]), rel_tol=1e-12)


def clusters(count=400, width=12, seed=2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, width)) * 4
    return (centres[draw.integers(0, 8, count)] + draw.normal(size=(count, width))).tolist()


def test_ties_copies_and_unusable_rows(spark):
    vectors = clusters()
    vectors[50:90] = [vectors[0]] * 40                      # one vector many times
    rows = list(enumerate(vectors)) + [
        (1000, None), (1001, [0.0] * 12), (1002, [None] + [1.0] * 11), (1003, [math.nan] * 12),
        (1004, [math.inf] + [1.0] * 11), (1005, [1.0, 2.0]), (None, vectors[3]), (1006, []),
    ]
    frame = spark.createDataFrame(
        [(n, v, "x", 1.0) for n, v in rows], "vec_id long, embedding array<double>, slot string, score double"
    )
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, block=64, query_block=7)
    names = list(range(400))
    want = brute(names, vectors, range(0, 400, 20))
    got = answers(found)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
    for asked in (0, 60, 80):
        copies = [n for n in [0, *range(50, 90)] if n != asked][:10]
        assert got[asked] == [(0.0, n) for n in copies]


def test_odd_lengths_and_repeated_queries(spark):
    vectors = clusters(300, 8)
    for odd in range(300):                       # every vector in turn could lead the sample
        if odd % 60 == 0:
            rows = [(n, v[:3] if n == odd else v) for n, v in enumerate(vectors)]
            rows += [(7, vectors[9]), (20, vectors[11]), (20, [9.0] * 8)]
            frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
            got = answers(neighbours.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, nearest=5))
            assert set(got) == {n for n in range(0, 300, 20) if n != odd}
            least = min(v for n, v in rows if n == 20 and len(v) == 8)
            want = sorted((math.dist(least, v), n) for n, v in rows if n != 20 and len(v) == 8)[:5]
            if odd != 20:
                assert len({n for _, n in got[20]} & {n for _, n in want}) >= 4


def test_few_rows_and_none(spark):
    frame = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest_neighbours(frame, F.col("vec_id") < 2))
    assert got == {0: [(1.0, 1), (2.0, 2), (3.0, 3)], 1: [(1.0, 0), (1.0, 2), (2.0, 3)]}
    assert neighbours.nearest_neighbours(frame.where("false"), F.lit(True)).collect() == []
    assert neighbours.nearest_neighbours(frame, F.lit(False)).collect() == []
    alone = frame.limit(1)
    assert neighbours.nearest_neighbours(alone, F.lit(True)).collect() == []


def test_probing_finds_every_code_within_the_radius():
    codes = np.random.default_rng(1).integers(0, 256, (3000, 4), dtype=np.uint8)
    index = neighbours.SubstringIndex(codes)
    for radius in (0, 3, 7, 12, 32):
        for code in codes[:20]:
            want = np.flatnonzero(neighbours.hamming(codes, code) <= radius)
            assert index.within(code, radius).tolist() == want.tolist()
