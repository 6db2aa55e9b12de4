"""Hard negatives against all pairs, in whole numbers of any size."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score double, rank int, tile string, key long"


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    found = [math.floor(256 * x) for x in vector]
    return found if sum(map(abs, found)) < 1 << 31 else None


def brute(rows, asked, positives=5, negatives=3, low=50, high=95):
    usable = [(n, whole(v), k) for n, v, k in rows if n is not None and k is not None and whole(v) is not None]
    out = []
    for name, vector, label in {(n, tuple(v), k) for n, v, k in usable if asked(n)}:
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, v)), n, k) for n, v, k in usable if n != name and len(v) == len(vector)
        )
        for minus, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(-s, n) for s, n, k in scored if k != label and low * -minus <= -100 * s <= high * -minus]
            out += [(name, positive, r, n, -minus, s) for r, (s, n) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def answers(frame):
    return sorted(tuple(r) for r in frame.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ).collect())


def search(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1.0, 2, "t", 3) for r in rows], SCHEMA).repartition(3)
    return answers(hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, **options))


def clusters(count, width, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width)) * 2
    which = draw.integers(0, 6, count)
    vectors = (centres[which] + draw.normal(size=(count, width))).round(3)
    labels = np.where(draw.random(count) < 0.4, draw.integers(0, 6, count), which)
    return [(i, v, int(k)) for i, (v, k) in enumerate(zip(vectors.tolist(), labels))]


@pytest.mark.parametrize("options", [{}, {"tile": 16, "leaf": 4, "block": 3, "page": 2}, {"tile": 64, "leaf": 8, "block": 7}])
def test_equals_all_pairs(spark, options):
    rows = clusters(500, 8, 1)
    assert search(spark, rows, **options) == brute(rows, lambda n: n % 10 == 0)


def test_awkward_rows(spark):
    rows = clusters(160, 4, 2)
    draw = random.Random(3)
    rows += [(1000 + i, [1.0, 0.5, 0.25, 2.0], i % 3) for i in range(150)]             # one vector half of the time
    rows += [(2000 + i, [draw.random() for _ in range(3)], i % 2) for i in range(30)]   # another length
    rows += [(3000, None, 1), (3010, [None, 1.0, 1.0, 1.0], 1), (3020, [math.nan] * 4, 1), (3030, [math.inf] * 4, 2)]
    rows += [(3040, [1.0] * 4, None), (None, [1.0] * 4, 1), (3050, [], 1), (3060, [], 2), (3070, [0.0] * 4, 2)]
    rows += [(0, rows[5][1], 1), (20, rows[20][1], rows[20][2]), (20, rows[20][1], rows[20][2]), (21, rows[21][1], rows[21][2])]
    rows += [(-50 + i, [-1.0, -0.5, 0.0, 0.0], i % 4) for i in range(20)]
    rows = [r for r in rows if r[0] != 0]
    want = brute(rows, lambda n: n % 10 == 0)
    assert search(spark, rows, tile=32, leaf=8, block=5) == want


def test_large_numbers_stay_exact(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([1, 1.5, -1]) * draw.choice([2e6, 1e6 + i / 7, 3.0]) for _ in range(3)], i % 3) for i in range(90)]
    rows += [(90, [1e300, 1.0, 1.0], 1), (91, [8388608.0, 0.0, 0.0], 1)]     # too large
    assert search(spark, rows, tile=16, leaf=4) == brute(rows, lambda n: n % 10 == 0)


def test_few_rows_and_none(spark):
    assert search(spark, []) == []
    assert search(spark, [(10, [1.0], 1)]) == []
    assert search(spark, [(10, [1.0], 1), (11, [1.0], 1), (12, [0.9], 2)]) == [(10, 11, 1, 12, 65536, 58880)]


def test_boxes_prune_tiles_and_leaves():
    draw = np.random.default_rng(1)
    rows = np.concatenate([draw.integers(-9, 9, (256, 4)) + 1000 * np.eye(4, dtype=int)[i % 4] for i in range(8)]).astype(np.int32)
    order = hard_negatives.str_order(rows, 32)
    rows = rows[order]
    cuts = np.arange(0, len(rows), 32)
    ids = np.arange(len(rows), dtype=np.int64)
    tile = {
        "ids": ids.tobytes(), "labels": np.zeros(len(rows), dtype=np.int64).tobytes(), "rows": rows.tobytes(),
        "leaf_low": np.minimum.reduceat(rows, cuts).tobytes(), "leaf_high": np.maximum.reduceat(rows, cuts).tobytes(),
    }
    window = {"slot": 0, "low": hard_negatives.NONE, "high": 1 << 60, "floor": hard_negatives.NONE}
    block = hard_negatives.Block([{"id": -1, "key": 0, "label": 0, "vector": [1, 0, 0, 0], "windows": [window]}])
    seen, plain = [], hard_negatives.product

    def counted(left, right):
        seen.append(len(right))
        return plain(left, right)

    hard_negatives.product = counted
    try:
        _, found, score = hard_negatives.search_tile(tile, block, np.array([0]), True, 5, 32)
    finally:
        hard_negatives.product = plain
    want = sorted(zip((-rows[:, 0]).tolist(), ids.tolist()))[:5]
    assert list(zip((-score).tolist(), found.tolist())) == want
    assert sum(seen[4:]) <= len(rows) // 3       # the first four products are the bounds
