"""Overlapping notices against a plain comparison of all pairs; repeated ids in the toxicity fit."""

import random
import time

from opsloom.llm import licenses, toxicity


def plain(found, sizes):
    out = []
    for hit in sorted(found, key=lambda h: (-round(h[1] * sizes[h[0]]), -h[1], h[0], h[2:])):
        def shared(other):
            return 2 * (min(other[3], hit[3]) - max(other[2], hit[2]))
        if all(o[0] == hit[0] or shared(o) <= max(o[3] - o[2], hit[3] - hit[2]) for o in out):
            out.append(hit)
    return out


def test_closest_equals_all_pairs():
    draw = random.Random(5)
    sizes = {"a": 5, "b": 20, "c": 60}
    for _ in range(300):
        found = []
        for _ in range(draw.randrange(30)):
            start = draw.randrange(60)
            found.append((draw.choice("abc"), draw.choice([0.8, 0.9, 1.0]), start, start + draw.randrange(1, 50)))
        assert sorted(licenses.closest(found, sizes)) == sorted(plain(found, sizes))


def test_many_notices_in_one_text():
    found = [("a", 1.0, 40 * i, 40 * i + 30) for i in range(40_000)]
    start = time.perf_counter()
    assert len(licenses.closest(found, {"a": 5})) == len(found)
    assert time.perf_counter() - start < 5


def test_repeated_ids_bring_one_row_each(spark):
    rows = [(i, f"you are a stupid {i}" if i % 2 else f"a calm and pleasant day {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows * 30, "doc_id long, text string")
    first, second = (toxicity.fit_toxicity(d, labels) for d in (once, often))
    assert first == second
    # texts that differ under one id: the same one is used on each run
    mixed = spark.createDataFrame(rows + [(i, f"other words {i}") for i, _ in rows], "doc_id long, text string")
    assert toxicity.fit_toxicity(mixed, labels) == toxicity.fit_toxicity(mixed.repartition(7), labels)
