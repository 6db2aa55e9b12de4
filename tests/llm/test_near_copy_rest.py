"""Near copies: what large groups leave after their centres is compared as well, and nothing is lost."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.llm import near_copies

from test_near_copies import brute, family, least_ids, shingles


def grouped(spark, texts, **more):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return least_ids(near_copies.near_copies(docs, **more).collect())


def cuts(count, seed):
    """The beginnings of one text, of 200 to 1,000 words: no member is similar to most others."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(3000)}" for _ in range(1000)]
    return {i: " ".join(words[:draw.randint(200, 1000)]) for i in range(count)}


def bridges(seed):
    """Many texts similar to none, and pairs among them that no third text is similar to."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(2000)}" for _ in range(200)]
    texts = []
    for _ in range(150):
        own = list(words)
        for at in draw.sample(range(200), 8):
            own[at] = f"x{draw.randrange(100_000)}"
        other = list(own)
        for at in draw.sample(range(200), 3):
            other[at] = f"y{draw.randrange(100_000)}"
        texts += [" ".join(own), " ".join(other)]
    draw.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("texts", [
    family(2000, 10, 3), family(600, 12, 4), cuts(150, 1), bridges(2), bridges(3),
], ids=["family", "wide family", "cuts", "bridges", "more bridges"])
def test_large_groups_lose_no_link(spark, texts):
    assert grouped(spark, texts) == brute(texts)


def test_few_hubs_lose_no_link(spark, monkeypatch):
    """With one hub and values crowded from three members on, the third round finds what is left."""
    monkeypatch.setattr(near_copies, "HUBS", 1)
    texts = bridges(5) | {1000 + k: v for k, v in cuts(60, 6).items()}
    assert grouped(spark, texts, crowd=2) == brute(texts)


def sets_frame(spark, sets):
    rows = [(node, np.sort(np.array(list(s), dtype="<u8")).tobytes(), len(s)) for node, s in sets.items()]
    rows = [(n, bytearray(b), size, bytearray(near_copies.counts_of(np.frombuffer(b, "<u8")))) for n, b, size in rows]
    return spark.createDataFrame(rows, "node long, shingles binary, size long, counts binary")


@pytest.mark.parametrize("part", [3, 1 << 14])
@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_no_similar_pair_is_filtered(spark, monkeypatch, similarity, part):
    """Also where a shingle's members are dealt to several tasks."""
    monkeypatch.setattr(near_copies, "SLICE", part)
    monkeypatch.setattr(near_copies, "TILE", 4)
    draw = random.Random(part)
    sets = {}
    for base in range(6):
        own = draw.sample(range(1 << 62), draw.choice([5, 40, 200]))
        for i in range(25):
            kept = draw.sample(own, max(1, int(len(own) * draw.uniform(0.6, 1))))
            sets[100 * base + i] = set(kept) | {draw.randrange(1 << 62) for _ in range(draw.choice([0, 0, 1, 4, 30]))}
    left = spark.createDataFrame([(n, n if n % 7 else n // 100 * 100) for n in sets], "node long, root long")
    root = {r["node"]: r["root"] for r in left.collect()}
    rows = near_copies.met_on(near_copies.rare_shingles(sets_frame(spark, sets), left, similarity), similarity).collect()
    met = {(r["left"], r["right"]) for r in rows}
    assert len(met) == len(rows) and all((root[a], root[b]) in ((r["low"], r["high"]), (r["high"], r["low"])) for r in rows
                                         for a, b in [(r["left"], r["right"])])
    want = {
        (a, b) for a in sets for b in sets
        if a < b and root[a] != root[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    }
    every = sum(root[a] != root[b] for a in sets for b in sets if a < b)
    assert want and want <= met and len(met) < every / 3


def test_many_pairs_a_group_are_settled_by_few(spark, monkeypatch):
    """Beginnings of one text: after the best pair of each group most others are within one group."""
    texts = cuts(120, 4)
    sets = {n: {near_copies.mixed(np.array([hash(x) & (1 << 62) - 1], dtype=np.uint64))[0] for x in shingles(t)}
            for n, t in texts.items()}
    frame = sets_frame(spark, sets)
    left = spark.createDataFrame([(n, n) for n in sets], "node long, root long")
    waiting = near_copies.met_on(near_copies.rare_shingles(frame, left, 0.8), 0.8)
    joined, real = [], near_copies.verified

    def counted(pairs, sets, similarity):
        joined.append(pairs.count())
        return real(pairs, sets, similarity)

    monkeypatch.setattr(near_copies, "verified", counted)
    links = near_copies.linked(waiting, frame, 0.8)
    got = near_copies.components(links).groupBy("root").agg(F.collect_set("node").alias("all")).collect()
    want = {}
    for node, least in brute(texts).items():
        want.setdefault(least, set()).add(node)
    assert {frozenset(r["all"]) for r in got} == {frozenset(g) for g in want.values() if len(g) > 1}
    assert len(joined) > 1 and sum(joined) < waiting.count() / 3
