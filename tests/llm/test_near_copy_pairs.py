"""Near copies: few pairs are joined to their shingle sets, and none of those left out is similar."""

import random

import numpy as np
import pytest

from opsloom.llm import near_copies

from test_near_copies import brute, family, least_ids


@pytest.fixture
def joined(monkeypatch):
    """How many pairs each round joins to shingle sets."""
    counts, real = [], near_copies.verified

    def counted(pairs, sets, similarity):
        counts.append(pairs.count())
        return real(pairs, sets, similarity)

    monkeypatch.setattr(near_copies, "verified", counted)
    return counts


def test_pairs_of_a_large_family_grow_with_its_members(spark, joined):
    """One to ten changed words of 200: most members share band values with many they are not similar to."""
    for count in (400, 800):
        docs = spark.createDataFrame(list(family(count, 10, 6).items()), "doc_id long, text string")
        near_copies.near_copies(docs).collect()
    first, second = sum(joined[:2]), sum(joined[2:])
    assert first <= 8 * 400 and second <= 2.5 * first


def test_second_round_joins_groups_of_the_first(spark, monkeypatch):
    """With a leader that is similar to few, links of the second round join what the first left apart."""
    texts = family(60, 6, 9)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rounds, real = [], near_copies.verified

    def first_loses(pairs, sets, similarity):
        rounds.append(pairs.columns)
        found = real(pairs, sets, similarity)
        return found.where("left % 3 = 0") if len(rounds) == 1 else found

    monkeypatch.setattr(near_copies, "verified", first_loses)
    assert least_ids(near_copies.near_copies(docs, crowd=100).collect()) == brute(texts)
    assert rounds == [["left", "right"], ["left", "right", "low", "high"]]


@pytest.mark.parametrize("size", [1, 9, 40, 300, 5000])
def test_no_similar_pair_is_left_out(spark, size):
    draw = np.random.default_rng(size)
    rows, similar = [], set()
    for at in range(120):
        one = np.unique(draw.integers(0, 1 << 64, size, dtype=np.uint64))
        kept = one[draw.random(len(one)) < draw.choice([0.7, 0.85, 0.92, 1.0])]
        other = np.unique(np.concatenate([
            kept, draw.integers(0, 1 << 64, int(size * draw.choice([0, 0.05, 0.1, 0.3])), dtype=np.uint64)
        ]))
        common = len(np.intersect1d(one, other))
        if common >= 0.8 * (len(one) + len(other) - common):
            similar.add((2 * at, 2 * at + 1))
        rows.append(tuple(
            (2 * at + end, 2 * at + end, len(s), bytearray(near_copies.counts_of(s))) for end, s in enumerate((one, other))
        ))
    member = "struct<node: bigint, root: bigint, size: bigint, counts: binary>"
    pairs = spark.createDataFrame(rows, f"one {member}, other {member}")
    left = {(r["left"], r["right"]) for r in near_copies.possible(pairs, 0.8).collect()}
    assert similar and similar <= left
    assert size not in (40, 300) or len(left) < 120


def test_counts_of_no_and_of_many_hashes():
    assert near_copies.counts_of(np.zeros(0, dtype=np.uint64)).tolist() == [0] * 256
    counts = near_copies.counts_of(np.arange(1000, dtype=np.uint64) | np.uint64(7 << 56))
    assert counts[7] == 255 and counts.sum() == 255
