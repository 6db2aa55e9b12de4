"""The near-copy stage links by SimHash: fingerprints at most two bits apart, verified."""

import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.llm import near_copies, simhash
from opsloom.llm.simhash import majority


def pairs_of_texts():
    """Texts with even numbers, each with a copy that has one other word."""
    draw = random.Random(4)
    out = []
    for _ in range(8):
        words = [f"w{draw.randrange(50_000)}" for _ in range(4000)]
        out.append(" ".join(words))
        words[draw.randrange(4000)] = "x"
        out.append(" ".join(words))
    return out


def fingerprint(text):
    return int(majority(near_copies.shingle_set(text.encode(), 5, 42)))


@pytest.fixture
def no_shared_band(monkeypatch):
    real = near_copies.signatures
    monkeypatch.setattr(near_copies, "signatures", lambda *a: real(*a).withColumn("bands", F.array("node")))


def test_stage_links_by_simhash_alone(spark, no_shared_band):
    texts = pairs_of_texts()
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = [(fingerprint(texts[i]) ^ fingerprint(texts[i + 1])).bit_count() <= 2 for i in range(0, 16, 2)]
    assert sum(near) >= 4
    left = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert left == {i for i in range(16) if i % 2 == 0 or not near[i // 2]}


def test_simhash_links_are_verified(spark, no_shared_band):
    """Sets without a common shingle whose fingerprints are equal, two bits and three bits apart."""
    base = 0x0123456789ABCDEF
    prints = [base, base, base ^ 3, base ^ 7 << 20]
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, fingerprint long")
    pairs = sorted(map(tuple, near_copies.simhash_pairs(nodes).collect()))
    assert pairs == [(0, 1), (0, 2)]
    none = spark.createDataFrame([(i, np.arange(i * 9, i * 9 + 9, dtype="<u8").tobytes()) for i in range(4)],
                                 "node long, shingles binary")
    assert near_copies.verified(spark.createDataFrame(pairs, "left long, right long"), none, 0.8).count() == 0


def test_fingerprint_of_a_set_is_that_of_the_operator():
    hashes = np.array(simhash.shingle_hashes(b"a b c d e f", 3, 42), dtype="<u8")
    votes = [sum(int(h) >> bit & 1 for h in hashes) for bit in range(64)]
    assert int(majority(hashes)) == sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(hashes))
    assert int(majority(hashes[:0])) == 0
