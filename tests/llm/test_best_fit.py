"""Minimum bin slack against enumeration, and packed ids against the tokenizer library."""

import random
import zlib
from collections import Counter

import llm_data
import numpy as np
import public_tokenizers
import pytest

from opsloom.llm import best_fit, queries

WORDS = "word_bpe_49k.json"


def best_fill(lengths, window):
    """The largest sum of some of the lengths that is not above the window, one by one."""
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= window}
    return max(sums)


@pytest.mark.parametrize("seed", range(12))
def test_every_sequence_is_the_fullest(seed):
    draw = random.Random(seed)
    window = draw.choice([7, 16, 30, 61])
    lengths = [draw.choice([draw.randint(1, window - 1), 1 + window // 3]) for _ in range(draw.randint(1, 60))]
    left = Counter(lengths)
    for repeats, taken in best_fit.plan(Counter(lengths), window):
        for _ in range(repeats):
            assert sum(n * c for n, c in taken) == best_fill(left.elements(), window)
            left.subtract(dict(taken))
            assert min(left.values()) >= 0
    assert not +left
    left = Counter(lengths)
    for repeats, taken in best_fit.plan(left, window, best_fit.with_largest):
        for _ in range(repeats):
            largest = max((+left).elements())
            left.subtract([largest])
            rest = best_fill((n for n in left.elements()), window - largest)
            assert sum(n * c for n, c in taken) == largest + rest and largest in dict(taken)
            left.subtract(dict(taken))
            left.update([largest])
    assert not +left


def test_fewer_sequences_where_large_pieces_need_small_ones():
    draw = random.Random(4)
    counts = {n: draw.randint(1, 1000) for n in range(1, 200)}
    plain = best_fit.plan(counts, 200)
    better = best_fit.fewest(counts, 200)
    assert sum(r for r, _ in better) < sum(r for r, _ in plain)


def test_places_are_dealt_once():
    draw = random.Random(1)
    counts = Counter(draw.randint(1, 99) for _ in range(5000)) + Counter({1: 4000, 34: 2000})
    planned = best_fit.plan(counts, 100)
    slots = best_fit.Slots.of(planned)
    filled = {}
    for length, count in counts.items():
        sequence, offset = slots.find(np.full(count, length), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            filled.setdefault(s, []).append((o, length))
    assert sorted(filled) == list(range(slots.sequences)) and slots.sequences == sum(r for r, _ in planned)
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 100


def checked(rows, docs, window, end_id):
    """All invariants of a packing; ``docs`` are (id, text) pairs."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(WORDS))
    want = Counter()
    for name, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        for start in range(0, len(ids), window):
            part = np.array(ids[start:start + window], dtype="<u4")
            want[name, start // window, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    left = Counter(r["length"] for r in rows if r["length"] < window)
    fills = sorted(sum(n for _, n in pieces) for pieces in bins.values())
    planned = [n for k, taken in best_fit.fewest(left, window) for n in [sum(a * b for a, b in taken)] * k]
    assert fills == sorted([window] * sum(r["length"] == window for r in rows) + planned)


def test_the_query(spark):
    docs = spark.read.parquet(f"{llm_data.SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.queries()["op12_best_fit"](spark, llm_data.SMALL).collect()
    checked(rows, [tuple(d) for d in docs], 4096, 1)


@pytest.mark.parametrize("window", [5, 64])
def test_awkward_rows_and_small_windows(spark, window):
    import pyspark.sql.functions as F

    texts = [*llm_data.awkward(), *["same text again"] * 50]
    frame = llm_data.documents(spark, texts, 5)
    found = best_fit.best_fit_packing(frame, public_tokenizers.path(WORDS), window=window, end_id=9)
    rows = found.withColumn("ids_crc32", F.crc32("ids")).collect()
    checked(rows, [*enumerate(texts), (None, "no id")], window, 9)


def test_empty_table(spark):
    frame = llm_data.documents(spark, ["x"]).where("false")
    assert best_fit.best_fit_packing(frame, public_tokenizers.path(WORDS)).collect() == []
