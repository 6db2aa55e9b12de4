"""Encoding for packing takes memory by the slice, not by the batch."""

import tracemalloc

import llm_data
import numpy as np
import public_tokenizers
import pyarrow as pa

from opsloom.llm import common, packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_memory_of_encoding_a_large_batch():
    with open(WORDS, "rb") as file:
        words = packing.WordIds(file.read(), 400_000)
    text = " ".join(f"word{i % 977} and" for i in range(200))
    batch = pa.record_batch({"id": list(range(3000)), "text": [text] * 3000})
    assert batch.column("text").nbytes > 6_000_000
    common.released()
    tracemalloc.start()
    n = sum(rows.num_rows for rows in packing.id_rows([batch], words, 0, b"\2\0\0\0"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    common.released()
    assert n == 3000
    assert peak < 60 << 20, peak


def test_words_are_remembered_in_order():
    memory = common.SpanMemory(lambda word: list(word), 10_000)
    for text in llm_data.noise(300, seed=7):
        blob = text.encode()
        data = np.frombuffer(blob, dtype=np.uint8)
        begins, ends = common.edges_of(data != 32)
        ids, sizes = memory.ids(blob, begins, ends)
        assert bytes(ids.astype(np.uint8)) == blob.replace(b" ", b"")
        assert (sizes == ends - begins).all()
        assert (memory.hashes[1:] >= memory.hashes[:-1]).all()


def test_workers_give_back_what_arrow_keeps(monkeypatch):
    """At the end of a task the tables and Arrow's freed buffers go back."""
    calls = []
    pool = type("Pool", (), {"release_unused": lambda self: calls.append(1)})
    monkeypatch.setattr(common.pa, "default_memory_pool", pool)
    common.powers(common._ROOTS[0], 10)
    common.released()
    assert calls == [1] and not common._TABLES
