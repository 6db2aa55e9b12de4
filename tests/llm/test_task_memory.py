"""At the end of a task nothing is held, and texts reach Python's objects by the slice."""

import llm_data
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsloom.llm import common, passages, secrets, toxicity

MODEL = toxicity.ToxicityModel(-1.0, {f: 0.7 for f in toxicity.features_of("apple")})


class Rows:
    """Stands for a table; gives back the function that its rows would go through."""

    def mapInArrow(self, run, schema):
        return run

    def select(self, *columns):
        return self


STEPS = {
    "anchors": lambda: passages.find_anchors(Rows(), 100, 32),
    "contexts": lambda: passages.contexts(Rows(), 100, 32),
    "windows": lambda: passages.windows_of(Rows(), 100, 32),
}


@pytest.mark.parametrize("step", sorted(STEPS))
def test_the_last_batch_is_free_when_memory_goes_back(monkeypatch, step):
    real, held = pa.default_memory_pool(), []
    pool = type("Pool", (), {"release_unused": lambda self: held.append(real.bytes_allocated())})
    monkeypatch.setattr(common.pa, "default_memory_pool", pool)
    run = STEPS[step]()
    before = real.bytes_allocated()

    def batches():
        text = b"".join(np.random.default_rng(7).bytes(1000) for _ in range(200))
        yield pa.record_batch({
            "id": pa.array([1, 2], pa.int64()), "tag": pa.array([0, 0], pa.int32()),
            "text": pa.array([text, text[::-1]], pa.binary()),
            "found": pa.array([[{"place": 500, "gram": 9}]] * 2),
        })

    for rows in run(batches()):
        assert rows.num_rows
        del rows
    assert len(held) == 1 and held[0] - before < 100_000, held


def test_texts_come_in_slices():
    batch = pa.array([None, "é" * 1_500_000, "", "b" * 1_500_000, "c", None])
    parts = list(common.text_slices(iter([batch, pa.array([], pa.string())])))
    assert pa.concat_arrays(parts).equals(batch)
    assert [len(part) for part in parts] == [1, 1, 4]


def test_scores_and_masks_of_texts_beyond_a_slice(spark):
    long = "pear " * 500_000
    texts = [None, "apple", long, "", long + "apple", "token=abcdefgh1 " + long, "token=abcdefgh1", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)
    found = rows.select(
        "n", toxicity.toxicity_score(F.col("text"), MODEL).alias("score"), secrets.mask_secrets(F.col("text")).alias("masked")
    ).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.n]
        assert row.score == MODEL.score((text or "").split(), {})
        assert row.masked == (None if text is None else text.replace("token=abcdefgh1", "[assign]"))


def test_features_of_labelled_texts_are_as_in_one_piece(spark):
    texts = [f"{t} she is fine. apple {i % 3}" for i, t in enumerate(llm_data.noise(40, seed=5))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(40)], "doc_id long, toxic int")
    found = toxicity.fit_toxicity(docs, labels)
    order = sorted(range(40), key=str)
    swaps = toxicity.swapped_terms(toxicity.GROUP_TERMS)
    pairs = [pair for i in order for pair in toxicity.counterfactuals(texts[i], swaps)]
    wanted = toxicity.fit([toxicity.bag(texts[i]) for i in order], [i % 2 for i in order], pairs)
    assert len(pairs) >= 40 and found == wanted
