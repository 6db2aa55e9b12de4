"""The corpus pipeline: each stage's decisions take effect and clean documents stay."""

import corpus_pipeline
import llm_data
import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and returns, over the whole table."""
    from opsloom.llm.common import written

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, FOLDER), f"test-{name}")
        out[name] = (docs, result)
        docs = result
    return out


def test_stages_return_the_columns_of_documents(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert after.dtypes == before.dtypes, name


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    left = after.join(labels, "doc_id").groupBy("toxic").count().collect()
    had = dict(before.join(labels, "doc_id").groupBy("toxic").count().collect())
    left = {r["toxic"]: r["count"] for r in left}
    assert left[0] >= 0.99 * had[0] and left.get(1, 0) <= 0.3 * had[1]


def test_one_document_of_each_group_stays(stages):
    from test_near_copies import brute

    before, after = stages["simhash_near_dedup"]
    groups = brute({r["doc_id"]: r["text"] for r in before.collect()})
    assert sorted(set(groups.values())) == sorted(r["doc_id"] for r in after.collect())
    assert after.join(before, ["doc_id", "text"]).count() == after.count() < before.count()


def test_repeats_are_cut_as_by_brute_force(stages):
    from test_duplicates import brute

    before, after = stages["suffix_array_dedup"]
    want = brute([(r["doc_id"], r["text"]) for r in before.orderBy("doc_id").collect()])
    rows = llm_data.by_id(after)
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert set(rows) == set(want) and any(w[1] for w in want.values())
    for key, (size, gone, _, _) in want.items():
        assert rows[key]["n_chars"] == len(rows[key]["text"])
        assert size - gone - 6 * want[key][2] - 6 <= len(rows[key]["text"].encode()) <= size - gone
        if not gone:
            assert rows[key]["text"] == texts[key]


def test_secrets_are_masked(stages):
    from opsloom.llm import secrets

    before, after = stages["secrets"]
    rows = llm_data.by_id(after)
    changed = 0
    for row in before.collect():
        own = rows[row["doc_id"]]
        assert secrets.found(own["text"]) == []
        changed += own["text"] != row["text"]
    assert len(rows) == before.count() and changed


def test_packing_covers_what_is_left(stages):
    before, after = stages["packing"]
    sums = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert sums.where("n != all").count() == 0
    assert sums.count() == before.count()


def test_run_returns_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, stages["packing"][1].collect()))


def test_stages_take_awkward_rows(spark):
    texts = [t for t in llm_data.awkward() if t is None or len(t) < 10_000]
    rows = [(i, t, "en", None, None) for i, t in enumerate(texts)]
    rows += rows[:20] + [(None, "without id", None, "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.where("doc_id is null").count() == 1, name
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).collect() == []
