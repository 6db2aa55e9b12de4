"""JSON arrays read in splits give the same rows as the document read whole."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from opsloom.sources import files, json_arrays

SCHEMA = "id bigint, text string, deep struct<items: array<struct<v: string>>>"
ODD = ['}', '{', '"', '\\', '[', ']', '\n', 'é', '\\"', '{"a": 1}', ' ', 'x', '\\\\', '}"{', "\u2028"]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def to(size):
        for key in before:
            spark.conf.set(key, size)

    yield to
    for key, value in before.items():
        spark.conf.set(key, value)


def records(rng, n):
    def text():
        return "".join(rng.choice(ODD) for _ in range(rng.randrange(12)))

    return [
        {"id": i, "text": text(), "deep": {"items": [{"v": text()} for _ in range(rng.randrange(4))]}}
        for i in range(n)
    ]


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_splits_give_the_rows_of_the_whole_document(spark, tmp_path, small_splits):
    rng = random.Random(1)
    for name, n, indent in (("one", 800, None), ("two", 300, 2), ("three", 1, None)):
        (tmp_path / f"{name}.json").write_text(json.dumps(records(rng, n), indent=indent, ensure_ascii=False))
    whole = rows(files.read_json_document(spark, str(tmp_path), SCHEMA))
    small_splits("997")
    pieces = json_arrays._pieces(spark, str(tmp_path))
    assert pieces.select("file", "block").distinct().count() > 50
    assert pieces.rdd.getNumPartitions() > 50
    assert len(whole) == 1101
    assert rows(json_arrays.read_json_array(spark, str(tmp_path), SCHEMA)) == whole


def test_order_in_the_file_is_kept(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(records(random.Random(2), 200)))
    small_splits("500")
    found = json_arrays.array_records(spark, str(tmp_path)).collect()
    assert [json.loads(r["text"])["id"] for r in sorted(found, key=lambda r: r["record"])] == list(range(200))


def test_records_longer_than_splits(spark, tmp_path, small_splits):
    long = [{"id": i, "text": "}\"{" * 700, "deep": None} for i in range(5)]
    (tmp_path / "a.json").write_text(json.dumps(long))
    small_splits("600")
    found = json_arrays.read_json_array(spark, str(tmp_path), SCHEMA).collect()
    assert sorted((r["id"], r["text"]) for r in found) == [(i, "}\"{" * 700) for i in range(5)]


@pytest.mark.parametrize("content, ids", [
    ("", []), ("[]", []), (" [ ] \n", []), ('{"id": 3}', [3]), ('[{"id": 1},\n {"id": 2}]\n', [1, 2]),
    ('[1, "}{", {"id": 4}, null]', [4]), ('[{"id": 5}, {"id": 6', [5, 6]), ('[{"id": 5}, {"id": {"a": 6', [5]), ("[{}]", [None]),
])
def test_edges(spark, tmp_path, content, ids):
    (tmp_path / "a.json").write_text(content)
    found = json_arrays.read_json_array(spark, str(tmp_path), "id bigint").collect()
    assert sorted([r["id"] for r in found], key=str) == ids


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from('{}"\\[]\n,:a'), max_size=20), min_size=1, max_size=15), st.integers(20, 200))
def test_any_strings(spark, tmp_path_factory, small_splits, texts, size):
    folder = tmp_path_factory.mktemp("any")
    (folder / "a.json").write_text(json.dumps([{"text": t} for t in texts]))
    small_splits(str(size))
    found = json_arrays.array_records(spark, str(folder)).orderBy("record").collect()
    assert [json.loads(r["text"])["text"] for r in found] == texts
