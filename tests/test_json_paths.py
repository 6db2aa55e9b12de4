"""Nested schema inference against a plain walk, and its edge cases."""

import json

from opsloom.operators import json_paths


def schema(spark, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    found = json_paths.nested_schema(frame, "line").collect()
    return {r["field"]: (r["types"], r["present"], r["nulls"], r["missing"], r["parents"]) for r in found}


def test_paths_types_and_missing(spark):
    found = schema(
        spark,
        json.dumps({"messages": [{"role": "user", "content": "a"}, {"role": None}], "n": 1}),
        json.dumps({"messages": [], "n": 1.5, "meta": {"a b": True}}),
        json.dumps({"messages": "none", "meta": None}),
    )
    assert found == {
        "messages": ("array|string", 3, 0, 0, 3),
        "messages[]": ("object", 2, 0, 0, 2),
        "messages[].role": ("string", 2, 1, 0, 2),
        "messages[].content": ("string", 1, 0, 1, 2),
        "n": ("number", 2, 0, 1, 3),
        "meta": ("object", 2, 1, 1, 3),
        'meta["a b"]': ("boolean", 1, 0, 0, 1),
    }


def test_lines_that_are_no_objects_count_nowhere(spark):
    assert schema(spark, None, "", "{", "[1]", "7", '{"a": NaN}', '{"a": 1} x', "[" * 5000) == {}
    assert schema(spark, '{"a": 1, "a": null}', "{}") == {"a": ("null", 1, 1, 1, 2)}


def test_lists_of_lists_and_keys_with_dots(spark):
    found = schema(spark, '{"a.b": {"c": 1}, "a": {"b": {"c": "x"}}, "l": [[1, 2], [], [null]], "": 0}')
    assert found['["a.b"].c'] == ("integer", 1, 0, 0, 1)
    assert found["a.b.c"] == ("string", 1, 0, 0, 1)
    assert found["l[]"] == ("array", 3, 0, 0, 1)
    assert found["l[][]"] == ("integer", 3, 1, 0, 3)
    assert found['[""]'] == ("integer", 1, 0, 0, 1)


def test_deep_records_and_an_empty_table(spark):
    deep = '{"a": ' * 200 + "1" + "}" * 200
    found = schema(spark, deep)
    assert len(found) == 200 and found[".".join(["a"] * 200)][0] == "integer"
    assert json_paths.nested_schema(spark.createDataFrame([], "line string"), "line").count() == 0


def test_counts_do_not_depend_on_partitions_or_flushes(spark, monkeypatch):
    lines = [(json.dumps({f"k{i % 7}": [{"x": i}] * (i % 3), "i": i}),) for i in range(300)]
    frame = spark.createDataFrame(lines, "line string")
    one = json_paths.nested_schema(frame.coalesce(1), "line").collect()
    many = json_paths.nested_schema(frame.repartition(13), "line").collect()
    assert sorted(one) == sorted(many)
    table = frame.coalesce(1).select("line").toArrow().to_batches()
    monkeypatch.setattr(json_paths, "PATHS_HELD", 2)
    flushed = list(json_paths._counted(iter(table)))
    assert len(flushed) > 2
    assert sum(sum(sum(c.to_pylist()) for c in b.columns[2:]) for b in flushed) == 300 * 3 + 2 * 300
