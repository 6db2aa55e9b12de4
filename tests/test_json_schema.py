"""Compiled JSON schemas against the meaning of each rule."""

import json

import pytest

from opsloom.functions import json_schema, rules

VALUES = [
    None, True, False, 0, 1, -3, 1.0, 1.5, 1e30, "", "a", "abc", "12", [], [1], [1, "a"], [[1]], {}, {"a": 1},
    {"a": None}, {"a": "x", "b": [1]}, {"b c": 2, "a": {"a": 5}},
]


def number(v):
    return isinstance(v, (int, float)) and not isinstance(v, bool)


CASES = [
    ({}, lambda v: True),
    (True, lambda v: True), (False, lambda v: False),
    ({"type": "integer"}, lambda v: number(v) and v == int(v)),
    ({"type": "number"}, number),
    ({"type": ["string", "null"]}, lambda v: v is None or isinstance(v, str)),
    ({"type": "boolean"}, lambda v: isinstance(v, bool)),
    ({"type": "array"}, lambda v: isinstance(v, list)),
    ({"enum": ["a", 1, None, False]}, lambda v: v == "a" or v is None or v is False or (number(v) and v == 1)),
    ({"const": "12"}, lambda v: v == "12"),
    ({"required": ["a"]}, lambda v: not isinstance(v, dict) or "a" in v),
    ({"properties": {"a": {"type": "integer"}}},
     lambda v: not isinstance(v, dict) or "a" not in v or (number(v["a"]))),
    ({"properties": {"b c": {"const": 2}}, "additionalProperties": False, "type": "object"},
     lambda v: v == {}),
    ({"properties": {"a": {}, "b": {}}, "additionalProperties": False},
     lambda v: not isinstance(v, dict) or set(v) <= {"a", "b"}),
    ({"items": {"type": "integer"}}, lambda v: not isinstance(v, list) or all(number(x) for x in v)),
    ({"minItems": 1, "maxItems": 1}, lambda v: not isinstance(v, list) or len(v) == 1),
    ({"minLength": 1, "maxLength": 2}, lambda v: not isinstance(v, str) or 1 <= len(v) <= 2),
    ({"pattern": "b|1"}, lambda v: not isinstance(v, str) or "b" in v or "1" in v),
    ({"minimum": 0, "exclusiveMaximum": 1.5}, lambda v: not number(v) or 0 <= v < 1.5),
    ({"maximum": 1, "exclusiveMinimum": -3}, lambda v: not number(v) or -3 < v <= 1),
    ({"anyOf": [{"type": "string"}, {"minimum": 1, "type": "number"}]},
     lambda v: isinstance(v, str) or (number(v) and v >= 1)),
    ({"oneOf": [{"type": "integer"}, {"type": "number"}]}, lambda v: number(v) and v != int(v)),
    ({"allOf": [{"type": "number"}, {"not": {"const": 0}}]}, lambda v: number(v) and v != 0),
    ({"properties": {"a": {"$ref": "#/$defs/x/inner"}}, "$defs": {"x": {"inner": {"properties": {"a": {"const": 5}}}}}},
     lambda v: True),
]


@pytest.mark.parametrize("schema, wanted", CASES, ids=lambda c: json.dumps(c) if not callable(c) else "")
def test_each_rule(spark, schema, wanted):
    frame = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(VALUES)], "i int, line string")
    found = dict(frame.select("i", json_schema.conforms("line", schema)).collect())
    assert {i: found[i] for i in found} == {i: bool(wanted(v)) for i, v in enumerate(VALUES)}


def test_broken_texts_do_not_conform(spark):
    frame = spark.createDataFrame([(s,) for s in (None, "", "{", "nul", "1 2", '{"a": 1, "a": 2}')], "line string")
    assert {r[0] for r in frame.select(json_schema.conforms("line", {})).collect()} == {False}


@pytest.mark.parametrize("schema", [
    {"patternProperties": {}}, {"additionalProperties": {"type": "string"}}, {"$ref": "http://x"},
    {"$ref": "#"}, {"enum": [[1]]}, {"properties": {"it's": {}}},
    {"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}},
])
def test_what_cannot_be_compiled_is_an_error(spark, schema):
    with pytest.raises(ValueError):
        json_schema.conforms("line", schema)


def test_schema_text_and_native_plan(spark, capsys):
    frame = spark.createDataFrame([('{"steps": []}',)], "line string")
    checked = frame.select(json_schema.conforms("line", json.dumps(rules.WORKFLOW_SCHEMA)).alias("ok"))
    assert checked.collect()[0]["ok"] is True
    checked.explain()
    assert "Python" not in capsys.readouterr().out
