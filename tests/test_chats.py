"""Function-call chats and workflows."""

import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsloom.functions import chats as columns
from opsloom.operators import chats, workflows

ONE = """ASSISTANT: <functioncall> {"name": "w", "arguments": '{"city": "Oslo"}'} <|endoftext|>"""
TWO = ONE + " " + ONE.replace('"w"', '"v"')
BAD = """ASSISTANT: <functioncall> {"name": "f", "arguments": '{broken json'} <|endoftext|>"""


def calls_of(one, chat):
    return one(columns.function_calls(F.col("c")), c=chat)


def test_calls(one):
    call = calls_of(one, ONE)[0]
    assert (call["name"], call["n_arguments"], call["malformed"]) == ("w", 1, None)
    assert json.loads(call["arguments"]) == {"city": "Oslo"}
    assert [c["name"] for c in calls_of(one, TWO)] == ["w", "v"]
    assert calls_of(one, "plain") == [] and calls_of(one, "") == []
    bad = calls_of(one, BAD)[0]
    assert bad["name"] is None and bad["malformed"].startswith('{"name": "f"')


def python_calls(text):
    """The same reading done with Python's own JSON reader."""
    found = re.findall(r"<functioncall>\s*(\{.*?\})\s*(?:<\|endoftext\|>|$)", text, re.DOTALL)
    out = []
    for block in found:
        try:
            call = json.loads(re.sub(r"'(\{.*?\})'", r"\1", block, flags=re.DOTALL))
            args = call.get("arguments", {})
            if isinstance(args, str):
                try:
                    args = json.loads(args)
                except json.JSONDecodeError:
                    pass
            out.append((args, len(args) if isinstance(args, dict) else None))
        except json.JSONDecodeError:
            out.append(block[:100])
    return out


PIECES = st.sampled_from([
    '{"name": "f"}', '{"name": "f", "arguments": {"a": 1}}', "{'name': 1}", '{"a": 1} {"b": 2}',
    '{"name": "f", "arguments": "text"}', '{"name": "f", "arguments": "{\\"k\\": [1, 2]}"}',
    '{"name": "f", "arguments": \'{"x": 1, "y": 2, "z": 3}\'}', '{"a": 1,}', '{"a": 1}] }',
    '{"a": 01}', '{"name": "f", "arguments": null}', '{"name": "f", "arguments": [1]}',
    '{"a": "line\nbreak"}', '{"a": NaN, "arguments": {}}', '{"name": "f", "arguments": "5"}',
    '{"dup": 1, "dup": 2}', '{"a": "\\u00e9 é"}', "{a: 1}", "{}", '{"a": {"b": {"c": "}"}}}',
    '{"a": tru}', '{"a": 1}}', '{"name": "f", "arguments": {"d": 1, "d": 2, "e": 3}}',
])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(PIECES, min_size=1, max_size=3), min_size=1, max_size=15))
def test_calls_equal_the_python_reading(spark, chats_):
    texts = [" ".join(f"<functioncall> {p} <|endoftext|> text" for p in c) for c in chats_]
    texts += [f"<functioncall> {c[0]}" for c in chats_]
    frame = spark.createDataFrame([(t,) for t in texts], "c string")
    rows = frame.select("c", columns.function_calls("c").alias("calls")).collect()
    for r in rows:
        expected = python_calls(r["c"])
        assert len(r["calls"]) == len(expected)
        for call, want in zip(r["calls"], expected):
            if isinstance(want, str):
                assert call["malformed"] == want, r["c"]
            else:
                assert call["malformed"] is None, r["c"]
                got = json.loads(call["arguments"])
                assert repr(got) == repr(want[0]) and call["n_arguments"] == want[1], r["c"]


@pytest.mark.parametrize("chat, tier", [
    ("x", "none"), (ONE, "simple"), (TWO, "complex"), (BAD, "malformed"),
    ('<functioncall> {"name": "f", "arguments": {"a": 1, "b": 2, "c": 3}} <|endoftext|>', "moderate"),
])
def test_tiers(one, chat, tier):
    assert one(columns.complexity_tier(columns.function_calls(F.col("c"))), c=chat) == tier


SYSTEM = """SYSTEM: You help. {"name": "w", "description": "d", "parameters": {"type": "object",
"properties": {"city": {"type": "string"}, "day": {"type": "string"}}, "required": ["city"]}}"""


def test_signatures(one):
    row = one(columns.function_signature(F.col("s")), s=SYSTEM)
    assert row.asDict() == {"name": "w", "description": "d", "parameters": ["city", "day"],
                            "required": ["city"]}
    for text in ("", None, "no json", '{"a": 1}', '{"name": "a"} {"name": "b"}', "{broken}"):
        assert one(columns.function_signature(F.col("s")), s=text) is None
    bare = one(columns.function_signature(F.col("s")), s='{"name": "n", "parameters": []}')
    assert (bare["parameters"], bare["required"]) == ([], [])
    assert one(columns.function_signature(F.col("s")),
               s='{"name": "n", "parameters": {"properties": [1]}}') is None


def raw(spark, *rows):
    return spark.createDataFrame(rows, "system string, chat string")


def test_feature_record(spark):
    chat = "USER: hi\nUSER: more " + ONE + " <functionresponse> {\"error\": 1} </functionresponse>"
    rows = chats.call_features(raw(spark, (SYSTEM, chat), (None, ""), (None, None))).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["num_turns"], row["num_calls"], row["complexity_tier"]) == (2, 1, "simple")
    assert json.loads(row["function_calls"]) == [{"name": "w", "arguments": {"city": "Oslo"}}]
    assert json.loads(row["function_signatures"]) == {
        "w": {"description": "d", "parameters": ["city", "day"], "required": ["city"]}}
    assert json.loads(row["defined_function_names"]) == ["w"]
    assert row["has_function_error_response"] and json.loads(row["error_keywords_found"]) == ["error"]


def test_error_flags(one):
    flag = columns.has_conditional_error(F.col("c"))
    assert one(flag, c="If the call will FAIL then") and not one(flag, c="if " + "x" * 40 + " fail")
    assert not one(flag, c="if\nerror")
    assert one(columns.has_function_error(F.col("c")),
               c="<functionresponse>\n{failed}\n</functionresponse>")


def test_chat_messages(spark):
    rows = chats.chat_messages(chats.call_features(raw(
        spark, (SYSTEM, "USER: scale it ASSISTANT: ok " + ONE),
        (None, "USER: hello\nASSISTANT: \"quoted\"\nreply <|endoftext|>"), (None, "no turns " + "x" * 300),
        (None, "USER: a ASSISTANT: b " + BAD)))).collect()
    first = json.loads(rows[0]["messages"][2]["content"])
    assert first == {"workflow": {"steps": [{"tool": "w", "params": {"city": "Oslo"}}]}}
    assert rows[0]["messages"][1]["content"] == "scale it"
    assert json.loads(rows[1]["messages"][2]["content"]) == {
        "workflow": {"steps": []}, "message": '"quoted"\nreply'}
    assert rows[2]["messages"][1]["content"] == "no turns " + "x" * 300
    assert json.loads(rows[2]["messages"][2]["content"])["message"] == ""
    assert json.loads(rows[3]["messages"][2]["content"])["workflow"]["steps"] == []


def slices(spark):
    return spark.range(1000).select(
        (F.col("id") % 7).cast("int").alias("num_turns"), (F.col("id") % 4).cast("int").alias("num_calls"),
        F.when(F.col("id") < 5, "complex").otherwise("simple").alias("complexity_tier"),
        (F.col("id") % 20 == 0).alias("has_malformed"), (F.col("id") % 10 == 0).alias("has_error_handling"),
        (F.col("id") % 10 == 1).alias("has_parallel"), (F.col("id") % 3).cast("int").alias("num_defined_functions"))


def test_slice_summary(spark):
    summary = chats.slice_summary(chats.add_slice_features(slices(spark)))
    rows = summary.collect()
    shares = {}
    for r in rows:
        shares[r["slice_column"]] = shares.get(r["slice_column"], 0) + r["proportion"]
    assert set(shares) == set(chats.SLICE_COLUMNS)
    assert all(v == pytest.approx(1.0, abs=0.01) for v in shares.values())
    found = chats.representation_findings(summary).collect()
    assert [(r["slice_value"], r["severity"], r["strategy"]) for r in found] == [
        ("complex", "high", "oversample")]


def test_threshold_checks(spark):
    flags = {r["check"]: r["is_anomaly"] for r in chats.threshold_checks(slices(spark)).collect()}
    assert flags == {"malformed_rate": False, "none_complexity_rate": False, "record_count": True,
                     "avg_turns": False, "avg_calls": False, "defined_functions_coverage": False}


@pytest.mark.parametrize("text, valid", [
    ('{"steps": []}', True), ('{"steps": [{"step_id": 1, "tool": "t", "params": {}}]}', True),
    ('{"steps": [{"step_id": 1, "tool": "t", "params": {"replicas": 2, "pod": null}}]}', True),
    ('{"steps": [{"step_id": 1, "tool": "t", "params": {"other": 2}}]}', False),
    ('{"steps": [{"step_id": 1, "tool": 5, "params": {}}]}', False),
    ('{"steps": [{"step_id": 1, "tool": "t"}]}', False), ('{"steps": [5]}', False),
    ('{"steps": [{"step_id": "x", "tool": "t", "params": {}}]}', False), ('{}', False),
    ('{"steps": [{"step_id": 1, "tool": "t", "params": {"replicas": 1.5}}]}', False),
    ('{"steps": [{"step_id": 1, "tool": "t", "params": {"deployment": 7}}]}', False),
    ('{"steps": []} extra', False), ("not json", False), ("[]", False),
])
def test_workflow_valid(one, text, valid):
    assert one(F.coalesce(workflows.workflow_valid(F.col("w")), F.lit(False)), w=text) is valid


RECORD = "id int, messages array<struct<role string, content string>>"


def test_chat_errors_and_anomalies(spark):
    s, u, a = ("system", "s"), ("user", "u"), ("assistant", '{"a": 1}')
    frame = spark.createDataFrame([
        (1, [s, u, a]), (2, [u, a]), (3, [s, u, u]), (4, None), (5, [s, u, ("assistant", "text")]),
        (6, []), (7, [s, u, ("assistant", "{'a': 1}")]), (8, [s, u, ("assistant", "5")])], RECORD)
    errors = {r["id"]: r["errors"] for r in workflows.chat_errors(frame).collect()}
    assert [i for i, e in errors.items() if e] == [2, 3, 4, 6]
    found = {r["id"]: r["anomaly"] for r in workflows.chat_anomalies(frame).collect()}
    assert set(found) == {2, 3, 4, 5, 6, 7} and found[3] == "missing role assistant"


def test_prompt_queue(spark):
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id long, user_intent string")
    done = workflows.mark_processed(prompts.filter("id < 2"), prompts.filter("id IN (1, 4)"))
    assert sorted(r["id"] for r in workflows.unprocessed(prompts, done).collect()) == [2, 3, 5]
    made = spark.createDataFrame([(2, "{}"), (3, None)], "id long, workflow_json string")
    assert [r["id"] for r in workflows.pair_workflows(prompts, made).collect()] == [2]


def test_long_replies_and_blocks_stay_whole(spark):
    reply, block = "word " * 500 + "end", '{"name": ' + "x" * 400
    rows = chats.call_features(raw(
        spark, (None, f"USER: go ASSISTANT: {reply}"),
        (None, f"USER: go ASSISTANT: <functioncall> {block}}} <|endoftext|>")))
    messages = chats.chat_messages(rows).collect()
    assert json.loads(messages[0]["messages"][2]["content"])["message"] == reply
    [bad] = [c for r in rows.collect() for c in r["calls"]]
    assert bad["malformed"] == block + "}"
