"""Infrastructure-as-code corpus: gates, redaction, records, reports."""

import json
import re

import pytest
import yaml
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsloom.functions import corpus as columns
from opsloom.functions import rules
from opsloom.operators import corpus

GOOD = ("apiVersion: apps/v1\nkind: Deployment\nmetadata:\n  name: gpu-job\nspec:\n  limits:\n"
        "    nvidia.com/gpu: 1\n" + "  note: " + "x" * 150 + "\n")
FILE = ("content string, ext string, lang string, size long, alphanum_fraction double, "
        "hexsha string, max_stars_repo_path string, max_issues_repo_path string, "
        "max_forks_repo_path string, max_stars_repo_licenses array<string>, "
        "max_issues_repo_licenses array<string>, max_forks_repo_licenses array<string>")


def row(**changes):
    base = dict(content=GOOD, ext="yaml", lang="yaml", size=400, alphanum_fraction=0.6, hexsha="h",
                max_stars_repo_path="deploy/gpu-job.yaml", max_issues_repo_path=None,
                max_forks_repo_path=None, max_stars_repo_licenses=["MIT"],
                max_issues_repo_licenses=None, max_forks_repo_licenses=None)
    return tuple({**base, **changes}.values())


def frame(spark, *rows):
    return spark.createDataFrame(rows, FILE)


CASES = [
    ({}, "ok"), ({"content": ""}, "empty_content"), ({"content": None}, "empty_content"),
    ({"size": 199}, "too_small"), ({"size": None}, "too_small"), ({"size": 200}, "ok"),
    ({"size": 500001}, "too_large"), ({"size": 500000}, "ok"),
    ({"alphanum_fraction": 0.24}, "low_alphanum"), ({"alphanum_fraction": None}, "low_alphanum"),
    ({"ext": "json"}, "bad_extension"), ({"ext": ".YML"}, "ok"), ({"ext": ""}, "ok"),
    ({"ext": None}, "ok"), ({"content": GOOD.replace("apiVersion", "apiversion")}, "not_k8s"),
    ({"content": GOOD.replace("kind:", "knd:")}, "missing_kind"),
    ({"content": GOOD.replace("metadata:", "meta:")}, "missing_metadata"),
    ({"content": GOOD + "bad: [unclosed"}, "invalid_yaml"), ({"content": GOOD + "---\na: 1"}, "invalid_yaml"),
    ({"content": GOOD + "d: 2024-13-45"}, "invalid_yaml"),
    ({"max_stars_repo_licenses": None}, "missing_license"),
    ({"max_stars_repo_licenses": ["", " "]}, "missing_license"),
    ({"max_stars_repo_licenses": ["GPL-3.0"]}, "bad_license"),
    ({"max_stars_repo_licenses": ["GPL-3.0"], "max_forks_repo_licenses": [" Apache-2.0 "]}, "ok"),
    ({"content": GOOD.replace("gpu", "cpu")}, "not_ml_infra"),
    ({"content": GOOD.replace("gpu", "GPU")}, "ok"),
]


def test_filter_reasons(spark):
    rows = [row(**{**change, "hexsha": str(i)}) for i, (change, _) in enumerate(CASES)]
    out = {r["hexsha"]: r["reason"]
           for r in corpus.with_filter_reason(frame(spark, *rows)).collect()}
    assert [out[str(i)] for i in range(len(CASES))] == [reason for _, reason in CASES]


def test_gates_can_be_switched_off(spark):
    s = corpus.FilterSettings(kind=False, valid_yaml=False, require_license=False, require_ml=False)
    rows = [row(content=GOOD.replace("kind:", "knd:")), row(content=GOOD + "bad: [x"),
            row(max_stars_repo_licenses=None)]
    assert {r["reason"] for r in corpus.with_filter_reason(frame(spark, *rows), s).collect()} == {"ok"}
    loose = corpus.FilterSettings(ml_mode="any", api_version=False, kind=False, metadata=False)
    out = corpus.with_filter_reason(frame(spark, row(content="a: " + "b" * 300)), loose)
    assert out.collect()[0]["reason"] == "ok"  # no gate is on, so every file passes them


def test_curated_records(spark):
    leaking = GOOD + "owner: bob@example.com at 10.0.0.1\n"
    breaking = GOOD + "secret: {x: 1, y: 2}\n"
    out = {r["hexsha"]: r for r in corpus.curate(frame(
        spark, row(content=leaking, hexsha="a"), row(content=breaking, hexsha="b"))).collect()}
    assert out["b"]["reason"] == "invalid_yaml_post_redaction" and out["b"]["messages"] is None
    record = out["a"]
    assert record["messages"][0]["content"] == "Provision a GPU workload for gpu job"
    call = json.loads(record["messages"][1]["content"])
    assert call["tool"] == "apply_manifest"
    manifest = call["params"]["manifest_content"]
    assert "EMAIL_REDACTED at IPV4_REDACTED" in manifest and yaml.safe_load(manifest)
    assert record["_meta"].asDict() == {"hexsha": "a", "path": "deploy/gpu-job.yaml", "size": 400,
                                        "licenses": ["mit"]}


def python_redact(text):
    p = rules.PII_PATTERNS
    text = re.sub(p["ipv4"], "IPV4_REDACTED", text)
    text = re.sub(p["api_key"], "sk-REDACTED", text)
    text = re.sub(p["email"], "EMAIL_REDACTED", text)
    return re.sub(p["creds"], r"\1: REDACTED", text, flags=re.IGNORECASE)


PARTS = st.sampled_from([
    "10.0.0.1", "1.2.3", "256.1.1.1", "999.10.0.0.1", "bob@example.com", "/x@y.z", "éa@b.c", "ab@c-d.e",
    "sk-" + "a1" * 12, "sk-short", "password=abc", "Token : xyz", "SECRET:\n v", "api_key", " ", "\n",
    ",", ".", "/", "é", "ſecret=1", "1.2.3.4é", "v1.2.3.4", "+x@y.z", "toKen=1",
])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=8).map("".join), min_size=1, max_size=25))
def test_redaction_equals_the_python_patterns(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", columns.redact("t").alias("r"), columns.has_pii("t").alias("p")).collect():
        assert r["r"] == python_redact(r["t"])
        assert r["p"] == any(re.search(p, r["t"]) for p in rules.PII_PATTERNS.values())


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["GPU", "gpu", "Kubeflow", "ſerving", "WORKFLOW", "x", " ",
                                          "pipeline", "infeRence"]), max_size=8).map("".join),
                min_size=1, max_size=20))
def test_keyword_counts_equal_the_python_patterns(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = [w for ws in rules.CORPUS_KEYWORDS.values() for w in ws]
    out = df.select("t", *[columns.keyword_count("t", w).alias(f"k{i}") for i, w in enumerate(words)])
    for r in out.collect():
        for i, w in enumerate(words):
            assert r[f"k{i}"] == len(re.findall(re.escape(w), r["t"], re.I))


@pytest.mark.parametrize("path, prompt", [
    ("a/deploy-web.yaml", "Deploy the deploy web configuration"),
    ("x/my_service.YML", "Apply the my service service manifest"),
    ("inference_x.yaml", "Set up the inference x inference workload"),
    ("", "Apply the following Kubernetes manifest for manifest"),
    (None, "Apply the following Kubernetes manifest for manifest"),
    ("k/thing.yaml", "Apply the following Kubernetes manifest for thing"),
])
def test_prompts(one, path, prompt):
    assert one(columns.synthesize_prompt(F.col("p")), p=path) == prompt


@pytest.mark.parametrize("text, kind, wide", [
    ("kind: InferenceService", "kserve", "kserve"), ("seldon", "seldon", "seldon"),
    ("kind:   Job", "k8s_workload", "k8s_workload"), ("kind: Secret", "k8s_config", "k8s_config"),
    ("apiVersion: x", "k8s_other", "k8s_other"), ('resource "a"', "other", "terraform"),
    ("x" * 2000 + "apiVersion", "k8s_other", "k8s_other"), ("terraform {", "other", "terraform"),
])
def test_manifest_type(one, text, kind, wide):
    assert one(columns.manifest_type(F.col("c")), c=text) == kind
    assert one(columns.manifest_type(F.col("c"), terraform=True), c=text) == wide


def test_classes(one):
    assert one(columns.size_bucket(F.col("s")), s=999) == "<1KB"
    assert one(columns.size_bucket(F.col("s")), s=100000) == ">100KB"
    assert one(columns.prompt_type(F.col("p")), p="Apply the Secret") == "secret"
    assert one(columns.escape_difficulty(F.col("c")), c='"' * 501) == "medium"
    assert one(columns.escape_difficulty(F.col("c")), c="\\" * 1700) == "hard"
    assert one(columns.license_class(F.array(F.lit("GPL"), F.lit(" MIT ")))) == "mit"
    assert one(columns.license_class(F.array(F.lit("GPL")))) == "other"
    assert one(columns.license_class(F.lit(None).cast("array<string>"))) == "unknown"
    for pct, weight in [(80.0, 0.5), (20.0, 1.0), (0.0, 1.0), (100.0, 0.4)]:
        assert one(columns.sampling_weight(F.col("p")), p=pct) == weight


def line(messages=None, meta=None, drop=()):
    content = json.dumps({"tool": "apply_manifest", "params": {"manifest_content": "a: 1"}})
    record = {
        "messages": messages if messages is not None else [
            {"role": "user", "content": "do"}, {"role": "assistant", "content": content}],
        "_meta": meta if meta is not None else {"hexsha": None, "path": "", "size": 5, "licenses": []},
    }
    return json.dumps({k: v for k, v in record.items() if k not in drop})


def reply(tool="apply_manifest", manifest="a: 1"):
    body = json.dumps({"tool": tool, "params": {"manifest_content": manifest}})
    return [{"role": "user", "content": "do"}, {"role": "assistant", "content": body}]


def test_record_violations(spark):
    cases = [
        (line(), []), ("{bad", ["unparseable_line"]), (line(drop=["_meta"]), [
            "missing_top_key:_meta", *[f"missing_meta_key:{k}" for k in rules.RECORD_META_KEYS]]),
        (line(drop=["messages"]), ["missing_top_key:messages", "wrong_message_count:0"]),
        (line(messages=[]), ["wrong_message_count:0"]),
        (line(messages=reply()[::-1]), ["first_role_not_user", "second_role_not_assistant",
                                        "assistant_invalid_json"]),
        (line(messages=reply(tool="x")), ["wrong_tool_name"]),
        (line(messages=reply(manifest="")), ["empty_manifest_content"]),
        (line(messages=reply(manifest="a: [")), ["manifest_invalid_yaml"]),
        (line(messages=reply(manifest="ip: 999.1.1.1")), ["pii_leaked:ipv4"]),
        (line(messages=[{"role": "user", "content": " "}, reply()[1]]), ["empty_prompt"]),
        (line(meta={"hexsha": "h", "size": 1}), ["missing_meta_key:path", "missing_meta_key:licenses"]),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, record string")
    out = corpus.record_violations(df)
    found = {r["i"]: r["violations"] for r in out.collect()}
    assert [found[i] for i in range(len(cases))] == [v for _, v in cases]
    checks = {r["check"]: (r["value"], r["is_anomaly"]) for r in corpus.report_checks(out).collect()}
    assert checks["pii_leakage"] == (1.0, True) and checks["minimum_records"] == (12.0, False)
    assert checks["pass_rate"] == (8.33, True) and checks["violation_count"][1] is False
    summary = corpus.validation_summary(out).collect()[0]
    assert (summary["total"], summary["valid"], summary["pass_rate_pct"]) == (12, 1, 8.33)


def test_slices_and_imbalances(spark):
    rows = [row(hexsha=str(i)) for i in range(19)] + [row(content=GOOD + "\nkserve: 1", hexsha="k")]
    fields = corpus.record_fields(corpus.training_records(frame(spark, *rows)))
    shares = corpus.slice_shares(fields, 10.0, 40.0)
    out = {(r["dimension"], r["value"]): r["pct_of_total"] for r in shares.collect()}
    assert out[("iac_type", "k8s_workload")] == 95.0 and out[("iac_type", "kserve")] == 5.0
    flags = {(r["dimension"], r["direction"]): r["slice_values"]
             for r in corpus.imbalances(shares).collect()}
    assert flags[("iac_type", "under")] == "kserve" and flags[("license", "over")] == "mit"


def test_rejected_files_never_reach_the_yaml_check(spark):
    """Only undecided texts are shipped: a huge text of another kind costs nothing there."""
    plan = corpus.with_filter_reason(frame(spark, row()))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.count("ArrowEvalPython") == 1 and "isnull(_early" in text


def test_kind_is_found_behind_a_long_header(spark):
    from pyspark.sql import functions as F

    from opsloom.functions import corpus as columns

    header = "# licence text\n" * 300
    row = spark.range(1).select(
        columns.manifest_type(F.lit(header + "apiVersion: v1\nkind: Deployment\n")).alias("kind"),
        columns.manifest_type(F.lit("apiVersion: v1\nkind: Deployment\n")).alias("plain"),
    ).collect()[0]
    assert row["kind"] == row["plain"] != "other"


def python_nodes(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_reports_evaluate_the_funnel_once(spark):
    from opsloom.operators import corpus as operators
    from opsloom.plans.bindings import Tables

    tables = Tables(spark, "/root/testdata/sf0.001")
    once = python_nodes(operators.curate(tables.files()))
    assert once and python_nodes(operators.diagnostics(tables.files())) == once
    fields = operators.record_fields(tables.records())
    assert python_nodes(operators.slice_shares(fields)) == python_nodes(fields)
