"""Question-and-answer text functions and operators."""

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsloom.functions import text
from opsloom.functions.common import squeeze, strip
from opsloom.operators import qa


@pytest.mark.parametrize("raw, clean", [
    ("<p>Hello <b>world</b></p>", "Hello world"), ("a &amp; b &lt;c&gt;", "a & b <c>"),
    ("x &hellip; &#39;y&#39; &eacute;", "x … 'y' é"), ("", ""), (None, ""),
    ("  many \n\t spaces here ", "many spaces here"), ("no tags", "no tags"),
])
def test_clean_html(one, raw, clean):
    assert one(text.clean_html(F.col("t")), t=raw) == clean


@pytest.mark.parametrize("raw, clean", [
    ("see https://a.b/c?d=1 now", "see [URL] now"), ("http://x", "[URL]"), ("", ""), (None, ""),
    ("keep `code` and ```block\nmore```", "keep `code` and ```block more```"),
])
def test_clean_text(one, raw, clean):
    assert one(text.clean_text(F.col("t")), t=raw) == clean


def test_code_functions(one):
    raw = "Run `ls` then ```\ncat x\n``` end"
    assert one(text.code_blocks(F.col("t")), t=raw) == ["`ls`", "```\ncat x\n```"]
    assert one(text.mask_code(F.col("t")), t=raw) == "Run [CODE] then [CODE] end"
    assert one(text.clean_text(F.col("t"), remove_code=True), t=raw) == "Run then end"


def test_text_metrics(one):
    row = one(text.text_metrics(F.col("t")), t="Hello world. How are you? `x`!")
    assert row.asDict() == {"char_count": 30, "word_count": 6, "sentence_count": 3,
                            "code_block_count": 1}
    assert one(text.text_metrics(F.col("t")), t="")["char_count"] == 0


@pytest.mark.parametrize("raw, names", [
    ("pod in crashloopbackoff", ["CrashLoopBackOff"]), ("OOMKilled", ["OOMKilled"]),
    ("Timed out; 403", ["Timeout", "PermissionDenied"]), ("nothing", []),
])
def test_error_signatures(one, raw, names):
    assert one(text.error_signatures(F.col("t")), t=raw) == names


def test_infra_components_and_tags(one):
    assert one(text.infra_components(F.col("t")), t="kubectl and Terraform on AWS") == [
        "kubernetes", "terraform", "cloud_aws"]
    assert one(text.tag_list(F.col("t")), t="<docker><gpu>") == ["docker", "gpu"]
    assert one(text.tag_list(F.col("t")), t=None) == []


@pytest.mark.parametrize("raw, kind", [
    ("How do I scale?", "how_to"), ("Why is it slow", "explanation"), ("what is a pod", "definition"),
    ("please fix it", "troubleshooting"), ("it crashed", "error_resolution"),
    ("any best practice", "best_practice"), ("hello", "general"),
])
def test_question_type(one, raw, kind):
    assert one(text.question_type(F.col("t")), t=raw) == kind


def test_complexity(one):
    assert one(text.complexity(F.col("t")), t="short text") == "simple"
    assert one(text.complexity(F.col("t")), t="short `a`") == "moderate"
    assert one(text.complexity(F.col("t")), t="w " * 250 + "`a` `b`") == "complex"


ODD = st.text(alphabet="ab \t\n\x1c\x85  　é.`&;<>", max_size=40)


@settings(max_examples=20, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=20))
def test_whitespace_and_entities_as_in_python(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    rows = frame.select("t", squeeze("t").alias("sq"), strip("t").alias("st"),
                        text.word_count("t").alias("w"), text.clean_html("t").alias("h")).collect()
    for r in rows:
        assert r["sq"] == re.sub(r"\s+", " ", r["t"]).strip()
        assert r["st"] == r["t"].strip()
        assert r["w"] == len(r["t"].split())
        plain = html.unescape(re.sub(r"<[^>]+>", " ", r["t"]))
        assert r["h"] == re.sub(r"\s+", " ", plain).strip()


def questions(spark, *rows):
    return spark.createDataFrame(rows, "Id string, Title string, Body string, Tags string, "
                                 "Score string, ViewCount string, AcceptedAnswerId string, "
                                 "CreationDate string")


def test_clean_questions_drops_unusable_rows(spark):
    out = qa.clean_questions(questions(
        spark,
        ("1", "T", "<p>b</p>", "<gpu>", "7", "10", "11", "d"), ("2", "T", "b", "", "4", "1", "12", "d"),
        ("3", "T", "b", "", "9", "1", " ", "d"), ("x", "T", "b", "", "9", "1", "14", "d"),
        ("5", "T", "b", "", "n/a", "1", "15", "d"), ("6", None, None, None, "9", None, "16", None),
    )).orderBy("question_id").collect()
    assert [r["question_id"] for r in out] == [1, 6]
    assert out[0]["body"] == "b" and out[0]["tags"] == ["gpu"]
    assert (out[1]["title"], out[1]["view_count"], out[1]["tags"]) == ("", 0, [])


def test_last_answer_wins(spark):
    raw = spark.createDataFrame(
        [("10", "1", "first", "3", 1), ("11", "1", "last", "2", 2), ("12", "1", "bad", "?", 3),
         ("", "2", "no id", "1", 4)],
        "AnswerId string, QuestionId string, AnswerBody string, AnswerScore string, o int")
    out = qa.clean_answers(raw, "o").collect()
    assert [(r["question_id"], r["answer_id"], r["body"]) for r in out] == [(1, 11, "last")]


FEATURES = ("question_id long, title string, question_body string, answer_body string, "
            "tags array<string>, score long, view_count long, answer_score long")


def test_features(spark):
    pairs = spark.createDataFrame([
        (1, "T", "How do I fix a crashing pod in kubernetes?", "Use `kubectl` " + "word " * 20,
         ["k8s"], 10, 1000, 5),
        (2, "T", "too short", "x" * 80, [], 1, 1, 1), (3, "T", "q" * 30, "short", [], 1, 1, 1),
        (4, None, None, "x" * 80, [], 1, 1, 1)], FEATURES)
    out = qa.qa_features(pairs).collect()
    assert [r["question_id"] for r in out] == [1]
    row = out[0]
    assert row["question_type"] == "how_to" and row["complexity"] == "moderate"
    assert row["quality_score"] == pytest.approx(20 + 15 + 1 + 9 / 50 + 22 / 100 + 0.5, abs=0.01)


def bias_features(spark, rare=5):
    rows = [(i, "t", "q" * 40, "a" * (400 if i < rare else 100), ["big"] if i % 2 else ["x"],
             100.0 if i < rare else 10.0, 3, [], ["gpu"] if i < rare else [], "how_to", "simple")
            for i in range(100)]
    return spark.createDataFrame(
        rows, "question_id long, title string, question_body string, answer_body string, "
        "tags array<string>, quality_score double, answer_score long, error_signatures "
        "array<string>, infra_components array<string>, question_type string, complexity string")


def test_slice_bias(spark):
    metrics = qa.slice_metrics(bias_features(spark, 30), 30, with_median=True)
    rows = {r["slice"]: r for r in metrics.collect()}
    assert rows[None]["count"] == 100 and rows["infra_gpu"]["count"] == 30
    assert rows["how_to"]["proportion"] == 1.0 and rows["infra_gpu"]["quality_median"] == 100.0
    bias = qa.slice_bias(metrics.drop("quality_median"))
    found = {r["slice"]: r for r in bias.collect()}
    assert found["infra_gpu"]["severity"] == "high" and not found["how_to"]["is_biased"]
    assert {(r["slice"], r["strategy"]) for r in qa.mitigations(bias).collect()} >= {
        ("infra_gpu", "length_normalization")}
    assert qa.bias_summary(bias).collect()[0]["high_severity_count"] == 1


def test_small_slices_are_left_out(spark):
    names = {r["slice"] for r in qa.slice_metrics(bias_features(spark, 5), 30).collect()}
    assert "infra_gpu" not in names and "how_to" in names


def test_outliers(spark):
    frame = spark.createDataFrame([(i, float(i % 10)) for i in range(100)] + [(100, 500.0)],
                                  "question_id long, score double")
    out = qa.iqr_outliers(frame, columns=["score"]).collect()
    assert [(r["question_id"], r["value"]) for r in out] == [(100, 500.0)]
    summary = qa.outlier_summary(frame, columns=["score"]).collect()[0]
    assert (summary["outliers"], summary["warning"]) == (1, False)


def test_training_forms(spark):
    features = bias_features(spark).limit(1)
    chat = qa.chat_records(features).collect()[0]
    assert [m["role"] for m in chat["messages"]] == ["system", "user", "assistant"]
    assert chat["metadata"]["sample_weight"] == 1.0
    plain = qa.chat_records(features, system_prompt=None).collect()[0]
    assert [m["role"] for m in plain["messages"]] == ["user", "assistant"]
    prompt = qa.completion_records(features).collect()[0]["prompt"]
    assert prompt.startswith("### Question\nt\n\n") and prompt.endswith("### Answer\n")
