"""Checks, profiles, sequences, combining, alerts, sources and streaming."""

import json

import pytest
from pyspark.sql import functions as F

from opsloom.functions import rules
from opsloom.operators import alerts, combine, logs, profile, quality, sequences
from opsloom.session import scratch_path
from opsloom.sources import files
from opsloom.streaming import logs as stream


@pytest.fixture
def table(spark):
    rows = [(1, "a", 1.0), (2, "b", 5.0), (2, "", None), (3, None, 9.0), (None, "a", 2.0)]
    return spark.createDataFrame(rows, "id int, s string, x double")


def results(frame):
    return {r["check"]: (r["success"], r["violations"]) for r in frame.collect()}


def test_checks(table):
    out = results(quality.run_checks(table, [
        quality.columns_present(table, ["id", "gone"]), quality.no_nulls(table, ["id", "s", "gone"]),
        quality.value_range(table, "x", 1.0, 5.0), quality.value_range(table, "gone", 1, 2),
        quality.allowed_values(table, "s", ["a", "b", ""]), quality.row_count(1, 4),
        quality.no_empty_strings(table, ["s"]), quality.unique(table, "id"), quality.unique(table, "s"),
        quality.regex_match(table, "s", "^[ab]$")]))
    assert out == {
        "columns_present": (False, 1), "no_nulls_id": (False, 1), "no_nulls_s": (False, 1),
        "no_nulls_gone": (False, None), "range_x": (False, 1), "range_gone": (False, None),
        "allowed_s": (False, 1), "row_count": (False, 1), "no_empty_s": (False, 1),
        "unique_id": (False, 1), "unique_s": (False, 1), "regex_s": (False, 1)}


def test_open_bounds_and_listed_null(table):
    out = results(quality.run_checks(table, [
        quality.value_range(table, "x", min_val=0), quality.row_count(5),
        quality.allowed_values(table, "s", ["a", "b", "", None])]))
    assert all(ok for ok, _ in out.values())


def test_suite_summary(table):
    summary = quality.suite_summary(quality.run_checks(
        table, [quality.row_count(1), quality.no_nulls(table, ["id"])])).collect()[0]
    assert summary.asDict() == {"total": 2, "passed": 1, "failed": 1, "success_rate": 0.5,
                                "all_passed": False}


def test_schema_checks(table):
    out = results(quality.schema_checks(table, {
        "required_columns": ["id", "gone"], "not_null_columns": ["s", "gone"],
        "column_value_sets": {"s": ["a", ""]}, "row_count_range": (1, 10),
        "numeric_ranges": {"x": (0, 5)}}))
    assert out == {"column_exists_id": (True, 0), "column_exists_gone": (False, 1),
                   "no_nulls_s": (False, 1), "values_in_set_s": (False, 1),
                   "row_count_range": (True, 0), "range_x": (False, 1)}
    empty = quality.schema_checks(table.filter("id > 99"), {"numeric_ranges": {"x": (0, 5)}})
    assert results(empty) == {"range_x": (False, 1)}


def test_set_differences(table, spark):
    out = {r["value"]: r["count"] for r in quality.disallowed_values(table, "s", ["a"]).collect()}
    assert out == {"b": 1, "": 1, None: 1}
    known = spark.createDataFrame([("a",), (None,)], "v string")
    out = {r["value"] for r in quality.disallowed_values(table, "s", known).collect()}
    assert out == {"b", ""}
    fields = spark.createDataFrame([(c,) for c in table.columns], "field string")
    kinds = {(r["kind"], r["column"]) for r in quality.field_differences(fields, ["id", "q"]).collect()}
    assert kinds == {("missing", "q"), ("extra", "s"), ("extra", "x")}
    known = quality.field_differences(fields.where("field = 'x'"), ["id", "x"], ["q"]).collect()
    assert [tuple(r) for r in known] == [("missing", "id")]


def test_sequence_statistics_are_one_pass_and_defined_on_odd_rows(spark, capsys):
    schema = "sequence_ids array<bigint>, label bigint"
    odd = spark.createDataFrame([([1, 1, None], 0), ([], 9), (None, 2), ([105, 205], None)], schema)
    found = [(r["metric"], r["value"]) for r in sequences.sequence_statistics(odd).collect()]
    assert sorted(found, key=str) == sorted([
        ("total_sequences", 4.0), ("length_min", 0.0), ("length_max", 3.0), ("length_mean", 1.67),
        ("total_tokens", 5.0), ("cpu_tokens", 1.0), ("memory_tokens", 1.0), ("empty_sequences", 1.0),
        ("invalid_labels", 1.0), ("missing_fields", 2.0), ("unique_tokens", 3.0),
        ("label_" + rules.SEQUENCE_LABELS[0], 1.0), ("label_9", 1.0),
        ("label_" + rules.SEQUENCE_LABELS[2], 1.0), (None, 1.0),
    ], key=str)
    empty = {r["metric"]: r["value"] for r in sequences.sequence_statistics(odd.limit(0)).collect()}
    assert empty["total_sequences"] == 0 and empty["length_mean"] is None and empty["unique_tokens"] == 0
    path = scratch_path(spark, "sequences")
    odd.write.parquet(path)
    sequences.sequence_statistics(spark.read.parquet(path)).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_profiles(table):
    nulls = {r["column"]: r["null_pct"] for r in profile.null_rates(table).collect()}
    assert nulls == {"id": 20.0, "s": 20.0, "x": 20.0}
    unique = {r["column"]: r["n_unique"] for r in profile.distinct_counts(table, ["id", "s"]).collect()}
    assert unique == {"id": 4, "s": 4}
    row = profile.numeric_profile(table, ["x"]).collect()[0]
    assert (row["count"], row["mean"], row["median"], row["min"]) == (4, 4.25, 3.5, 1.0)
    shares = {r["value"]: r["pct"] for r in profile.share_of_values(table, "s").collect()}
    assert shares["a"] == 40.0 and shares[None] == 20.0
    whole = {r["column"]: r["dtype"] for r in profile.table_profile(table).collect()}
    assert whole == {"id": "int", "s": "string", "x": "double"}


def test_top_values_and_rates(spark):
    frame = spark.createDataFrame([(i % 3, i % 2 == 0) for i in range(9)] + [(None, True)],
                                  "g int, f boolean")
    assert profile.rows_of_top_values(frame, "g", 2).count() == 6
    rates = profile.group_rates(frame.filter("g IS NOT NULL"), F.col("f"), "g")
    assert profile.rate_difference(rates).collect()[0]["bias_detected"]


SEQ = [([100, 200, 101], 0), ([105, 207], 1), ([102, 202, 301], 2), ([400, 104], 3), ([103], 4),
       ([], 7), (None, None), ([1, None], 0)]


@pytest.fixture
def sequence_table(spark):
    return spark.createDataFrame(SEQ, "sequence_ids array<bigint>, label bigint")


def test_sequences(sequence_table):
    errors = sorted(r["error"] for r in sequences.sequence_errors(sequence_table).collect())
    assert errors == ["invalid label", "invalid label", "non-integer token",
                      "sequence_ids is empty", "sequence_ids is missing"]
    stats = {r["metric"]: r["value"] for r in sequences.sequence_statistics(sequence_table).collect()}
    assert stats["total_sequences"] == 8 and stats["cpu_tokens"] == 6 and stats["memory_tokens"] == 3
    assert stats["empty_sequences"] == 1 and stats["missing_fields"] == 1 and stats["label_Normal"] == 2
    assert sequences.critical_sequences(sequence_table).count() == 2
    shares = {r["label"]: r["bias_detected"] for r in sequences.label_imbalance(sequence_table, 20).collect()}
    assert shares[0] is True and shares[1] is False


def test_combining(spark, sequence_table):
    narrow = spark.createDataFrame([([1], 1)], "sequence_ids array<int>, label int")
    out = combine.combine_sequences({"a": sequence_table, "b": narrow, "c": None})
    assert dict(out.dtypes)["sequence_ids"] == "array<bigint>"
    by = {r["source_dataset"]: r["count"] for r in combine.records_by_source(out, ["a", "b", "c"]).collect()}
    assert by == {"a": 8, "b": 1, "c": 0}
    with pytest.raises(FileNotFoundError):
        combine.combine_sequences({"c": None})
    one = spark.createDataFrame([(1, "x")], "m int, extra string")
    two = spark.createDataFrame([(2,)], "m int")
    rows = combine.combine_chats({"p": one, "q": two}).orderBy("m").collect()
    assert [(r["extra"], r["source_dataset"]) for r in rows] == [("x", "p"), (None, "q")]


def test_combining_json_lines(spark):
    rows = [('{"a": 1}', "p"), (" {} ", "p"), ("", "p"), ("{bad", "q"), ('{"b": {"c": "}"}} ', "q"),
            ('{"a": 1} trailing', "q"), ("[1]", "q")]
    out = combine.combine_json_lines(spark.createDataFrame(rows, "value string, source_dataset string"))
    assert sorted(json.dumps(json.loads(r["record"]), sort_keys=True) for r in out.collect()) == [
        '{"a": 1, "source_dataset": "p"}', '{"b": {"c": "}"}, "source_dataset": "q"}',
        '{"source_dataset": "p"}']


def test_alerts(spark):
    few = spark.createDataFrame([("x",)] * 10, "k string")
    many = spark.createDataFrame([(f"k{i}",) for i in range(11)], "k string")
    assert alerts.anomaly_alert(few, "p", "k").collect()[0]["severity"] == "warning"
    row = alerts.anomaly_alert(many, "p", "k").collect()[0]
    assert row["severity"] == "error" and json.loads(row["details"])["types"].count(",") == 10
    row = alerts.anomaly_alert(many, "p", "k", named=5).collect()[0]
    assert json.loads(row["details"])["types"].count(",") == 4
    assert alerts.anomaly_alert(few.limit(0), "p", "k").count() == 0
    bias = spark.createDataFrame([(True, "high"), (True, "low"), (False, "none")],
                                 "is_biased boolean, severity string")
    row = alerts.bias_alert(bias, "p").collect()[0]
    assert row["severity"] == "error" and row["message"] == "Bias in 2 slices of p"
    history = spark.range(5).select(F.col("id").alias("timestamp"), F.col("id").alias("v"))
    out = alerts.append_history(history, spark.range(1).select(F.col("id").alias("v")), F.lit(9), 3)
    assert [r["timestamp"] for r in out.collect()] == [9, 4, 3]


def test_sources(spark, tmp_path):
    path = tmp_path / "usage.csv"
    path.write_text("10,m_1,5.0,95.0,0,0,0,x\n20,m_2,,10,0,0,0,\n")
    usage = files.read_positional_csv(spark, str(path), files.SERVER_USAGE).collect()
    assert usage[0]["cpu_util_percent"] == 5.0 and usage[1]["cpu_util_percent"] is None
    path = tmp_path / "q.csv"
    path.write_text('Id,Title,Body,Tags,Score,ViewCount,AcceptedAnswerId,CreationDate\n'
                    '1,"a ""b""","line\nbreak",<x>,7,1,2,d\n')
    row = files.read_wide_text_csv(spark, str(path), files.QUESTIONS).collect()[0]
    assert (row["Title"], row["Body"]) == ('a "b"', "line\nbreak")
    path = tmp_path / "lines.jsonl"
    path.write_text('{"a": 1}\n\n{bad\n{"a": 2} x\n{"a": 3}\n')
    counts = files.line_counts(files.read_checked_json_lines(spark, str(path))).collect()[0]
    assert (counts["total"], counts["valid"], counts["malformed"]) == (4, 2, 2)
    path = tmp_path / "doc.json"
    path.write_text('[{"a": 1},\n {"a": 2}]')
    target = str(tmp_path / "parquet")
    files.json_to_parquet(spark, str(path), target, "a int")
    assert sorted(r["a"] for r in files.read_parquet(spark, target, ["a"]).collect()) == [1, 2]
    assert files.first_rows(spark.range(9), None, ["id"]).count() == 9
    assert [r["id"] for r in files.first_rows(spark.range(9), 2, ["id"]).collect()] == [0, 1]


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    rows = [("spark", f"24/01/01 00:{m:02d}:{s:02d}", "ERROR" if s % 2 else "INFO", "c", "E1", "t",
             "connection refused" if s == 3 else "m", str(m * 10 + s), "{}", "")
            for m in range(30) for s in range(4)]
    events = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rules.EVENT_COLUMNS))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.write.parquet(source)
    incoming = spark.readStream.schema(events.schema).parquet(source)
    query = stream.write_counts(stream.windowed_counts(incoming), out, str(tmp_path / "cp"))
    query.awaitTermination(120)
    done = spark.read.parquet(out)
    # windows the watermark has passed: all but the last eleven minutes
    assert done.select("window_start").distinct().count() >= 19
    closed = done.groupBy("event_type").agg(F.sum("total").alias("n"), F.sum("error_count").alias("e"))
    by = {r["event_type"]: r for r in closed.collect()}
    windows = done.select("window_start").distinct().count()
    assert by["network_issue"]["n"] == windows and by["network_issue"]["e"] == windows


def test_scratch_paths_are_shared_and_fresh(spark):
    first, second = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert first != second and first.startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))


def test_merged_and_single_scan_normalisation_agree(spark):
    from opsloom.plans.bindings import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    merged = logs.merge_events({s: logs.normalize(t.raw_log(s), s) for s in rules.LOG_SYSTEMS})
    assert merged.exceptAll(t.unified()).count() == 0 and merged.count() == t.unified().count()
