import hashlib

import pytest
from pyspark.sql import functions as F

from opsloom.functions import logs as columns
from opsloom.functions import rules
from opsloom.operators import logs


@pytest.mark.parametrize("message, expected", [
    ("authentication failure; logname=", "ERROR"), ("Failed password for root", "ERROR"),
    ("connection timed out", "WARN"), ("service deprecated", "WARN"),
    ("session opened for user", "INFO"), ("", "INFO"), (None, "INFO"),
    ("timeout then error", "ERROR"), ("KERNEL PANIC", "ERROR"),
])
def test_linux_severity(one, message, expected):
    assert one(columns.linux_severity(F.col("m")), m=message) == expected


@pytest.mark.parametrize("state, flag, message, expected", [
    ("state_change.unavailable", "0", "x", "ERROR"), ("ok", "1", "x", "ERROR"),
    ("ok", " 1 ", "x", "ERROR"), ("degraded", "0", "x", "WARN"), ("ok", "0", "slow disk", "WARN"),
    ("ok", "0", "fatal", "ERROR"), ("ok", "0", "fine", "INFO"), (None, None, None, "INFO"),
])
def test_hpc_severity(one, state, flag, message, expected):
    out = columns.hpc_severity(F.col("s"), F.col("f"), F.col("m"))
    assert one(out, s=state, f=flag, m=message) == expected


@pytest.mark.parametrize("system, level, message, expected", [
    ("hdfs", "INFO", "error here", "INFO"), ("hdfs", " fatal ", "x", "ERROR"),
    ("hdfs", "WARNING", "x", "WARN"), ("hdfs", "custom", "corrupt block", "ERROR"),
    ("spark", "custom", "corrupt block", "INFO"), ("hadoop", None, "fallback used", "WARN"),
    ("hdfs", None, "fallback used", "INFO"), ("hadoop", "TRACE", "x", "INFO"),
])
def test_level_severity(one, system, level, message, expected):
    out = columns.level_severity(F.col("l"), F.col("m"), system)
    assert one(out, l=level, m=message) == expected


@pytest.mark.parametrize("message, template, severity, expected", [
    ("pam_unix check", "t", "INFO", "auth_failure"),
    ("Failed password; access denied", "t", "ERROR", "auth_failure"),
    ("not permitted", "t", "INFO", "permission_denied"),
    ("java heap space", "t", "INFO", "compute_oom"),
    ("connection refused", "t", "INFO", "network_issue"),
    ("plain", "Kernel Panic", "INFO", "system_crash"),
    ("some error", "t", "INFO", "job_failed"),
    ("plain", "t", "INFO", "normal_ops"), ("plain", "t", "WARN", "unknown"),
    ("some error", None, "INFO", "normal_ops"),  # a missing template leaves the severity rule
])
def test_event_type(one, message, template, severity, expected):
    out = columns.event_type(F.col("m"), F.col("t"), F.col("s"))
    assert one(out, m=message, t=template, s=severity) == expected


@pytest.mark.parametrize("system, timestamp, bucket", [
    ("hadoop", "2015-10-18 18:01:47,978", "2015-10-18 18:01"),
    ("spark", "17/06/09 20:10:40", "17/06/09 20:10"), ("hdfs", "081109 203615", "081109 2036"),
    ("linux", "Jun 14 15:16:01", "Jun 14 15:16"), ("hpc", "1077804742", "1077804"),
    ("hpc", "107", "107"), ("hdfs", "0811092036155", "081109203"),
    ("linux", "nospacehere!", "nospaceher"), ("linux", None, "None"),
])
def test_time_bucket(one, system, timestamp, bucket):
    out = columns.time_bucket(F.col("t"), F.col("s"))
    assert one(out, t=timestamp, s=system) == bucket


@pytest.mark.parametrize("text, parsed", [
    ("1077804742", "2004-02-26 14:12:22"), ("Jun 14 15:16:01", "1970-06-14 15:16:01"),
    ("Jun  4 15:16:01", "1970-06-04 15:16:01"), ("081109 203615", "2008-11-09 20:36:15"),
    ("17/06/09 20:10:40", "2017-06-09 20:10:40"),
    ("2015-10-18 18:01:47,978", "2015-10-18 18:01:47.978"),
    ("2015-10-18 18:01:47", "2015-10-18 18:01:47"), ("n/a", None), ("", None), (None, None),
    ("99999999999999999999999", None),
])
def test_parse_timestamp(one, text, parsed):
    assert one(columns.parse_timestamp(F.col("t")).cast("string"), t=text) == parsed


def test_event_number_and_label(one):
    assert one(columns.event_number(F.col("e")), e="E55") == 55
    assert one(columns.event_number(F.col("e")), e="X5") is None
    label = columns.event_label(F.col("k"), F.col("t"))
    assert one(label, k="compute_oom", t="x") == 1
    assert one(label, k="compute_oom", t="Request TIMEOUT") == 3
    assert one(label, k="auth_failure", t="Verification failed") == 4
    assert one(label, k="never heard of", t=None) == 0


@pytest.mark.parametrize("modulus", [2, 10, 97, 100, 1000003])
def test_stable_hash_equals_the_whole_integer(spark, modulus):
    keys = [f"linux:{i}" for i in range(200)]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    out = frame.select("k", columns.stable_hash_mod(F.col("k"), modulus).alias("h")).collect()
    for row in out:
        assert row["h"] == int(hashlib.md5(row["k"].encode()).hexdigest(), 16) % modulus


def test_sample_is_repeatable_and_near_ten_percent(spark):
    events = spark.range(2000).select(
        F.lit("hdfs").alias("system"), F.col("id").cast("string").alias("raw_id")
    )
    first = {r["raw_id"] for r in logs.sample_events(events, 10).collect()}
    second = {r["raw_id"] for r in logs.sample_events(events.repartition(7), 10).collect()}
    assert first == second and 100 <= len(first) <= 400


def test_merge_needs_every_system(spark):
    with pytest.raises(FileNotFoundError):
        logs.merge_events({"linux": spark.range(1)})


@pytest.fixture
def labelled(spark):
    kinds = ["job_failed", "normal_ops", "auth_failure", "network_issue"]
    rows = [
        (s, "2015-10-18 18:01:47,978", "ERROR" if i % 4 == 0 else "INFO", "src", f"E{i % 5 + 1}",
         f"template {i % 5 + 1}", f"m {i}", str(i), "{}", kinds[i % 4])
        for s in rules.LOG_SYSTEMS for i in range(20)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rules.EVENT_COLUMNS))


def test_aggregates(labelled):
    rates = logs.error_rate(labelled).collect()
    assert len(rates) == 5 and all(r["error_rate"] == 0.25 and r["total"] == 20 for r in rates)
    top = logs.top_templates(labelled, 3).collect()
    assert len(top) == 15
    assert sum(r["count"] for r in logs.event_counts(labelled).collect()) == 100


def test_joined_rate_equals_one_pass(labelled):
    events = logs.with_time_bucket(labelled)
    totals = events.groupBy("system", "time_bucket").agg(F.count("*").alias("total"))
    errors = events.filter("severity = 'ERROR' AND system <> 'hpc'").groupBy(
        "system", "time_bucket").agg(F.count("*").alias("error_count"))
    joined = {r["system"]: r["error_rate"] for r in logs.join_error_counts(totals, errors).collect()}
    assert joined["hpc"] == 0.0 and joined["linux"] == 0.25


def test_sequences_keep_the_last_events_nulls_and_the_label_of_all(spark):
    """A window larger than the length limit: last events stay, the label sees every row."""
    base = ["hadoop", "INFO", "s", "t", "m", "{}"]
    rows = []
    for i in range(700):
        kind = "permission_denied" if i == 0 else "normal_ops"
        event = "none" if i == 699 else f"E{i}"
        rows.append((base[0], f"2015-10-18 18:01:{i // 20:02d},{i % 20:03d}", base[1], base[2],
                     event, base[3], base[4], f"{i:05d}", base[5], kind))
    rows.append(("linux", "unreadable", "INFO", "s", "E7", "t", "m", "1", "{}", "normal_ops"))
    events = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rules.EVENT_COLUMNS))
    out = {r["system"]: r for r in logs.event_sequences(events).collect()}
    assert out["hadoop"]["sequence_ids"] == [*range(188, 699), None]
    assert out["hadoop"]["label"] == 6
    assert out["linux"]["window"] is None
    assert out["linux"]["sequence_ids"] == [7] + [0] * 511


def test_hot_window_is_limited_before_the_shuffle(labelled):
    plan = logs.event_sequences(labelled)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_quality_gate(labelled, spark):
    templates = spark.createDataFrame(
        [(f"E{i}", s, "t") for i in range(1, 5) for s in ("linux", "linux")],
        "EventId string, system string, EventTemplate string")
    result = {r["check"]: r["success"]
              for r in logs.quality_gate(labelled, templates, expected_rows=100).collect()}
    assert result["sampling_sanity"] and result["columns_present"] and result["event_id_pattern"]
    assert not result["template_coverage"] and not result["template_no_duplicates"]


def test_windows_without_time_are_limited_in_parts(spark):
    """All rows share the null window; the last ones come out, however many parts there are."""
    rows = spark.range(4000).selectExpr(
        "'linux' AS system", "CAST(id AS STRING) AS raw_id", "'no time' AS timestamp", "'INFO' AS severity",
        "concat('E', id) AS event_id", "'t' AS event_template", "'m' AS message", "'normal' AS event_type",
    ).repartition(16)
    for length in (512, 2000):
        [row] = logs.event_sequences(rows, length).collect()
        last = sorted(map(str, range(4000)), reverse=True)[:length]
        assert [t for t in row["sequence_ids"] if t] == [int(x) for x in last if int(x)][::-1]
