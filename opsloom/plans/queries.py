"""Named queries: one per operator of the inventory, each over the whole bound tables.

The prefix of a name is the operator's inventory id. List results are joined into text so
that they compare order-sensitively as plain values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.functions import chats as chat_columns
from opsloom.functions import corpus as corpus_columns
from opsloom.functions import logs as log_columns
from opsloom.functions import json_schema, rules, text
from opsloom.functions import traces as trace_columns
from opsloom.operators import (
    alerts, balance, chats, combine, corpus, json_paths, logs, profile, qa, quality, selection,
    sequences, traces, workflows,
)
from opsloom.plans.bindings import Tables
from opsloom.session import checkpointed, scratch_path
from opsloom.sources import files, json_arrays, snapshots
from opsloom.streaming import traces as machine_streams

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def joined(values: Column | str) -> Column:
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(values.cast("array<string>"), ",", "null")


def written(t: Tables, name: str, write: Callable[[str], None]) -> str:
    path = scratch_path(t.spark, name)
    write(path)
    return path


# --- A: sources and sinks ----------------------------------------------------------------

@query
def a1_positional_csv(t: Tables) -> DataFrame:
    path = written(t, "usage", lambda p: files.write_csv(t.usage(), p, header=False))
    usage = files.read_positional_csv(t.spark, path, files.SERVER_USAGE)
    return usage.select("time_stamp", "machine_id", "cpu_util_percent", "mem_util_percent")


@query
def a2_text_csv(t: Tables) -> DataFrame:
    path = written(t, "hdfs", lambda p: files.write_csv(t.raw_log("hdfs"), p))
    lines = files.read_text_csv(t.spark, path)
    return lines.select("LineId", "Date", "Time", "Level", "Content", "EventId")


@query
def a3_questions_csv(t: Tables) -> DataFrame:
    path = written(t, "questions", lambda p: files.write_csv(t.questions(), p))
    raw = files.read_wide_text_csv(t.spark, path, files.QUESTIONS)
    return _question_columns(qa.clean_questions(raw))


def _question_columns(questions: DataFrame) -> DataFrame:
    return questions.select(
        "question_id", "title", F.md5("body").alias("body_md5"), "score", "accepted_answer_id",
        joined("tags").alias("tags"), "view_count", "creation_date",
    )


@query
def a4_answers_csv(t: Tables) -> DataFrame:
    ordered = t.answers().orderBy("row_order").drop("row_order")
    path = written(t, "answers", lambda p: files.write_csv(ordered, p))
    raw = files.read_wide_text_csv(t.spark, path, files.ANSWERS)
    answers = qa.clean_answers(raw, "row_order")
    return answers.select("question_id", "answer_id", F.md5("body").alias("body_md5"), "score")


CUSTOMER = "c_custkey bigint, c_name string, c_acctbal double"


def _customer_documents(t: Tables) -> str:
    """JSON array documents of at most 1000 customers each."""
    row = F.struct("c_custkey", "c_name", "c_acctbal")
    documents = t.read("customer").groupBy(F.floor(F.col("c_custkey") / 1000)).agg(
        F.to_json(F.collect_list(row)).alias("value")
    ).select("value")
    return written(
        t, "documents", lambda p: documents.write.option("maxRecordsPerFile", 1).text(p)
    )


@query
def a5_json_document(t: Tables) -> DataFrame:
    return files.read_json_document(t.spark, _customer_documents(t), CUSTOMER)


@query
def a5_split_json_array(t: Tables) -> DataFrame:
    """Records with braces, quotes and escapes in their strings, read in splits."""
    odd = F.concat("c_name", F.lit(' }"{ \\ ['))
    row = F.struct("c_custkey", odd.alias("c_name"), F.struct("c_acctbal").alias("account"))
    documents = t.read("customer").groupBy(F.floor(F.col("c_custkey") / 1000)).agg(
        F.to_json(F.collect_list(row)).alias("value")
    ).select("value")
    path = written(t, "arrays", lambda p: documents.write.option("maxRecordsPerFile", 1).text(p))
    records = json_arrays.read_json_array(
        t.spark, path, "c_custkey bigint, c_name string, account struct<c_acctbal: double>"
    )
    return records.select("c_custkey", "c_name", "account.c_acctbal")


def _customer_lines(t: Tables) -> DataFrame:
    good = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal"))
    return t.read("customer").select(F.explode(F.array(
        F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("{broken "), good)).otherwise(good),
        F.lit(""),
    )).alias("value"))


@query
def a6_json_lines(t: Tables) -> DataFrame:
    lines = _customer_lines(t).filter(~F.col("value").startswith("{broken"))
    path = written(t, "lines", lambda p: lines.write.text(p))
    return files.read_json_lines(t.spark, path, CUSTOMER)


@query
def a7_checked_json_lines(t: Tables) -> DataFrame:
    path = written(t, "lines", lambda p: _customer_lines(t).write.text(p))
    return files.line_counts(files.read_checked_json_lines(t.spark, path))


@query
def a8_parquet_folder(t: Tables) -> DataFrame:
    path = written(t, "orders", lambda p: files.write_parquet(t.read("orders"), p, 5000))
    return files.read_parquet(t.spark, path).groupBy("o_orderstatus").agg(
        F.count("*").alias("count"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query
def a9_bounded_parquet(t: Tables) -> DataFrame:
    path = written(t, "orders", lambda p: files.write_parquet(t.read("orders"), p, 1000))
    per_file = files.read_parquet(t.spark, path).groupBy("_metadata.file_path").agg(
        F.count("*").alias("n")
    )
    return per_file.agg(
        F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("all_within_limit")
    )


@query
def a10_csv_sink(t: Tables) -> DataFrame:
    path = written(t, "counts", lambda p: files.write_csv(logs.event_counts(t.labelled()), p))
    return files.read_text_csv(t.spark, path)


@query
def a11_json_lines_sink(t: Tables) -> DataFrame:
    records = qa.chat_records(t.features())
    path = written(t, "chat", lambda p: files.write_json_lines(records, p))
    back = files.read_json_lines(t.spark, path, records.schema)
    return back.select(
        F.col("metadata.question_id").alias("question_id"),
        F.array_size("messages").alias("n_messages"),
        F.md5(F.col("messages")[1]["content"]).alias("question_md5"),
        F.col("metadata.quality_score").alias("quality_score"),
    )


@query
def a12_json_to_parquet(t: Tables) -> DataFrame:
    source = _customer_documents(t)
    path = written(
        t, "interim", lambda p: files.json_to_parquet(t.spark, source, p, CUSTOMER)
    )
    return files.read_parquet(t.spark, path)


@query
def a13_first_rows(t: Tables) -> DataFrame:
    return files.first_rows(t.read("documents").select("doc_id", "lang"), 500, ["doc_id"])


@query
def a14_pruned_scan(t: Tables) -> DataFrame:
    columns = ["l_returnflag", "l_quantity"]
    scan = files.read_parquet(t.spark, f"{t.folder}/lineitem.parquet", columns)
    return scan.groupBy("l_returnflag").agg(
        F.count("*").alias("count"), F.sum("l_quantity").alias("quantity")
    )


# --- B: projections and filters -----------------------------------------------------------

@query
def b1_normalize_logs(t: Tables) -> DataFrame:
    return t.unified()


@query
def b2_constant_tag(t: Tables) -> DataFrame:
    tagged = combine.tag_source(logs.normalize(t.raw_log("linux"), "linux"), "ds_logs")
    return tagged.select("system", "raw_id", "source_dataset")


@query
def b3_null_fill(t: Tables) -> DataFrame:
    return traces.fill_task_defaults(t.tasks()).select("key", "status", "task_type")


@query
def b4_first_non_blank(t: Tables) -> DataFrame:
    return t.files().select("doc_id", corpus_columns.best_path().alias("path"))


@query
def b5_packed_columns(t: Tables) -> DataFrame:
    return logs.normalize(t.raw_log("hpc"), "hpc").select("raw_id", "message", "extras")


@query
def b6_admission(t: Tables) -> DataFrame:
    return t.pairs().select("question_id", qa.admitted(600, 400).alias("admitted"))


@query
def b7_question_filter(t: Tables) -> DataFrame:
    return qa.clean_questions(t.questions(), min_score=10).select("question_id", "score")


@query
def b8_filter_reason(t: Tables) -> DataFrame:
    return corpus.with_filter_reason(t.files()).select("doc_id", "reason")


@query
def b9_kubernetes_gates(t: Tables) -> DataFrame:
    content = F.coalesce("content", F.lit(""))
    return t.files().select(
        "doc_id", corpus_columns.kubernetes_gates(content).alias("all_gates"),
        corpus_columns.kubernetes_gates(content, kind=False).alias("without_kind"),
    )


@query
def b10_keyword_modes(t: Tables) -> DataFrame:
    content = F.coalesce("content", F.lit(""))
    gates = corpus_columns.kubernetes_gates(content)
    word = corpus_columns.has_keyword(content, ["ml_gpu", "kserve_seldon", "mlops"])
    return t.files().select(
        "doc_id", word.alias("has_keyword"), (gates & word).alias("strict"),
        (gates | word).alias("lenient"),
    )


@query
def b11_licenses(t: Tables) -> DataFrame:
    names = corpus_columns.licenses()
    allowed = F.array(*[F.lit(x) for x in rules.PERMISSIVE_LICENSES])
    return t.files().select(
        "doc_id", joined(names).alias("licenses"),
        F.arrays_overlap(names, allowed).alias("permissive"),
    )


@query
def b12_curated_reason(t: Tables) -> DataFrame:
    return corpus.curate(t.files(), keep=["doc_id"]).select(
        "doc_id", "reason", F.md5(F.col("messages")[0]["content"]).alias("prompt_md5")
    )


@query
def b13_lookup_tokens(t: Tables) -> DataFrame:
    kind = F.lower(F.coalesce("event_type", F.lit("unknown")))
    return t.machine_events().select("key", trace_columns.event_token(kind).alias("token"))


# --- C: joins --------------------------------------------------------------------------------

@query
def c1_error_join(t: Tables) -> DataFrame:
    events = logs.with_time_bucket(t.labelled())
    totals = events.groupBy("system", "time_bucket").agg(F.count("*").alias("total"))
    errors = events.filter(F.col("severity") == "ERROR").groupBy("system", "time_bucket").agg(
        F.count("*").alias("error_count")
    )
    return logs.join_error_counts(totals, errors)


def _pair_view(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "question_id", "title", F.md5("question_body").alias("question_md5"), "score",
        "view_count", F.md5("answer_body").alias("answer_md5"), "answer_score",
    )


@query
def c2_pair_by_question(t: Tables) -> DataFrame:
    return _pair_view(t.pairs())


@query
def c3_pair_by_accepted(t: Tables) -> DataFrame:
    answers = qa.clean_answers(t.answers(), "row_order")
    return _pair_view(qa.pair_by_accepted(qa.clean_questions(t.questions()), answers))


@query
def c4_filter_templates(t: Tables) -> DataFrame:
    return logs.filter_templates(t.templates(), t.unified())


@query
def c5_missing_templates(t: Tables) -> DataFrame:
    return logs.missing_templates(t.unified(), t.templates())


@query
def c6_unprocessed_prompts(t: Tables) -> DataFrame:
    done = workflows.mark_processed(
        t.prompts().filter(F.col("id") % 3 == 0), t.prompts().filter(F.col("id") % 5 == 0)
    )
    return workflows.unprocessed(t.prompts(), done).select("id")


@query
def c6_committed_marks(t: Tables) -> DataFrame:
    """Two marks as commits of a snapshot table; the rows each changed, and what is left."""
    table = snapshots.SnapshotTable(t.spark, scratch_path(t.spark, "processed"), t.prompts().select("id").schema)
    first = snapshots.mark(table, t.prompts().filter(F.col("id") % 3 == 0))
    second = snapshots.mark(table, t.prompts().filter(F.col("id") % 5 == 0))
    return workflows.unprocessed(t.prompts(), table.read()).select(
        "id", F.lit(first).cast("bigint").alias("first_changed"), F.lit(second).cast("bigint").alias("second_changed")
    )


@query
def c7_pair_workflows(t: Tables) -> DataFrame:
    generated = t.prompts().select("id", "workflow_json")
    return workflows.pair_workflows(t.prompts().drop("workflow_json"), generated).select(
        "id", "tool_context", "workflow_json"
    )


@query
def c8_rows_of_top_values(t: Tables) -> DataFrame:
    rows = profile.rows_of_top_values(t.tasks(), "task_type", 5)
    return rows.groupBy("task_type").agg(F.count("*").alias("count"))


# --- D: aggregations ----------------------------------------------------------------------

@query
def d1_event_counts(t: Tables) -> DataFrame:
    return logs.event_counts(t.labelled())


@query
def d2_error_rate(t: Tables) -> DataFrame:
    return logs.error_rate(t.labelled())


@query
def d3_value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.labelled(), "event_template")


@query
def d4_value_shares(t: Tables) -> DataFrame:
    return profile.share_of_values(traces.fill_task_defaults(t.tasks()), "status", 40.0)


@query
def d5_null_rates(t: Tables) -> DataFrame:
    return profile.null_rates(t.labelled())


@query
def d6_distinct_counts(t: Tables) -> DataFrame:
    return profile.distinct_counts(t.labelled(), ["event_id", "event_template", "source"])


@query
def d7_dataset_statistics(t: Tables) -> DataFrame:
    return profile.dataset_statistics(
        t.labelled(), ["system", "severity", "event_type"], ["event_id", "event_template"]
    )


@query
def d8_numeric_profile(t: Tables) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    numbers = profile.numeric_profile(t.read("lineitem"), columns)
    return numbers.select("column", "count", *[
        F.round(c, 4).alias(c) for c in ["mean", "std", "min", "max", "q25", "median", "q75"]
    ])


@query
def d9_text_profile(t: Tables) -> DataFrame:
    return profile.text_profile(t.read("documents"), ["text", "lang"])


@query
def d10_table_profile(t: Tables) -> DataFrame:
    out = profile.table_profile(t.read("customer"))
    return out.select(
        "column", "dtype", "null_count", "null_pct", "count",
        *[F.round(c, 4).alias(c) for c in ["mean", "std", "min", "max", "q25", "median", "q75"]],
        "n_unique", "min_length", "max_length", "mean_length", "total_bytes",
    )


@query
def d11_list_value_counts(t: Tables) -> DataFrame:
    return profile.top_list_values(t.features(), "infra_components", 20)


@query
def d12_sequence_statistics(t: Tables) -> DataFrame:
    return sequences.sequence_statistics(t.sequences())


@query
def d13_event_sequences(t: Tables) -> DataFrame:
    return logs.event_sequences(t.labelled()).select(
        "system", F.date_format("window", "yyyy-MM-dd HH:mm:ss").alias("window"),
        F.md5(joined("sequence_ids")).alias("sequence_md5"), "label",
    )


@query
def d14_event_type_by_system(t: Tables) -> DataFrame:
    return logs.event_type_by_system(t.labelled())


@query
def d15_system_profile(t: Tables) -> DataFrame:
    return logs.system_profile(t.labelled())


@query
def d16_duplicate_pairs(t: Tables) -> DataFrame:
    doubled = t.templates().unionByName(t.templates().filter(F.col("system") == "spark"))
    return logs.duplicate_templates(doubled)


@query
def d17_keyword_totals(t: Tables) -> DataFrame:
    return corpus.keyword_totals(t.files())


@query
def d17_one_pass_totals(t: Tables) -> DataFrame:
    return corpus.keyword_totals(t.files(), one_pass=True)


@query
def d18_license_counts(t: Tables) -> DataFrame:
    return corpus.license_counts(t.files())


@query
def d19_corpus_report(t: Tables) -> DataFrame:
    return corpus.corpus_report(t.files())


@query
def d20_diagnostics(t: Tables) -> DataFrame:
    return corpus.diagnostics(t.files())


@query
def d21_drop_counts(t: Tables) -> DataFrame:
    return corpus.drop_counts(corpus.curate(t.files()))


@query
def d22_group_rates(t: Tables) -> DataFrame:
    marked = t.read("documents").join(t.read("labels"), "doc_id")
    rates = profile.group_rates(marked, F.col("toxic") == 1, "lang")
    spread = profile.rate_difference(rates, 0.01)
    return rates.select("group", F.round("selection_rate", 6).alias("selection_rate"), "count"
                        ).unionByName(spread.select(
                            F.lit("difference").alias("group"),
                            F.round("difference", 6).alias("selection_rate"),
                            F.col("bias_detected").cast("bigint").alias("count")))


@query
def d23_chat_slices(t: Tables) -> DataFrame:
    summary = chats.slice_summary(chats.add_slice_features(t.call_features()))
    return summary.select(
        "slice_column", "slice_value", "count", F.round("avg_turns", 6).alias("avg_turns"),
        F.round("avg_calls", 6).alias("avg_calls"), "malformed_count",
        F.round("error_handling_pct", 6).alias("error_handling_pct"), "proportion",
        "is_underrepresented",
    )


@query
def d24_record_slices(t: Tables) -> DataFrame:
    return corpus.slice_shares(corpus.record_fields(t.records()))


@query
def d25_length_profile(t: Tables) -> DataFrame:
    return corpus.length_profile(corpus.record_violations(t.record_lines()))


@query
def d26_violation_counts(t: Tables) -> DataFrame:
    return corpus.validation_report(corpus.record_violations(t.record_lines()))


@query
def d27_records_by_source(t: Tables) -> DataFrame:
    return combine.records_by_source(t.combined(), ["traces", "logs", "absent"])


@query
def d28_anomaly_breakdown(t: Tables) -> DataFrame:
    return sequences.anomaly_breakdown(t.sequences())


@query
def d29_processing_summary(t: Tables) -> DataFrame:
    row = chats.processing_summary(t.call_features())
    return row.select("total_records", F.round("avg_turns", 6).alias("avg_turns"),
                      F.round("avg_calls", 6).alias("avg_calls"), "malformed_calls")


@query
def d30_parse_quality(t: Tables) -> DataFrame:
    return logs.parse_quality(t.labelled())


@query
def d31_yields(t: Tables) -> DataFrame:
    row = qa.pipeline_yield(
        qa.clean_questions(t.questions()), qa.clean_answers(t.answers(), "row_order")
    )
    return row.withColumn("avg_quality_score", F.round("avg_quality_score", 4))


# --- E: windows, ranking, dedup, split --------------------------------------------------------

def _window_view(windows: DataFrame) -> DataFrame:
    return windows.withColumn("sequence_ids", joined("sequence_ids"))


@query
def e1_usage_windows(t: Tables) -> DataFrame:
    return _window_view(traces.usage_windows(t.usage()))


@query
def e2_machine_windows(t: Tables) -> DataFrame:
    return _window_view(traces.usage_windows(t.usage(), 3, ["machine_id"]))


@query
def e2_streamed_windows(t: Tables) -> DataFrame:
    """The events table as a stream, in one trigger; readings of the last second stay open."""
    windows = machine_streams.machine_windows(t.usage_stream(), 3, "0 seconds")
    path = scratch_path(t.spark, "streamed-windows")
    machine_streams.write_windows(windows, path, scratch_path(t.spark, "streamed-state")).awaitTermination()
    return _window_view(t.spark.read.schema(windows.schema).parquet(path))


@query
def e3_minute_windows(t: Tables) -> DataFrame:
    fields = logs.with_sequence_fields(t.labelled())
    return fields.groupBy(
        "system", F.date_format("window", "yyyy-MM-dd HH:mm:ss").alias("window")
    ).agg(F.count("*").alias("count"))


@query
def e4_time_buckets(t: Tables) -> DataFrame:
    return logs.with_time_bucket(t.unified()).select(
        "system", "raw_id", "message", "time_bucket"
    )


@query
def e5_top_templates(t: Tables) -> DataFrame:
    return logs.top_templates(t.labelled())


@query
def e6_rank_by_quality(t: Tables) -> DataFrame:
    return qa.rank_by_quality(t.features()).select("question_id", "quality_score")


@query
def e7_first_by_key(t: Tables) -> DataFrame:
    slim = t.files().select("doc_id", "hexsha", "size", "max_stars_repo_name")
    return corpus.first_by_key(slim, "hexsha", ["doc_id"])


@query
def e8_distinct_subset(t: Tables) -> DataFrame:
    return t.unified().select("event_id", "system").dropDuplicates(["event_id", "system"])


@query
def e9_train_test_split(t: Tables) -> DataFrame:
    return balance.train_test_split(
        t.read("documents").select("doc_id", "lang"), "doc_id", 0.2, 42
    )


@query
def e10_latest_rows(t: Tables) -> DataFrame:
    history = t.read("events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "event_id"
    )
    return alerts.latest(history, 1000)


# --- F: set operations -----------------------------------------------------------------------

@query
def f1_merge_events(t: Tables) -> DataFrame:
    normalized = {s: logs.normalize(t.raw_log(s), s) for s in rules.LOG_SYSTEMS}
    merged = logs.merge_events(normalized)
    return merged.select("system", "timestamp", "severity", "event_id", "raw_id", "extras")


@query
def f2_combine_sequences(t: Tables) -> DataFrame:
    return t.combined().groupBy(
        "source_dataset", "label", joined("sequence_ids").alias("sequence_ids")
    ).agg(F.count("*").alias("count"))


@query
def f3_combine_chats(t: Tables) -> DataFrame:
    combined = combine.combine_chats({
        "qa": qa.chat_records(t.features()),
        "calls": chats.chat_messages(t.call_features()),
        "workflows": workflows.workflow_records(
            t.prompts().filter(F.col("workflow_json").isNotNull())),
        "corpus": t.records(),
    })
    typed = combined.groupBy("source_dataset").agg(
        F.count("*").alias("records"), F.count("metadata").alias("with_metadata"),
        F.count("complexity_tier").alias("with_tier"), F.count("_meta").alias("with_meta"),
    )
    lines = combine.combine_json_lines(t.combined_lines())
    return typed.unionByName(lines.groupBy(
        F.concat(F.lit("lines_"), F.get_json_object("record", "$.source_dataset"))
        .alias("source_dataset")
    ).agg(
        F.count("*").alias("records"), F.lit(0).cast("bigint").alias("with_metadata"),
        F.lit(0).cast("bigint").alias("with_tier"), F.lit(0).cast("bigint").alias("with_meta"),
    ))


@query
def f4_set_difference(t: Tables) -> DataFrame:
    return quality.disallowed_values(
        t.labelled(), "event_type", ["normal_ops", "job_failed", "unknown"]
    )


@query
def f4_field_differences(t: Tables) -> DataFrame:
    """Missing and extra fields of the answered questions as JSON records."""
    changed = t.features().withColumn("note", F.lit("x")).drop("title", "view_count")
    lines = changed.select(F.to_json(F.struct(*changed.columns)).alias("line"))
    return quality.field_differences(
        workflows.json_fields(lines, "line"), rules.QA_REQUIRED_COLUMNS,
        [*rules.QA_KNOWN_COLUMNS, *rules.QA_SIDE_COLUMNS],
    )


# --- G: scalar functions ------------------------------------------------------------------------

def _severity_view(t: Tables, system: str) -> DataFrame:
    return logs.normalize(t.raw_log(system), system).select("raw_id", "message", "severity")


@query
def g1_linux_severity(t: Tables) -> DataFrame:
    return _severity_view(t, "linux")


@query
def g2_hpc_severity(t: Tables) -> DataFrame:
    return _severity_view(t, "hpc")


@query
def g3_level_severity(t: Tables) -> DataFrame:
    frames = [
        _severity_view(t, s).withColumn("system", F.lit(s)) for s in ("hdfs", "hadoop", "spark")
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query
def g4_event_type(t: Tables) -> DataFrame:
    return t.labelled().select("raw_id", "system", "message", "event_type")


@query
def g5_event_label(t: Tables) -> DataFrame:
    label = log_columns.event_label("event_type", "event_template")
    return t.labelled().select("raw_id", "system", "message", label.alias("event_label"))


@query
def g6_event_number(t: Tables) -> DataFrame:
    return t.unified().select(
        "raw_id", "system", "message", log_columns.event_number("event_id").alias("event_int")
    )


@query
def g7_join_timestamp(t: Tables) -> DataFrame:
    return t.raw_logs().select(
        "LineId",
        log_columns.join_timestamp("Month", "Date", "LogId", "Time").alias("joined"),
        log_columns.clean_part(F.when(F.col("Date") == "n/a", "nan").otherwise(F.col("LogId")))
        .alias("clean"),
    )


@query
def g8_parse_timestamp(t: Tables) -> DataFrame:
    parsed = log_columns.parse_timestamp("timestamp")
    return t.unified().select(
        "raw_id", "system", "message",
        F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSS").alias("parsed"),
    )


@query
def g9_stable_hash(t: Tables) -> DataFrame:
    key = F.concat("system", F.lit(":"), "raw_id")
    return t.unified().select(
        "system", "raw_id", "message",
        log_columns.stable_hash_mod(key, 100).alias("bucket"),
        log_columns.in_sample("system", "raw_id", 10).alias("kept"),
    )


@query
def g10_decile_tokens(t: Tables) -> DataFrame:
    return t.tasks().select(
        "key", trace_columns.cpu_token("plan_cpu").alias("cpu"),
        trace_columns.planned_memory_token("plan_mem").alias("mem"),
    )


@query
def g11_task_sequences(t: Tables) -> DataFrame:
    return _window_view(traces.task_sequences(t.tasks(), keep=["key"]))


@query
def g12_machine_event_sequences(t: Tables) -> DataFrame:
    return _window_view(traces.machine_event_sequences(t.machine_events(), keep=["key"]))


@query
def g13_fit_length(t: Tables) -> DataFrame:
    codes = F.transform(F.split("props", ""), lambda c: F.ascii(c).cast("bigint"))
    short = trace_columns.fit_length(codes, 5)
    long = trace_columns.fit_length(codes, 12)
    return t.read("events").select(
        "event_id", joined(short).alias("cut"), joined(long).alias("padded")
    )


@query
def g14_clean_html(t: Tables) -> DataFrame:
    return t.read("pages").select("page_id", F.md5(text.clean_html("html")).alias("clean_md5"))


@query
def g15_tag_list(t: Tables) -> DataFrame:
    return t.questions().select("Id", joined(text.tag_list("Tags")).alias("tags"))


@query
def g16_clean_text(t: Tables) -> DataFrame:
    return t.questions().select(
        "Id", F.md5(text.clean_text("Body")).alias("clean_md5"),
        F.md5(text.clean_text("Body", remove_code=True)).alias("without_code_md5"),
    )


@query
def g17_code_blocks(t: Tables) -> DataFrame:
    return t.questions().select(
        "Id", F.array_join(text.code_blocks("Body"), "|").alias("blocks"),
        F.md5(text.mask_code("Body")).alias("masked_md5"),
    )


@query
def g18_text_metrics(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", text.text_metrics("text").alias("m")).select(
        "doc_id", "m.*"
    )


@query
def g19_error_signatures(t: Tables) -> DataFrame:
    return t.questions().select("Id", joined(text.error_signatures("Body")).alias("names"))


@query
def g20_infra_components(t: Tables) -> DataFrame:
    return t.questions().select("Id", joined(text.infra_components("Body")).alias("names"))


@query
def g21_quality_score(t: Tables) -> DataFrame:
    return t.features().select("question_id", "quality_score")


@query
def g22_complexity(t: Tables) -> DataFrame:
    return t.questions().select("Id", text.complexity("Body").alias("complexity"))


@query
def g23_question_type(t: Tables) -> DataFrame:
    return t.questions().select("Id", text.question_type("Body").alias("question_type"))


@query
def g24_function_calls(t: Tables) -> DataFrame:
    calls = t.call_chats().select(
        "id", F.posexplode(chat_columns.function_calls("chat")).alias("position", "c")
    )
    return calls.select(
        "id", "position", F.col("c.name").alias("name"),
        F.col("c.n_arguments").alias("n_arguments"),
        F.col("c.malformed").alias("malformed"),
    )


@query
def g25_function_signatures(t: Tables) -> DataFrame:
    signature = chat_columns.function_signature("system")
    return t.call_chats().select(
        "id", signature["name"].alias("name"), signature["description"].alias("description"),
        joined(signature["parameters"]).alias("parameters"),
        joined(signature["required"]).alias("required"),
    )


@query
def g26_error_handling(t: Tables) -> DataFrame:
    return t.call_chats().select(
        "id", joined(chat_columns.error_words("chat")).alias("words"),
        chat_columns.has_function_error("chat").alias("function_error"),
        chat_columns.has_conditional_error("chat").alias("conditional_error"),
    )


@query
def g27_user_turns(t: Tables) -> DataFrame:
    calls = chat_columns.function_calls("chat")
    return t.call_chats().select(
        "id", chat_columns.user_turns("chat").alias("turns"),
        chat_columns.has_malformed(calls).alias("has_malformed"),
    )


@query
def g28_complexity_tier(t: Tables) -> DataFrame:
    calls = chat_columns.function_calls("chat")
    return t.call_chats().select("id", chat_columns.complexity_tier(calls).alias("tier"))


@query
def g29_call_features(t: Tables) -> DataFrame:
    features = t.call_features()
    return features.select(
        F.md5("chat").alias("chat_md5"), "num_turns", "num_calls", "complexity_tier",
        "has_parallel", "has_malformed", "num_defined_functions", "defined_function_names",
        F.get_json_object("function_signatures", "$.get_weather.required").alias("required"),
        "has_error_handling", "has_function_error_response", "has_conditional_error",
        "error_keywords_found",
    )


@query
def g30_chat_messages(t: Tables) -> DataFrame:
    records = chats.chat_messages(t.call_features())
    reply = F.col("messages")[2]["content"]
    return records.select(
        F.md5(F.col("messages")[1]["content"]).alias("user_md5"),
        F.get_json_object(reply, "$.workflow.steps[0].tool").alias("first_tool"),
        F.get_json_object(reply, "$.workflow.steps[1].tool").alias("second_tool"),
        F.get_json_object(reply, "$.message").alias("message"),
        "complexity_tier", "has_error_handling", "num_turns", "num_calls",
    )


@query
def g31_slice_buckets(t: Tables) -> DataFrame:
    features = chats.add_slice_features(t.call_features())
    return features.groupBy("turn_bucket", "call_bucket", "has_defined_functions").agg(
        F.count("*").alias("count")
    )


@query
def g32_redact(t: Tables) -> DataFrame:
    clean = corpus_columns.redact("text")
    return t.read("documents").select("doc_id", F.md5(clean).alias("clean_md5"))


@query
def g33_has_pii(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", corpus_columns.has_pii("text").alias("has_pii"))


@query
def g34_prompts(t: Tables) -> DataFrame:
    path = corpus_columns.best_path()
    return t.files().select(
        "doc_id", corpus_columns.synthesize_prompt(path).alias("prompt")
    )


@query
def g35_wrap_manifest(t: Tables) -> DataFrame:
    wrapped = corpus_columns.wrap_manifest(F.coalesce("content", F.lit("")))
    return t.files().select(
        "doc_id", F.get_json_object(wrapped, "$.tool").alias("tool"),
        F.md5(corpus_columns.manifest_of(wrapped)).alias("manifest_md5"),
    )


@query
def g36_manifest_type(t: Tables) -> DataFrame:
    content = F.coalesce("content", F.lit(""))
    return t.files().select(
        "doc_id", corpus_columns.manifest_type(content).alias("iac_type"),
        corpus_columns.manifest_type(content, terraform=True).alias("with_terraform"),
    )


@query
def g37_escape_difficulty(t: Tables) -> DataFrame:
    content = F.coalesce("content", F.lit(""))
    return t.files().select(
        "doc_id", corpus_columns.escape_difficulty(content, 15, 40).alias("difficulty")
    )


@query
def g38_size_bucket(t: Tables) -> DataFrame:
    return t.files().select("doc_id", corpus_columns.size_bucket("size").alias("bucket"))


@query
def g39_prompt_and_license_class(t: Tables) -> DataFrame:
    prompt = corpus_columns.synthesize_prompt(corpus_columns.best_path())
    return t.files().select(
        "doc_id", corpus_columns.prompt_type(prompt).alias("prompt_type"),
        corpus_columns.license_class(corpus_columns.licenses()).alias("license"),
    )


@query
def g40_chat_records(t: Tables) -> DataFrame:
    records = qa.chat_records(balance.quality_weights(t.features()))
    return records.select(
        F.col("metadata.question_id").alias("question_id"),
        F.col("messages")[0]["content"].alias("system"),
        F.md5(F.col("messages")[1]["content"]).alias("user_md5"),
        F.md5(F.col("messages")[2]["content"]).alias("assistant_md5"),
        joined("metadata.infra_components").alias("infra"),
        F.round("metadata.sample_weight", 6).alias("sample_weight"),
    )


@query
def g41_completion_records(t: Tables) -> DataFrame:
    return qa.completion_records(t.features()).select(
        F.col("metadata.question_id").alias("question_id"),
        F.md5("prompt").alias("prompt_md5"), F.md5("completion").alias("completion_md5"),
    )


@query
def g42_workflow_records(t: Tables) -> DataFrame:
    pairs = t.prompts().filter(F.col("workflow_json").isNotNull())
    return workflows.workflow_records(pairs).select(
        "id", F.col("messages")[0]["content"].alias("system"),
        F.md5(F.col("messages")[1]["content"]).alias("user_md5"),
        F.col("messages")[2]["content"].alias("assistant"),
    )


@query
def g43_workflow_valid(t: Tables) -> DataFrame:
    valid = F.coalesce(workflows.workflow_valid("workflow_json"), F.lit(False))
    return t.prompts().select("id", valid.alias("workflow_valid"))


@query
def g43_json_schema(t: Tables) -> DataFrame:
    fits = json_schema.conforms("workflow_json", rules.WORKFLOW_SCHEMA)
    return t.prompts().select("id", fits.alias("workflow_valid"))


# --- H: sampling, balancing, weights ------------------------------------------------------------

@query
def h1_balance_classes(t: Tables) -> DataFrame:
    stored = checkpointed(t.sequences())    # a stored table: balancing reads it twice
    return balance.balance_classes(stored, "key").select("key", "label", "copy")


@query
def h2_hash_sample(t: Tables) -> DataFrame:
    return logs.sample_events(t.unified(), 10).select("system", "raw_id", "message")


@query
def h3_oversample_slices(t: Tables) -> DataFrame:
    features = checkpointed(t.features())
    rare = qa.explode_slices(features).filter(F.col("slice").rlike("^(tag|error|infra)_"))
    wanted = rare.groupBy("slice").agg(F.count("*").alias("count")).select(
        "slice", F.lit("data_augmentation").alias("strategy"),
        F.when(F.col("count") < 50, "high").otherwise("medium").alias("priority"),
    )
    grown = balance.oversample_slices(features, wanted, "question_id")
    return grown.groupBy("question_id").agg(F.count("*").alias("copies"))


@query
def h4_quality_weights(t: Tables) -> DataFrame:
    return balance.quality_weights(t.features()).select(
        "question_id", F.round("sample_weight", 6).alias("sample_weight")
    )


@query
def h5_cap_class_share(t: Tables) -> DataFrame:
    kinds = t.files().select(
        "doc_id", corpus_columns.manifest_type(F.coalesce("content", F.lit("")))
        .alias("iac_type")
    )
    return balance.cap_class_share(kinds, "iac_type", "doc_id", 20.0)


@query
def h6_sampling_weight(t: Tables) -> DataFrame:
    kinds = t.files().select(
        corpus_columns.manifest_type(F.coalesce("content", F.lit(""))).alias("iac_type")
    )
    return balance.keep_ratios(kinds, "iac_type", 20.0).select(
        "iac_type", "count", F.round("pct", 4).alias("pct"),
        F.round("keep_ratio", 6).alias("keep_ratio"), "sampling_weight",
    )


# --- I: data quality ------------------------------------------------------------------------------

@query
def i1_columns_present(t: Tables) -> DataFrame:
    events = t.labelled()
    return quality.run_checks(events, [
        quality.columns_present(events, rules.EVENT_COLUMNS),
        quality.row_count(1),
    ])


@query
def i2_no_nulls(t: Tables) -> DataFrame:
    events = t.labelled()
    return quality.run_checks(events, [
        quality.no_nulls(events, ["event_id", "event_template", "message", "absent"])
    ])


@query
def i3_value_range(t: Tables) -> DataFrame:
    items = t.read("lineitem")
    return quality.run_checks(items, [
        quality.value_range(items, "l_quantity", 1, 45),
        quality.value_range(items, "l_discount", min_val=0),
        quality.value_range(items, "l_tax", max_val=0.05),
    ])


@query
def i4_allowed_values(t: Tables) -> DataFrame:
    tasks = t.tasks()
    return quality.run_checks(tasks, [
        quality.allowed_values(tasks, "status", ["Failed", "Terminated", "Waiting"]),
        quality.Check("allowed_status_or_null", quality.allowed_values(
            tasks, "status", ["Failed", "Terminated", "Waiting", None]).violations),
    ])


@query
def i5_row_count(t: Tables) -> DataFrame:
    return quality.run_checks(t.read("orders"), [quality.row_count(1, 100)])


@query
def i6_no_empty_strings(t: Tables) -> DataFrame:
    events = t.unified()
    return quality.run_checks(events, [
        quality.no_empty_strings(events, ["message", "event_type", "raw_id"])
    ])


@query
def i7_unique(t: Tables) -> DataFrame:
    files_ = t.files()
    return quality.run_checks(files_, [
        quality.unique(files_, "hexsha"), quality.unique(files_, "doc_id"),
        quality.unique(files_, "lang"),
    ])


@query
def i8_regex_match(t: Tables) -> DataFrame:
    events = t.labelled()
    return quality.run_checks(events, [
        quality.regex_match(events, "event_id", rules.EVENT_ID_PATTERN),
        quality.regex_match(events, "event_template", "[a-z]"),
    ])


@query
def i9_suite_summary(t: Tables) -> DataFrame:
    return quality.suite_summary(logs.event_checks(t.labelled()))


@query
def i10_schema_checks(t: Tables) -> DataFrame:
    return quality.schema_checks(t.read("orders"), {
        "required_columns": ["o_orderkey", "o_custkey", "o_comment"],
        "not_null_columns": ["o_orderkey", "o_comment"],
        "column_value_sets": {"o_orderstatus": ["O", "F"]},
        "row_count_range": (1, 10**12),
        "numeric_ranges": {"o_totalprice": (0, 100000)},
    })


@query
def i10_record_schemas(t: Tables) -> DataFrame:
    """Order records as JSON against two schema documents."""
    line = F.when(F.col("o_orderkey") % 11 == 0, F.lit('{"key": ')).otherwise(F.to_json(F.struct(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.struct(
            F.round("o_totalprice", 2).alias("total"),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit("gift")).alias("note"),
        ).alias("price"),
        F.when(F.col("o_orderkey") % 3 == 0, F.array("o_custkey", F.lit(-1)))
        .otherwise(F.array("o_custkey")).alias("parties"),
    )))
    return t.read("orders").select(
        "o_orderkey", json_schema.conforms(line, ORDER_SCHEMA).alias("plain"),
        json_schema.conforms(line, STRICT_ORDER_SCHEMA).alias("strict"),
    )


ORDER_SCHEMA = {
    "type": "object", "required": ["key", "price"],
    "properties": {
        "key": {"type": "integer", "minimum": 1}, "status": {"enum": ["O", "F"]},
        "price": {"type": "object", "properties": {"total": {"type": "number", "maximum": 200000}}},
    },
}
STRICT_ORDER_SCHEMA = {
    "allOf": [{"$ref": "#/$defs/order"}],
    "$defs": {
        "order": {
            "type": "object", "additionalProperties": False, "required": ["key", "status", "price", "parties"],
            "properties": {
                "key": {"type": "integer"}, "status": {"type": "string", "pattern": "^[OFP]$"},
                "price": {
                    "type": "object", "additionalProperties": False, "properties": {"total": {"type": "number"}},
                },
                "parties": {"type": "array", "minItems": 1, "items": {"type": "integer", "exclusiveMinimum": 0}},
            },
        },
    },
}


@query
def i11_sequence_errors(t: Tables) -> DataFrame:
    spoiled = t.sequences().withColumn(
        "label", F.when(F.col("label") == 4, 9).otherwise(F.col("label"))
    ).withColumn("sequence_ids", F.when(F.col("label") == 3, F.array().cast("array<bigint>"))
                 .otherwise(F.col("sequence_ids")))
    return sequences.sequence_errors(spoiled).select("key", "error")


@query
def i12_log_quality(t: Tables) -> DataFrame:
    unsampled = t.read("events").agg(F.count("*")).scalar()
    return logs.quality_gate(t.labelled(), t.templates(), expected_rows=unsampled)


@query
def i13_log_checks(t: Tables) -> DataFrame:
    return logs.event_checks(t.labelled())


@query
def i14_qa_schema(t: Tables) -> DataFrame:
    changed = t.features().withColumn("note", F.lit(1)).drop("title")
    lines = changed.select(
        F.to_json(F.struct(*changed.columns), {"ignoreNullFields": "false"}).alias("line")
    )
    fields = workflows.json_fields(lines, "line")
    return qa.check_schema(fields)


@query
def i15_qa_data_quality(t: Tables) -> DataFrame:
    report = qa.check_data_quality(t.features(), min_rows=10)
    return report.withColumn("value", F.round("value", 6))


@query
def i16_qa_text_quality(t: Tables) -> DataFrame:
    report = qa.check_text_quality(t.features(), 700, 700)
    return report.withColumn("value", F.round("value", 4))


@query
def i17_qa_feature_distribution(t: Tables) -> DataFrame:
    report = qa.check_feature_distribution(t.features())
    return report.withColumn("value", F.round("value", 4))


@query
def i18_qa_suite(t: Tables) -> DataFrame:
    return qa.schema_suite(t.features(), 10)


@query
def i19_call_suite(t: Tables) -> DataFrame:
    return chats.call_suite(t.call_features(), 10, 10**12)


@query
def i20_chat_errors(t: Tables) -> DataFrame:
    return workflows.chat_errors(t.chat_records()).select(
        "id", joined("errors").alias("errors")
    )


@query
def i21_chat_statistics(t: Tables) -> DataFrame:
    return workflows.chat_statistics(t.chat_records())


@query
def i21_inferred_schema(t: Tables) -> DataFrame:
    changed = t.read("customer").select(F.when(
        F.col("c_custkey") % 7 == 0, F.lit("{broken")
    ).otherwise(F.to_json(F.struct(
        "c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"),
        F.struct(F.col("c_acctbal").alias("balance")).alias("account"),
        F.when(F.col("c_acctbal") < 0, F.lit("debit")).otherwise(F.lit(None)).alias("state"),
        (F.col("c_acctbal") > 0).alias("good"), F.array("c_nationkey").alias("nations"),
    ))).alias("line"))
    return workflows.json_fields(changed, "line")


@query
def i21_nested_schema(t: Tables) -> DataFrame:
    stop = F.struct(
        F.col("c_nationkey").alias("nation"), F.when(F.col("c_custkey") % 3 == 0, F.lit("x")).alias("tag")
    )
    nested = F.to_json(F.struct(
        F.col("c_custkey").alias("key"),
        F.struct(
            F.col("c_acctbal").alias("balance"), F.when(F.col("c_acctbal") < 0, F.lit(True)).alias("debit.mark")
        ).alias("account"),
        F.array(stop, stop).alias("stops"),
    ))
    flat = F.lit('{"key": "text", "stops": null}')
    line = F.when(F.col("c_custkey") % 7 == 0, F.lit("{broken")).when(F.col("c_custkey") % 5 == 0, flat).otherwise(nested)
    return json_paths.nested_schema(t.read("customer").select(line.alias("line")), "line")


@query
def i22_record_violations(t: Tables) -> DataFrame:
    return corpus.record_violations(t.record_lines()).select(
        "doc_id", F.array_join("violations", ",").alias("violations")
    )


# --- J: anomalies and alerts ------------------------------------------------------------------------

@query
def j1_iqr_outliers(t: Tables) -> DataFrame:
    customer = F.col("o_custkey").cast("double")
    prices = t.read("orders").select(
        F.col("o_orderkey").alias("question_id"), "o_totalprice",
        (customer * customer * customer * customer).alias("skewed"),
    )
    return qa.iqr_outliers(prices, "question_id", ["o_totalprice", "skewed"]).select(
        "question_id", "column", *[F.round(c, 4).alias(c)
                                   for c in ("value", "lower_bound", "upper_bound")]
    )


@query
def j2_html_residue(t: Tables) -> DataFrame:
    return qa.html_residue(t.features()).select("question_id")


@query
def j3_chat_anomalies(t: Tables) -> DataFrame:
    return workflows.chat_anomalies(t.chat_records()).select("id", "anomaly")


@query
def j4_threshold_checks(t: Tables) -> DataFrame:
    return chats.threshold_checks(t.call_features())


@query
def j5_report_checks(t: Tables) -> DataFrame:
    return corpus.report_checks(corpus.record_violations(t.record_lines()))


@query
def j6_critical_sequences(t: Tables) -> DataFrame:
    return sequences.critical_sequences(t.sequences()).select("key", "label", "label_name")


@query
def j1_outlier_summary(t: Tables) -> DataFrame:
    customer = F.col("o_custkey").cast("double")
    prices = t.read("orders").select(
        F.col("o_orderkey").alias("question_id"), "o_totalprice",
        (customer * customer * customer * customer).alias("skewed"),
    )
    return qa.outlier_summary(prices, "question_id", ["o_totalprice", "skewed"])


@query
def j7_validation_alert(t: Tables) -> DataFrame:
    checks = quality.run_checks(t.read("orders"), [
        quality.row_count(1, 100), quality.value_range(t.read("orders"), "o_totalprice", 0, 10000),
        quality.no_nulls(t.read("orders"), ["o_orderkey"]),
    ])
    return alerts.validation_alert(checks, "orders")


@query
def j7_quality_alert(t: Tables) -> DataFrame:
    rows = t.read("orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("buyer")
    )
    return alerts.quality_alert(profile.null_rates(rows), "orders", 10.0)


@query
def j7_alert_history(t: Tables) -> DataFrame:
    history = t.read("orders").select(
        F.col("o_orderdate").cast("date").cast("string").alias("timestamp"),
        F.col("o_orderkey").alias("key"),
    )
    newer = t.read("customer").select(F.col("c_custkey").alias("key"))
    return alerts.append_history(history, newer, F.lit("9999-01-01"), 500)


@query
def j7_alerts(t: Tables) -> DataFrame:
    anomalies = alerts.anomaly_alert(
        sequences.anomalous_sequences(t.sequences()), "traces", "label_name"
    )
    findings = chats.representation_findings(
        chats.slice_summary(chats.add_slice_features(t.call_features()), threshold=0.2)
    ).withColumn("is_biased", F.lit(True))
    return anomalies.unionByName(alerts.bias_alert(findings, "calls"))


# --- K: bias and slices -------------------------------------------------------------------------------

@query
def k1_after_balancing(t: Tables) -> DataFrame:
    stored = checkpointed(t.sequences())
    return sequences.label_imbalance(balance.balance_classes(stored, "key"), 30.0)


@query
def e9_stratified_split(t: Tables) -> DataFrame:
    split = balance.train_test_split(t.read("orders"), "o_orderkey", stratify_by=["o_orderstatus"])
    return split.select("o_orderkey", "split")


@query
def k1_label_imbalance(t: Tables) -> DataFrame:
    return sequences.label_imbalance(t.sequences(), 30.0)


@query
def k2_status_disparity(t: Tables) -> DataFrame:
    tasks = traces.fill_task_defaults(t.tasks())
    rates = profile.group_rates(tasks, F.col("status") == "Failed", "status")
    return profile.rate_difference(rates)


@query
def k2_task_type_disparity(t: Tables) -> DataFrame:
    tasks = traces.fill_task_defaults(t.tasks())
    return profile.rate_difference(
        profile.group_rates(tasks, F.col("status") == "Failed", "task_type")
    ).withColumn("difference", F.round("difference", 9))


@query
def k3_log_bias_flags(t: Tables) -> DataFrame:
    return logs.bias_flags(t.labelled(), multiplier=1.02, dominance=0.21)


@query
def k4_slice_members(t: Tables) -> DataFrame:
    return qa.explode_slices(t.features()).groupBy("slice").agg(
        F.count("*").alias("count")
    ).filter(F.col("count") >= 30)


def _bias(t: Tables, minimum: int = 5) -> DataFrame:
    return qa.slice_bias(qa.slice_metrics(t.features(), minimum), 0.15)


@query
def k5_slice_metrics(t: Tables) -> DataFrame:
    features = checkpointed(t.features())
    metrics = qa.slice_metrics(features, 5, with_median=True).filter("slice IS NOT NULL")
    return metrics.select("slice", "count", *[
        F.round(c, 4).alias(c) for c in metrics.columns if c not in ("slice", "count")
    ])


@query
def k6_slice_bias(t: Tables) -> DataFrame:
    return _bias(t).select(
        "slice", "is_biased", "severity",
        joined(F.transform("factors", lambda f: f["factor"])).alias("factors"),
    )


@query
def k7_mitigations(t: Tables) -> DataFrame:
    return qa.mitigations(_bias(t))


@query
def k8_bias_summary(t: Tables) -> DataFrame:
    row = qa.bias_summary(_bias(t))
    return row.withColumn("bias_rate", F.round("bias_rate", 6))


@query
def k9_representation_findings(t: Tables) -> DataFrame:
    summary = chats.slice_summary(chats.add_slice_features(t.call_features()), threshold=0.2)
    return chats.representation_findings(summary)


@query
def k10_imbalances(t: Tables) -> DataFrame:
    return corpus.imbalances(corpus.slice_shares(corpus.record_fields(t.records()), 20.0, 30.0))


# --- exact order statistics, used by several of the above -------------------------------------------

@query
def x1_exact_quantiles(t: Tables) -> DataFrame:
    return selection.exact_quantiles(
        t.read("lineitem"), ["l_extendedprice"],
        {"nearest90": (0.9, "nearest"), "linear90": (0.9, "linear")}, by=["l_returnflag"],
    ).select("l_returnflag", "column", "n", "nearest90", F.round("linear90", 4).alias("linear90"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in REGISTRY.items()}
