"""System-log operators: normalise, merge, label, aggregate, sequence, check."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions import logs, rules, traces
from opsloom.functions.common import col, computed, strip
from opsloom.operators import quality

SALTS = 32       # parts that a window's rows are dealt to


def _packed(**fields: str) -> Column:
    """Named columns as one JSON text; nulls are kept."""
    packed = F.struct(*[F.col(source).alias(name) for name, source in fields.items()])
    return F.to_json(packed, {"ignoreNullFields": "false"})


def _extras(system: str) -> Column:
    return {
        "linux": lambda: _packed(pid="PID", level_raw="Level"),
        "hpc": lambda: _packed(node="Node", component="Component", state="State", flag="Flag"),
        "hdfs": lambda: _packed(pid="Pid", level_raw="Level"),
        "hadoop": lambda: _packed(process="Process", level_raw="Level"),
        "spark": lambda: _packed(level_raw="Level"),
    }[system]()


def _severity(system: str) -> Column:
    if system == "linux":
        return logs.linux_severity("Content")
    if system == "hpc":
        return logs.hpc_severity("State", "Flag", "Content")
    return logs.level_severity("Level", "Content", system)


def _timestamp(system: str) -> Column:
    parts = {"linux": ["Month", "Date", "Time"], "hpc": ["Time"]}.get(system, ["Date", "Time"])
    return reduce(lambda a, b: F.concat(a, F.lit(" "), b), [F.col(p) for p in parts])


def _source(system: str) -> Column:
    if system == "hpc":
        return F.concat(F.col("Node"), F.lit("|"), F.col("Component"))
    return F.col("Component")


def _raw_id(system: str) -> Column:
    if system == "hpc":
        return F.when(strip("LogId") != "", F.col("LogId")).otherwise(F.col("LineId"))
    return F.col("LineId")


def normalize(raw: DataFrame, system: str) -> DataFrame:
    """One system's structured log table -> the unified ten-column event table."""
    if system not in rules.LOG_SYSTEMS:
        raise ValueError(f"unknown log system {system!r}")
    return raw.select(
        F.lit(system).alias("system"),
        _timestamp(system).alias("timestamp"),
        _severity(system).alias("severity"),
        _source(system).alias("source"),
        F.col("EventId").alias("event_id"),
        F.col("EventTemplate").alias("event_template"),
        F.col("Content").alias("message"),
        _raw_id(system).alias("raw_id"),
        _extras(system).alias("extras"),
        F.lit("").alias("event_type"),
    )


def normalize_mixed(raw: DataFrame, system: Column | str = "system") -> DataFrame:
    """Normalise a table that holds several systems' lines, in one scan.

    The raw table carries the union of the systems' columns; each row uses its own system's
    rules.
    """
    name = col(system)

    def per_system(build) -> Column:
        result = F.when(name == rules.LOG_SYSTEMS[0], build(rules.LOG_SYSTEMS[0]))
        for other in rules.LOG_SYSTEMS[1:]:
            result = result.when(name == other, build(other))
        return result

    judged = computed(
        raw.withColumn("system", name),
        timestamp=per_system(_timestamp), severity=per_system(_severity),
    )
    return judged.select(
        "system", "timestamp", "severity",
        per_system(_source).alias("source"),
        F.col("EventId").alias("event_id"),
        F.col("EventTemplate").alias("event_template"),
        F.col("Content").alias("message"),
        per_system(_raw_id).alias("raw_id"),
        per_system(_extras).alias("extras"),
        F.lit("").alias("event_type"),
    )


def merge_events(normalized: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of the normalised tables; every system must be there."""
    missing = [s for s in rules.LOG_SYSTEMS if s not in normalized]
    if missing:
        raise FileNotFoundError(f"no normalised table for {missing}")
    frames = [normalized[s].select(*rules.EVENT_COLUMNS) for s in rules.LOG_SYSTEMS]
    return reduce(DataFrame.unionByName, frames)


def label_event_types(events: DataFrame) -> DataFrame:
    """Fill ``event_type`` from message, template and severity."""
    combined = events.withColumn("_text", logs.labelled_text("message", "event_template"))
    kind = logs.event_type_of("_text", "severity")
    return computed(combined, event_type=kind).select(*events.columns)


def sample_events(events: DataFrame, percent: int = 10) -> DataFrame:
    """The repeatable hash sample of ``percent`` of the rows."""
    return events.filter(logs.in_sample("system", "raw_id", percent))


def with_time_bucket(events: DataFrame) -> DataFrame:
    return computed(events, time_bucket=logs.time_bucket("timestamp", "system"))


def event_counts(events: DataFrame) -> DataFrame:
    """Events per system, severity, event type and time bucket."""
    return (
        with_time_bucket(events)
        .groupBy("system", "severity", "event_type", "time_bucket")
        .agg(F.count("*").alias("count"))
        .orderBy("system", "time_bucket", "severity", "event_type")
    )


def _rate(errors: Column | str, total: Column | str) -> Column:
    return F.round(col(errors) / col(total), 4)


def error_rate(events: DataFrame) -> DataFrame:
    """Error share per system and time bucket, in one pass."""
    return (
        with_time_bucket(events)
        .groupBy("system", "time_bucket")
        .agg(F.count("*").alias("total"),
             F.count_if(F.col("severity") == "ERROR").alias("error_count"))
        .withColumn("error_rate", _rate("error_count", "total"))
        .orderBy("system", "time_bucket")
    )


def join_error_counts(totals: DataFrame, errors: DataFrame) -> DataFrame:
    """Totals left-joined with error counts; buckets without errors count zero.

    For counts that already exist as tables. From raw events, ``error_rate`` needs no join.
    """
    joined = totals.join(errors, ["system", "time_bucket"], "left")
    return joined.withColumn(
        "error_count", F.coalesce(F.col("error_count"), F.lit(0)).cast("bigint")
    ).withColumn("error_rate", _rate("error_count", "total"))


def top_templates(events: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent templates of each system; ties go to the smaller event id."""
    counts = events.groupBy("system", "event_id", "event_template").agg(
        F.count("*").alias("count")
    )
    order = Window.partitionBy("system").orderBy(
        F.desc("count"), F.asc_nulls_first("event_id"), F.asc_nulls_first("event_template")
    )
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def filter_templates(templates: DataFrame, events: DataFrame) -> DataFrame:
    """Templates whose event id occurs in the events, one row per (EventId, system).

    The match is on the id alone, across systems. Of several rows with one key the smallest
    template text is kept.
    """
    used = events.select(F.col("event_id").alias("EventId"))
    others = [c for c in templates.columns if c not in ("EventId", "system")]
    kept = templates.join(used, "EventId", "left_semi")
    first = F.min(F.struct(*others)).alias("_row")
    return kept.groupBy("EventId", "system").agg(first).select("EventId", "system", "_row.*")


def missing_templates(events: DataFrame, templates: DataFrame) -> DataFrame:
    """Distinct event ids of the events that no template row has."""
    ids = events.select("event_id").distinct()
    known = templates.select(F.col("EventId").alias("event_id")).distinct()
    return ids.join(known, "event_id", "left_anti")


def duplicate_templates(templates: DataFrame) -> DataFrame:
    """(EventId, system) pairs that occur more than once."""
    return (
        templates.groupBy("EventId", "system").agg(F.count("*").alias("count"))
        .filter(F.col("count") > 1)
    )


def system_profile(events: DataFrame) -> DataFrame:
    """Per system: rows, share, errors, error rate and the most frequent event type."""
    by_type = events.groupBy("system", "event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("severity") == "ERROR").alias("errors")
    )
    total = by_type.agg(F.sum("n")).scalar()
    # most rows first, then the alphabetically first name
    leader = F.min_by("event_type", F.struct(-F.col("n"), F.col("event_type")))
    return (
        by_type.groupBy("system")
        .agg(F.sum("n").alias("count"), F.sum("errors").alias("error_count"),
             leader.alias("top_event_type"))
        .withColumn("pct_of_total", F.round(F.col("count") / total * 100, 2))
        .withColumn("error_rate", _rate("error_count", "count"))
    )


def event_type_by_system(events: DataFrame) -> DataFrame:
    """Events per event type and system."""
    return events.groupBy("event_type", "system").agg(F.count("*").alias("count"))


def bias_flags(events: DataFrame, multiplier: float = 2.0, dominance: float = 0.80,
               min_events: int = 5) -> DataFrame:
    """Systems with an outsized error rate, and systems that dominate an event type.

    One row per flag: (slice, metric, value, threshold).
    """
    cells = events.groupBy("event_type", "system").agg(
        F.count("*").alias("n"), F.count_if(F.col("severity") == "ERROR").alias("errors")
    )
    # one row per (event type, system) by now: all totals are windows over that small table
    everything, system = Window.partitionBy(F.lit(0)), Window.partitionBy("system")
    kind = Window.partitionBy("event_type")
    known = cells.withColumns({
        "error_rate": _rate(F.sum("errors").over(system), F.sum("n").over(system)),
        "limit": F.sum("errors").over(everything) / F.sum("n").over(everything) * multiplier,
        "total": F.sum("n").over(kind),
        "leads": F.row_number().over(system.orderBy("event_type")) == 1,
    })
    share = F.col("n") / F.col("total")
    by_rate = F.when(
        F.col("leads") & (F.col("error_rate") > F.col("limit")) & (F.col("limit") > 0),
        F.struct(F.col("system").alias("slice"), F.lit("error_rate").alias("metric"),
                 F.col("error_rate").alias("value"), F.round("limit", 4).alias("threshold")),
    )
    by_type = F.when(
        (F.col("total") >= min_events) & (share > dominance),
        F.struct(F.concat(F.col("system"), F.lit("/"), F.col("event_type")).alias("slice"),
                 F.lit("event_type_dominance").alias("metric"), F.round(share, 4).alias("value"),
                 F.lit(float(dominance)).alias("threshold")),
    )
    return known.select(F.inline(F.array_compact(F.array(by_rate, by_type))))


def with_sequence_fields(events: DataFrame) -> DataFrame:
    """Add event number, label, parsed time and one-minute window."""
    return (
        events.withColumn("event_int", logs.event_number("event_id"))
        .withColumn("event_label", logs.event_label("event_type", "event_template"))
        .withColumn("timestamp_dt", logs.parse_timestamp("timestamp"))
        .withColumn("window", F.date_trunc("minute", "timestamp_dt"))
    )


def event_sequences(events: DataFrame, max_length: int = rules.MAX_SEQUENCE_LENGTH) -> DataFrame:
    """Event numbers of each (system, minute) in time order, with the highest label.

    Only the last ``max_length`` events of a window reach the output. They are selected by two
    ranked limits, first among the rows of a window that share a hash of the row (``SALTS``
    parts), then among what is left, so the one window that all rows without a readable time
    share meets in many tasks, and at most SALTS * max_length of its rows in one. The label
    comes from every row of the window, by an aggregate that combines on the map side.
    """
    fields = with_sequence_fields(events)
    group = ["system", "window"]
    labels = fields.groupBy(
        F.col("system").alias("_system"), F.col("window").alias("_window")
    ).agg(F.max("event_label").alias("label"))
    order = [F.desc_nulls_last("timestamp_dt"), F.desc("raw_id"), F.desc("event_int")]
    salt = F.pmod(F.xxhash64("raw_id", "event_int", "timestamp_dt"), F.lit(SALTS))
    parts = Window.partitionBy(*group, "_salt").orderBy(*order)
    last = (
        fields.select(*group, "timestamp_dt", "raw_id", "event_int", salt.alias("_salt"))
        .withColumn("_place", F.row_number().over(parts)).filter(F.col("_place") <= max_length)
        .withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        .filter(F.col("rank") <= max_length)
    )
    ordered = F.sort_array(F.collect_list(F.struct(-F.col("rank"), F.col("event_int").alias("v"))))
    tokens = last.groupBy(*group).agg(F.transform(ordered, lambda x: x["v"]).alias("tokens"))
    same = F.col("system").eqNullSafe(F.col("_system")) & F.col("window").eqNullSafe(
        F.col("_window")
    )
    return tokens.join(labels, same).select(
        "system", "window",
        traces.fit_length(F.col("tokens"), max_length).alias("sequence_ids"), "label",
    )


def parse_quality(events: DataFrame) -> DataFrame:
    """One row of parse counters: timestamp families, failures, ids, label overrides."""
    fields = with_sequence_fields(events).withColumn("form", logs.timestamp_form("timestamp"))
    parsed = F.col("timestamp_dt").isNotNull()
    return fields.agg(
        F.count_if((F.col("form") == "standard") & parsed).alias("standard_count"),
        F.count_if(F.col("form") == "epoch").alias("epoch_count"),
        F.count_if(F.col("form") == "linux").alias("linux_count"),
        F.count_if(~parsed).alias("unparsed_count"),
        F.min("event_int").alias("min_event"),
        F.max("event_int").alias("max_event"),
        F.count(logs.template_label("event_template")).alias("override_count"),
    )


def event_checks(events: DataFrame) -> DataFrame:
    """Schema and value checks of the labelled event table."""
    return quality.run_checks(events, _event_checks(events) + [quality.row_count(1)])


def _event_checks(events: DataFrame) -> list:
    return [
        quality.columns_present(events, rules.EVENT_COLUMNS),
        quality.allowed_values(events, "system", rules.LOG_SYSTEMS),
        quality.allowed_values(events, "severity", rules.SEVERITIES),
        quality.allowed_values(events, "event_type", rules.EVENT_TYPES),
        quality.no_nulls(events, ["event_id", "event_template", "message", "raw_id", "system"]),
        quality.regex_match(events, "event_id", rules.EVENT_ID_PATTERN, "event_id_pattern"),
    ]


def quality_gate(events: DataFrame, templates: DataFrame, expected_rows: int | Column,
                 min_percent: float = 5.0) -> DataFrame:
    """Everything that must hold before events are used: (check, success, violations).

    Event checks, no empty ids or texts, a sampled share between ``min_percent`` and 100 % of
    ``expected_rows``, every event id known to the templates and no doubled template key.
    """
    share = F.count("*") / F.first(F.lit(expected_rows)) * 100
    sampling = F.when((share >= min_percent) & (share <= 100), 0).otherwise(1).cast("bigint")
    ids = ["event_id", "event_template", "message", "raw_id"]
    checks = quality.run_checks(events, _event_checks(events) + [
        quality.no_empty_strings(events, ids), quality.Check("sampling_sanity", sampling),
    ])
    uncovered = missing_templates(events, templates).agg(F.count("*").alias("violations"))
    doubled = duplicate_templates(templates).agg(F.count("*").alias("violations"))
    for name, frame in [("template_coverage", uncovered), ("template_no_duplicates", doubled)]:
        checks = checks.unionByName(frame.select(
            F.lit(name).alias("check"), (F.col("violations") == 0).alias("success"), "violations"
        ))
    return checks
