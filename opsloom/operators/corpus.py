"""Infrastructure-as-code corpus operators: dedup, filter funnel, redaction, records, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions import chats, corpus, matcher, rules
from opsloom.functions.common import computed, first_match, strip
from opsloom.operators.qa import message
from opsloom.operators.selection import QUARTILES, exact_quantiles
from opsloom.session import checkpointed, saved

SLICE_DIMENSIONS = ["iac_type", "license", "size_bucket", "prompt_type"]


@dataclass(frozen=True)
class FilterSettings:
    """Limits and gates of the filter funnel."""

    min_size: int = rules.MIN_SIZE_BYTES
    max_size: int = rules.MAX_SIZE_BYTES
    min_alphanum: float = rules.MIN_ALPHANUM_FRACTION
    extensions: tuple[str, ...] = tuple(rules.ALLOWED_EXTENSIONS)
    api_version: bool = True
    kind: bool = True
    metadata: bool = True
    valid_yaml: bool = True
    require_license: bool = True
    licenses: tuple[str, ...] = tuple(rules.PERMISSIVE_LICENSES)
    require_ml: bool = True
    ml_mode: str = "strict"
    ml_groups: tuple[str, ...] = field(default=("ml_gpu", "kserve_seldon", "mlops"))


def first_by_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of each key in ingest order.

    An aggregate with partial results, so a key that many rows share is reduced before the
    shuffle and never meets whole in one task.
    """
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_row")
    return df.groupBy(key).agg(first).select(key, "_row.*").select(*df.columns)


def _early_reason(s: FilterSettings) -> Column:
    """First failing check of those that need no YAML reader, else null."""
    content = F.coalesce(F.col("content"), F.lit(""))
    size = F.coalesce(F.col("size"), F.lit(0)).cast("bigint")
    alphanum = F.coalesce(F.col("alphanum_fraction"), F.lit(0.0)).cast("double")
    ext = F.lower(F.regexp_replace(F.coalesce(F.col("ext"), F.lit("")), r"^\.+", ""))
    allowed = [e.lstrip(".").lower() for e in s.extensions]
    cases = [
        (content == "", "empty_content"),
        (size < s.min_size, "too_small"),
        (size > s.max_size, "too_large"),
        (alphanum < s.min_alphanum, "low_alphanum"),
    ]
    if allowed:
        cases.append(((ext != "") & ~ext.isin(allowed), "bad_extension"))
    for enabled, mark, reason in [
        (s.api_version, "apiVersion", "not_k8s"),
        (s.kind, "kind:", "missing_kind"),
        (s.metadata, "metadata:", "missing_metadata"),
    ]:
        if enabled:
            cases.append((~content.contains(mark), reason))
    return first_match(cases, F.lit(None).cast("string"))


def _late_reason(s: FilterSettings) -> Column:
    """First failing licence or content check, else 'ok'."""
    names = corpus.licenses()
    cases = []
    if s.licenses:
        if s.require_license:
            cases.append((F.array_size(names) == 0, "missing_license"))
        listed = F.array(*[F.lit(x.lower()) for x in s.licenses])
        cases.append(((F.array_size(names) > 0) & ~F.arrays_overlap(names, listed), "bad_license"))
    if s.require_ml:
        keyword = corpus.has_keyword("content", list(s.ml_groups))
        gates = corpus.kubernetes_gates("content", s.api_version, s.kind, s.metadata)
        wanted = (gates & keyword) if s.ml_mode == "strict" else (gates | keyword)
        cases.append((~wanted, "not_ml_infra"))
    return first_match(cases, F.lit("ok")) if cases else F.lit("ok")


def with_filter_reason(files: DataFrame, settings: FilterSettings | None = None) -> DataFrame:
    """Add ``reason``: the first check a file fails, or 'ok'.

    Native checks run first; only files that pass them send their text to the YAML check.
    """
    s = settings or FilterSettings()
    early = computed(files, _early=_early_reason(s))
    if s.valid_yaml:
        undecided = F.when(F.col("_early").isNull(), F.col("content"))
        early = early.withColumn("_yaml", corpus.yaml_valid(undecided))
    else:
        early = early.withColumn("_yaml", F.lit(True))
    reason = F.coalesce(F.col("_early"), F.when(~F.col("_yaml"), "invalid_yaml"), _late_reason(s))
    return computed(early, reason=reason).drop("_early", "_yaml")


def curate(files: DataFrame, settings: FilterSettings | None = None,
           keep: Sequence[str] = ("hexsha",)) -> DataFrame:
    """Filter, redact, re-check and wrap: every input row with its final ``reason``, and the
    training record (``messages``, ``_meta``) where the reason is 'ok'.

    The YAML check after redaction only sees texts that redaction changed.
    """
    judged = computed(
        with_filter_reason(files, settings),
        _clean=F.when(F.col("reason") == "ok", corpus.redact("content")),
    )
    changed = F.when(F.col("_clean") != F.col("content"), F.col("_clean"))
    checked = judged.withColumn("_still", corpus.yaml_valid(changed))
    broken = ~F.coalesce(F.col("_still"), F.lit(True))
    final = computed(
        checked,
        reason=F.when(broken, "invalid_yaml_post_redaction").otherwise(F.col("reason")),
        _path=corpus.best_path(),
    )
    wrapped = corpus.wrap_manifest("_clean")
    good = F.col("reason") == "ok"
    return final.select(
        *keep, "reason",
        F.when(good, F.array(
            message("user", corpus.synthesize_prompt("_path")), message("assistant", wrapped)
        )).alias("messages"),
        F.when(good, F.struct(
            F.col("hexsha"), F.col("_path").alias("path"), F.col("size"),
            corpus.licenses().alias("licenses"),
        )).alias("_meta"),
    )


def training_records(files: DataFrame, settings: FilterSettings | None = None) -> DataFrame:
    """The accepted records alone, after a round trip through their JSON text."""
    kept = curate(files, settings).filter(F.col("reason") == "ok")
    readable = corpus.manifest_of(F.col("messages")[1]["content"]).isNotNull()
    return kept.filter(readable).select("messages", "_meta")


def drop_counts(judged: DataFrame) -> DataFrame:
    """Rows and percentage per reason ('ok' is the yield)."""
    counts = judged.groupBy("reason").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", F.round(F.col("count") / total * 100, 2))


# --- analysis ----------------------------------------------------------------------------

def keyword_totals(files: DataFrame, top: int = 15, one_pass: bool = False) -> DataFrame:
    """Occurrences of every taxonomy word, the ``top`` of each category.

    One sum per word over the texts; nothing is exploded. By default each word is searched by a
    native expression, which needs no Python worker; ``one_pass`` finds all words in one reading of
    a text, at a cost that does not grow with their number.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    words = [(cat, w) for cat, ws in rules.CORPUS_KEYWORDS.items() for w in ws]
    if one_pass:
        counted = files.select(matcher.word_counts(content, [w for _, w in words]).alias("n"))
        row = counted.agg(*[F.sum(F.col("n")[i]).alias(f"k{i}") for i in range(len(words))])
    else:
        row = files.agg(*[
            F.sum(corpus.keyword_count(content, w)).alias(f"k{i}") for i, (_, w) in enumerate(words)
        ])
    by_category = {}
    for i, (category, word) in enumerate(words):
        by_category.setdefault(category, []).append(F.struct(
            (-F.col(f"k{i}")).alias("neg"), F.lit(word).alias("keyword"),
            F.lit(category).alias("category"),
        ))
    lists = [F.slice(F.sort_array(F.array(*s)), 1, top) for s in by_category.values()]
    return row.select(F.explode(F.concat(*lists)).alias("r")).select(
        F.col("r.category"), F.col("r.keyword"), (-F.col("r.neg")).alias("hits")
    ).filter(F.col("hits") > 0)


def license_counts(files: DataFrame, top: int = 15,
                   column: str = "max_stars_repo_licenses") -> DataFrame:
    """Most frequent licence names, lower-cased."""
    counts = files.select(F.explode(column).alias("x")).groupBy(
        F.lower("x").alias("license")
    ).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "license").limit(top)


def corpus_report(files: DataFrame) -> DataFrame:
    """Tidy (metric, name, count, pct): file kinds, escape difficulty, sizes, personal data,
    missing fields.

    One pass: files are counted per combination of the three classes, some dozens of rows, and
    all figures are sums over those.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    present = [c for c in rules.CORPUS_COLUMNS if c in files.columns]
    classes = ["iac_type", "escape_difficulty", "size"]
    cells = files.groupBy(
        corpus.manifest_type(content, terraform=True).alias("iac_type"),
        corpus.escape_difficulty(content).alias("escape_difficulty"),
        corpus.size_bucket("size").alias("size"),
    ).agg(
        F.count("*").alias("_n"), F.count_if(corpus.has_pii(content)).alias("_pii"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in present],
    )
    figures = [(c, F.col(c), F.col("_n")) for c in classes]
    figures.append(("pii_files", F.lit("any"), F.col("_pii")))
    figures += [("field_null", F.lit(c), F.col(f"_null_{c}")) for c in present]
    size = F.when(F.col("metric") == "size", F.col("count"))
    total = F.sum(size).over(Window.partitionBy(F.lit(0)))      # of one row per figure
    return _summed(cells, figures).withColumn("pct", F.round(F.col("count") / total * 100, 2))


def _summed(cells: DataFrame, figures: list[tuple[str | Column, Column, Column]]) -> DataFrame:
    """(metric, name, count): sums of the figures (metric, name, amount) over a small table."""
    rows = F.array(*[
        F.struct((metric if isinstance(metric, Column) else F.lit(metric)).alias("metric"), name.alias("name"), amount.alias("count"))
        for metric, name, amount in figures
    ])
    return cells.select(F.explode(rows).alias("r")).groupBy("r.metric", "r.name").agg(
        F.sum("r.count").alias("count")
    )


def diagnostics(files: DataFrame, settings: FilterSettings | None = None) -> DataFrame:
    """Tidy (metric, name, count): files per personal-data pattern and per filter outcome.

    One pass: everything is counted per filter outcome and summed from those few rows.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    wrapped = corpus.manifest_of(F.col("messages")[1]["content"]).isNotNull()
    cells = curate(files, settings, keep=("content",)).groupBy("reason").agg(
        F.count("*").alias("_n"), F.count_if(wrapped).alias("_wrapped"),
        *[F.count_if(corpus.pii_found(content, n)).alias(f"_pii_{n}") for n in rules.PII_PATTERNS],
    )
    outcome = F.when(F.col("reason") == "ok", "filter_pass").otherwise("filter_drop")
    return _summed(cells, [
        *[("pii", F.lit(n), F.col(f"_pii_{n}")) for n in rules.PII_PATTERNS],
        (outcome, F.col("reason"), F.col("_n")),
        ("wrap_ok", F.lit("any"), F.col("_wrapped")),
    ])


# --- records: slices, mitigation, validation ------------------------------------------------

def record_fields(records: DataFrame) -> DataFrame:
    """Flat slice fields of two-message records whose assistant turn is readable."""
    manifest = corpus.manifest_of(F.col("messages")[1]["content"])
    fields = computed(records.filter(F.array_size("messages") == 2), _manifest=manifest)
    return fields.filter(F.col("_manifest").isNotNull()).select(
        *records.columns,
        corpus.manifest_type("_manifest").alias("iac_type"),
        corpus.license_class("_meta.licenses").alias("license"),
        corpus.size_bucket("_meta.size").alias("size_bucket"),
        corpus.prompt_type(F.col("messages")[0]["content"]).alias("prompt_type"),
        F.char_length("_manifest").alias("manifest_length"),
    )


def slice_shares(fields: DataFrame, min_pct: float = 5.0, max_pct: float = 40.0) -> DataFrame:
    """Count, share and mean manifest length per value of the four slice dimensions.

    The total is that of the first dimension, so the records are read once.
    """
    first = F.when(F.col("dimension") == SLICE_DIMENSIONS[0], F.col("count"))
    total = F.sum(first).over(Window.partitionBy(F.lit(0)))     # of one row per slice value
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in SLICE_DIMENSIONS
    ])
    grouped = fields.select(F.explode(pairs).alias("s"), "manifest_length").groupBy(
        "s.dimension", "s.value"
    ).agg(
        F.count("*").alias("count"),
        F.round(F.avg("manifest_length"), 1).alias("mean_manifest_chars"),
    )
    return (
        grouped.withColumn("pct_of_total", F.round(F.col("count") / total * 100, 2))
        .withColumn("underrepresented", F.col("pct_of_total") < min_pct)
        .withColumn("overrepresented", F.col("pct_of_total") > max_pct)
    )


def imbalances(shares: DataFrame) -> DataFrame:
    """Per dimension and direction, the slice values outside the band.

    The value lists are bounded by the fixed classes of each dimension.
    """
    flagged = shares.select(
        "dimension", "value",
        F.explode(F.array_compact(F.array(
            F.when(F.col("underrepresented"), "under"), F.when(F.col("overrepresented"), "over")
        ))).alias("direction"),
    )
    return flagged.groupBy("dimension", "direction").agg(
        F.array_join(F.array_sort(F.collect_set("value")), ",").alias("slice_values")
    )


def record_violations(lines: DataFrame, column: str = "record") -> DataFrame:
    """Add ``violations``: every rule a JSON training record breaks (empty if valid).

    Works on the JSON text, so an absent key and a null value stay different things.
    """
    text = F.col(column)
    parsed = computed(lines, _fields=chats.json_object(text))
    shape = "array<struct<role string, content string>>"
    parsed = computed(parsed, _messages=F.from_json(F.col("_fields")["messages"], shape))
    messages = F.col("_messages")
    user, assistant = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))
    parsed = computed(parsed, _two=F.coalesce(F.array_size("_messages"), F.lit(0)) == 2)
    parsed = computed(
        parsed, _reply=F.when(F.col("_two"), chats.json_object(assistant["content"]))
    )
    manifest = F.when(F.col("_reply").isNotNull(), corpus.manifest_of(assistant["content"]))
    parsed = computed(parsed, _manifest=F.coalesce(manifest, F.lit("")))
    parsed = parsed.withColumn(
        "_yaml", corpus.yaml_valid(F.when(F.col("_manifest") != "", F.col("_manifest")))
    )
    two, reply, manifest = F.col("_two"), F.col("_reply"), F.col("_manifest")
    n = F.coalesce(F.array_size("_messages"), F.lit(0))
    # cheap tests that every match of the leak patterns passes, in the patterns' order
    hints = [manifest.contains("sk-"), manifest.rlike(r"\p{Nd}\.\p{Nd}"), manifest.contains("@")]
    meta_keys = F.coalesce(
        F.json_object_keys(F.col("_fields")["_meta"]), F.array().cast("array<string>")
    )
    found = [
        F.when(~F.map_contains_key("_fields", F.lit(k)), f"missing_top_key:{k}")
        for k in ("messages", "_meta")
    ]
    found += [
        F.when(~two, F.concat(F.lit("wrong_message_count:"), n.cast("string"))),
        F.when(two & ~F.coalesce(user["role"] == "user", F.lit(False)), "first_role_not_user"),
        F.when(two & ~F.coalesce(assistant["role"] == "assistant", F.lit(False)),
               "second_role_not_assistant"),
        F.when(two & (F.coalesce(strip(user["content"]), F.lit("")) == ""), "empty_prompt"),
        F.when(two & reply.isNull(), "assistant_invalid_json"),
        F.when(reply.isNotNull() & ~F.coalesce(reply["tool"] == "apply_manifest", F.lit(False)),
               "wrong_tool_name"),
        F.when(reply.isNotNull() & (manifest == ""), "empty_manifest_content"),
        F.when(~F.coalesce(F.col("_yaml"), F.lit(True)), "manifest_invalid_yaml"),
    ]
    found += [
        F.when((manifest != "") & hint & manifest.rlike("(?U)" + p), f"pii_leaked:{name}")
        for (name, p), hint in zip(rules.PII_LEAK_PATTERNS.items(), hints)
    ]
    found += [
        F.when(~F.array_contains(meta_keys, k), f"missing_meta_key:{k}")
        for k in rules.RECORD_META_KEYS
    ]
    violations = F.when(
        F.col("_fields").isNull(), F.array(F.lit("unparseable_line"))
    ).otherwise(F.array_compact(F.array(*found)))
    return computed(parsed, violations=violations).select(
        *lines.columns, "violations", F.col("_manifest").alias("manifest"),
        F.when(two, user["content"]).alias("prompt"),
        F.get_json_object(text, "$._meta.size").try_cast("bigint").alias("source_size"),
    )


def validation_summary(validated: DataFrame) -> DataFrame:
    """One row: total, valid, invalid, pass rate in percent."""
    valid = F.count_if(F.array_size("violations") == 0)
    total = F.count("*")
    return validated.agg(
        total.alias("total"), valid.alias("valid"), (total - valid).alias("invalid"),
        F.coalesce(F.round(F.try_divide(valid, total) * 100, 2), F.lit(0.0))
        .alias("pass_rate_pct"),
    )


def violation_counts(validated: DataFrame) -> DataFrame:
    return validated.select(F.explode("violations").alias("violation")).groupBy(
        "violation"
    ).agg(F.count("*").alias("count"))


def length_profile(validated: DataFrame) -> DataFrame:
    """count, min, max, mean and median of prompt, manifest and source lengths of valid records.

    The records are read once, to count each length, and all figures come from those counts.
    """
    measured = {
        "prompt_length": F.char_length("prompt"), "manifest_length": F.char_length("manifest"),
        "source_size": F.coalesce(F.col("source_size"), F.lit(0)),
    }
    counted = saved(validated.filter(F.array_size("violations") == 0).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("measure"), value.cast("bigint").alias("value")) for name, value in measured.items()
    ]))).groupBy("measure", "value").agg(F.count("*").alias("rows")), "record-lengths")
    known = F.sum(F.when(F.col("value").isNotNull(), F.col("rows")))
    figures = counted.groupBy("measure").agg(
        F.coalesce(known, F.lit(0)).alias("count"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.round(F.sum(F.col("value") * F.col("rows")) / known, 1).alias("mean"),
    )
    medians = exact_quantiles(counted, ["value"], {"median": QUARTILES["median"]}, ["measure"], "rows")
    names = validated.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, measured))).alias("measure"))
    return names.join(figures, "measure", "left").join(
        medians.select("measure", "median"), "measure", "left"
    ).withColumn("count", F.coalesce("count", F.lit(0)))


def validation_report(validated: DataFrame) -> DataFrame:
    """Tidy (name, value): the validation summary and every violation's count, in one pass."""
    valid = F.array_size("violations") == 0
    marks = F.array_compact(F.array(
        F.lit("total"), F.when(valid, "valid"), F.when(~valid, "invalid")
    ))
    # a row per kind of violation, needed twice: write the few rows, not the work behind them
    counts = checkpointed(
        validated.select(F.explode(F.concat(marks, "violations")).alias("name")).groupBy(
            "name"
        ).agg(F.count("*").cast("double").alias("value"))
    )
    total = F.sum(F.when(F.col("name") == "total", F.col("value")))
    passed = F.coalesce(F.sum(F.when(F.col("name") == "valid", F.col("value"))), F.lit(0.0))
    rate = counts.agg(F.round(passed / total * 100, 2).alias("value")).select(
        F.lit("pass_rate_pct").alias("name"), "value"
    )
    return counts.unionByName(rate)


def report_checks(validated: DataFrame, min_pass_rate: float = 80.0, max_violations: int = 50,
                  max_pii: int = 0, min_records: int = 10) -> DataFrame:
    """Four alarms over the validation outcome: (check, value, threshold, is_anomaly)."""
    name, value = F.col("name"), F.col("value")
    summary = name.isin("total", "valid", "invalid", "pass_rate_pct")

    def of(condition: Column, agg=F.sum) -> Column:
        return F.coalesce(agg(F.when(condition, value)), F.lit(0.0))

    row = validation_report(validated).agg(
        of(name == "pass_rate_pct").alias("rate"),
        of(name.startswith("pii_leaked")).alias("leaks"),
        of(~summary, F.max).alias("worst"), of(name == "total").alias("total"),
    )
    checks = [
        ("pass_rate", F.col("rate"), min_pass_rate, "low"),
        ("pii_leakage", F.col("leaks"), max_pii, "high"),
        ("violation_count", F.col("worst"), max_violations, "high"),
        ("minimum_records", F.col("total"), min_records, "low"),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check"), value.cast("double").alias("value"),
            F.lit(float(limit)).alias("threshold"),
            (value < limit if side == "low" else value > limit).alias("is_anomaly"),
        )
        for name, value, limit, side in checks
    ]
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
