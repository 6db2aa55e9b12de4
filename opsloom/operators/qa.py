"""Question-and-answer operators: load rules, joins, features, checks, slices, training forms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions import rules, text
from opsloom.functions.common import computed, strip
from opsloom.operators import quality
from opsloom.operators.profile import numeric_profile, top_list_values
from opsloom.operators.selection import QUARTILES, exact_quantiles
from opsloom.session import checkpointed, saved

NUMERIC_COLUMNS = ["score", "answer_score", "view_count", "quality_score"]


# --- acquisition -------------------------------------------------------------------

def _number(name: str) -> Column:
    """Text as integer; blank counts as 0, anything unreadable is null."""
    raw = F.coalesce(F.col(name), F.lit(""))
    return F.when(raw == "", F.lit(0).cast("bigint")).otherwise(strip(raw).try_cast("bigint"))


def clean_questions(raw: DataFrame, min_score: int = 5) -> DataFrame:
    """Question rows (all text) -> typed, cleaned rows with an accepted answer.

    Rows with unreadable numbers, too low a score or no accepted answer are dropped.
    """
    accepted = strip(F.coalesce(F.col("AcceptedAnswerId"), F.lit("")))
    typed = raw.select(
        strip("Id").try_cast("bigint").alias("question_id"),
        F.col("Title"), F.col("Body"),
        _number("Score").alias("score"),
        accepted.try_cast("bigint").alias("accepted_answer_id"),
        text.tag_list("Tags").alias("tags"),
        _number("ViewCount").alias("view_count"),
        F.coalesce(F.col("CreationDate"), F.lit("")).alias("creation_date"),
    )
    usable = reduce(
        lambda a, b: a & b,
        [F.col(c).isNotNull()
         for c in ["question_id", "score", "accepted_answer_id", "view_count"]],
    )
    kept = typed.filter(usable & (F.col("score") >= min_score))
    return kept.select(
        "question_id", text.clean_html("Title").alias("title"),
        text.clean_html("Body").alias("body"), "score", "accepted_answer_id", "tags",
        "view_count", "creation_date",
    )


def clean_answers(raw: DataFrame, order: str | None = None) -> DataFrame:
    """Answer rows (all text) -> one typed, cleaned row per question; the last row wins.

    ``order`` names the column that says which row came last (the readers add one).
    """
    typed = raw.select(
        _number("AnswerId").alias("answer_id"), _number("QuestionId").alias("question_id"),
        F.col("AnswerBody"), _number("AnswerScore").alias("score"),
        (F.col(order) if order else F.col("AnswerId")).alias("_order"),
    ).filter(
        (F.col("answer_id") != 0) & (F.col("question_id") != 0) & F.col("score").isNotNull()
    )
    # an aggregate rather than a window: partial results keep a hot question small
    last = typed.groupBy("question_id").agg(
        F.max_by(
            F.struct("answer_id", "AnswerBody", "score"), F.struct("_order", "answer_id")
        ).alias("a")
    )
    return last.select(
        "question_id", F.col("a.answer_id").alias("answer_id"),
        text.clean_html("a.AnswerBody").alias("body"), F.col("a.score").alias("score"),
    )


def _pair_columns(answer_body: Column, answer_score: Column) -> list[Column]:
    return [
        F.col("question_id"), F.col("title"), F.col("body").alias("question_body"),
        F.col("tags"), F.col("score"), F.col("view_count"),
        answer_body.alias("answer_body"), answer_score.alias("answer_score"),
    ]


def pair_by_question(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions with the answer that names them."""
    renamed = answers.select(
        "question_id", F.col("body").alias("_body"), F.col("score").alias("_score")
    )
    joined = questions.join(renamed, "question_id")
    return joined.select(*_pair_columns(F.col("_body"), F.col("_score")))


def pair_by_accepted(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions with the answer they accepted."""
    renamed = answers.select(
        F.col("answer_id").alias("accepted_answer_id"),
        F.col("body").alias("_body"), F.col("score").alias("_score"),
    )
    joined = questions.join(renamed, "accepted_answer_id")
    return joined.select(*_pair_columns(F.col("_body"), F.col("_score")))


# --- features ----------------------------------------------------------------------

def admitted(min_question: int = 20, min_answer: int = 50) -> Column:
    """Required fields are filled and both cleaned bodies are long enough."""
    return (
        _filled("question_body", "answer_body")
        & (F.char_length(text.clean_text("question_body")) >= min_question)
        & (F.char_length(text.clean_text("answer_body")) >= min_answer)
    )


def _filled(question: str, answer: str) -> Column:
    return (
        (F.coalesce(F.col("question_id"), F.lit(0)) != 0)
        & (F.coalesce(F.col(question), F.lit("")) != "")
        & (F.coalesce(F.col(answer), F.lit("")) != "")
    )


def _long_enough(question: str, answer: str, min_question: int = 20,
                 min_answer: int = 50) -> Column:
    """The admission rule where ``question_body`` and ``answer_body`` are already clean."""
    return (
        _filled(question, answer)
        & (F.char_length("question_body") >= min_question)
        & (F.char_length("answer_body") >= min_answer)
    )


def qa_features(pairs: DataFrame) -> DataFrame:
    """Admitted pairs with cleaned bodies, signatures, types, metrics and a quality score.

    The score is taken from the bodies as they came; everything else from the cleaned ones.
    """
    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    cleaned = computed(
        pairs.withColumn("_question", F.col("question_body"))
        .withColumn("_answer", F.col("answer_body")).withColumn("_title", F.col("title")),
        title=text.clean_text("title"), question_body=text.clean_text("question_body"),
        answer_body=text.clean_text("answer_body"),
    )
    scored = cleaned.filter(_long_enough("_question", "_answer")).withColumn(
        "quality_score",
        text.quality_score(
            number("score"), number("answer_score"), number("view_count"),
            F.col("_question"), F.col("_answer"),
        ),
    )
    both = F.concat_ws(
        " ", F.coalesce(F.col("_title"), F.lit("None")),
        F.col("question_body"), F.col("answer_body"),
    )
    return computed(scored, _both=both).select(
        "question_id", "title", "question_body", "answer_body", "tags", "score",
        "answer_score", "view_count",
        text.error_signatures("_both").alias("error_signatures"),
        text.infra_components("_both").alias("infra_components"),
        text.question_type("question_body").alias("question_type"),
        text.complexity("_both").alias("complexity"),
        text.text_metrics("question_body").alias("question_metrics"),
        text.text_metrics("answer_body").alias("answer_metrics"),
        "quality_score",
    )


def rank_by_quality(features: DataFrame) -> DataFrame:
    """Best pairs first; equal scores by question id."""
    return features.orderBy(F.desc("quality_score"), "question_id")


def pipeline_yield(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """One row: questions loaded, answers matched, records out, records filtered, average quality.

    The rows of one outer join carry all figures, so each source is read once. Questions without
    an answer count as loaded only.
    """
    renamed = answers.select(
        "question_id", F.struct(F.col("body"), F.col("score")).alias("_answer")
    )
    joined = questions.join(renamed, "question_id", "left")
    pairs = joined.select(
        *_pair_columns(F.col("_answer.body"), F.col("_answer.score")),
        F.col("_answer").isNotNull().alias("_matched"),
    )
    marked = computed(pairs, _kept=F.col("_matched") & admitted())
    quality = F.when(F.col("_kept"), text.quality_score(
        *[F.coalesce(F.col(c), F.lit(0)) for c in ("score", "answer_score", "view_count")],
        F.col("question_body"), F.col("answer_body"),
    ))
    return marked.agg(
        F.count("*").alias("questions_loaded"),
        F.count_if("_matched").alias("answers_matched"),
        F.count_if("_matched").alias("input_records"),
        F.count_if("_kept").alias("output_records"),
        (F.count_if("_matched") - F.count_if("_kept")).alias("filtered_count"),
        F.avg(quality).alias("avg_quality_score"),
    )


# --- validation --------------------------------------------------------------------

def _report(row: DataFrame, entries: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """A one-row aggregate -> (check, status, severity, value) rows.

    A null status drops its row: some warnings only exist when they fire.
    """
    structs = [
        F.struct(
            F.lit(name).alias("check"), status.alias("status"),
            F.when(status == "fail", "error").when(status == "warn", "warning")
            .otherwise("none").alias("severity"),
            value.cast("double").alias("value"),
        )
        for name, status, value in entries
    ]
    rows = row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    return rows.filter(F.col("status").isNotNull())


def _status(fail: Column, warn: Column | None = None) -> Column:
    out = F.when(fail, "fail")
    return (out.when(warn, "warn") if warn is not None else out).otherwise("pass")


def check_schema(fields: DataFrame) -> DataFrame:
    """Required fields that no record has fail, unexpected ones warn: one row per kind of fault.

    ``fields`` has one row per field that the records hold, with the column ``field``, as schema
    inference over their text gives it. Without unexpected fields there is no row for them.
    """
    known = rules.QA_KNOWN_COLUMNS + rules.QA_SIDE_COLUMNS
    required = rules.QA_REQUIRED_COLUMNS
    row = fields.agg(
        (F.lit(len(required)) - F.count_if(F.col("field").isin(required))).alias("missing"),
        F.count_if(~F.col("field").isin(known)).alias("extra"),
    )
    lacking, extra = F.col("missing") > 0, F.col("extra") > 0
    checks = F.array_compact(F.array(
        F.struct(
            F.lit("schema_required_columns").alias("check"),
            F.when(lacking, "fail").otherwise("pass").alias("status"),
            F.when(lacking, "error").otherwise("none").alias("severity"),
            F.col("missing").cast("double").alias("value"),
        ),
        F.when(extra, F.struct(
            F.lit("schema_extra_columns").alias("check"), F.lit("warn").alias("status"),
            F.lit("warning").alias("severity"), F.col("extra").cast("double").alias("value"),
        )),
    ))
    return row.select(F.inline(checks))


def check_data_quality(df: DataFrame, min_rows: int = 100, max_missing: float = 0.1,
                       max_duplicates: float = 0.05) -> DataFrame:
    """Row minimum, missing shares, duplicate ids and blank texts."""
    total = F.count("*")
    critical = ["question_id", "question_body", "answer_body"]
    texts = ["question_body", "answer_body", "title"]
    aggs = [total.alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in critical]
    aggs += [F.count_if(strip(c) == "").alias(f"blank_{c}") for c in texts]
    per_id = df.groupBy("question_id").agg(F.count("*").alias("n"))
    duplicates = per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()
    row = df.agg(*aggs).withColumn("duplicates", duplicates)
    rows = F.col("rows")
    entries = [("min_rows", _status(rows < min_rows), rows)]
    for c in critical:
        share = F.try_divide(F.col(f"missing_{c}"), rows)
        entries.append((f"missing_values_{c}",
                        _status(share > max_missing, F.col(f"missing_{c}") > 0), share))
    share = F.try_divide(F.col("duplicates"), rows)
    entries.append(("duplicates", _status(share > max_duplicates, F.col("duplicates") > 0), share))
    for c in texts:
        blank = F.col(f"blank_{c}")
        entries.append((f"empty_strings_{c}", F.when(blank > 0, "warn"), blank))
    return _report(row, entries)


def check_text_quality(df: DataFrame, short_question: int = 50, short_answer: int = 100,
                       max_short: float = 0.1) -> DataFrame:
    """Byte-length statistics of the bodies and a warning when too many are short.

    The rows are read once, to count each length, and all figures come from those counts.
    """
    sides = {"question": ("question_body", short_question), "answer": ("answer_body", short_answer)}
    counted = saved(df.select(F.inline(F.array(*[
        F.struct(F.lit(side).alias("side"), F.octet_length(column).cast("long").alias("size"))
        for side, (column, _) in sides.items()
    ]))).groupBy("side", "size").agg(F.count("*").alias("rows")), "text-lengths")
    medians = exact_quantiles(counted, ["size"], {"median": QUARTILES["median"]}, ["side"], "rows")
    aggs = [F.coalesce(F.sum(F.when(F.col("side") == "question", F.col("rows"))), F.lit(0)).alias("rows")]
    for side, (_, limit) in sides.items():
        size, rows = (F.when(F.col("side") == side, F.col(c)) for c in ("size", "rows"))
        known = F.sum(F.when(size.isNotNull(), rows))
        aggs += [
            F.min(size).alias(f"{side}_min"), F.max(size).alias(f"{side}_max"),
            (F.sum(size * rows) / known).alias(f"{side}_mean"),
            medians.where(F.col("side") == side).select("median").scalar().alias(f"{side}_median"),
            F.coalesce(F.sum(F.when(size < limit, rows)), F.lit(0)).alias(f"{side}_short"),
        ]
    entries = []
    for side in sides:
        for m in ["min", "max", "mean", "median"]:
            entries.append((f"{side}_length_{m}", F.lit("info"), F.col(f"{side}_{m}")))
        many = F.col(f"{side}_short") > F.col("rows") * max_short
        quiet = F.lit("pass") if side == "question" else F.lit(None)
        entries.append(
            (f"{side}_short_texts", F.when(many, "warn").otherwise(quiet), F.col(f"{side}_short"))
        )
    return _report(counted.agg(*aggs), entries)


def check_feature_distribution(df: DataFrame, min_tags: int = 3) -> DataFrame:
    """Spread of the scores and variety of the tags."""
    row = df.agg(
        F.stddev_samp("score").alias("score_std"), F.avg("score").alias("score_mean"),
        F.stddev_samp("quality_score").alias("quality_std"),
        F.avg("quality_score").alias("quality_mean"),
    )
    tags = df.select(F.explode("tags").alias("t")).agg(F.count_distinct("t")).scalar()
    return _report(row.withColumn("n_tags", tags), [
        ("score_mean", F.lit("info"), F.col("score_mean")),
        ("score_std", F.when(F.col("score_std") == 0, "warn").otherwise("info"),
         F.col("score_std")),
        ("quality_score_mean", F.lit("info"), F.col("quality_mean")),
        ("quality_score_std", F.lit("info"), F.col("quality_std")),
        ("unique_tags", F.when(F.col("n_tags") < min_tags, "warn").otherwise("info"),
         F.col("n_tags")),
    ])


def tag_distribution(df: DataFrame, n: int = 20) -> DataFrame:
    return top_list_values(df, "tags", n)


def schema_suite(df: DataFrame, min_rows: int = 100, max_rows: int | None = None) -> DataFrame:
    """The standard check suite of a processed pair table."""
    return quality.run_checks(df, [
        quality.columns_present(df, rules.QA_REQUIRED_COLUMNS),
        quality.no_nulls(df, ["question_id", "question_body", "answer_body", "score"]),
        quality.row_count(min_rows, max_rows),
        quality.unique(df, "question_id"),
        quality.value_range(df, "score", min_val=0),
        quality.value_range(df, "quality_score", min_val=0),
    ])


def iqr_bounds(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS,
               factor: float = 1.5) -> DataFrame:
    """Outlier bounds per numeric column from its exact quartiles."""
    spread = (F.col("q75") - F.col("q25")) * factor
    return exact_quantiles(df, columns, {k: QUARTILES[k] for k in ("q25", "q75")}).select(
        "column", (F.col("q25") - spread).alias("lower_bound"),
        (F.col("q75") + spread).alias("upper_bound"),
    )


def iqr_outliers(df: DataFrame, key: str = "question_id",
                 columns: Sequence[str] = NUMERIC_COLUMNS, factor: float = 1.5) -> DataFrame:
    """One row per value outside its column's bounds: (key, column, value, bounds)."""
    values = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns
    ])).alias("v")).select(key, "v.*")
    bounds = F.broadcast(iqr_bounds(df, columns, factor))  # one row per checked column
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return values.join(bounds, "column").filter(outside).select(
        key, "column", "value", "lower_bound", "upper_bound"
    )


def outlier_summary(df: DataFrame, key: str = "question_id",
                    columns: Sequence[str] = NUMERIC_COLUMNS, share: float = 0.05) -> DataFrame:
    """Outliers per column and a warning above ``share`` of the rows."""
    total = df.agg(F.count("*")).scalar()
    return (
        iqr_outliers(df, key, columns).groupBy("column").agg(F.count("*").alias("outliers"))
        .withColumn("warning", F.col("outliers") > total * share)
    )


def html_residue(df: DataFrame, column: str = "question_body") -> DataFrame:
    """Rows whose text still holds a plain tag."""
    return df.filter(F.col(column).rlike("<[a-z]+>"))


# --- slices and bias -----------------------------------------------------------------

def slice_names() -> Column:
    """The slices a record belongs to: type, complexity, tag_*, error_*, infra_*."""
    def prefixed(column: str, prefix: str) -> Column:
        values = F.array_distinct(F.coalesce(F.col(column), F.array().cast("array<string>")))
        return F.transform(values, lambda x: F.concat(F.lit(prefix), x))

    return F.concat(
        F.array_compact(F.array("question_type", "complexity")),
        prefixed("tags", "tag_"), prefixed("error_signatures", "error_"),
        prefixed("infra_components", "infra_"),
    )


def explode_slices(features: DataFrame) -> DataFrame:
    """One row per (record, slice it belongs to)."""
    return features.withColumn("slice", F.explode(slice_names()))


def _slice_measures() -> list[Column]:
    def spread(column: Column, name: str) -> list[Column]:
        return [F.avg(column).alias(f"{name}_mean"),
                F.coalesce(F.stddev_samp(column), F.lit(0.0)).alias(f"{name}_std")]

    shares = [
        (F.count_if(F.col("complexity") == c) / F.count("*")).alias(f"{c}_share")
        for c in ("simple", "moderate", "complex")
    ]
    return [
        F.count("*").alias("count"), *spread(F.col("quality_score"), "quality"),
        *spread(F.col("answer_score"), "answer_score"),
        *spread(F.octet_length("question_body"), "question_length"),
        *spread(F.octet_length("answer_body"), "answer_length"), *shares,
    ]


def slice_metrics(features: DataFrame, min_samples: int = 30,
                  with_median: bool = False) -> DataFrame:
    """Measures of every slice with at least ``min_samples`` records, and of all records.

    All slices come from one explode and one aggregation, whatever their number. The row of
    all records has a null ``slice``. The table is as small as the number of slices and feeds
    several steps, so it is written once instead of computing the features again for each.
    """
    with_all = F.concat(slice_names(), F.array(F.lit(None).cast("string")))
    table = checkpointed(
        features.withColumn("slice", F.explode(with_all)).groupBy("slice").agg(
            *_slice_measures()
        )
    )
    total = table.agg(F.max(F.when(F.col("slice").isNull(), F.col("count")))).scalar()
    metrics = table.filter(
        F.col("slice").isNull() | (F.col("count") >= min_samples)
    ).withColumn("proportion", F.col("count") / total)
    if not with_median:
        return metrics
    medians = exact_quantiles(
        explode_slices(features), ["quality_score"], {"quality_median": (0.5, "linear")}, by=["slice"]
    ).select("slice", "quality_median")
    return metrics.join(medians, "slice", "left")


def slice_bias(metrics: DataFrame, threshold: float = 0.25) -> DataFrame:
    """Compare each slice with all records: factors found and a severity.

    Factors: quality differs by more than ``threshold``, answer length by more than half, or
    the slice is tiny. ``factors`` is a list of (factor, difference_ratio, direction).
    """
    whole = metrics.agg(F.max(F.when(
        F.col("slice").isNull(), F.struct("quality_mean", "answer_length_mean")
    ))).scalar()
    metrics = metrics.filter(F.col("slice").isNotNull())

    def difference(column: str) -> Column:
        base = whole.getField(column)
        return F.when(base > 0, F.abs(F.col(column) - base) / base)

    def direction(column: str, more: str, less: str) -> Column:
        return F.when(F.col(column) > whole.getField(column), more).otherwise(less)

    def factor(name: str, ratio: Column, way: Column) -> Column:
        return F.struct(
            F.lit(name).alias("factor"), F.round(ratio, 3).alias("difference_ratio"),
            way.alias("direction"),
        )

    compared = metrics.withColumn("quality_diff", difference("quality_mean")).withColumn(
        "length_diff", difference("answer_length_mean")
    )
    nothing = F.lit(None).cast("string")
    factors = F.array_compact(F.array(
        F.when(F.col("quality_diff") > threshold,
               factor("quality_score", F.col("quality_diff"),
                      direction("quality_mean", "higher", "lower"))),
        F.when(F.col("length_diff") > 0.5,
               factor("answer_length", F.col("length_diff"),
                      direction("answer_length_mean", "longer", "shorter"))),
        F.when((F.col("proportion") < 0.005) & (F.col("count") < 20),
               factor("underrepresentation", F.lit(0.0), nothing)),
    ))
    worst = F.array_max(F.transform("factors", lambda f: f["difference_ratio"]))
    n = F.array_size("factors")
    severity = (
        F.when(n == 0, "none").when((worst > 0.75) | (n >= 3), "high")
        .when((worst > 0.5) | (n >= 2), "medium").otherwise("low")
    )
    return (
        compared.withColumn("factors", factors).withColumn("is_biased", n > 0)
        .withColumn("severity", severity).drop("quality_diff", "length_diff")
    )


def mitigations(bias: DataFrame) -> DataFrame:
    """Suggested remedy per biased slice and factor: (slice, issue, strategy, priority)."""
    rows = bias.select("slice", "count", F.explode("factors").alias("f"))
    kind, way = F.col("f.factor"), F.col("f.direction")
    lower = (kind == "quality_score") & (way == "lower")
    strategy = (
        F.when(kind == "underrepresentation", "data_augmentation")
        .when(lower, "quality_filtering").when(kind == "answer_length", "length_normalization")
    )
    issue = (
        F.when(kind == "underrepresentation", F.lit("Underrepresentation"))
        .when(lower, F.lit("Lower quality examples"))
        .when(kind == "answer_length",
              F.concat(F.lit("Answers are "), way, F.lit(" than average")))
    )
    priority = (
        F.when(kind == "underrepresentation", F.when(F.col("count") < 50, "high")
               .otherwise("medium"))
        .when(lower, "medium").otherwise("low")
    )
    return rows.filter(strategy.isNotNull()).select(
        "slice", issue.alias("issue"), strategy.alias("strategy"), priority.alias("priority")
    )


def bias_summary(bias: DataFrame) -> DataFrame:
    """One row: slices, biased slices, bias rate and slices per severity."""
    biased = F.count_if(F.col("is_biased"))
    return bias.agg(
        F.count("*").alias("total_slices"), biased.alias("biased_slices"),
        F.coalesce(F.try_divide(biased, F.count("*")), F.lit(0.0)).alias("bias_rate"),
        *[F.count_if(F.col("severity") == s).alias(f"{s}_severity_count")
          for s in ("high", "medium", "low")],
    )


# --- training forms --------------------------------------------------------------------

def message(role: str, content: Column | str) -> Column:
    content = F.col(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_records(features: DataFrame, system_prompt: str | None = rules.QA_SYSTEM_PROMPT
                 ) -> DataFrame:
    """Pairs as chat messages with metadata; ``system_prompt=None`` leaves the system turn out."""
    weight = F.col("sample_weight") if "sample_weight" in features.columns else F.lit(1.0)
    turns = [message("user", F.coalesce("question_body", F.lit(""))),
             message("assistant", F.coalesce("answer_body", F.lit("")))]
    if system_prompt is not None:
        turns.insert(0, message("system", F.lit(system_prompt)))
    return features.select(
        F.array(*turns).alias("messages"),
        F.struct(
            "question_id", "tags", "error_signatures", "infra_components", "quality_score",
            weight.alias("sample_weight"),
        ).alias("metadata"),
    )


def completion_records(features: DataFrame) -> DataFrame:
    """Pairs as prompt and completion texts."""
    prompt = F.concat(
        F.lit("### Question\n"), F.coalesce("title", F.lit("")), F.lit("\n\n"),
        F.coalesce("question_body", F.lit("")), F.lit("\n\nTags: "),
        F.array_join("tags", ", "), F.lit("\n\n### Answer\n"),
    )
    return features.select(
        prompt.alias("prompt"), F.coalesce("answer_body", F.lit("")).alias("completion"),
        F.struct("question_id", "quality_score").alias("metadata"),
    )


def score_profile(df: DataFrame) -> DataFrame:
    return numeric_profile(df, NUMERIC_COLUMNS)
