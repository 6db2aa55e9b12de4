"""The shared test tables dressed as the operators' inputs.

Each binding is a list of (column, SQL expression). Spark evaluates it on the table's frame;
the checking SQL puts the same text into a common table expression. Only date formats and
array literals are spelled per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.functions import corpus
from opsloom.operators import chats, combine, logs, qa, traces
from opsloom.operators import corpus as corpus_ops
from opsloom.operators.qa import message

SPARK, DUCK = "spark", "duck"


def case(selector: str, *values: str, default: str | None = None) -> str:
    """CASE over 0, 1, 2, ...; ``default`` is the ELSE branch."""
    branches = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {selector} {branches}{tail} END"


def text(value: str) -> str:
    """A SQL string literal; line breaks become chr(10)."""
    parts = ["'" + p.replace("'", "''") + "'" for p in value.split("\n")]
    return " || chr(10) || ".join(parts)


def array(dialect: str, *items: str) -> str:
    inside = ", ".join(f"'{i}'" for i in items)
    return f"array({inside})" if dialect == SPARK else f"[{inside}]"


DATE_FORMS = {
    "month": ("MMM", "%b"), "day": ("d", "%-d"), "clock": ("HH:mm:ss", "%H:%M:%S"),
    "compact_day": ("yyMMdd", "%y%m%d"), "compact_clock": ("HHmmss", "%H%M%S"),
    "iso_day": ("yyyy-MM-dd", "%Y-%m-%d"), "milli_clock": ("HH:mm:ss,SSS", "%H:%M:%S,%g"),
    "slash_day": ("yy/MM/dd", "%y/%m/%d"),
}


def date_text(dialect: str, form: str, column: str = "ts") -> str:
    java, strf = DATE_FORMS[form]
    if dialect == SPARK:
        return f"date_format({column}, '{java}')"
    return f"strftime({column}, '{strf}')"


def epoch_seconds(dialect: str, column: str = "ts") -> str:
    if dialect == SPARK:
        return f"unix_timestamp({column})"
    return f"CAST(floor(epoch({column})) AS BIGINT)"


LOG_PHRASES = [
    "Failed password for root", "access denied for user <*>", "block missing on datanode <*>",
    "java heap space exhausted", "connection refused by peer <*>",
    "IOException while reading input split", "executor lost on host <*>", "kernel panic at boot",
    "unhandled exception in worker", "checksum mismatch on block <*>",
    "request timeout after <*> ms", "host unreachable <*>", "verification failed for block <*>",
    "session opened for user <*>", "Received block <*> of size <*>", "task <*> finished",
    "retry scheduled, backoff <*>", "fallback to local disk", "container killed by scheduler",
    "pam_unix session closed", "not permitted to mount <*>", "namenode down",
    "OOM killer invoked", "broken pipe on channel <*>", "could not read partition <*>",
    "stage failed, resubmitting", "reboot requested", "heartbeat from <*>",
    "warn: clock skew <*>", "statistics flushed",
]
SYSTEM = case("user_id % 5", "'linux'", "'hpc'", "'hdfs'", "'hadoop'", default="'spark'")


def raw_logs(dialect: str) -> list[tuple[str, str]]:
    """Structured log lines of all five systems, from ``events``."""
    def d(form: str) -> str:
        return date_text(dialect, form)

    phrase = case("event_id % 30", *[text(p) for p in LOG_PHRASES])
    day = case("user_id % 5", d("day"), "''", d("compact_day"), d("iso_day"),
               default=d("slash_day"))
    clock = case("user_id % 5", d("clock"), f"CAST({epoch_seconds(dialect)} AS STRING)",
                 d("compact_clock"), d("milli_clock"), default=d("clock"))
    pid = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(user_id AS STRING) END"
    return [
        ("event_id_number", "event_id"),
        ("system", SYSTEM),
        ("LineId", "CAST(event_id AS STRING)"),
        ("LogId", "CASE WHEN event_id % 3 = 0 THEN ' ' ELSE 'L' || CAST(event_id AS STRING) END"),
        ("Month", d("month")),
        ("Date", f"CASE WHEN event_id % 41 = 0 THEN 'n/a' ELSE {day} END"),
        ("Time", clock),
        ("Node", "'node-' || CAST(user_id AS STRING)"),
        ("Component", "'comp' || CAST(event_id % 7 AS STRING)"),
        ("State", case("event_id % 9", "'state_change.unavailable'", "'Degraded'",
                       "'unix.hw.failing'", default="'ok'")),
        ("Flag", "CASE WHEN event_id % 13 = 0 THEN ' 1 ' ELSE '0' END"),
        ("Level", "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN ' warning ' "
                  "WHEN 'click' THEN 'debug' WHEN 'view' THEN 'combo' ELSE 'INFO' END"),
        ("PID", pid),
        ("Process", pid),
        ("Content", f"event_type || ' ' || props || ' ' || {phrase}"),
        ("EventId", "CASE WHEN event_id % 30 = 28 THEN 'X29' "
                    "ELSE 'E' || CAST(event_id % 30 + 1 AS STRING) END"),
        ("EventTemplate", f"CASE WHEN event_id % 30 = 29 THEN NULL ELSE {phrase} END"),
    ]


def log_templates(dialect: str) -> list[tuple[str, str]]:
    """Template rows, from ``nation`` (25 keys): some ids are absent, some doubled."""
    return [
        ("EventId", "'E' || CAST((n_nationkey * 2) % 32 + 1 AS STRING)"),
        ("EventTemplate", "'template ' || n_name"),
        ("Occurrences", "CAST(n_nationkey AS STRING)"),
        ("system", case("n_regionkey", "'linux'", "'hpc'", "'hdfs'", "'hadoop'",
                        default="'spark'")),
    ]


def server_usage(dialect: str) -> list[tuple[str, str]]:
    """Utilisation readings, from ``events``."""
    zero = "CAST(0 AS DOUBLE)"
    return [
        ("time_stamp", f"{epoch_seconds(dialect)}"),
        ("machine_id", "'m_' || CAST(user_id AS STRING)"),
        ("cpu_util_percent", "least(value, CAST(100 AS DOUBLE))"),
        ("mem_util_percent", "CAST((event_id * 7) % 100 AS DOUBLE)"),
        ("net_in", zero), ("net_out", zero), ("disk_io_percent", zero), ("extra", "props"),
    ]


def server_events(dialect: str) -> list[tuple[str, str]]:
    """Machine events, from ``events``."""
    return [
        ("key", "'e' || CAST(event_id AS STRING)"),
        ("time_stamp", f"{epoch_seconds(dialect)}"),
        ("machine_id", "'m_' || CAST(user_id AS STRING)"),
        ("event_type", "CASE event_type WHEN 'error' THEN 'Failure' WHEN 'signup' THEN 'ADD' "
                       "WHEN 'view' THEN NULL WHEN 'click' THEN 'softerror' ELSE 'remove' END"),
        ("plan_cpu", "least(value, CAST(100 AS DOUBLE))"),
        ("plan_mem", "CAST(event_id % 11 AS DOUBLE) / 10"),
    ]


def batch_tasks(dialect: str) -> list[tuple[str, str]]:
    """Batch tasks, from ``lineitem`` joined with ``orders``."""
    return [
        ("key", "'t' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
                " || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"),
        ("start_time", "CAST(l_orderkey AS BIGINT)"),
        ("end_time", "CAST(l_orderkey AS BIGINT) + l_linenumber"),
        ("inst_num", "l_linenumber"),
        ("task_type", "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_linenumber END"),
        ("job_id", "'j_' || CAST(l_orderkey AS STRING)"),
        ("status", "CASE WHEN l_linenumber = 5 THEN NULL WHEN o_orderstatus = 'F' THEN 'Failed' "
                   "WHEN o_orderstatus = 'O' THEN 'Terminated' ELSE 'Waiting' END"),
        ("plan_cpu", "l_quantity * 2"),
        ("plan_mem", "l_discount * 10"),
    ]


QUESTION_PHRASES = [
    "How do I fix CrashLoopBackOff in my pod? See http://docs.example.org/a?b=1 now.",
    "Why is the service unreachable &amp; dns failing? ```kubectl get pods```",
    "What is the best practice for a docker image? `docker build .` `docker push`",
    "I need to resolve OOMKilled on gpu nodes! Quota exceeded.",
    "Job crash with exception, connection refused by postgres.",
    "Should I recommend terraform modules for aws? ```hcl``` ```tf``` `plan`",
    "permission denied 403 on jenkins pipeline",
    "ImagePullBackOff &lt;error&gt; with config yaml invalid",
    "",
]
ANSWER_PHRASES = ["Run ```kubectl apply -f x.yaml``` then `kubectl get`.", "See the &quot;docs&quot;.",
                  "", "Use prometheus metrics.", "```a``` ```b``` ```c```"]
QUESTION_ID = "conv_id * 100 + turn + 1"


def questions(dialect: str) -> list[tuple[str, str]]:
    """Raw question rows (all text), from the user turns of ``conversations``."""
    phrase = case("(conv_id + turn) % 9", *[text(p) for p in QUESTION_PHRASES])
    return [
        ("Id", f"CASE WHEN conv_id % 53 = 7 THEN 'x' ELSE '' END || CAST({QUESTION_ID} AS STRING)"),
        ("Title", f"'Question ' || CAST({QUESTION_ID} AS STRING) || ' &amp; <b>more</b>'"),
        ("Body", f"'<p>' || text || '</p> ' || {phrase}"),
        ("Tags", case("conv_id % 6", "'<kubernetes><docker>'", "'<gpu>'",
                      "'<terraform><kubernetes>'", "''", "NULL", "'<airflow>'")),
        ("Score", "CASE WHEN conv_id % 47 = 8 THEN 'n/a' WHEN conv_id % 43 = 9 THEN '' "
                  "ELSE CAST(conv_id % 40 AS STRING) END"),
        ("ViewCount", "CAST(((conv_id * 37) % 500) * 10 AS STRING)"),
        ("AcceptedAnswerId", "CASE WHEN conv_id % 11 = 0 THEN ' ' "
                             f"ELSE CAST({QUESTION_ID} + 1 AS STRING) END"),
        ("CreationDate", "'2024-01-01'"),
    ]


def answers(dialect: str) -> list[tuple[str, str]]:
    """Raw answer rows (all text), from the assistant turns; ``again`` is 0 or 50."""
    phrase = case("(conv_id + turn) % 5", *[text(p) for p in ANSWER_PHRASES])
    return [
        ("AnswerId", f"CAST({QUESTION_ID} + again AS STRING)"),
        ("QuestionId", f"CAST({QUESTION_ID} - 1 AS STRING)"),
        ("AnswerBody", f"'<div>' || text || '</div> ' || {phrase}"),
        ("AnswerScore", "CASE WHEN conv_id % 59 = 3 THEN 'bad' "
                        "ELSE CAST(conv_id % 17 + turn + again AS STRING) END"),
    ]


CALL_BLOCKS = [
    "",
    """<functioncall> {"name": "get_weather", "arguments": '{"city": "Oslo"}'} <|endoftext|>""",
    """<functioncall> {"name": "scale", "arguments": {"a": 1, "b": 2, "c": [1, 2]}} <|endoftext|>""",
    """<functioncall> {"name": "one", "arguments": '{"x": 1}'} <|endoftext|> USER: again """
    """ASSISTANT: <functioncall> {"name": "two", "arguments": '{"y": {"z": 2}}'} <|endoftext|>""",
    """<functioncall> {"name": "f", "arguments": '{broken json'} <|endoftext|>""",
    """<functioncall> {"name": "noargs"} <|endoftext|> <functionresponse> {"status": "failed"}"""
    """ </functionresponse>""",
    "If the call hits an error, retry. USER: and then? ASSISTANT: done.",
    """<functioncall> {"arguments": "plain text"}""",
]
FUNCTION_TEXTS = [
    """SYSTEM: You are helpful. {"name": "get_weather", "description": "Weather", "parameters": """
    """{"type": "object", "properties": {"city": {"type": "string"}, "unit": {"type": "string"}},"""
    """ "required": ["city"]}}""",
    "You are a helpful assistant.",
    """Functions: {"name": "a", "description": "x"} {"name": "b"}""",
    None,
    """{"name": "restart_pod", "parameters": []}""",
]


def call_chats(dialect: str) -> list[tuple[str, str]]:
    """(system, chat) rows, from user turns joined with the next assistant turn."""
    block = case("(conv_id + turn) % 8", *[text(b) for b in CALL_BLOCKS])
    system = case("conv_id % 5", *["NULL" if f is None else text(f) for f in FUNCTION_TEXTS])
    return [
        ("id", f"{QUESTION_ID}"),
        ("system", system),
        ("chat", "CASE WHEN conv_id % 61 = 5 THEN '' ELSE 'USER: ' || user_text || ' ASSISTANT: '"
                 f" || reply_text || ' ' || {block} END"),
    ]


WORKFLOWS = [
    """{"steps": [{"step_id": 1, "tool": "scale_service", "params": {"deployment": "web", """
    """"replicas": 3}}]}""",
    """{"steps": []}""",
    """{"steps": [{"step_id": 1, "params": {}}]}""",
    """{"steps": [{"step_id": 1, "tool": "restart_pod", "params": {"pod": "p1", "extra": 1}}]}""",
    "not json",
    None,
    """{"steps": [{"step_id": "2", "tool": "restart_pod", "params": {"pod": null}}], "note": "x"}""",
    """{"steps": {"step_id": 1}}""",
    """{"steps": [{"step_id": 1.5, "tool": "t", "params": {}}]}""",
]
VALID_WORKFLOWS = [0, 1, 6]


def prompts(dialect: str) -> list[tuple[str, str]]:
    """Workflow prompts, from the user turns of ``conversations``."""
    return [
        ("id", QUESTION_ID),
        ("user_intent", "CASE WHEN conv_id % 19 = 0 THEN '' ELSE text END"),
        ("tool_context", "'scale_service, restart_pod'"),
        ("workflow_json", case("(conv_id + turn) % 9",
                               *["NULL" if w is None else text(w) for w in WORKFLOWS])),
    ]


MANIFEST_HEADS = [
    "apiVersion: apps/v1\nkind: Deployment\nmetadata:\n  name: gpu-train\nspec:\n"
    "  accelerator: nvidia.com/gpu\n",
    "apiVersion: serving.kserve.io/v1beta1\nkind: InferenceService\nmetadata:\n"
    "  name: predictor\n",
    "apiVersion: v1\nkind: Service\nmetadata:\n  name: web\n",
    "apiVersion: machinelearning.seldon.io/v1\nkind: SeldonDeployment\nmetadata:\n  name: s\n",
    "name: ci workflow\n",
    "apiVersion: v1\nkind: Job\nmetadata:\n  name: [unclosed\n",
    "apiVersion: v1\nmetadata:\n  name: nokind\n",
    'resource "aws_x" "y" {}\n',
]


def iac_files(dialect: str) -> list[tuple[str, str]]:
    """Source files of an infrastructure corpus, from ``documents``.

    A manifest head picked by doc_id, then the whole text as a YAML block. Head 5 is broken
    YAML; heads with the ``secret`` line break when credentials are redacted.
    """
    head = case("doc_id % 8", *[text(h) for h in MANIFEST_HEADS])
    nothing = "CAST(NULL AS STRING)"
    lists = [array(dialect, "MIT"), array(dialect, "GPL-3.0", "Apache-2.0 "),
             array(dialect, "GPL-3.0"), "NULL", array(dialect, "", " "),
             array(dialect, "BSD-3-Clause")]
    no_list = f"CASE WHEN doc_id < 0 THEN {array(dialect, 'MIT')} END"
    return [
        ("doc_id", "doc_id"),
        ("content",
         "CASE WHEN doc_id % 37 = 0 THEN NULL ELSE "
         f"CASE WHEN doc_id % 16 = 14 THEN {text('apiVersion: v1' + chr(10) + 'kind: ConfigMap' + chr(10))} "
         f"ELSE {head} END"
         f" || CASE WHEN doc_id % 24 = 3 THEN {text('secret: {x: 1, y: 2}' + chr(10))} ELSE '' END"
         f" || 'notes: |2' || chr(10) || '  ' || replace(text, chr(10), chr(10) || '  ') END"),
        ("ext", case("doc_id % 10", "'.YML'", "''", "'json'", default="'yaml'")),
        ("lang", "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'yaml' END"),
        ("size", "CASE WHEN doc_id % 29 = 0 THEN 600000 ELSE n_chars END"),
        ("avg_line_length", "CAST(n_chars AS DOUBLE) / 40"),
        ("max_line_length", "n_chars"),
        ("alphanum_fraction",
         "CASE WHEN doc_id % 31 = 0 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END"),
        ("hexsha", "md5(text)"),
        ("max_stars_repo_path", case(
            "doc_id % 7", "'deploy/' || source || '/gpu-train_job.yaml'", "' '", "NULL",
            "'svc/my_service.YML'", "'a/b/ingress-main.yaml'", "'secret.yaml'",
            default="'x/' || source || '.yml'")),
        ("max_stars_repo_name", "source"),
        ("max_stars_repo_licenses", case("doc_id % 6", *lists)),
        ("max_issues_repo_path",
         "CASE WHEN doc_id % 2 = 0 THEN 'pipelines/inference-' || lang || '.yaml' END"),
        ("max_forks_repo_path", nothing),
        ("max_issues_repo_licenses",
         f"CASE WHEN doc_id % 12 = 3 THEN {array(dialect, 'ISC')} END"),
        ("max_forks_repo_licenses", no_list),
        ("repo_url", "'https://example.org/' || source"),
    ]


def select(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS `{name}`" for name, expr in columns])


class Tables:
    """The bound inputs over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # logs
    def raw_logs(self) -> DataFrame:
        return select(self.read("events"), raw_logs(SPARK))

    def raw_log(self, system: str) -> DataFrame:
        return self.raw_logs().filter(F.col("system") == system)

    def unified(self) -> DataFrame:
        return logs.normalize_mixed(self.raw_logs())

    def labelled(self) -> DataFrame:
        return logs.label_event_types(self.unified())

    def templates(self) -> DataFrame:
        return select(self.read("nation"), log_templates(SPARK))

    # traces
    def usage(self) -> DataFrame:
        return select(self.read("events"), server_usage(SPARK))

    def usage_stream(self) -> DataFrame:
        path = f"{self.folder}/events.parque[t]"     # a pattern, as a stream takes no single file
        return select(self.spark.readStream.schema(self.read("events").schema).parquet(path), server_usage(SPARK))

    def machine_events(self) -> DataFrame:
        return select(self.read("events"), server_events(SPARK))

    def tasks(self) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_orderstatus")
        items = self.read("lineitem")
        joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
        return select(joined, batch_tasks(SPARK))

    def sequences(self) -> DataFrame:
        """Task and machine-event sequences with their row key."""
        return traces.task_sequences(self.tasks(), keep=["key"]).unionByName(
            traces.machine_event_sequences(self.machine_events(), keep=["key"])
        )

    # questions and answers
    def turns(self, role: str) -> DataFrame:
        return self.read("conversations").filter(F.col("role") == role)

    def questions(self) -> DataFrame:
        return select(self.turns("user"), questions(SPARK))

    def answers(self) -> DataFrame:
        """Every fourth conversation answers each question twice; the second comes later."""
        said = self.turns("assistant")
        first = said.withColumn("again", F.lit(0))
        second = said.filter(F.col("conv_id") % 4 == 0).withColumn("again", F.lit(50))
        both = select(first.unionByName(second), answers(SPARK))
        return both.withColumn("row_order", F.col("AnswerId").cast("bigint"))

    def pairs(self) -> DataFrame:
        return qa.pair_by_question(
            qa.clean_questions(self.questions()), qa.clean_answers(self.answers(), "row_order")
        )

    def features(self) -> DataFrame:
        return qa.qa_features(self.pairs())

    # chats
    def turn_pairs(self) -> DataFrame:
        user = self.turns("user").select("conv_id", "turn", F.col("text").alias("user_text"))
        reply = self.turns("assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply_text")
        )
        return user.join(reply, ["conv_id", "turn"])

    def call_chats(self) -> DataFrame:
        return select(self.turn_pairs(), call_chats(SPARK))

    def call_features(self) -> DataFrame:
        return chats.call_features(self.call_chats())

    def prompts(self) -> DataFrame:
        return select(self.turns("user"), prompts(SPARK))

    def chat_records(self) -> DataFrame:
        """Chat records, five of six with something odd."""
        kind = (F.col("conv_id") + F.col("turn")) % 6
        system = message("system", F.lit("Available Tools: none"))
        user, reply = message("user", "user_text"), message("assistant", "reply_text")
        messages = (
            F.when(kind == 0, F.array(system, user, message("assistant", F.lit('{"ok": 1}'))))
            .when(kind == 1, F.array(user, reply))
            .when(kind == 2, F.array(system, user, user))
            .when(kind == 3, F.array(system, user, reply))
            .when(kind == 5, F.array(system, user, message("assistant", F.lit(""))))
        )
        return self.turn_pairs().select(
            F.expr(QUESTION_ID).alias("id"), messages.alias("messages"),
            F.expr("CASE WHEN conv_id % 19 = 0 THEN '' ELSE user_text END").alias("user_intent"),
        )

    # corpus
    def files(self) -> DataFrame:
        return select(self.read("documents"), iac_files(SPARK))

    def records(self) -> DataFrame:
        return corpus_ops.training_records(self.files())

    def record_lines(self) -> DataFrame:
        """Training records as JSON lines, unredacted, eight of nine with a defect."""
        kind = F.col("doc_id") % 9
        content = F.coalesce("content", F.lit(""))

        def packed(tool: str, manifest) -> F.Column:
            return F.to_json(F.struct(
                F.lit(tool).alias("tool"),
                F.struct(manifest.alias("manifest_content")).alias("params"),
            ))

        path = corpus.best_path()
        prompt = corpus.synthesize_prompt(path)
        user, reply = message("user", prompt), message("assistant", corpus.wrap_manifest(content))
        whole = F.struct("hexsha", path.alias("path"), "size", corpus.licenses().alias("licenses"))

        def line(messages, meta=whole):
            return F.to_json(F.struct(messages.alias("messages"), meta.alias("_meta")))

        record = (
            F.when(kind == 1, F.lit("not json"))
            .when(kind == 2, F.to_json(F.struct(F.array(user, reply).alias("messages"))))
            .when(kind == 3, line(F.array(user)))
            .when(kind == 4, line(F.array(
                message("assistant", prompt), message("user", corpus.wrap_manifest(content)))))
            .when(kind == 5, line(F.array(
                user, message("assistant", packed("other_tool", content)))))
            .when(kind == 6, line(F.array(
                user, message("assistant", packed("apply_manifest", F.lit(""))))))
            .when(kind == 7, line(F.array(user, reply), F.struct("hexsha", "size")))
            .when(kind == 8, line(F.array(message("user", F.lit(" ")), reply)))
            .otherwise(line(F.array(user, reply)))
        )
        return self.files().select("doc_id", record.alias("record"))

    def combined_lines(self) -> DataFrame:
        """JSON lines of two sources as text, some malformed, with their source name."""
        text_lines = self.read("customer").select(
            F.expr("CASE WHEN c_custkey % 7 = 0 THEN '{broken' WHEN c_custkey % 7 = 1 THEN '' "
                   "ELSE '{\"id\": ' || CAST(c_custkey AS STRING) || '}' END").alias("value"),
            F.expr("CASE WHEN c_nationkey % 2 = 0 THEN 'qa' ELSE 'calls' END")
            .alias("source_dataset"),
        )
        return text_lines

    def combined(self) -> DataFrame:
        return combine.combine_sequences({
            "traces": traces.task_sequences(self.tasks()),
            "logs": traces.machine_event_sequences(self.machine_events()),
            "absent": None,
        })
