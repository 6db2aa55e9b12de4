"""The SQL each named query is checked against, written for another engine (DuckDB).

Inputs come from the shared bindings; everything the operators do is spelled out again here
in SQL. Queries without an entry are checked against small fixtures in the tests instead.
"""

from __future__ import annotations

from opsloom.functions import rules
from opsloom.plans import bindings as b

# --- SQL fragments ---------------------------------------------------------------------------


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def has(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def matches(text: str, pattern: str, flags: str = "") -> str:
    tail = f", {lit(flags)}" if flags else ""
    return f"regexp_matches({text}, {lit(pattern)}{tail})"


def count_matches(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {lit(pattern)}))"


def squeeze(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def join_list(items: str) -> str:
    return f"coalesce(array_to_string({items}, ','), '')"


def names_found(text: str, patterns: dict[str, str]) -> str:
    parts = [f"CASE WHEN {matches(text, p, 'i')} THEN {lit(n)} END" for n, p in patterns.items()]
    return join_list(f"[{', '.join(parts)}]")


def clean_html(text: str) -> str:
    out = f"regexp_replace(coalesce({text}, ''), '<[^>]+>', ' ', 'g')"
    for name, char in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"),
                       ("amp", "&")]:
        out = f"regexp_replace({out}, '&{name};?', '{char}', 'g')"
    return squeeze(out)


def clean_text(text: str, remove_code: bool = False) -> str:
    out = rf"regexp_replace(coalesce({text}, ''), 'https?://\S+', '[URL]', 'g')"
    if remove_code:
        out = f"regexp_replace({out}, {lit(rules.FENCED_CODE)}, '', 'g')"
        out = f"regexp_replace({out}, {lit(rules.INLINE_CODE)}, '', 'g')"
    return squeeze(out)


def words(text: str) -> str:
    return count_matches(text, r"\S+")


def blocks(text: str) -> str:
    return count_matches(text, rules.CODE_BLOCK)


EMAIL = r"(^|[^/\pL\pN_])[\pL\pN_.+-]{2,}@[\pL\pN_-]+\.[\pL\pN_.-]+"
PII = {**rules.PII_PATTERNS, "email": EMAIL}


def redact(text: str) -> str:
    out = f"regexp_replace({text}, {lit(PII['ipv4'])}, 'IPV4_REDACTED', 'g')"
    out = f"regexp_replace({out}, {lit(PII['api_key'])}, 'sk-REDACTED', 'g')"
    out = f"regexp_replace({out}, {lit(EMAIL)}, '\\1EMAIL_REDACTED', 'g')"
    return f"regexp_replace({out}, {lit('(?i)' + PII['creds'])}, '\\1: REDACTED', 'g')"


def kind_of_file(text: str, terraform: bool = False) -> str:
    kinds = rules.MANIFEST_TYPES + ([rules.TERRAFORM_TYPE] if terraform else [])
    cases = " ".join(f"WHEN {matches(text, p)} THEN {lit(n)}" for n, p in kinds)
    return f"CASE {cases} ELSE 'other' END"


def size_class(size: str) -> str:
    return (f"CASE WHEN coalesce({size}, 0) < 1000 THEN '<1KB' WHEN {size} < 10000 THEN '1-10KB' "
            f"WHEN {size} < 100000 THEN '10-100KB' ELSE '>100KB' END")


def escape_class(text: str, medium: int, hard: int) -> str:
    def count(mark: str) -> str:
        return f"(length({text}) - length(replace({text}, {mark}, '')))"

    score = f"({count('chr(10)')} + 2 * {count(chr(39) + chr(34) + chr(39))} + 3 * {count('chr(92)')})"
    return f"CASE WHEN {score} > {hard} THEN 'hard' WHEN {score} > {medium} THEN 'medium' ELSE 'easy' END"


PATH = ("coalesce(nullif(trim(max_stars_repo_path), ''), nullif(trim(max_issues_repo_path), ''), "
        "nullif(trim(max_forks_repo_path), ''), '')")
SLUG = (r"trim(regexp_replace(regexp_replace(regexp_extract(coalesce(nullif(" + PATH +
        r", ''), 'manifest.yaml'), '[^/]*$'), '(?i)\.(yaml|yml)$', ''), '[-_]+', ' ', 'g'))")


def prompt_sql() -> str:
    def fill(template: str) -> str:
        before, after = template.split("{slug}")
        return f"{lit(before)} || {SLUG} || {lit(after)}"

    cases = " ".join(f"WHEN contains(lower({SLUG}), {lit(w)}) THEN {fill(t)}"
                     for w, t in rules.PROMPT_RULES)
    return f"CASE {cases} ELSE {fill(rules.PROMPT_FALLBACK)} END"


def prompt_class(prompt: str) -> str:
    cases = " ".join(f"WHEN contains(lower({prompt}), '{w}') THEN '{w}'"
                     for w in rules.PROMPT_TYPES)
    return f"CASE {cases} ELSE 'fallback' END"


LICENSES = ("list_transform(list_filter(coalesce(max_stars_repo_licenses, []) || "
            "coalesce(max_issues_repo_licenses, []) || coalesce(max_forks_repo_licenses, []), "
            "lambda x: trim(x) <> ''), lambda x: lower(trim(x)))")
PERMISSIVE = "[" + ", ".join(lit(x) for x in rules.PERMISSIVE_LICENSES) + "]"
LICENSE_CLASS = (f"CASE WHEN len({LICENSES}) = 0 THEN 'unknown' ELSE "
                 f"coalesce(list_filter({LICENSES}, lambda x: list_contains({PERMISSIVE}, x))[1], "
                 "'other') END")
ALL_WORDS = [w for ws in rules.CORPUS_KEYWORDS.values() for w in ws]
GATES = ("(contains(c, 'apiVersion') AND contains(c, 'kind:') AND contains(c, 'metadata:'))")
KEYWORD = has("lower(c)", ALL_WORDS)


def tokens(expr: str, base: int) -> str:
    return f"CAST(least(greatest(floor(({expr}) / 10), 0), 9) + {base} AS BIGINT)"


def lookup(expr: str, table: dict, default) -> str:
    cases = " ".join(f"WHEN {lit(str(k))} THEN {v}" for k, v in table.items())
    return f"CASE {expr} {cases} ELSE {default} END"


def bound(columns: list[tuple[str, str]], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns)} FROM {source}"


def severity_words(text: str, errors: list[str], warns: list[str]) -> str:
    return (f"CASE WHEN {has(text, errors)} THEN 'ERROR' WHEN {has(text, warns)} THEN 'WARN' "
            "ELSE 'INFO' END")


def severity_sql() -> str:
    msg = "lower(Content)"
    level = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.LEVEL_SEVERITY.items())
    hpc = (f"CASE WHEN trim(Flag) = '1' OR {has('lower(State)', rules.HPC_ERROR_STATE_WORDS)} "
           f"OR {has(msg, rules.HPC_ERROR_WORDS)} THEN 'ERROR' "
           f"WHEN {has('lower(State)', rules.HPC_WARN_STATE_WORDS)} "
           f"OR {has(msg, rules.HPC_WARN_WORDS)} THEN 'WARN' ELSE 'INFO' END")
    branches = [
        f"WHEN 'linux' THEN {severity_words(msg, rules.LINUX_ERROR_WORDS, rules.LINUX_WARN_WORDS)}",
        f"WHEN 'hpc' THEN {hpc}",
    ]
    for s in ("hdfs", "hadoop", "spark"):
        by_words = severity_words(msg, rules.LEVEL_ERROR_WORDS[s], rules.LEVEL_WARN_WORDS[s])
        branches.append(f"WHEN '{s}' THEN CASE upper(trim(Level)) {level} ELSE {by_words} END")
    return f"CASE system {' '.join(branches)} END"


def event_type_sql() -> str:
    cases = " ".join(f"WHEN {has('_t', ws)} THEN '{n}'" for n, ws in rules.EVENT_TYPE_RULES)
    return f"CASE {cases} WHEN severity = 'INFO' THEN 'normal_ops' ELSE 'unknown' END"


def template_label_sql() -> str:
    cases = " ".join(f"WHEN {has('lower(event_template)', ws)} THEN {n}"
                     for n, ws in rules.TEMPLATE_LABEL_RULES)
    return f"CASE {cases} END"


def pack(**fields: str) -> str:
    inner = ", ".join(f"'{k}': {v}" for k, v in fields.items())
    return f"CAST(to_json({{{inner}}}) AS VARCHAR)"


def task_tokens() -> tuple[str, str, str]:
    return (tokens("plan_cpu", 100), tokens("plan_mem * 100", 200),
            lookup("coalesce(status, 'Unknown')", rules.STATUS_TOKENS, 304))


CPU, MEM, STATUS = task_tokens()
TASK_LABEL = (f"CASE WHEN coalesce(status, 'Unknown') = 'Failed' AND {CPU} <= 103 THEN 2 "
              f"WHEN status = 'Terminated' AND {MEM} >= 207 THEN 1 "
              "WHEN status IN ('Failed', 'Waiting') THEN 4 ELSE 0 END")
EVENT_KIND = "lower(coalesce(event_type, 'unknown'))"
EVENT_TOKEN = lookup(EVENT_KIND, rules.EVENT_TOKENS, 403)
LABEL_NAME = "CASE label " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in rules.SEQUENCE_LABELS.items()) + " END"
HEX = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"

TIME_BUCKET = r"""CASE WHEN system = 'hpc' THEN left(trim(timestamp), 7)
  WHEN system = 'hdfs' THEN CASE WHEN len(string_split(trim(timestamp), ' ')) = 2
    THEN string_split(trim(timestamp), ' ')[1] || ' ' || left(string_split(trim(timestamp), ' ')[2], 4)
    ELSE left(trim(timestamp), 9) END
  WHEN contains(trim(timestamp), ' ') THEN regexp_extract(trim(timestamp), '^(.*) [^ ]*$', 1) || ' ' ||
    array_to_string(list_slice(string_split(replace(regexp_extract(trim(timestamp), '([^ ]*)$', 1),
      ',', '.'), ':'), 1, 2), ':')
  ELSE left(trim(timestamp), 10) END"""
LINUX_FORM = r"^[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}$"
FORM = (r"CASE WHEN regexp_full_match(trim(timestamp), '\d+') THEN 'epoch' "
        f"WHEN regexp_matches(timestamp, '{LINUX_FORM}') THEN 'linux' ELSE 'standard' END")
PARSED = f"""CASE {FORM} WHEN 'epoch' THEN make_timestamp(TRY_CAST(timestamp AS BIGINT) * 1000000)
  WHEN 'linux' THEN try_strptime('1970 ' || timestamp, '%Y %b %d %H:%M:%S')
  ELSE coalesce(try_strptime(timestamp, '%Y-%m-%d %H:%M:%S,%g'),
    try_strptime(timestamp, '%Y-%m-%d %H:%M:%S'), try_strptime(timestamp, '%y/%m/%d %H:%M:%S'),
    try_strptime(timestamp, '%y%m%d %H%M%S')) END"""

CALL_PATTERN = r"<functioncall>\s*(\{.*?\})\s*(?:<\|endoftext\|>|$)"
CALL_BLOCKS = f"regexp_extract_all(chat, {lit(CALL_PATTERN)}, 1, 's')"
QUOTED_OBJECT = "'(\\{.*?\\})'"
FIXED = "regexp_replace(block, " + lit(QUOTED_OBJECT) + ", '\\1', 'gs')"
N_ARGS = ("CASE WHEN json_extract(fixed, '$.arguments') IS NULL THEN 0 "
          "WHEN json_type(json_extract(fixed, '$.arguments')) = 'OBJECT' "
          "THEN len(json_keys(json_extract(fixed, '$.arguments'))) END")
SIGNATURE = r"regexp_extract(system, '\{.*\}', 0, 's')"
ERROR_WORDS = "[" + ", ".join(
    f"CASE WHEN contains(lower(chat), {lit(w)}) THEN {lit(w)} END"
    for w in rules.CALL_ERROR_WORDS) + "]"

YAML_BROKEN = "(doc_id % 8 IN (5, 7))"
EXT = r"lower(regexp_replace(coalesce(ext, ''), '^\.+', ''))"
REASON = f"""CASE WHEN c = '' THEN 'empty_content' WHEN coalesce(size, 0) < 200 THEN 'too_small'
  WHEN size > 500000 THEN 'too_large' WHEN alphanum_fraction < 0.25 THEN 'low_alphanum'
  WHEN {EXT} <> '' AND {EXT} NOT IN ('yaml', 'yml') THEN 'bad_extension'
  WHEN NOT contains(c, 'apiVersion') THEN 'not_k8s' WHEN NOT contains(c, 'kind:') THEN 'missing_kind'
  WHEN NOT contains(c, 'metadata:') THEN 'missing_metadata' WHEN {YAML_BROKEN} THEN 'invalid_yaml'
  WHEN len({LICENSES}) = 0 THEN 'missing_license'
  WHEN NOT list_has_any({LICENSES}, {PERMISSIVE}) THEN 'bad_license'
  WHEN NOT {KEYWORD} THEN 'not_ml_infra' ELSE 'ok' END"""

LEAKS = [(p, f"pii_leaked:{name}") for name, p in rules.PII_LEAK_PATTERNS.items()]
VIOLATIONS = "CASE WHEN kind = 1 THEN ['unparseable_line'] ELSE list_filter([" + ", ".join([
    "CASE WHEN kind = 2 THEN 'missing_top_key:_meta' END",
    "CASE WHEN kind = 3 THEN 'wrong_message_count:1' END",
    "CASE WHEN kind = 4 THEN 'first_role_not_user' END",
    "CASE WHEN kind = 4 THEN 'second_role_not_assistant' END",
    "CASE WHEN kind = 8 THEN 'empty_prompt' END",
    "CASE WHEN kind = 5 THEN 'wrong_tool_name' END",
    "CASE WHEN kind <> 3 AND manifest = '' THEN 'empty_manifest_content' END",
    f"CASE WHEN kind <> 3 AND manifest <> '' AND {YAML_BROKEN} THEN 'manifest_invalid_yaml' END",
    *[f"CASE WHEN kind <> 3 AND manifest <> '' AND {matches('manifest', p)} THEN {lit(n)} END"
      for p, n in LEAKS],
    "CASE WHEN kind = 2 THEN 'missing_meta_key:hexsha' END",
    "CASE WHEN kind IN (2, 7) THEN 'missing_meta_key:path' END",
    "CASE WHEN kind = 2 THEN 'missing_meta_key:size' END",
    "CASE WHEN kind IN (2, 7) THEN 'missing_meta_key:licenses' END",
]) + "], lambda x: x IS NOT NULL) END"

FEATURE_TEXT = "coalesce(title, 'None') || ' ' || q || ' ' || a"

# --- common table expressions: name -> (SQL, names it builds on) ------------------------------

CTES: dict[str, tuple[str, list[str]]] = {
    "raw_logs": (bound(b.raw_logs(b.DUCK), "events"), []),
    "unified": (f"""SELECT system,
  CASE system WHEN 'linux' THEN Month || ' ' || Date || ' ' || Time WHEN 'hpc' THEN Time
    ELSE Date || ' ' || Time END AS timestamp,
  {severity_sql()} AS severity,
  CASE WHEN system = 'hpc' THEN Node || '|' || Component ELSE Component END AS source,
  EventId AS event_id, EventTemplate AS event_template, Content AS message,
  CASE WHEN system = 'hpc' AND trim(LogId) <> '' THEN LogId ELSE LineId END AS raw_id,
  CASE system WHEN 'hpc' THEN {pack(node='Node', component='Component', state='State', flag='Flag')}
    WHEN 'hadoop' THEN {pack(process='Process', level_raw='Level')}
    WHEN 'spark' THEN {pack(level_raw='Level')}
    ELSE {pack(pid='PID', level_raw='Level')} END AS extras,
  '' AS event_type FROM raw_logs""", ["raw_logs"]),
    "labelled": (f"""SELECT * EXCLUDE (event_type, _t), {event_type_sql()} AS event_type
  FROM (SELECT *, lower(message || ' ' || event_template) AS _t FROM unified)""", ["unified"]),
    "bucketed": (f"SELECT *, {TIME_BUCKET} AS time_bucket FROM labelled", ["labelled"]),
    "fields": (rf"""SELECT *, TRY_CAST(nullif(regexp_extract(event_id, 'E(\d+)', 1), '') AS BIGINT)
  AS event_int, CAST(coalesce({template_label_sql()},
    {lookup('event_type', rules.EVENT_TYPE_LABELS, 0)}) AS BIGINT) AS event_label,
  {FORM} AS form, timestamp_dt, date_trunc('minute', timestamp_dt) AS win
  FROM (SELECT *, {PARSED} AS timestamp_dt FROM labelled)""", ["labelled"]),
    "templates": (bound(b.log_templates(b.DUCK), "nation"), []),
    "usage": (bound(b.server_usage(b.DUCK), "events"), []),
    "machine_events": (bound(b.server_events(b.DUCK), "events"), []),
    "tasks": (bound(b.batch_tasks(b.DUCK), "lineitem JOIN orders ON l_orderkey = o_orderkey"), []),
    "task_sequences": (f"""SELECT key, [{CPU}, {MEM}, {STATUS}] AS ids, {TASK_LABEL} AS label
  FROM tasks""", ["tasks"]),
    "event_sequences": (f"""SELECT key, [{EVENT_TOKEN}, {CPU}, {MEM}] AS ids,
  CASE WHEN {EVENT_KIND} = 'failure' THEN 3 ELSE 0 END AS label FROM machine_events""",
                        ["machine_events"]),
    "sequences": ("SELECT * FROM task_sequences UNION ALL SELECT * FROM event_sequences",
                  ["task_sequences", "event_sequences"]),
    "questions": (bound(b.questions(b.DUCK), "(SELECT * FROM conversations WHERE role = 'user')"),
                  []),
    "answers": (bound(b.answers(b.DUCK), """(SELECT *, 0 AS again FROM conversations
  WHERE role = 'assistant' UNION ALL SELECT *, 50 AS again FROM conversations
  WHERE role = 'assistant' AND conv_id % 4 = 0)"""), []),
    "q_typed": (f"""SELECT TRY_CAST(Id AS BIGINT) AS question_id, {clean_html('Title')} AS title,
  {clean_html('Body')} AS body,
  CASE WHEN Score = '' THEN 0 ELSE TRY_CAST(Score AS BIGINT) END AS score,
  TRY_CAST(nullif(trim(AcceptedAnswerId), '') AS BIGINT) AS accepted_answer_id,
  regexp_extract_all(coalesce(Tags, ''), '<([^>]+)>', 1) AS tags,
  CAST(ViewCount AS BIGINT) AS view_count, CreationDate AS creation_date FROM questions""",
                ["questions"]),
    "qs": ("""SELECT * FROM q_typed WHERE question_id IS NOT NULL AND score >= 5
  AND accepted_answer_id IS NOT NULL""", ["q_typed"]),
    "ans": (f"""SELECT CAST(QuestionId AS BIGINT) AS question_id,
  CAST(AnswerId AS BIGINT) AS answer_id, {clean_html('AnswerBody')} AS body,
  TRY_CAST(AnswerScore AS BIGINT) AS score FROM answers
  WHERE TRY_CAST(AnswerScore AS BIGINT) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY QuestionId ORDER BY CAST(AnswerId AS BIGINT) DESC) = 1""",
            ["answers"]),
    "pairs": ("""SELECT qs.question_id, title, qs.body AS question_body, tags, qs.score, view_count,
  ans.body AS answer_body, ans.score AS answer_score FROM qs JOIN ans USING (question_id)""",
              ["qs", "ans"]),
    "features": (f"""SELECT question_id, {clean_text('title')} AS title, q AS question_body,
  a AS answer_body, tags, score, answer_score, view_count,
  {names_found(FEATURE_TEXT, rules.ERROR_SIGNATURES)} AS errors,
  {names_found(FEATURE_TEXT, rules.INFRA_COMPONENTS)} AS infra,
  CASE {' '.join(f"WHEN {matches('lower(q)', p)} THEN '{n}'" for n, p in rules.QUESTION_TYPES)}
    ELSE 'general' END AS question_type,
  CASE WHEN {words(FEATURE_TEXT)} < 50 AND {blocks(FEATURE_TEXT)} = 0 THEN 'simple'
    WHEN {words(FEATURE_TEXT)} < 200 OR {blocks(FEATURE_TEXT)} <= 1 THEN 'moderate'
    ELSE 'complex' END AS complexity,
  round(CAST(score AS DOUBLE) * 2 + CAST(answer_score AS DOUBLE) * 3
    + CAST(view_count AS DOUBLE) * CAST(0.001 AS DOUBLE)
    + least(CAST({words('question_body')} AS DOUBLE) / 50, 2)
    + least(CAST({words('answer_body')} AS DOUBLE) / 100, 3)
    + {blocks('answer_body')} * CAST(0.5 AS DOUBLE), 2) AS quality_score
  FROM (SELECT *, {clean_text('question_body')} AS q, {clean_text('answer_body')} AS a FROM pairs)
  WHERE question_id <> 0 AND question_body <> '' AND answer_body <> ''
    AND length(q) >= 20 AND length(a) >= 50""", ["pairs"]),
    "slices": ("""SELECT *, unnest([question_type, complexity]
  || list_transform(list_distinct(tags), lambda x: 'tag_' || x)
  || list_transform(list_filter(string_split(errors, ','), lambda x: x <> ''),
                    lambda x: 'error_' || x)
  || list_transform(list_filter(string_split(infra, ','), lambda x: x <> ''),
                    lambda x: 'infra_' || x)) AS slice FROM features""", ["features"]),
    "turn_pairs": ("""SELECT u.conv_id, u.turn, u.text AS user_text, r.text AS reply_text
  FROM conversations u JOIN conversations r ON u.conv_id = r.conv_id AND r.turn = u.turn + 1
  WHERE u.role = 'user' AND r.role = 'assistant'""", []),
    "chats": (bound(b.call_chats(b.DUCK), "turn_pairs"), ["turn_pairs"]),
    "call_list": (f"""SELECT id, position - 1 AS position, block, {FIXED} AS fixed,
  json_valid({FIXED}) AS good FROM (SELECT id, unnest(blocks) AS block,
    generate_subscripts(blocks, 1) AS position
    FROM (SELECT id, {CALL_BLOCKS} AS blocks FROM chats))""", ["chats"]),
    "call_facts": (f"""SELECT id, position, CASE WHEN good THEN
    coalesce(json_extract_string(fixed, '$.name'), 'unknown') END AS name,
  CASE WHEN good THEN {N_ARGS} END AS n_arguments,
  CASE WHEN NOT good THEN block END AS malformed FROM call_list""", ["call_list"]),
    "signatures": (f"""SELECT id, CASE WHEN json_valid({SIGNATURE}) THEN {SIGNATURE} END AS sig
  FROM chats""", ["chats"]),
    "call_features": (rf"""SELECT id, chat, {count_matches('chat', 'USER:')} AS num_turns,
  coalesce(n, 0) AS num_calls,
  CASE WHEN coalesce(n, 0) = 0 THEN 'none' WHEN n > 1 THEN 'complex' WHEN bad > 0 THEN 'malformed'
    WHEN args <= 2 THEN 'simple' ELSE 'moderate' END AS complexity_tier,
  coalesce(n, 0) > 1 AS has_parallel, coalesce(bad, 0) > 0 AS has_malformed,
  CASE WHEN sig IS NULL THEN 0 ELSE 1 END AS num_defined_functions,
  json_extract_string(sig, '$.name') AS defined, sig,
  {join_list(ERROR_WORDS)} AS words, {join_list(ERROR_WORDS)} <> '' AS has_error_handling,
  {matches('lower(chat)', rules.FUNCTION_ERROR_RESPONSE, 's')} AS has_function_error_response,
  {matches('lower(chat)', rules.CONDITIONAL_ERROR)} AS has_conditional_error
  FROM chats LEFT JOIN (SELECT id, count(*) AS n, count(malformed) AS bad,
      max(n_arguments) AS args, min(name) AS x FROM call_facts GROUP BY id) USING (id)
    JOIN signatures USING (id)
  WHERE chat <> ''""", ["chats", "call_facts", "signatures"]),
    "call_slices": ("""SELECT *, CASE WHEN num_turns <= 1 THEN 'single' WHEN num_turns <= 3
  THEN 'short' WHEN num_turns <= 5 THEN 'medium' ELSE 'long' END AS turn_bucket,
  CASE WHEN num_calls <= 0 THEN 'no_calls' WHEN num_calls <= 1 THEN 'one_call'
  WHEN num_calls <= 2 THEN 'two_calls' ELSE 'many_calls' END AS call_bucket,
  num_defined_functions > 0 AS has_defined_functions FROM call_features""", ["call_features"]),
    "call_summary": ("""SELECT slice_column, slice_value, count(*) AS count, avg(num_turns) AS turns,
  avg(num_calls) AS calls, count(*) FILTER (has_malformed) AS malformed,
  avg(CAST(has_error_handling AS INT)) AS handling,
  count(*) / (SELECT count(*) FROM call_features) AS share
  FROM (SELECT *, unnest(['complexity_tier', 'turn_bucket', 'call_bucket', 'has_error_handling',
      'has_parallel', 'has_defined_functions']) AS slice_column,
    unnest([complexity_tier, turn_bucket, call_bucket, CAST(has_error_handling AS VARCHAR),
      CAST(has_parallel AS VARCHAR), CAST(has_defined_functions AS VARCHAR)]) AS slice_value
    FROM call_slices) GROUP BY ALL""", ["call_slices", "call_features"]),
    "prompts": (bound(b.prompts(b.DUCK), "(SELECT *, (conv_id + turn) % 9 AS wf FROM conversations "
                                         "WHERE role = 'user')").replace(
        " FROM (SELECT *, (conv_id", ", wf FROM (SELECT *, (conv_id"), []),
    "chat_records": (f"""SELECT {b.QUESTION_ID} AS id, (conv_id + turn) % 6 AS kind,
  CASE WHEN conv_id % 19 = 0 THEN '' ELSE user_text END AS user_intent, reply_text
  FROM turn_pairs""", ["turn_pairs"]),
    "files": (f"SELECT *, coalesce(content, '') AS c FROM ({bound(b.iac_files(b.DUCK), 'documents')})",
              []),
    "judged": (f"SELECT *, {REASON} AS early FROM files", ["files"]),
    "curated": ("""SELECT *, CASE WHEN early = 'ok' AND doc_id % 24 = 3
  THEN 'invalid_yaml_post_redaction' ELSE early END AS reason FROM judged""", ["judged"]),
    "records": (f"""SELECT *, {redact('c')} AS manifest, {prompt_sql()} AS prompt FROM curated
  WHERE reason = 'ok'""", ["curated"]),
    "record_slices": (f"""SELECT *, {kind_of_file('manifest')} AS iac_type,
  {LICENSE_CLASS} AS license, {size_class('size')} AS size_bucket,
  {prompt_class('prompt')} AS prompt_type FROM records""", ["records"]),
    "shares": ("""SELECT dimension, value, count(*) AS count,
  round(avg(length(manifest)), 1) AS mean_manifest_chars,
  round(count(*) / (SELECT count(*) FROM records) * 100, 2) AS pct_of_total
  FROM (SELECT manifest, unnest(['iac_type', 'license', 'size_bucket', 'prompt_type']) AS dimension,
    unnest([iac_type, license, size_bucket, prompt_type]) AS value FROM record_slices)
  GROUP BY ALL""", ["record_slices", "records"]),
    "lines": (f"""SELECT *, {VIOLATIONS} AS violations FROM (SELECT *,
  CASE WHEN kind = 6 THEN '' ELSE c END AS manifest, {prompt_sql()} AS prompt
  FROM (SELECT *, doc_id % 9 AS kind FROM files))""", ["files"]),
    "broken": ("SELECT unnest(violations) AS violation FROM lines", ["lines"]),
    "bias_metrics": ("""SELECT slice, count(*) AS count, avg(quality_score) AS quality,
  avg(strlen(answer_body)) AS length, count(*) / (SELECT count(*) FROM features) AS proportion
  FROM slices GROUP BY slice HAVING count(*) >= 5""", ["slices", "features"]),
    "bias": ("""SELECT *, list_filter([
    CASE WHEN abs(quality - oq) / oq > 0.15 THEN {'factor': 'quality_score',
      'diff': round(abs(quality - oq) / oq, 3),
      'way': CASE WHEN quality > oq THEN 'higher' ELSE 'lower' END} END,
    CASE WHEN abs(length - ol) / ol > 0.5 THEN {'factor': 'answer_length',
      'diff': round(abs(length - ol) / ol, 3),
      'way': CASE WHEN length > ol THEN 'longer' ELSE 'shorter' END} END,
    CASE WHEN proportion < 0.005 AND count < 20 THEN {'factor': 'underrepresentation',
      'diff': 0.0, 'way': NULL} END], lambda x: x IS NOT NULL) AS factors
  FROM bias_metrics, (SELECT avg(quality_score) AS oq, avg(strlen(answer_body)) AS ol
    FROM features)""", ["bias_metrics", "features"]),
    "bias_rows": ("""SELECT *, len(factors) > 0 AS is_biased,
  list_max(list_transform(factors, lambda f: f.diff)) AS worst FROM bias""", ["bias"]),
    "bias_graded": ("""SELECT *, CASE WHEN len(factors) = 0 THEN 'none'
  WHEN worst > 0.75 OR len(factors) >= 3 THEN 'high'
  WHEN worst > 0.5 OR len(factors) >= 2 THEN 'medium' ELSE 'low' END AS severity FROM bias_rows""",
                    ["bias_rows"]),
}


def using(body: str, *names: str) -> str:
    """``body`` with the named table expressions, and all they build on, in front."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][1]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


def nearest(column: str, share: float) -> str:
    return f"list_sort(list({column}))[1 + CAST(floor((count({column}) - 1) * {share} + 0.5) AS BIGINT)]"


def profile_row(table: str, column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", count({x}) AS count, round(avg({x}), 4) AS mean,
  round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, round(max({x}), 4) AS max,
  round({nearest(x, 0.25)}, 4) AS q25, round(quantile_cont({x}, 0.5), 4) AS median,
  round({nearest(x, 0.75)}, 4) AS q75 FROM {table}"""


def check_rows(table: str, checks: dict[str, str | None]) -> str:
    parts = [
        f"SELECT '{name}' AS \"check\", CAST({expr or 'NULL'} AS BIGINT) AS violations FROM {table}"
        if expr else f"SELECT '{name}' AS \"check\", CAST(NULL AS BIGINT) AS violations"
        for name, expr in checks.items()
    ]
    return ('SELECT "check", coalesce(violations = 0, false) AS success, violations FROM ('
            + " UNION ALL ".join(parts) + ")")


def not_in(column: str, values: list[str]) -> str:
    return (f"count(*) FILTER ({column} IS NULL OR {column} NOT IN "
            f"({', '.join(lit(v) for v in values)}))")


def nulls(column: str) -> str:
    return f"count(*) FILTER ({column} IS NULL)"


def empties(column: str) -> str:
    return f"count(*) FILTER ({column} = '')"


EVENT_CHECKS = {
    "columns_present": "0",
    "allowed_system": not_in("system", rules.LOG_SYSTEMS),
    "allowed_severity": not_in("severity", rules.SEVERITIES),
    "allowed_event_type": not_in("event_type", rules.EVENT_TYPES),
    **{f"no_nulls_{c}": nulls(c)
       for c in ["event_id", "event_template", "message", "raw_id", "system"]},
    "event_id_pattern": r"count(*) FILTER (NOT regexp_matches(event_id, '^E\d+$'))",
}
# aggregate-only queries need one row even for constants
EVENT_CHECKS["columns_present"] = "0 * count(*)"
IDS = ["event_id", "event_template", "message", "raw_id"]


# columns Spark returns as 32-bit integers
INT_COLUMNS = {
    "d9_text_profile": ["min_length", "max_length"],
    "d10_table_profile": ["min_length", "max_length"],
    "e5_top_templates": ["rank"],
    "g18_text_metrics": ["char_count", "word_count", "sentence_count", "code_block_count"],
    "g24_function_calls": ["position", "n_arguments"],
    "g27_user_turns": ["turns"],
    "g29_call_features": ["num_turns", "num_calls"],
    "g30_chat_messages": ["num_turns", "num_calls"],
}


def oracle_sql() -> dict[str, str]:
    sql = _oracles()
    for name, columns in INT_COLUMNS.items():
        casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in columns)
        sql[name] = f"SELECT * REPLACE ({casts}) FROM ({sql[name]})"
    return sql


def _usage_windows(size: int, keys: str, usage: str = "usage") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    out = f"{keys}, " if keys else ""
    order = "time_stamp, machine_id, cpu_util_percent, mem_util_percent"
    return f"""SELECT {out}win AS "window",
  string_agg(cpu || ',' || mem, ',' ORDER BY i) AS sequence_ids,
  CAST(CASE WHEN arg_max(mem, i) >= 207 OR arg_max(cpu, i) >= 208 THEN 1 ELSE 0 END AS BIGINT)
    AS label
FROM (SELECT {out}i, i // {size} AS win, {tokens('cpu_util_percent', 100)} AS cpu,
    {tokens('mem_util_percent', 200)} AS mem
  FROM (SELECT *, row_number() OVER ({part}ORDER BY {order}) - 1 AS i FROM {usage}))
GROUP BY {out}win HAVING count(*) = {size}"""


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    seq_text = "array_to_string(ids, ',')"
    customer = "SELECT c_custkey, c_name, c_acctbal FROM customer"
    question_view = f"""SELECT question_id, title, md5(body) AS body_md5, score,
  accepted_answer_id, {join_list('tags')} AS tags, view_count, creation_date FROM qs"""
    pair_view = """SELECT question_id, title, md5(question_body) AS question_md5, score,
  view_count, md5(answer_body) AS answer_md5, answer_score FROM pairs"""
    event_counts = """SELECT system, severity, event_type, time_bucket, count(*) AS count
  FROM bucketed GROUP BY ALL"""
    error_rates = """SELECT system, time_bucket, count(*) AS total,
  count(*) FILTER (severity = 'ERROR') AS error_count,
  round(count(*) FILTER (severity = 'ERROR') / count(*), 4) AS error_rate
  FROM bucketed GROUP BY ALL"""

    # A
    q["a1_positional_csv"] = using(
        "SELECT time_stamp, machine_id, cpu_util_percent, mem_util_percent FROM usage", "usage")
    q["a2_text_csv"] = using("""SELECT LineId, Date, Time, Level, Content, EventId FROM raw_logs
  WHERE system = 'hdfs'""", "raw_logs")
    q["a3_questions_csv"] = using(question_view, "qs")
    q["a4_answers_csv"] = using(
        "SELECT question_id, answer_id, md5(body) AS body_md5, score FROM ans", "ans")
    q["a5_json_document"] = customer
    q["a5_split_json_array"] = """SELECT c_custkey, c_name || ' }"{ \\ [' AS c_name, c_acctbal FROM customer"""
    q["a6_json_lines"] = customer + " WHERE c_custkey % 7 <> 0"
    q["a7_checked_json_lines"] = """SELECT count(*) AS total,
  count(*) FILTER (c_custkey % 7 <> 0) AS valid,
  count(*) FILTER (c_custkey % 7 = 0) AS malformed FROM customer"""
    q["a8_parquet_folder"] = """SELECT o_orderstatus, count(*) AS count,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"""
    q["a9_bounded_parquet"] = "SELECT count(*) AS rows, true AS all_within_limit FROM orders"
    q["a10_csv_sink"] = using(
        event_counts.replace("count(*) AS count", "CAST(count(*) AS VARCHAR) AS count"),
        "bucketed")
    q["a11_json_lines_sink"] = using("""SELECT question_id, 3 AS n_messages,
  md5(question_body) AS question_md5, quality_score FROM features""", "features")
    q["a12_json_to_parquet"] = customer
    q["a13_first_rows"] = "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 500"
    q["a14_pruned_scan"] = """SELECT l_returnflag, count(*) AS count, sum(l_quantity) AS quantity
  FROM lineitem GROUP BY 1"""

    # B
    q["b1_normalize_logs"] = using("SELECT * FROM unified", "unified")
    q["b2_constant_tag"] = using("""SELECT system, raw_id, 'ds_logs' AS source_dataset FROM unified
  WHERE system = 'linux'""", "unified")
    q["b3_null_fill"] = using("""SELECT key, coalesce(status, 'Unknown') AS status,
  coalesce(task_type, -1) AS task_type FROM tasks""", "tasks")
    q["b4_first_non_blank"] = using(f"SELECT doc_id, {PATH} AS path FROM files", "files")
    q["b5_packed_columns"] = using(
        "SELECT raw_id, message, extras FROM unified WHERE system = 'hpc'", "unified")
    q["b6_admission"] = using(f"""SELECT question_id, question_id <> 0 AND question_body <> ''
  AND answer_body <> '' AND length({clean_text('question_body')}) >= 600
  AND length({clean_text('answer_body')}) >= 400 AS admitted FROM pairs""", "pairs")
    q["b7_question_filter"] = using("""SELECT question_id, score FROM q_typed
  WHERE question_id IS NOT NULL AND score >= 10 AND accepted_answer_id IS NOT NULL""", "q_typed")
    q["b8_filter_reason"] = using("SELECT doc_id, early AS reason FROM judged", "judged")
    q["b9_kubernetes_gates"] = using(f"""SELECT doc_id, {GATES} AS all_gates,
  contains(c, 'apiVersion') AND contains(c, 'metadata:') AS without_kind FROM files""", "files")
    q["b10_keyword_modes"] = using(f"""SELECT doc_id, {KEYWORD} AS has_keyword,
  {GATES} AND {KEYWORD} AS strict, {GATES} OR {KEYWORD} AS lenient FROM files""", "files")
    q["b11_licenses"] = using(f"""SELECT doc_id, {join_list(LICENSES)} AS licenses,
  list_has_any({LICENSES}, {PERMISSIVE}) AS permissive FROM files""", "files")
    q["b12_curated_reason"] = using(f"""SELECT doc_id, reason,
  CASE WHEN reason = 'ok' THEN md5({prompt_sql()}) END AS prompt_md5 FROM curated""", "curated")
    q["b13_lookup_tokens"] = using(
        f"SELECT key, CAST({EVENT_TOKEN} AS BIGINT) AS token FROM machine_events",
        "machine_events")

    # C
    q["c1_error_join"] = using(error_rates, "bucketed")
    q["c2_pair_by_question"] = using(pair_view, "pairs")
    q["c3_pair_by_accepted"] = using(pair_view.replace("FROM pairs", """FROM (
  SELECT qs.question_id, title, qs.body AS question_body, qs.score, view_count,
    ans.body AS answer_body, ans.score AS answer_score
  FROM qs JOIN ans ON qs.accepted_answer_id = ans.answer_id)"""), "qs", "ans")
    q["c4_filter_templates"] = using("""SELECT EventId, system,
  arg_min(EventTemplate, EventTemplate) AS EventTemplate,
  arg_min(Occurrences, EventTemplate) AS Occurrences FROM templates
  WHERE EventId IN (SELECT event_id FROM unified) GROUP BY EventId, system""",
                                     "templates", "unified")
    q["c5_missing_templates"] = using("""SELECT DISTINCT event_id FROM unified
  WHERE event_id NOT IN (SELECT EventId FROM templates)""", "templates", "unified")
    q["c6_unprocessed_prompts"] = using(
        "SELECT id FROM prompts WHERE id % 3 <> 0 AND id % 5 <> 0", "prompts")
    q["c6_committed_marks"] = using("""SELECT id,
  (SELECT count(DISTINCT id) FROM prompts WHERE id % 3 = 0) AS first_changed,
  (SELECT count(DISTINCT id) FROM prompts WHERE id % 5 = 0 AND id % 3 <> 0) AS second_changed
  FROM prompts WHERE id % 3 <> 0 AND id % 5 <> 0""", "prompts")
    q["c7_pair_workflows"] = using("""SELECT id, tool_context, workflow_json FROM prompts
  WHERE workflow_json IS NOT NULL""", "prompts")
    q["c8_rows_of_top_values"] = using("""SELECT task_type, count(*) AS count FROM tasks
  WHERE task_type IS NOT NULL GROUP BY 1 ORDER BY count DESC, task_type LIMIT 5""", "tasks")

    # D
    q["d1_event_counts"] = using(event_counts, "bucketed")
    q["d2_error_rate"] = using(error_rates, "bucketed")
    q["d3_value_counts"] = using(
        "SELECT event_template AS value, count(*) AS count FROM labelled GROUP BY 1", "labelled")
    q["d4_value_shares"] = using("""SELECT value, count, round(count / sum(count) OVER () * 100, 2)
  AS pct, round(count / sum(count) OVER () * 100, 2) > 40 AS is_dominant
  FROM (SELECT coalesce(status, 'Unknown') AS value, count(*) AS count FROM tasks GROUP BY 1)""",
                                 "tasks")
    q["d5_null_rates"] = using(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {nulls(c)} AS null_count,
  round({nulls(c)} / count(*) * 100, 2) AS null_pct FROM labelled"""
        for c in rules.EVENT_COLUMNS), "labelled")
    distinct = ("count(DISTINCT {0}) + max(CAST({0} IS NULL AS INT))").format
    q["d6_distinct_counts"] = using(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({distinct(c)} AS BIGINT) AS n_unique FROM labelled"
        for c in ["event_id", "event_template", "source"]), "labelled")
    q["d7_dataset_statistics"] = using("SELECT metric, name, CAST(value AS DOUBLE) AS value FROM ("
        + " UNION ALL ".join([
            "SELECT 'total_rows' AS metric, '' AS name, count(*) AS value FROM labelled",
            "SELECT 'total_columns', '', 10",
            *[f"SELECT 'null_rate_pct', '{c}', round({nulls(c)} / count(*) * 100, 2) FROM labelled"
              for c in rules.EVENT_COLUMNS],
            *[f"SELECT 'unique', '{c}', {distinct(c)} FROM labelled"
              for c in ["event_id", "event_template"]],
            *[f"SELECT 'distribution_{c}', {c}, count(*) FROM labelled GROUP BY {c}"
              for c in ["system", "severity", "event_type"]],
        ]) + ")", "labelled")
    q["d8_numeric_profile"] = " UNION ALL ".join(
        profile_row("lineitem", c) for c in ["l_quantity", "l_extendedprice", "l_discount"])
    text_row = """SELECT '{0}' AS "column", count(DISTINCT {0}) AS n_unique,
  min(strlen({0})) AS min_length, max(strlen({0})) AS max_length,
  round(avg(strlen({0})), 2) AS mean_length, CAST(sum(strlen({0})) AS BIGINT) AS total_bytes
  FROM {1}""".format
    q["d9_text_profile"] = " UNION ALL ".join(text_row(c, "documents") for c in ["text", "lang"])
    types = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
             "c_acctbal": "double", "c_mktsegment": "string"}
    numeric = " UNION ALL ".join(
        profile_row("customer", c) for c in ["c_custkey", "c_nationkey", "c_acctbal"])
    textual = " UNION ALL ".join(text_row(c, "customer") for c in ["c_name", "c_mktsegment"])
    missing = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, {nulls(c)} AS null_count,
  round({nulls(c)} / count(*) * 100, 2) AS null_pct FROM customer""" for c, t in types.items())
    q["d10_table_profile"] = f"""SELECT * FROM ({missing}) LEFT JOIN ({numeric}) USING ("column")
  LEFT JOIN ({textual}) USING ("column")"""
    q["d11_list_value_counts"] = using("""SELECT value, count(*) AS count FROM (
  SELECT unnest(string_split(infra, ',')) AS value FROM features) WHERE value <> ''
  GROUP BY 1 ORDER BY count DESC, value LIMIT 20""", "features")
    between = "len(list_filter(ids, lambda x: x BETWEEN {0} AND {1}))".format
    q["d12_sequence_statistics"] = using(
        "SELECT metric, CAST(value AS DOUBLE) AS value FROM (" + " UNION ALL ".join([
            "SELECT 'total_sequences' AS metric, count(*) AS value FROM sequences",
            "SELECT 'length_min', min(len(ids)) FROM sequences",
            "SELECT 'length_max', max(len(ids)) FROM sequences",
            "SELECT 'length_mean', round(avg(len(ids)), 2) FROM sequences",
            "SELECT 'total_tokens', sum(len(ids)) FROM sequences",
            f"SELECT 'cpu_tokens', sum({between(100, 109)}) FROM sequences",
            f"SELECT 'memory_tokens', sum({between(200, 209)}) FROM sequences",
            "SELECT 'empty_sequences', count(*) FILTER (len(ids) = 0) FROM sequences",
            "SELECT 'invalid_labels', count(*) FILTER (label NOT BETWEEN 0 AND 4) FROM sequences",
            "SELECT 'missing_fields', 0",
            "SELECT 'unique_tokens', count(DISTINCT x) FROM (SELECT unnest(ids) AS x FROM sequences)",
            f"SELECT 'label_' || {LABEL_NAME}, count(*) FROM sequences GROUP BY label",
        ]) + ")", "sequences")
    q["d13_event_sequences"] = using("""SELECT system,
  strftime(win, '%Y-%m-%d %H:%M:%S') AS "window",
  md5(string_agg(coalesce(CAST(event_int AS VARCHAR), 'null'), ',' ORDER BY rn DESC)
      FILTER (rn <= 512) || repeat(',0', 512 - CAST(least(count(*), 512) AS INT)))
    AS sequence_md5, max(event_label) AS label
FROM (SELECT *, row_number() OVER (PARTITION BY system, win
    ORDER BY timestamp_dt DESC NULLS LAST, raw_id DESC, event_int DESC NULLS LAST) AS rn
  FROM fields) GROUP BY system, win""", "fields")
    q["d14_event_type_by_system"] = using(
        "SELECT event_type, system, count(*) AS count FROM labelled GROUP BY ALL", "labelled")
    q["d15_system_profile"] = using("""SELECT system, CAST(sum(n) AS BIGINT) AS count,
  CAST(sum(e) AS BIGINT) AS error_count,
  arg_min(event_type, lpad(CAST(1000000000000 - n AS VARCHAR), 16, '0') || event_type)
    AS top_event_type,
  round(sum(n) / (SELECT count(*) FROM labelled) * 100, 2) AS pct_of_total,
  round(sum(e) / sum(n), 4) AS error_rate
FROM (SELECT system, event_type, count(*) AS n, count(*) FILTER (severity = 'ERROR') AS e
  FROM labelled GROUP BY ALL) GROUP BY system""", "labelled")
    q["d16_duplicate_pairs"] = using("""SELECT EventId, system, count(*) AS count FROM (
  SELECT * FROM templates UNION ALL SELECT * FROM templates WHERE system = 'spark')
  GROUP BY ALL HAVING count(*) > 1""", "templates")
    hits = [(cat, w) for cat, ws in rules.CORPUS_KEYWORDS.items() for w in ws]
    q["d17_keyword_totals"] = using("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{cat}' AS category, '{w}' AS keyword, CAST(sum("
        f"{count_matches('c', '(?i)' + w.replace('.', chr(92) + '.'))}) AS BIGINT) AS hits FROM files"
        for cat, w in hits) + ") WHERE hits > 0", "files")
    q["d17_one_pass_totals"] = q["d17_keyword_totals"]
    q["d18_license_counts"] = using("""SELECT lower(x) AS license, count(*) AS count FROM (
  SELECT unnest(max_stars_repo_licenses) AS x FROM files) GROUP BY 1
  ORDER BY count DESC, license LIMIT 15""", "files")
    pii_any = "(" + " OR ".join(matches("c", p) for p in PII.values()) + ")"
    q["d19_corpus_report"] = using(
        "SELECT metric, name, count, round(count / (SELECT count(*) FROM files) * 100, 2) AS pct "
        "FROM (" + " UNION ALL ".join([
            f"SELECT 'iac_type' AS metric, {kind_of_file('c', True)} AS name, count(*) AS count "
            "FROM files GROUP BY ALL",
            f"SELECT 'escape_difficulty', {escape_class('c', 1000, 5000)} AS name, count(*) "
            "FROM files GROUP BY ALL",
            f"SELECT 'size', {size_class('size')} AS name, count(*) FROM files GROUP BY ALL",
            f"SELECT 'pii_files', 'any', count(*) FILTER ({pii_any}) FROM files",
            *[f"SELECT 'field_null', '{c}', {nulls(c)} FROM files"
              for c in rules.CORPUS_COLUMNS],
        ]) + ")", "files")
    q["d20_diagnostics"] = using("SELECT metric, name, count FROM (" + " UNION ALL ".join([
        *[f"SELECT 'pii' AS metric, '{n}' AS name, count(*) FILTER ({matches('c', p)}) AS count "
          "FROM files" for n, p in PII.items()],
        "SELECT CASE WHEN reason = 'ok' THEN 'filter_pass' ELSE 'filter_drop' END, reason, "
        "count(*) FROM curated GROUP BY reason",
        "SELECT 'wrap_ok', 'any', count(*) FILTER (reason = 'ok') FROM curated",
    ]) + ")", "curated", "files")
    q["d21_drop_counts"] = using("""SELECT reason, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM curated) * 100, 2) AS pct FROM curated GROUP BY 1""",
                                 "curated")
    q["d22_group_rates"] = """WITH r AS (SELECT lang AS g, avg(CAST(toxic = 1 AS INT)) AS rate,
  count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT g AS "group", round(rate, 6) AS selection_rate, n AS count FROM r UNION ALL
SELECT 'difference', round(max(rate) - min(rate), 6),
  CAST(max(rate) - min(rate) > 0.01 AS BIGINT) FROM r"""
    q["d23_chat_slices"] = using("""SELECT slice_column, slice_value, count,
  round(turns, 6) AS avg_turns, round(calls, 6) AS avg_calls, malformed AS malformed_count,
  round(handling, 6) AS error_handling_pct, round(share, 4) AS proportion,
  share < 0.05 AS is_underrepresented FROM call_summary""", "call_summary")
    q["d24_record_slices"] = using("""SELECT *, pct_of_total < 5 AS underrepresented,
  pct_of_total > 40 AS overrepresented FROM shares""", "shares")
    q["d25_length_profile"] = using(" UNION ALL ".join(
        f"""SELECT '{n}' AS measure, count({x}) AS count, min({x}) AS min, max({x}) AS max,
  round(avg({x}), 1) AS mean, quantile_cont({x}, 0.5) AS median FROM lines
  WHERE len(violations) = 0"""
        for n, x in [("prompt_length", "length(prompt)"), ("manifest_length", "length(manifest)"),
                     ("source_size", "size")]), "lines")
    passed = "count(*) FILTER (len(violations) = 0)"
    q["d26_violation_counts"] = using(
        "SELECT name, CAST(value AS DOUBLE) AS value FROM (" + " UNION ALL ".join([
            "SELECT 'total' AS name, count(*) AS value FROM lines",
            f"SELECT 'valid', {passed} FROM lines",
            f"SELECT 'invalid', count(*) - {passed} FROM lines",
            f"SELECT 'pass_rate_pct', round({passed} / count(*) * 100, 2) FROM lines",
            "SELECT violation, count(*) FROM broken GROUP BY 1",
        ]) + ")", "lines", "broken")
    q["d27_records_by_source"] = using("""SELECT 'traces' AS source_dataset, count(*) AS count
  FROM task_sequences UNION ALL SELECT 'logs', count(*) FROM event_sequences
  UNION ALL SELECT 'absent', 0""", "task_sequences", "event_sequences")
    q["d28_anomaly_breakdown"] = using(f"""SELECT {LABEL_NAME} AS label_name, count(*) AS count
  FROM sequences WHERE label <> 0 GROUP BY 1""", "sequences")
    q["d29_processing_summary"] = using("""SELECT count(*) AS total_records,
  round(avg(num_turns), 6) AS avg_turns, round(avg(num_calls), 6) AS avg_calls,
  count(*) FILTER (has_malformed) AS malformed_calls FROM call_features""", "call_features")
    q["d30_parse_quality"] = using(f"""SELECT
  count(*) FILTER (form = 'standard' AND timestamp_dt IS NOT NULL) AS standard_count,
  count(*) FILTER (form = 'epoch') AS epoch_count, count(*) FILTER (form = 'linux') AS linux_count,
  count(*) FILTER (timestamp_dt IS NULL) AS unparsed_count, min(event_int) AS min_event,
  max(event_int) AS max_event, count({template_label_sql()}) AS override_count FROM fields""",
                                   "fields")
    q["d31_yields"] = using("""SELECT (SELECT count(*) FROM pairs) AS input_records,
  count(*) AS output_records, (SELECT count(*) FROM pairs) - count(*) AS filtered_count,
  round(avg(quality_score), 4) AS avg_quality_score,
  (SELECT count(*) FROM qs) AS questions_loaded, (SELECT count(*) FROM pairs) AS answers_matched
  FROM features""", "features", "pairs", "qs")

    # E
    q["e1_usage_windows"] = using(_usage_windows(5, ""), "usage")
    q["e2_machine_windows"] = using(_usage_windows(3, "machine_id"), "usage")
    passed = "(SELECT * FROM usage WHERE time_stamp < (SELECT max(time_stamp) FROM usage))"
    q["e2_streamed_windows"] = using(_usage_windows(3, "machine_id", passed), "usage")
    q["e3_minute_windows"] = using("""SELECT system,
  strftime(win, '%Y-%m-%d %H:%M:%S') AS "window", count(*) AS count
  FROM fields GROUP BY system, win""", "fields")
    q["e4_time_buckets"] = using(
        "SELECT system, raw_id, message, time_bucket FROM bucketed", "bucketed")
    q["e5_top_templates"] = using("""SELECT *, row_number() OVER (PARTITION BY system
    ORDER BY count DESC, event_id NULLS FIRST, event_template NULLS FIRST) AS rank
  FROM (SELECT system, event_id, event_template, count(*) AS count FROM labelled GROUP BY ALL)
  QUALIFY rank <= 10""", "labelled")
    q["e6_rank_by_quality"] = using(
        "SELECT question_id, quality_score FROM features ORDER BY 2 DESC, 1", "features")
    q["e7_first_by_key"] = using("""SELECT doc_id, hexsha, size, max_stars_repo_name FROM files
  QUALIFY row_number() OVER (PARTITION BY hexsha ORDER BY doc_id) = 1""", "files")
    q["e8_distinct_subset"] = using("SELECT DISTINCT event_id, system FROM unified", "unified")
    q["e9_train_test_split"] = """SELECT doc_id, lang,
  CASE WHEN row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42')) - 1
    < floor((SELECT count(*) FROM documents) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END
    AS split FROM documents"""
    q["e10_latest_rows"] = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, event_id
  FROM events ORDER BY ts DESC, event_id LIMIT 1000"""

    # F
    q["f1_merge_events"] = using(
        "SELECT system, timestamp, severity, event_id, raw_id, extras FROM unified", "unified")
    q["f2_combine_sequences"] = using(f"""SELECT source_dataset, CAST(label AS BIGINT) AS label,
  {seq_text} AS sequence_ids, count(*) AS count FROM (
    SELECT 'traces' AS source_dataset, * FROM task_sequences
    UNION ALL SELECT 'logs', * FROM event_sequences) GROUP BY ALL""",
                                      "task_sequences", "event_sequences")
    q["f3_combine_chats"] = using("""SELECT 'qa' AS source_dataset, count(*) AS records,
  count(*) AS with_metadata, 0 AS with_tier, 0 AS with_meta FROM features
UNION ALL SELECT 'calls', count(*), 0, count(*), 0 FROM call_features
UNION ALL SELECT 'workflows', count(workflow_json), 0, 0, 0 FROM prompts
UNION ALL SELECT 'corpus', count(*), 0, 0, count(*) FROM records
UNION ALL SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'lines_qa' ELSE 'lines_calls' END,
  count(*), 0, 0, 0 FROM customer WHERE c_custkey % 7 > 1 GROUP BY 1""",
                                  "features", "call_features", "prompts", "records")
    q["f4_set_difference"] = using("""SELECT event_type AS value, count(*) AS count FROM labelled
  WHERE event_type NOT IN ('normal_ops', 'job_failed', 'unknown') GROUP BY 1""", "labelled")
    q["f4_field_differences"] = using("""SELECT kind, "column" FROM (VALUES ('missing', 'title'),
  ('extra', 'note')) AS t(kind, "column") WHERE (SELECT count(*) FROM features) > 0""", "features")

    # G
    severity = "SELECT raw_id, message, severity FROM unified WHERE system = '{0}'".format
    q["g1_linux_severity"] = using(severity("linux"), "unified")
    q["g2_hpc_severity"] = using(severity("hpc"), "unified")
    q["g3_level_severity"] = using("""SELECT raw_id, message, severity, system FROM unified
  WHERE system NOT IN ('linux', 'hpc')""", "unified")
    q["g4_event_type"] = using("SELECT raw_id, system, message, event_type FROM labelled",
                               "labelled")
    q["g5_event_label"] = using("SELECT raw_id, system, message, event_label FROM fields",
                                "fields")
    q["g6_event_number"] = using("SELECT raw_id, system, message, event_int FROM fields", "fields")
    q["g7_join_timestamp"] = using("""SELECT LineId, concat_ws(' ', Month,
  nullif(Date, ''), nullif(LogId, ' '), Time) AS joined,
  CASE WHEN Date = 'n/a' THEN '' ELSE trim(LogId) END AS clean FROM raw_logs""", "raw_logs")
    q["g8_parse_timestamp"] = using("""SELECT raw_id, system, message,
  strftime(timestamp_dt, '%Y-%m-%d %H:%M:%S.%g') AS parsed FROM fields""", "fields")
    md5_mod = "CAST(CAST('0x' || md5(system || ':' || raw_id) AS UHUGEINT) % 100 AS BIGINT)"
    q["g9_stable_hash"] = using(f"""SELECT system, raw_id, message, {md5_mod} AS bucket,
  {md5_mod} < 10 AS kept FROM unified""", "unified")
    q["g10_decile_tokens"] = using(f"SELECT key, {CPU} AS cpu, {MEM} AS mem FROM tasks", "tasks")
    q["g11_task_sequences"] = using(f"""SELECT key, {seq_text} AS sequence_ids,
  CAST(label AS BIGINT) AS label FROM task_sequences""", "task_sequences")
    q["g12_machine_event_sequences"] = using(f"""SELECT key, {seq_text} AS sequence_ids,
  CAST(label AS BIGINT) AS label FROM event_sequences""", "event_sequences")
    q["g13_fit_length"] = """SELECT event_id, array_to_string(codes[-5:], ',') AS cut,
  array_to_string(CASE WHEN len(codes) > 12 THEN codes[-12:] ELSE codes
    || list_transform(range(12 - len(codes)), lambda x: 0) END, ',') AS padded
FROM (SELECT event_id, list_transform(string_split(props, ''), lambda x: ascii(x)) AS codes
  FROM events)"""
    q["g14_clean_html"] = f"SELECT page_id, md5({clean_html('html')}) AS clean_md5 FROM pages"
    q["g15_tag_list"] = using(f"""SELECT Id,
  {join_list("regexp_extract_all(coalesce(Tags, ''), '<([^>]+)>', 1)")} AS tags
  FROM questions""", "questions")
    q["g16_clean_text"] = using(f"""SELECT Id, md5({clean_text('Body')}) AS clean_md5,
  md5({clean_text('Body', True)}) AS without_code_md5 FROM questions""", "questions")
    code = lit(rules.CODE_BLOCK)
    q["g17_code_blocks"] = using(f"""SELECT Id,
  coalesce(array_to_string(regexp_extract_all(Body, {code}), '|'), '') AS blocks,
  md5({squeeze(f"regexp_replace(Body, {code}, ' [CODE] ', 'g')")}) AS masked_md5
  FROM questions""", "questions")
    q["g18_text_metrics"] = f"""SELECT doc_id, length(text) AS char_count,
  {words('text')} AS word_count, {count_matches('text', '[.!?]+')} AS sentence_count,
  {blocks('text')} AS code_block_count FROM documents"""
    q["g19_error_signatures"] = using(
        f"SELECT Id, {names_found('Body', rules.ERROR_SIGNATURES)} AS names FROM questions",
        "questions")
    q["g20_infra_components"] = using(
        f"SELECT Id, {names_found('Body', rules.INFRA_COMPONENTS)} AS names FROM questions",
        "questions")
    q["g21_quality_score"] = using("SELECT question_id, quality_score FROM features", "features")
    q["g22_complexity"] = using(f"""SELECT Id, CASE WHEN {words('Body')} < 50
  AND {blocks('Body')} = 0 THEN 'simple' WHEN {words('Body')} < 200 OR {blocks('Body')} <= 1
  THEN 'moderate' ELSE 'complex' END AS complexity FROM questions""", "questions")
    kinds = " ".join(f"WHEN {matches('lower(Body)', p)} THEN '{n}'"
                     for n, p in rules.QUESTION_TYPES)
    q["g23_question_type"] = using(
        f"SELECT Id, CASE {kinds} ELSE 'general' END AS question_type FROM questions", "questions")
    q["g24_function_calls"] = using("SELECT * FROM call_facts", "call_facts")
    keys = "json_keys(json_extract(sig, '$.parameters.properties'))"
    needed = "CAST(json_extract(sig, '$.parameters.required') AS VARCHAR[])"
    q["g25_function_signatures"] = using(f"""SELECT id, json_extract_string(sig, '$.name') AS name,
  CASE WHEN sig IS NOT NULL THEN coalesce(json_extract_string(sig, '$.description'), '') END
    AS description,
  CASE WHEN sig IS NOT NULL THEN {join_list(keys)} END AS parameters,
  CASE WHEN sig IS NOT NULL THEN {join_list(needed)} END AS required FROM signatures""",
                                         "signatures")
    q["g26_error_handling"] = using(f"""SELECT id, {join_list(ERROR_WORDS)} AS words,
  {matches('lower(chat)', rules.FUNCTION_ERROR_RESPONSE, 's')} AS function_error,
  {matches('lower(chat)', rules.CONDITIONAL_ERROR)} AS conditional_error FROM chats""", "chats")
    q["g27_user_turns"] = using(f"""SELECT id, {count_matches('chat', 'USER:')} AS turns,
  id IN (SELECT id FROM call_facts WHERE malformed IS NOT NULL) AS has_malformed FROM chats""",
                                "chats", "call_facts")
    q["g28_complexity_tier"] = using("""SELECT id, coalesce(complexity_tier, 'none') AS tier
  FROM chats LEFT JOIN call_features USING (id)""", "chats", "call_features")
    q["g29_call_features"] = using("""SELECT md5(chat) AS chat_md5, num_turns, num_calls,
  complexity_tier, has_parallel, has_malformed, num_defined_functions,
  CASE WHEN defined IS NULL THEN '[]' ELSE '["' || defined || '"]' END AS defined_function_names,
  CASE WHEN defined = 'get_weather' THEN '["city"]' END AS required,
  has_error_handling, has_function_error_response, has_conditional_error,
  CASE WHEN words = '' THEN '[]' ELSE '["' || replace(words, ',', '","') || '"]' END
    AS error_keywords_found FROM call_features""", "call_features")
    q["g30_chat_messages"] = using(r"""SELECT
  md5(trim(regexp_extract(f.chat, 'USER:\s*(.*?)(?:ASSISTANT:|$)', 1, 's'), chr(10) || ' '))
    AS user_md5,
  CASE WHEN num_calls > 0 AND NOT has_malformed THEN c0.name END AS first_tool,
  CASE WHEN num_calls > 0 AND NOT has_malformed THEN c1.name END AS second_tool,
  CASE WHEN num_calls = 0 OR has_malformed THEN trim(regexp_extract(f.chat,
    'ASSISTANT:\s*(.*?)(?:USER:|<\|endoftext\|>|$)', 1, 's'), chr(10) || ' ') END AS message,
  complexity_tier, has_error_handling, num_turns, num_calls
FROM call_features f LEFT JOIN call_facts c0 ON f.id = c0.id AND c0.position = 0
  LEFT JOIN call_facts c1 ON f.id = c1.id AND c1.position = 1""", "call_features", "call_facts")
    q["g31_slice_buckets"] = using("""SELECT turn_bucket, call_bucket, has_defined_functions,
  count(*) AS count FROM call_slices GROUP BY ALL""", "call_slices")
    q["g32_redact"] = f"SELECT doc_id, md5({redact('text')}) AS clean_md5 FROM documents"
    q["g33_has_pii"] = (f"SELECT doc_id, {' OR '.join(matches('text', p) for p in PII.values())} "
                        "AS has_pii FROM documents")
    q["g34_prompts"] = using(f"SELECT doc_id, {prompt_sql()} AS prompt FROM files", "files")
    q["g35_wrap_manifest"] = using(
        "SELECT doc_id, 'apply_manifest' AS tool, md5(c) AS manifest_md5 FROM files", "files")
    q["g36_manifest_type"] = using(f"""SELECT doc_id, {kind_of_file('c')} AS iac_type,
  {kind_of_file('c', True)} AS with_terraform FROM files""", "files")
    q["g37_escape_difficulty"] = using(
        f"SELECT doc_id, {escape_class('c', 15, 40)} AS difficulty FROM files", "files")
    q["g38_size_bucket"] = using(f"SELECT doc_id, {size_class('size')} AS bucket FROM files",
                                 "files")
    q["g39_prompt_and_license_class"] = using(f"""SELECT doc_id,
  {prompt_class(f'({prompt_sql()})')} AS prompt_type, {LICENSE_CLASS} AS license FROM files""",
                                              "files")
    weight = """CASE WHEN max(quality_score) OVER () > min(quality_score) OVER () THEN
    0.5 + (quality_score - min(quality_score) OVER ())
      / (max(quality_score) OVER () - min(quality_score) OVER ()) ELSE 1.0 END"""
    q["g40_chat_records"] = using(f"""SELECT question_id, {lit(rules.QA_SYSTEM_PROMPT)} AS system,
  md5(question_body) AS user_md5, md5(answer_body) AS assistant_md5, infra,
  round({weight}, 6) AS sample_weight FROM features""", "features")
    q["g41_completion_records"] = using("""SELECT question_id, md5('### Question' || chr(10)
  || title || chr(10) || chr(10) || question_body || chr(10) || chr(10) || 'Tags: '
  || coalesce(array_to_string(tags, ', '), '') || chr(10) || chr(10) || '### Answer' || chr(10))
  AS prompt_md5, md5(answer_body) AS completion_md5 FROM features""", "features")
    q["g42_workflow_records"] = using("""SELECT id,
  'You are an MLOps remediation engine. Available Tools: ' || tool_context AS system,
  md5(user_intent) AS user_md5, '{"workflow":' || workflow_json || '}' AS assistant
  FROM prompts WHERE workflow_json IS NOT NULL""", "prompts")
    good = ", ".join(str(i) for i in b.VALID_WORKFLOWS)
    q["g43_workflow_valid"] = using(
        f"SELECT id, wf IN ({good}) AS workflow_valid FROM prompts", "prompts")
    q["g43_json_schema"] = q["g43_workflow_valid"]

    # H
    q["h1_balance_classes"] = using("""SELECT key, CAST(label AS BIGINT) AS label,
  unnest(range(copies)) AS copy FROM (
  SELECT key, label, CAST(target // n + CASE WHEN rn < target % n THEN 1 ELSE 0 END AS BIGINT)
    AS copies FROM (SELECT key, label,
      row_number() OVER (PARTITION BY label ORDER BY md5(key || ':42')) - 1 AS rn FROM sequences)
  JOIN (SELECT label, n, CASE WHEN label = 0 THEN least(n, 3 * t) ELSE t END AS target
    FROM (SELECT label, count(*) AS n,
      max(CASE WHEN label > 0 THEN count(*) END) OVER () AS t FROM sequences GROUP BY label))
  USING (label))""", "sequences")
    q["h2_hash_sample"] = using(f"""SELECT system, raw_id, message FROM unified
  WHERE {md5_mod} < 10""", "unified")
    q["h3_oversample_slices"] = using("""WITH m AS (SELECT question_id, slice FROM slices
  WHERE regexp_matches(slice, '^(tag|error|infra)_') AND slice <> 'error_resolution'),
top AS (SELECT slice, count(*) AS n FROM m GROUP BY 1 HAVING count(*) < 50)
SELECT question_id, CAST(1 + 2 * count(slice) AS BIGINT) AS copies FROM features
  LEFT JOIN (SELECT question_id, slice FROM m JOIN top USING (slice) WHERE n < 30)
  USING (question_id) GROUP BY 1""".replace("WITH m", "SELECT * FROM (WITH m", 1) + ")",
                                      "slices", "features")
    q["h4_quality_weights"] = using(
        f"SELECT question_id, round({weight}, 6) AS sample_weight FROM features", "features")
    ratios = f"""(SELECT kind, n, p, CASE WHEN p > 20 THEN 20 / p ELSE 1.0 END AS keep,
    round(greatest(0.1, least(5.0, least(p, 20) / p)), 4) AS weight
  FROM (SELECT kind, count(*) AS n, count(*) / (SELECT count(*) FROM files) * 100 AS p
    FROM (SELECT {kind_of_file('c')} AS kind FROM files) GROUP BY kind))"""
    q["h5_cap_class_share"] = using(f"""SELECT doc_id, kind AS iac_type,
  CAST(weight AS DOUBLE) AS sampling_weight
  FROM (SELECT doc_id, {kind_of_file('c')} AS kind FROM files) JOIN {ratios} USING (kind)
  WHERE {HEX.format("CAST(doc_id AS VARCHAR) || ':42'")} / CAST(4294967296 AS DOUBLE) <= keep""",
                                    "files")
    q["h6_sampling_weight"] = using(f"""SELECT kind AS iac_type, n AS count, round(p, 4) AS pct,
  round(keep, 6) AS keep_ratio, CAST(weight AS DOUBLE) AS sampling_weight FROM {ratios}""",
                                    "files")

    # I
    q["i1_columns_present"] = using(check_rows("labelled", {
        "columns_present": "0 * count(*)",
        "row_count": "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END"}), "labelled")
    q["i2_no_nulls"] = using(check_rows("labelled", {
        **{f"no_nulls_{c}": nulls(c) for c in ["event_id", "event_template", "message"]},
        "no_nulls_absent": None}), "labelled")
    q["i3_value_range"] = check_rows("lineitem", {
        "range_l_quantity": "count(*) FILTER (l_quantity < 1 OR l_quantity > 45)",
        "range_l_discount": "count(*) FILTER (l_discount < 0)",
        "range_l_tax": "count(*) FILTER (l_tax > CAST(0.05 AS DOUBLE))"})
    listed = ["Failed", "Terminated", "Waiting"]
    q["i4_allowed_values"] = using(check_rows("tasks", {
        "allowed_status": not_in("status", listed),
        "allowed_status_or_null":
            f"count(*) FILTER (status NOT IN ({', '.join(lit(x) for x in listed)}))"}), "tasks")
    q["i5_row_count"] = check_rows("orders", {
        "row_count": "CASE WHEN count(*) BETWEEN 1 AND 100 THEN 0 ELSE 1 END"})
    q["i6_no_empty_strings"] = using(check_rows("unified", {
        f"no_empty_{c}": empties(c) for c in ["message", "event_type", "raw_id"]}), "unified")
    q["i7_unique"] = using(check_rows("files", {
        f"unique_{c}": f"count(*) - ({distinct(c)})" for c in ["hexsha", "doc_id", "lang"]}),
        "files")
    q["i8_regex_match"] = using(check_rows("labelled", {
        "regex_event_id": EVENT_CHECKS["event_id_pattern"],
        "regex_event_template": "count(*) FILTER (NOT regexp_matches(event_template, '[a-z]'))"}),
        "labelled")
    row_count = {"row_count": "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END"}
    event_checks = check_rows("labelled", {**EVENT_CHECKS, **row_count})
    q["i9_suite_summary"] = using(f"""SELECT count(*) AS total,
  count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failed,
  count(*) FILTER (success) / count(*) AS success_rate, bool_and(success) AS all_passed
  FROM ({event_checks})""", "labelled")
    q["i10_schema_checks"] = check_rows("orders", {
        "column_exists_o_orderkey": "0 * count(*)", "column_exists_o_custkey": "0 * count(*)",
        "column_exists_o_comment": "1 + 0 * count(*)", "no_nulls_o_orderkey": nulls("o_orderkey"),
        "values_in_set_o_orderstatus": "count(*) FILTER (o_orderstatus NOT IN ('O', 'F'))",
        "row_count_range": "0 * count(*)",
        "range_o_totalprice": "count(*) FILTER (o_totalprice < 0 OR o_totalprice > 100000)"})
    q["i10_record_schemas"] = """SELECT o_orderkey, o_orderkey % 11 <> 0
  AND o_orderstatus IN ('O', 'F') AND o_totalprice <= 200000 AS plain,
  o_orderkey % 11 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 AND o_custkey > 0
  AND o_orderstatus IN ('O', 'F', 'P') AS strict FROM orders"""
    q["i11_sequence_errors"] = using("""SELECT key, 'invalid label' AS error FROM sequences
  WHERE label = 4 UNION ALL SELECT key, 'sequence_ids is empty' FROM sequences
  WHERE label = 3""", "sequences")
    coverage = "SELECT DISTINCT event_id FROM unified WHERE event_id NOT IN (SELECT EventId FROM templates)"
    q["i12_log_quality"] = using(check_rows("labelled", {
        **EVENT_CHECKS, **{f"no_empty_{c}": empties(c) for c in IDS},
        "sampling_sanity": "CASE WHEN count(*) / (SELECT count(*) FROM events) * 100 BETWEEN 5 AND 100 THEN 0 ELSE 1 END",
    }) + f""" UNION ALL SELECT 'template_coverage', count(*) = 0, count(*) FROM ({coverage})
UNION ALL SELECT 'template_no_duplicates', count(*) = 0, count(*) FROM (
  SELECT EventId, system FROM templates GROUP BY ALL HAVING count(*) > 1)""",
        "labelled", "templates")
    q["i13_log_checks"] = using(event_checks, "labelled")
    q["i14_qa_schema"] = using("""SELECT "check", status, severity, value FROM (VALUES
  ('schema_required_columns', 'fail', 'error', CAST(1 AS DOUBLE)),
  ('schema_extra_columns', 'warn', 'warning', CAST(1 AS DOUBLE)))
  AS t("check", status, severity, value) WHERE (SELECT count(*) FROM features) > 0""", "features")
    dup = "(count(*) - count(DISTINCT question_id))"
    q["i15_qa_data_quality"] = using(f"""SELECT "check", status, CASE status WHEN 'fail'
  THEN 'error' WHEN 'warn' THEN 'warning' ELSE 'none' END AS severity,
  round(CAST(value AS DOUBLE), 6) AS value FROM (
  SELECT 'min_rows' AS "check", CASE WHEN count(*) < 10 THEN 'fail' ELSE 'pass' END AS status,
    count(*) AS value FROM features
  UNION ALL SELECT 'missing_values_question_id', 'pass', 0
  UNION ALL SELECT 'missing_values_question_body', 'pass', 0
  UNION ALL SELECT 'missing_values_answer_body', 'pass', 0
  UNION ALL SELECT 'duplicates', CASE WHEN {dup} / count(*) > 0.05 THEN 'fail'
    WHEN {dup} > 0 THEN 'warn' ELSE 'pass' END, {dup} / count(*) FROM features
  UNION ALL SELECT 'empty_strings_title', 'warn', count(*) FROM features
    WHERE trim(title) = '' HAVING count(*) > 0)""", "features")
    lengths = []
    for side, column in [("question", "question_body"), ("answer", "answer_body")]:
        x = f"strlen({column})"
        for m, agg in [("min", f"min({x})"), ("max", f"max({x})"), ("mean", f"avg({x})"),
                       ("median", f"quantile_cont({x}, 0.5)")]:
            lengths.append(f"""SELECT '{side}_length_{m}' AS "check", 'info' AS status,
  'none' AS severity, round(CAST({agg} AS DOUBLE), 4) AS value FROM features""")
        short = f"count(*) FILTER ({x} < 700)"
        quiet = "'pass'" if side == "question" else "NULL"
        lengths.append(f"""SELECT * FROM (SELECT '{side}_short_texts', CASE WHEN
  {short} > count(*) * 0.1 THEN 'warn' ELSE {quiet} END AS status,
  CASE WHEN {short} > count(*) * 0.1 THEN 'warning' ELSE 'none' END,
  CAST({short} AS DOUBLE) FROM features) WHERE status IS NOT NULL""")
    q["i16_qa_text_quality"] = using(" UNION ALL ".join(lengths), "features")
    spread = [("score_mean", "avg(score)"), ("score_std", "stddev_samp(score)"),
              ("quality_score_mean", "avg(quality_score)"),
              ("quality_score_std", "stddev_samp(quality_score)")]
    q["i17_qa_feature_distribution"] = using(" UNION ALL ".join(
        f"""SELECT '{n}' AS "check", 'info' AS status, 'none' AS severity,
  round(CAST({x} AS DOUBLE), 4) AS value FROM features""" for n, x in spread) + """
UNION ALL SELECT 'unique_tags', CASE WHEN count(DISTINCT x) < 3 THEN 'warn' ELSE 'info' END,
  CASE WHEN count(DISTINCT x) < 3 THEN 'warning' ELSE 'none' END, count(DISTINCT x)
  FROM (SELECT unnest(tags) AS x FROM features)""", "features")
    q["i18_qa_suite"] = using(check_rows("features", {
        "columns_present": "0 * count(*)",
        **{f"no_nulls_{c}": nulls(c)
           for c in ["question_id", "question_body", "answer_body", "score"]},
        "row_count": "CASE WHEN count(*) >= 10 THEN 0 ELSE 1 END",
        "unique_question_id": dup, "range_score": "count(*) FILTER (score < 0)",
        "range_quality_score": "count(*) FILTER (quality_score < 0)"}), "features")
    q["i19_call_suite"] = using(check_rows("call_features", {
        "columns_present": "0 * count(*)",
        **{f"no_nulls_{c}": nulls(c) for c in ["chat", "num_turns", "num_calls",
                                               "complexity_tier"]},
        "allowed_complexity_tier": not_in("complexity_tier", rules.COMPLEXITY_TIERS),
        "range_num_turns": "count(*) FILTER (num_turns NOT BETWEEN 0 AND 50)",
        "range_num_calls": "count(*) FILTER (num_calls NOT BETWEEN 0 AND 20)",
        "range_num_defined_functions":
            "count(*) FILTER (num_defined_functions NOT BETWEEN 0 AND 20)",
        "row_count": "CASE WHEN count(*) < 10 THEN 1 ELSE 0 END",
        "chat_not_empty": "count(*) FILTER (strlen(chat) < 10)"}), "call_features")
    q["i20_chat_errors"] = using("""SELECT id, CASE kind WHEN 1 THEN 'fewer than 3 messages'
  WHEN 2 THEN 'missing a required role' WHEN 4 THEN 'missing ''messages''' ELSE '' END AS errors
  FROM chat_records""", "chat_records")
    q["i21_chat_statistics"] = using("""SELECT count(*) AS row_count,
  count(*) FILTER (user_intent = '') AS missing_user_intent,
  count(*) FILTER (kind IN (1, 4)) AS records_missing_valid_messages FROM chat_records""",
                                     "chat_records")
    q["i22_record_violations"] = using(
        f"SELECT doc_id, {join_list('violations')} AS violations FROM lines", "lines")

    q["i21_inferred_schema"] = """WITH good AS (SELECT * FROM customer WHERE c_custkey % 7 <> 0),
field(field, types, present) AS (
  SELECT 'c_custkey', 'number', count(*) FROM good
  UNION ALL SELECT 'c_name', 'string', count(*) FROM good WHERE c_custkey % 3 <> 0 AND c_name IS NOT NULL
  UNION ALL SELECT 'account', 'object', count(*) FROM good
  UNION ALL SELECT 'state', 'string', count(*) FROM good WHERE c_acctbal < 0
  UNION ALL SELECT 'good', 'boolean', count(*) FROM good WHERE c_acctbal IS NOT NULL
  UNION ALL SELECT 'nations', 'array', count(*) FROM good)
SELECT field, types, present, 0 AS nulls, n - present AS missing, n AS records
FROM field, (SELECT count(*) AS n FROM good) WHERE present > 0"""
    q["i21_nested_schema"] = """WITH good AS (SELECT * FROM customer WHERE c_custkey % 7 <> 0),
n AS (SELECT count(*) AS records, count(*) FILTER (c_custkey % 5 = 0) AS flat,
    count(*) FILTER (c_custkey % 5 <> 0) AS deep,
    count(*) FILTER (c_custkey % 5 <> 0 AND c_acctbal < 0) AS debits,
    count(*) FILTER (c_custkey % 5 <> 0 AND c_custkey % 3 = 0) AS tagged FROM good)
SELECT field, types, present, nulls, parents - present AS missing, parents FROM (
  SELECT 'key' AS field, 'integer|string' AS types, records AS present, 0 AS nulls, records AS parents FROM n
  UNION ALL SELECT 'account', 'object', deep, 0, records FROM n
  UNION ALL SELECT 'account.balance', 'number', deep, 0, deep FROM n
  UNION ALL SELECT 'account["debit.mark"]', 'boolean', debits, 0, deep FROM n
  UNION ALL SELECT 'stops', 'array', records, flat, records FROM n
  UNION ALL SELECT 'stops[].nation', 'integer', 2 * deep, 0, 2 * deep FROM n
  UNION ALL SELECT 'stops[].tag', 'string', 2 * tagged, 0, 2 * deep FROM n)
UNION ALL SELECT 'stops[]', 'object', 2 * deep, 0, 0, deep FROM n"""

    # J
    skewed = "CAST(o_custkey AS DOUBLE)"
    skewed = " * ".join([skewed] * 4)
    outliers = [f"""SELECT o_orderkey AS question_id, '{n}' AS "column", round({x}, 4) AS value,
  round(lo, 4) AS lower_bound, round(hi, 4) AS upper_bound FROM orders,
  (SELECT a - 1.5 * (c - a) AS lo, c + 1.5 * (c - a) AS hi FROM (
    SELECT {nearest(x, 0.25)} AS a, {nearest(x, 0.75)} AS c FROM orders))
  WHERE {x} < lo OR {x} > hi""" for n, x in [("o_totalprice", "o_totalprice"),
                                               ("skewed", f"({skewed})")]]
    q["j1_iqr_outliers"] = " UNION ALL ".join(outliers)
    q["j2_html_residue"] = using("""SELECT question_id FROM features
  WHERE regexp_matches(question_body, '<[a-z]+>')""", "features")
    q["j3_chat_anomalies"] = using("""SELECT id, CASE kind WHEN 1 THEN 'missing messages'
  WHEN 2 THEN 'missing role assistant' WHEN 3 THEN 'assistant content is not valid JSON'
  ELSE 'missing ''messages''' END AS anomaly FROM chat_records WHERE kind IN (1, 2, 3, 4)""",
                                   "chat_records")
    checks = [("malformed_rate", "count(*) FILTER (has_malformed) / count(*)", "> ", 0.05),
              ("none_complexity_rate",
               "count(*) FILTER (complexity_tier = 'none') / count(*)", ">", 0.6),
              ("record_count", "count(*)", "<", 3000), ("avg_turns", "avg(num_turns)", ">", 10),
              ("avg_calls", "avg(num_calls)", ">", 5),
              ("defined_functions_coverage",
               "count(*) FILTER (num_defined_functions > 0) / count(*)", "<", 0.3)]
    q["j4_threshold_checks"] = using(" UNION ALL ".join(
        f"""SELECT '{n}' AS "check", round(CAST({x} AS DOUBLE), 4) AS value,
  CAST({limit} AS DOUBLE) AS threshold, {x} {op} {limit} AS is_anomaly FROM call_features"""
        for n, x, op, limit in checks), "call_features")
    leak = "SELECT count(*) AS v FROM broken WHERE starts_with(violation, 'pii_leaked')"
    worst = "SELECT max(n) AS v FROM (SELECT count(*) AS n FROM broken GROUP BY violation)"
    q["j5_report_checks"] = using(" UNION ALL ".join(
        f"""SELECT '{n}' AS "check", CAST(v AS DOUBLE) AS value, CAST({limit} AS DOUBLE)
  AS threshold, v {op} {limit} AS is_anomaly FROM ({x})""" for n, x, op, limit in [
            ("pass_rate", f"SELECT round({passed} / count(*) * 100, 2) AS v FROM lines", "<", 80),
            ("pii_leakage", leak, ">", 0), ("violation_count", worst, ">", 50),
            ("minimum_records", "SELECT count(*) AS v FROM lines", "<", 10)]), "lines", "broken")
    q["j6_critical_sequences"] = using(f"""SELECT key, CAST(label AS BIGINT) AS label,
  {LABEL_NAME} AS label_name FROM sequences WHERE label IN (1, 2)""", "sequences")
    findings = "(SELECT *, CASE WHEN round(share, 4) < 0.01 THEN 'high' ELSE 'medium' END AS sev FROM call_summary WHERE share < 0.2)"
    q["j1_outlier_summary"] = f"""SELECT "column", count(*) AS outliers,
  count(*) > (SELECT count(*) FROM orders) * 0.05 AS warning
  FROM ({" UNION ALL ".join(outliers)}) GROUP BY 1"""
    q["j7_validation_alert"] = """SELECT 'validation_failure' AS type, 'error' AS severity,
  'Data validation failed' AS title,
  'Data validation failed with ' || n || ' check(s) in orders' AS message, 'orders' AS pipeline,
  '{"failed_checks":"' || names || '","total_failures":' || n || '}' AS details
FROM (SELECT count(*) AS n, string_agg(name, ', ' ORDER BY name) AS names FROM (
  SELECT 'row_count' AS name FROM (SELECT count(*) AS n FROM orders) WHERE n < 1 OR n > 100
  UNION ALL SELECT 'range_o_totalprice' FROM (SELECT count(*) FILTER (
    o_totalprice < 0 OR o_totalprice > 10000) AS n FROM orders) WHERE n > 0)) WHERE n > 0"""
    q["j7_quality_alert"] = """SELECT 'data_quality_issue' AS type, 'warning' AS severity,
  'Data quality issue' AS title,
  'buyer is missing in ' || printf('%.2f', pct) || ' % of the rows' AS message,
  'orders' AS pipeline, '{"column":"buyer","null_pct":' || pct || '}' AS details
FROM (SELECT round(count(*) FILTER (o_orderkey % 3 <> 0 OR o_custkey IS NULL) / count(*) * 100, 2)
  AS pct FROM orders) WHERE pct > 10"""
    q["j7_alert_history"] = """SELECT timestamp, key FROM (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS timestamp, o_orderkey AS key FROM orders
  UNION ALL SELECT '9999-01-01', c_custkey FROM customer)
  ORDER BY timestamp DESC, key LIMIT 500"""
    q["j7_alerts"] = using(f"""SELECT 'anomaly_detected' AS type,
  CASE WHEN n > 10 THEN 'error' ELSE 'warning' END AS severity, 'Data anomalies' AS title,
  'Found ' || n || ' anomalies in traces' AS message, 'traces' AS pipeline,
  '{{"anomaly_count":' || n || ',"types":"' || names || '"}}' AS details
FROM (SELECT count(*) AS n, string_agg(DISTINCT {LABEL_NAME}, ', ' ORDER BY {LABEL_NAME}) AS names
  FROM sequences WHERE label <> 0)
UNION ALL SELECT 'bias_detected', CASE WHEN high > 0 THEN 'error' ELSE 'warning' END, 'Data bias',
  'Bias in ' || n || ' slices of calls', 'calls',
  '{{"high":' || high || ',"medium":' || medium || ',"low":0}}'
FROM (SELECT count(*) AS n, count(*) FILTER (sev = 'high') AS high,
  count(*) FILTER (sev = 'medium') AS medium FROM {findings})""", "sequences", "call_summary")

    # K
    q["k1_label_imbalance"] = using(f"""SELECT CAST(label AS BIGINT) AS label,
  {LABEL_NAME} AS label_name, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM sequences) * 100, 2) AS pct,
  label = 0 AND round(count(*) / (SELECT count(*) FROM sequences) * 100, 2) > 30 AS bias_detected
  FROM sequences GROUP BY label""", "sequences")
    q["k1_after_balancing"] = f"""SELECT label, {LABEL_NAME} AS label_name, count(*) AS count,
  round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct,
  label = 0 AND round(count(*) / sum(count(*)) OVER () * 100, 2) > 30 AS bias_detected
  FROM ({q["h1_balance_classes"]}) GROUP BY label"""
    q["e9_stratified_split"] = """SELECT o_orderkey, CASE WHEN rn < floor(n * 0.8) THEN 'train'
  ELSE 'test' END AS split FROM (SELECT o_orderkey,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || ':42')) - 1 AS rn,
    count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)"""
    q["k2_status_disparity"] = using("""SELECT max(r) - min(r) AS difference,
  max(r) - min(r) > 0.1 AS bias_detected FROM (
  SELECT avg(CAST(coalesce(status, 'Unknown') = 'Failed' AS INT)) AS r FROM tasks
  GROUP BY status)""", "tasks")
    q["k2_task_type_disparity"] = using("""SELECT round(max(r) - min(r), 9) AS difference,
  max(r) - min(r) > 0.1 AS bias_detected FROM (
  SELECT avg(CAST(coalesce(status, 'Unknown') = 'Failed' AS INT)) AS r FROM tasks
  GROUP BY task_type)""", "tasks")
    q["k3_log_bias_flags"] = using("""WITH t AS (SELECT count(*) FILTER (severity = 'ERROR')
    / count(*) * CAST(1.02 AS DOUBLE) AS lim FROM labelled)
SELECT system AS slice, 'error_rate' AS metric, rate AS value, round(lim, 4) AS threshold FROM t,
  (SELECT system, round(count(*) FILTER (severity = 'ERROR') / count(*), 4) AS rate
   FROM labelled GROUP BY system) WHERE rate > lim AND lim > 0
UNION ALL SELECT system || '/' || event_type, 'event_type_dominance', round(n / total, 4),
  CAST(0.21 AS DOUBLE) FROM (SELECT *, sum(n) OVER (PARTITION BY event_type) AS total FROM (
    SELECT system, event_type, count(*) AS n FROM labelled GROUP BY ALL))
  WHERE total >= 5 AND n / total > CAST(0.21 AS DOUBLE)""".replace(
        "WITH t AS", "SELECT * FROM (WITH t AS", 1) + ")", "labelled")
    q["k4_slice_members"] = using("""SELECT slice, count(*) AS count FROM slices GROUP BY 1
  HAVING count(*) >= 30""", "slices")

    def moments(x: str, name: str) -> str:
        return (f"round(avg({x}), 4) AS {name}_mean, "
                f"round(coalesce(stddev_samp({x}), 0), 4) AS {name}_std")

    mix = ", ".join(f"round(count(*) FILTER (complexity = '{c}') / count(*), 4) AS {c}_share"
                    for c in ("simple", "moderate", "complex"))
    q["k5_slice_metrics"] = using(f"""SELECT slice, count(*) AS count,
  {moments('quality_score', 'quality')}, {moments('answer_score', 'answer_score')},
  {moments('strlen(question_body)', 'question_length')},
  {moments('strlen(answer_body)', 'answer_length')}, {mix},
  round(count(*) / (SELECT count(*) FROM features), 4) AS proportion,
  round(quantile_cont(quality_score, 0.5), 4) AS quality_median
  FROM slices GROUP BY slice HAVING count(*) >= 5""", "slices", "features")
    q["k6_slice_bias"] = using(f"""SELECT slice, is_biased, severity,
  {join_list('list_transform(factors, lambda f: f.factor)')} AS factors FROM bias_graded""",
                               "bias_graded")
    q["k7_mitigations"] = using("""SELECT slice, CASE f.factor
    WHEN 'underrepresentation' THEN 'Underrepresentation'
    WHEN 'quality_score' THEN 'Lower quality examples'
    ELSE 'Answers are ' || f.way || ' than average' END AS issue,
  CASE f.factor WHEN 'underrepresentation' THEN 'data_augmentation'
    WHEN 'quality_score' THEN 'quality_filtering' ELSE 'length_normalization' END AS strategy,
  CASE f.factor WHEN 'underrepresentation' THEN CASE WHEN count < 50 THEN 'high' ELSE 'medium' END
    WHEN 'quality_score' THEN 'medium' ELSE 'low' END AS priority
FROM (SELECT slice, count, unnest(factors) AS f FROM bias_graded)
WHERE NOT (f.factor = 'quality_score' AND f.way = 'higher')""", "bias_graded")
    q["k8_bias_summary"] = using("""SELECT count(*) AS total_slices,
  count(*) FILTER (is_biased) AS biased_slices,
  round(count(*) FILTER (is_biased) / count(*), 6) AS bias_rate,
  count(*) FILTER (severity = 'high') AS high_severity_count,
  count(*) FILTER (severity = 'medium') AS medium_severity_count,
  count(*) FILTER (severity = 'low') AS low_severity_count FROM bias_graded""", "bias_graded")
    q["k9_representation_findings"] = using(f"""SELECT slice_column, slice_value,
  round(share, 4) AS proportion, count, sev AS severity,
  CASE sev WHEN 'high' THEN 'oversample' ELSE 'collect_more' END AS strategy FROM {findings}""",
                                            "call_summary")
    q["k10_imbalances"] = using("""SELECT dimension, direction,
  string_agg(value, ',' ORDER BY value) AS slice_values FROM (
  SELECT dimension, value, 'under' AS direction FROM shares WHERE pct_of_total < 20
  UNION ALL SELECT dimension, value, 'over' FROM shares WHERE pct_of_total > 30)
  GROUP BY ALL""", "shares")
    q["x1_exact_quantiles"] = f"""SELECT l_returnflag, 'l_extendedprice' AS "column",
  count(*) AS n, {nearest('l_extendedprice', 0.9)} AS nearest90,
  round(quantile_cont(l_extendedprice, 0.9), 4) AS linear90 FROM lineitem GROUP BY 1"""
    return q
