"""Word lists, lookup tables, thresholds and patterns.

Everything here is data that results depend on. Order matters wherever a list is
described as ordered: the first matching entry wins.
"""

# --- Fixed values: log severity -------------------------------------------------
LOG_SYSTEMS = ["linux", "hpc", "hdfs", "hadoop", "spark"]
SEVERITIES = ["INFO", "WARN", "ERROR"]

LINUX_ERROR_WORDS = [
    "authentication failure", "failed password", "permission denied",
    "not permitted", "denied", "invalid", "refused", "error",
    "failure", "segfault", "panic",
]
LINUX_WARN_WORDS = [
    "warn", "timeout", "timed out", "retry", "unable",
    "deprecated", "slow", "backoff",
]

HPC_ERROR_STATE_WORDS = ["unavailable"]
HPC_ERROR_WORDS = ["unavailable", "panic", "fatal", "error"]
HPC_WARN_STATE_WORDS = ["degraded", "fail", "error"]
HPC_WARN_WORDS = ["timeout", "retry", "slow"]

LEVEL_SEVERITY = {
    "INFO": "INFO", "WARN": "WARN", "WARNING": "WARN", "ERROR": "ERROR",
    "FATAL": "ERROR", "DEBUG": "INFO", "TRACE": "INFO",
}
LEVEL_ERROR_WORDS = {
    "hdfs": ["exception", "failed", "failure", "error", "unable", "corrupt", "denied"],
    "hadoop": ["exception", "failed", "failure", "killed", "oom", "error", "denied"],
    "spark": ["exception", "failed", "failure", "error", "killed", "oom"],
}
LEVEL_WARN_WORDS = {
    "hdfs": ["warn", "timeout", "retry", "slow"],
    "hadoop": ["warn", "timeout", "retry", "slow", "fallback"],
    "spark": ["warn", "timeout", "retry", "slow"],
}

# --- Fixed values: unified log event --------------------------------------------
EVENT_COLUMNS = [
    "system", "timestamp", "severity", "source", "event_id",
    "event_template", "message", "raw_id", "extras", "event_type",
]

# --- Fixed values: log event types (ordered) -------------------------------------
EVENT_TYPE_RULES = [
    ("auth_failure", ["authentication failure", "failed password", "login failed", "pam_unix"]),
    ("permission_denied", ["permission denied", "not permitted", "access denied", "authorization"]),
    ("storage_unavailable", ["unavailable", "state_change.unavailable", "block missing",
                             "namenode down", "disk failure"]),
    ("compute_oom", ["outofmemory", "oom", "java heap space", "killed container"]),
    ("network_issue", ["connection refused", "timed out", "unable to connect",
                       "broken pipe", "reset by peer"]),
    ("data_ingestion_failed", ["ingest", "input split", "failed to read",
                               "could not read", "ioexception"]),
    ("executor_failure", ["executor lost", "task failed", "stage failed", "container killed"]),
    ("system_crash", ["clusteraddmember", "risboot", "bootgenvmunix", "invalid acpi",
                      "irq routing", "pci:", "halt", "reboot", "kernel panic", "segfault"]),
    ("job_failed", ["exception", "failed", "failure", "error"]),
]
EVENT_TYPES = [
    "auth_failure", "permission_denied", "storage_unavailable", "data_ingestion_failed",
    "compute_oom", "executor_failure", "network_issue", "job_failed", "system_crash",
    "normal_ops", "unknown",
]
EVENT_TYPE_LABELS = {
    "normal_ops": 0, "unknown": 0, "compute_oom": 1, "storage_unavailable": 2,
    "executor_failure": 2, "system_crash": 2, "job_failed": 2, "network_issue": 3,
    "data_ingestion_failed": 4, "auth_failure": 5, "permission_denied": 6,
}
TEMPLATE_LABEL_RULES = [
    (3, ["timeout", "unreachable"]),
    (4, ["checksum", "verification failed"]),
]
EVENT_ID_PATTERN = r"^E\d+$"

# --- Fixed values: cluster trace tokens and sequence labels -----------------------
STATUS_TOKENS = {"Terminated": 300, "Failed": 301, "Waiting": 302, "Running": 303, "Unknown": 304}
EVENT_TOKENS = {"add": 400, "remove": 401, "failure": 402, "unknown": 403}
SEQUENCE_LABELS = {
    0: "Normal", 1: "Resource_Exhaustion", 2: "System_Crash",
    3: "Network_Failure", 4: "Data_Drift",
}
MAX_SEQUENCE_LENGTH = 512

# --- Fixed values: question and answer text ---------------------------------------
ERROR_SIGNATURES = {
    "CrashLoopBackOff": r"CrashLoopBackOff",
    "OOMKilled": r"OOMKilled|Out[Oo]f[Mm]emory|oom|OOM",
    "ImagePullBackOff": r"ImagePullBackOff|ErrImagePull",
    "Timeout": r"timeout|Timeout|TIMEOUT|timed out",
    "ConnectionRefused": r"connection refused|ECONNREFUSED",
    "PermissionDenied": r"permission denied|403|401|unauthorized",
    "ResourceExhausted": r"resource exhausted|quota exceeded|limit reached",
    "GPUError": r"CUDA|cuda|GPU|gpu error|device not found",
    "NetworkError": r"network|dns|resolve|unreachable",
    "ConfigError": r"config|configuration|yaml|invalid",
}
INFRA_COMPONENTS = {
    "kubernetes": r"kubernetes|k8s|kubectl|pod|deployment|service|ingress|helm",
    "terraform": r"terraform|tfstate|provider|module|hcl",
    "docker": r"docker|container|dockerfile|image|compose",
    "gpu": r"gpu|cuda|nvidia|GPU|tensor|TPU",
    "database": r"database|postgres|mysql|redis|mongodb|sql",
    "cloud_aws": r"aws|ec2|s3|lambda|eks|iam",
    "cloud_gcp": r"gcp|gke|bigquery|cloud run",
    "cloud_azure": r"azure|aks|blob",
    "monitoring": r"prometheus|grafana|alertmanager|datadog|metrics",
    "cicd": r"jenkins|github actions|gitlab|circleci|pipeline",
}
QUESTION_TYPES = [
    ("how_to", r"how (do|can|to|should)"),
    ("explanation", r"why (is|does|did|am|are)"),
    ("definition", r"what (is|are|does)"),
    ("troubleshooting", r"(fix|solve|resolve|debug)"),
    ("error_resolution", r"(error|exception|fail|crash)"),
    ("best_practice", r"(best practice|recommend|should i)"),
]
CODE_BLOCK = r"```[\s\S]*?```|`[^`]+`"
FENCED_CODE = r"```[\s\S]*?```"
INLINE_CODE = r"`[^`]+`"
QA_REQUIRED_COLUMNS = [
    "question_id", "title", "question_body", "answer_body", "tags", "score", "quality_score",
]
QA_KNOWN_COLUMNS = [
    "question_id", "title", "question_body", "answer_body", "tags", "score", "answer_score",
    "view_count", "quality_score", "error_signatures", "infra_components", "question_type",
    "complexity",
]
QA_SIDE_COLUMNS = ["processed_at", "question_metrics", "answer_metrics"]
QA_SYSTEM_PROMPT = (
    "You are an expert MLOps engineer helping to diagnose and fix infrastructure issues."
)

# --- Fixed values: function-call chats --------------------------------------------
CALL_ERROR_WORDS = [
    "error", "invalid", "failed", "null", "none",
    "exception", "traceback", "undefined", "not found",
]
FUNCTION_ERROR_RESPONSE = r"<functionresponse>.*?(error|failed|invalid).*?</functionresponse>"
CONDITIONAL_ERROR = r"(if|when).{0,30}(error|fail|invalid)"
CALL_COLUMNS = [
    "system", "chat", "num_turns", "num_calls", "complexity_tier", "has_parallel",
    "has_malformed", "function_calls", "num_defined_functions", "defined_function_names",
    "function_signatures", "has_error_handling", "has_function_error_response",
    "has_conditional_error", "error_keywords_found",
]
COMPLEXITY_TIERS = ["none", "simple", "moderate", "complex", "malformed"]

# --- Fixed values: infrastructure-as-code corpus -----------------------------------
MIN_SIZE_BYTES = 200
MAX_SIZE_BYTES = 500000
MIN_ALPHANUM_FRACTION = 0.25
ALLOWED_EXTENSIONS = ["yaml", "yml"]
PERMISSIVE_LICENSES = [
    "mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc",
    "cc0-1.0", "unlicense", "wtfpl", "0bsd",
]
CORPUS_KEYWORDS = {
    "ml_gpu": ["nvidia.com/gpu", "amd.com/gpu", "accelerator", "gpu"],
    "kserve_seldon": ["kserve", "seldon", "inferenceservice", "servingruntime",
                      "seldondeployment", "predictor", "storageuri"],
    "mlops": ["kubeflow", "mlflow", "inference", "serving", "pipeline", "workflow"],
}
CORPUS_COLUMNS = [
    "content", "ext", "lang", "size", "avg_line_length", "max_line_length",
    "alphanum_fraction", "hexsha", "max_stars_repo_path", "max_stars_repo_name",
    "max_stars_repo_licenses", "max_issues_repo_path", "max_forks_repo_path",
    "max_issues_repo_licenses", "max_forks_repo_licenses",
]
PII_PATTERNS = {
    "ipv4": r"\b(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\b",
    "email": r"(?<![/\w])[\w.+-]{2,}@[\w-]+\.[\w.-]+",
    "api_key": r"sk-[A-Za-z0-9]{20,}",
    "creds": r"(password|token|api_key|secret)\s*[:=]\s*\S+",
}
PII_REPLACEMENTS = {
    "ipv4": "IPV4_REDACTED", "email": "EMAIL_REDACTED",
    "api_key": "sk-REDACTED", "creds": "$1: REDACTED",
}
PII_REDACTION_ORDER = ["ipv4", "api_key", "email", "creds"]
PII_LEAK_PATTERNS = {
    "api_key": r"sk-[A-Za-z0-9]{20,}",
    "ipv4": r"(?:\d{1,3}\.){3}\d{1,3}",
    "email": r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+",
}
PROMPT_RULES = [
    ("deploy", "Deploy the {slug} configuration"),
    ("service", "Apply the {slug} service manifest"),
    ("inference", "Set up the {slug} inference workload"),
    ("gpu", "Provision a GPU workload for {slug}"),
    ("train", "Submit the {slug} training job"),
    ("pipeline", "Run the {slug} pipeline"),
    ("ingress", "Configure ingress for {slug}"),
    ("secret", "Apply the {slug} secret manifest"),
    ("config", "Apply the {slug} configuration"),
]
PROMPT_FALLBACK = "Apply the following Kubernetes manifest for {slug}"
PROMPT_TYPES = [
    "deploy", "gpu", "inference", "service", "train", "pipeline", "ingress", "secret", "config",
]
MANIFEST_TYPES = [
    ("kserve", r"InferenceService|kserve"),
    ("seldon", r"seldon|SeldonDeployment"),
    ("k8s_workload", r"kind:\s*(Deployment|StatefulSet|DaemonSet|Job)"),
    ("k8s_config", r"kind:\s*(Service|Ingress|ConfigMap|Secret)"),
    ("k8s_other", r"apiVersion"),
]
TERRAFORM_TYPE = ("terraform", r'resource\s+"|terraform\s*\{')
RECORD_META_KEYS = ["hexsha", "path", "size", "licenses"]


# fixed values: prompt and health limits of function-call chats
SYSTEM_PROMPT = (
    "You are an MLOps remediation engine. "
    "Convert user requests into valid JSON workflow definitions."
)
CALL_THRESHOLDS = {
    "malformed_rate": 0.05, "none_complexity_rate": 0.60, "record_count": 3000,
    "avg_turns": 10.0, "avg_calls": 5.0, "defined_functions_coverage": 0.30,
}
# The step schema of generated workflows as a JSON Schema document; whole numbers may be text.
WORKFLOW_SCHEMA = {
    "type": "object", "required": ["steps"],
    "properties": {"steps": {"type": "array", "items": {"$ref": "#/$defs/step"}}},
    "$defs": {
        "step": {
            "type": "object", "required": ["step_id", "tool", "params"],
            "properties": {
                "step_id": {"$ref": "#/$defs/whole"}, "tool": {"type": "string"},
                "params": {
                    "type": "object", "additionalProperties": False,
                    "properties": {
                        "deployment": {"type": ["string", "null"]}, "pod": {"type": ["string", "null"]},
                        "replicas": {"anyOf": [{"type": "null"}, {"$ref": "#/$defs/whole"}]},
                    },
                },
            },
        },
        "whole": {"anyOf": [
            {"type": ["integer", "boolean"]}, {"type": "string", "pattern": r"^[+-]?\d+(\.0+)?$"},
        ]},
    },
}
