"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of Parquet tables (default /root/testdata/sf0.1); each is first written again as
              one file a core, untimed, so that plans run as on a table of many files
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from opsloom.plans.queries import queries  # noqa: E402

HEADLINE = [
    "b1_normalize_logs", "d1_event_counts", "d2_error_rate", "d13_event_sequences",
    "e5_top_templates", "k3_log_bias_flags", "i12_log_quality", "e1_usage_windows",
    "e2_machine_windows", "h1_balance_classes", "d12_sequence_statistics", "d8_numeric_profile",
    "d10_table_profile", "c2_pair_by_question", "g21_quality_score", "k6_slice_bias",
    "g29_call_features", "d23_chat_slices", "b8_filter_reason", "b12_curated_reason",
    "d17_keyword_totals", "g32_redact", "e7_first_by_key", "e9_train_test_split",
    "i22_record_violations",
    "j1_iqr_outliers", "d20_diagnostics", "d7_dataset_statistics", "d31_yields",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    known = queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(known) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-checkpoint-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    source, folder = folder, f"{spark.conf.get('spark.checkpoint.dir')}/tables"
    for table in sorted(Path(source).glob("*.parquet")):
        rows = spark.read.parquet(str(table))
        rows.repartition(int(cpus)).write.parquet(f"{folder}/{table.name}")
    known["d14_event_type_by_system"](spark, folder).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", source)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
