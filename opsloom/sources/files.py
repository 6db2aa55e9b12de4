"""File readers and writers: CSV, JSON documents, JSON lines, Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opsloom.functions import chats

SERVER_USAGE = (
    "time_stamp bigint, machine_id string, cpu_util_percent double, mem_util_percent double, "
    "net_in double, net_out double, disk_io_percent double, extra string"
)
BATCH_TASK = (
    "start_time bigint, end_time bigint, inst_num int, task_type int, job_id string, "
    "status string, plan_cpu double, plan_mem double"
)
SERVER_EVENT = (
    "time_stamp bigint, machine_id string, event_type string, event_detail string, "
    "plan_cpu double, plan_mem double, extra string"
)
QUESTIONS = (
    "Id string, Title string, Body string, Tags string, Score string, ViewCount string, "
    "AcceptedAnswerId string, CreationDate string"
)
ANSWERS = "AnswerId string, QuestionId string, AnswerBody string, AnswerScore string"


def read_positional_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV without header; columns are named and typed by position."""
    return spark.read.schema(schema).option("header", False).csv(path)


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with header, every column a string.

    Line breaks inside quoted fields need ``multi_line``; such files cannot be split.
    """
    return (
        spark.read.option("header", True).option("escape", '"')
        .option("multiLine", multi_line).csv(path)
    )


def read_wide_text_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header and line breaks inside quoted fields, all columns strings.

    ``row_order`` is the file position: files by path, rows as they come. Such files cannot
    be split, so a large export should arrive as many files.
    """
    rows = (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("escape", '"').csv(path)
    )
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn("row_order", place)


def read_json_document(spark: SparkSession, path: str,
                       schema: str | StructType | None = None) -> DataFrame:
    """Files that each hold one JSON array (or object)."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One JSON object per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_checked_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines as text, each marked as a valid JSON object or not."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.withColumn("is_valid", chats.json_object(F.trim("value")).isNotNull())


def line_counts(checked: DataFrame) -> DataFrame:
    """One row: lines, valid lines, malformed lines."""
    valid = F.count_if("is_valid")
    return checked.agg(
        F.count("*").alias("total"), valid.alias("valid"),
        (F.count("*") - valid).alias("malformed"),
    )


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None
                 ) -> DataFrame:
    """A Parquet file or folder of chunks; only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Snappy Parquet, with at most ``rows_per_file`` rows in a file."""
    writer = df.write.option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.mode("error").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV whose fields come back as they were, surrounding blanks included."""
    writer = df.write.option("header", header).option("escape", '"')
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**keep).mode("error").csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are kept."""
    df.write.option("ignoreNullFields", False).mode("error").json(path)


def json_to_parquet(spark: SparkSession, source: str, target: str, schema: str) -> None:
    """Hand a JSON document over as Parquet."""
    write_parquet(read_json_document(spark, source, schema), target)


def first_rows(df: DataFrame, n: int | None, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order; None means no limit."""
    return df if n is None else df.orderBy(*order_by).limit(n)
