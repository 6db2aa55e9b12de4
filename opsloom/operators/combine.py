"""Combining sources into the two training tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions import chats


def tag_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source_dataset", F.lit(source))


def _present(sources: Mapping[str, DataFrame | None]) -> dict[str, DataFrame]:
    present = {name: df for name, df in sources.items() if df is not None}
    if not present:
        raise FileNotFoundError("no input table to combine")
    return present


def combine_sequences(sources: Mapping[str, DataFrame | None]) -> DataFrame:
    """UNION ALL of sequence tables with their source name; absent (None) inputs are skipped."""
    frames = [
        tag_source(df.select(
            F.col("sequence_ids").cast("array<bigint>").alias("sequence_ids"),
            F.col("label").cast("bigint").alias("label"),
        ), name)
        for name, df in _present(sources).items()
    ]
    return reduce(DataFrame.unionByName, frames)


def combine_chats(sources: Mapping[str, DataFrame | None]) -> DataFrame:
    """UNION ALL of chat tables whose extra columns differ; lacking columns become null."""
    frames = [tag_source(df, name) for name, df in _present(sources).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine_json_lines(lines: DataFrame, value: str = "value",
                       source: str = "source_dataset") -> DataFrame:
    """JSON-object lines with the source written into each; blank and malformed lines drop.

    Keeps every record's own shape, so sources with different fields share one text table.
    """
    text = F.trim(F.col(value))
    tag = F.concat(
        F.lit('"source_dataset":'), chats.quote_json(F.col(source)), F.lit("}")
    )
    body = F.regexp_replace(text, r"\}\s*$", "")
    empty = F.array_size(F.json_object_keys(text)) == 0
    record = F.concat(body, F.when(empty, "").otherwise(", "), tag)
    return lines.filter(chats.json_object(text).isNotNull()).select(
        record.alias("record"), F.col(source).alias("source_dataset")
    )


def records_by_source(combined: DataFrame, expected: Sequence[str] = ()) -> DataFrame:
    """Rows per source; expected sources without rows count zero."""
    counts = combined.groupBy("source_dataset").agg(F.count("*").alias("count"))
    if not expected:
        return counts
    names = combined.sparkSession.createDataFrame(
        [(s,) for s in expected], "source_dataset string"
    )
    joined = names.join(counts, "source_dataset", "full")
    return joined.select("source_dataset", F.coalesce("count", F.lit(0)).alias("count"))
