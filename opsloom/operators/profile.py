"""Table profiles: distributions, null rates, distinct counts, numeric and text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.operators.selection import exact_quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null is a value of its own."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))


def share_of_values(df: DataFrame, column: str, dominant: float = 80.0) -> DataFrame:
    """Rows and percentage per value, and whether the value dominates the column."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("count")).scalar()
    percent = F.round(F.col("count") / total * 100, 2)
    return counts.withColumn("pct", percent).withColumn("is_dominant", F.col("pct") > dominant)


def _unpivot(row: DataFrame, fields: dict[str, dict[str, str]]) -> DataFrame:
    """A one-row frame of aggregates -> one row per column: (column, named measures...)."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(src).alias(out) for out, src in m.items()])
        for c, m in fields.items()
    ]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _names(columns: Sequence[str], measures: Sequence[str]) -> dict[str, dict[str, str]]:
    return {c: {m: f"{m}_{i}" for m in measures} for i, c in enumerate(columns)}


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column, all columns in one pass."""
    columns = list(columns or df.columns)
    names = _names(columns, ["null_count", "null_pct"])
    total = F.count("*")
    aggs = []
    for c in columns:
        nulls = F.count_if(F.col(c).isNull())
        aggs += [nulls.alias(names[c]["null_count"]),
                 F.round(F.try_divide(nulls, total) * 100, 2).alias(names[c]["null_pct"])]
    return _unpivot(df.agg(*aggs), names)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; null counts as a value."""
    names = _names(columns, ["n_unique"])
    count = F.approx_count_distinct if approximate else F.count_distinct
    aggs = [
        (count(_distinct_by(df, c)) + F.max(F.col(c).isNull().cast("int")))
        .alias(names[c]["n_unique"])
        for c in columns
    ]
    return _unpivot(df.agg(*aggs), names)


def _distinct_by(df: DataFrame, column: str) -> Column:
    """The value, or the 128-bit digest of a text: what a distinct count has to shuffle."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.unhex(F.md5(F.col(column).cast("binary")))
    return F.col(column)


def dataset_statistics(df: DataFrame, distributions: Sequence[str],
                       distinct: Sequence[str]) -> DataFrame:
    """Tidy report (metric, name, value): size, distributions, null rates, distinct counts.

    One pass: every row leaves marks (metric, name, value, weight), which are summed first per
    value and then per name, so a distinct count is a count of sums. An empty table has no report.
    """
    none = F.lit(None).cast("binary")

    def mark(metric: str, name: Column, value: Column = none, weight: Column = F.lit(1)) -> Column:
        return F.struct(F.lit(metric).alias("metric"), name.cast("string").alias("name"),
                        value.alias("of"), weight.cast("bigint").alias("weight"))

    marks = [mark("total_rows", F.lit(""))]
    marks += [mark("null_rate_pct", F.lit(c), weight=F.col(c).isNull()) for c in df.columns]
    marks += [mark(f"distribution_{c}", F.col(c)) for c in distributions]
    marks += [
        mark("unique", F.lit(c), F.unhex(F.md5(F.col(c).cast("string").cast("binary"))))
        for c in distinct
    ]
    sums = (
        df.select(F.inline(F.array(*marks)))
        .groupBy("metric", "name", "of").agg(F.sum("weight").alias("rows"))
        .groupBy("metric", "name").agg(F.sum("rows").alias("rows"), F.count("*").alias("values"))
    )
    # one row per figure by now
    total = F.max(F.when(F.col("metric") == "total_rows", F.col("rows"))).over(
        Window.partitionBy(F.lit(0))
    )
    value = (
        F.when(F.col("metric") == "unique", F.col("values"))
        .when(F.col("metric") == "null_rate_pct", F.round(F.col("rows") / F.col("_total") * 100, 2))
        .otherwise(F.col("rows")).cast("double")
    )
    own = F.struct("metric", "name", value.alias("value"))
    width = F.when(F.col("metric") == "total_rows", F.struct(
        F.lit("total_columns").alias("metric"), F.lit("").alias("name"),
        F.lit(float(len(df.columns))).alias("value"),
    ))
    return sums.withColumn("_total", total).select(F.inline(F.array_compact(F.array(own, width))))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, max, q25, median, q75 of numeric columns.

    The standard deviation is the sample one. Quartiles are exact: q25 and q75 at the nearest
    rank, the median between the middle ranks.
    """
    measures = ["count", "mean", "std", "min", "max"]
    names = _names(columns, measures)
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        for measure, agg in zip(measures, [F.count, F.avg, F.stddev_samp, F.min, F.max]):
            aggs.append(agg(x).alias(names[c][measure]))
    simple = _unpivot(df.agg(*aggs), names)
    quartiles = exact_quantiles(df, columns).drop("n")
    return simple.join(quartiles, "column", "left")


def text_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and byte lengths (min, max, mean, total) of text columns."""
    measures = ["n_unique", "min_length", "max_length", "mean_length", "total_bytes"]
    names = _names(columns, measures)
    aggs = []
    for c in columns:
        size = F.octet_length(c)
        exprs = [F.count_distinct(_distinct_by(df, c)), F.min(size), F.max(size),
                 F.round(F.avg(size), 2), F.sum(size)]
        aggs += [e.alias(names[c][m]) for m, e in zip(measures, exprs)]
    return _unpivot(df.agg(*aggs), names)


def table_profile(df: DataFrame) -> DataFrame:
    """Profile of every column by its type: numeric measures, text measures, null share."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c, t in types.items() if isinstance(t, T.NumericType)]
    text = [c for c, t in types.items() if isinstance(t, T.StringType)]
    dtype = reduce(
        lambda acc, c: acc.when(F.col("column") == c, types[c].simpleString()),
        list(types)[1:], F.when(F.col("column") == list(types)[0],
                                types[list(types)[0]].simpleString()),
    )
    out = null_rates(df).withColumn("dtype", dtype)
    if numeric:
        out = out.join(F.broadcast(numeric_profile(df, numeric)), "column", "left")
    if text:
        out = out.join(F.broadcast(text_profile(df, text)), "column", "left")
    return out


def top_list_values(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per element of a list column, most frequent first; ``n`` keeps the top ones."""
    counts = df.select(F.explode(column).alias("value")).groupBy("value").agg(
        F.count("*").alias("count")
    )
    return counts if n is None else counts.orderBy(F.desc("count"), "value").limit(n)


def group_rates(df: DataFrame, flag: Column, group: str) -> DataFrame:
    """Share of flagged rows and row count per group."""
    return df.groupBy(F.col(group).cast("string").alias("group")).agg(
        F.avg(flag.cast("double")).alias("selection_rate"), F.count("*").alias("count")
    )


def rate_difference(rates: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Largest minus smallest group rate, and whether it exceeds the threshold."""
    difference = F.max("selection_rate") - F.min("selection_rate")
    return rates.agg(difference.alias("difference")).withColumn(
        "bias_detected", F.col("difference") > threshold
    )


def rows_of_top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """Rows whose value is one of the ``k`` most frequent ones."""
    top = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), column).limit(k).select(column)
    )
    return df.join(F.broadcast(top), column, "left_semi")
