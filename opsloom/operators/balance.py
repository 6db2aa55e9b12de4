"""Sampling, balancing, splitting and weighting. All draws are repeatable hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.common import col, shuffle_key, uniform
from opsloom.functions.corpus import sampling_weight
from opsloom.operators.selection import first_by_hash

NO_CLASS = "\0"      # stands for null, which is no map key


def balance_classes(df: DataFrame, key: Column | str, label: str = "label",
                    normal: int = 0, failures: Sequence[int] = (1, 2, 3, 4),
                    normal_ratio: int = 3, seed: int = 42) -> DataFrame:
    """Even out classes: failures are repeated up to the largest failure class, and the normal
    class is cut to ``normal_ratio`` times that size.

    Sizes are exact. Which rows stay (or repeat once more) is decided by the hash of ``key``
    and the seed, so the result does not depend on partitioning. Labels outside the named
    classes, and all rows if there is no failure, pass once. ``copy`` numbers the repetitions of a
    row from 0. The input is read several times, for its labels and keys and once whole; write it
    first if it is costly. Rows do not move.
    """
    keyed = df.withColumn("_order", shuffle_key(col(key), seed))
    failed = F.col(label).isin(list(failures))
    largest = df.where(failed).groupBy(label).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0]

    def target(n: Column) -> Column:
        if largest is None:
            return n
        return F.when(F.col(label) == normal, F.least(n, F.lit(largest * normal_ratio))).when(
            failed, F.lit(largest)
        ).otherwise(n)

    marked = first_by_hash(keyed, "_order", [label], lambda n: target(n) % n)
    copies = F.floor(target(F.col("_n")) / F.col("_n")) + F.col("_first").cast("long")
    return repeat_rows(marked.withColumn("_copies", copies), "_copies").select(*df.columns, "copy")


def repeat_rows(df: DataFrame, copies: str, block: int = 65536) -> DataFrame:
    """Each row as often as its ``copies`` column says, numbered from 0 in ``copy``.

    Two nested explodes keep every generated list short, however often one row repeats.
    """
    count = F.col(copies)
    blocks = df.filter(count > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((count - 1) / block)))
    )
    in_block = F.least(F.lit(block).cast("bigint"), count - F.col("_block") * block)
    return blocks.withColumn(
        "_in", F.explode(F.sequence(F.lit(0).cast("bigint"), in_block - 1))
    ).withColumn("copy", F.col("_block") * block + F.col("_in")).drop("_block", "_in")


def train_test_split(df: DataFrame, key: str, test_ratio: float = 0.2, seed: int = 42,
                     stratify_by: Sequence[str] = ()) -> DataFrame:
    """Mark rows ``train`` or ``test`` in a shuffled order, cut at an exact row count.

    The first int(n * (1 - test_ratio)) rows of the shuffle are the training rows; with
    ``stratify_by`` the cut is made inside each stratum.
    """
    keyed = df.withColumn("_order", shuffle_key(F.col(key), seed))
    marked = first_by_hash(
        keyed, "_order", stratify_by, lambda n: F.floor(n * F.lit(1 - test_ratio))
    )
    return marked.select(*df.columns, F.when(F.col("_first"), "train").otherwise("test").alias("split"))


def oversample_slices(df: DataFrame, suggestions: DataFrame, key: str,
                      max_slices: int | None = None, small: int = 30, cap: int | None = None
                      ) -> DataFrame:
    """Repeat the rows of small, high-priority slices that need more data.

    ``suggestions`` has columns slice, strategy, priority. Slices named tag_*, error_*
    or infra_* are looked at (the first ``max_slices`` by name, if given); one with fewer than
    ``small`` rows gains 2n extra rows (at most ``cap``, if given), spread evenly over its rows.
    """
    chosen = (
        suggestions.filter((F.col("strategy") == "data_augmentation")
                           & (F.col("priority") == "high"))
        .select("slice").distinct()
    )
    if max_slices is not None:
        chosen = chosen.orderBy("slice").limit(max_slices)
    names = F.array_union(
        F.array_union(
            F.transform(F.col("tags"), lambda x: F.concat(F.lit("tag_"), x)),
            F.transform(F.col("error_signatures"), lambda x: F.concat(F.lit("error_"), x)),
        ),
        F.transform(F.col("infra_components"), lambda x: F.concat(F.lit("infra_"), x)),
    )
    members = df.withColumn("slice", F.explode(names)).join(chosen, "slice")
    sizes = members.groupBy("slice").agg(F.count("*").alias("_n")).filter(F.col("_n") < small)
    # every slice left here has fewer than `small` rows, so ranking inside it is cheap
    extra = F.col("_n") * 2 if cap is None else F.least(F.col("_n") * 2, F.lit(cap))
    rank = F.row_number().over(Window.partitionBy("slice").orderBy(key)) - 1
    copies = F.floor(extra / F.col("_n")) + F.when(rank < extra % F.col("_n"), 1).otherwise(0)
    added = members.join(sizes, "slice").withColumn("_copies", copies)
    return df.unionByName(repeat_rows(added, "_copies").select(*df.columns))


def quality_weights(df: DataFrame, score: str = "quality_score") -> DataFrame:
    """Weight 0.5 to 1.5 by the score's place between its minimum and maximum."""
    ends = df.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi"))).scalar()
    low, high = F.col("_ends.lo"), F.col("_ends.hi")
    weight = F.when(high > low, 0.5 + (F.col(score) - low) / (high - low)).otherwise(1.0)
    return df.withColumn("_ends", ends).withColumn("sample_weight", weight).drop("_ends")


def keep_ratios(df: DataFrame, column: str, max_percent: float = 40.0) -> DataFrame:
    """Per class: count, share, the ratio of rows to keep and the sampling weight."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    # one row per class by now, so the total is taken in one place
    everything = Window.partitionBy(F.lit(0))
    percent = F.col("_percent")
    return counts.withColumn(
        "_percent", F.col("count") / F.sum("count").over(everything) * 100
    ).select(
        column, "count", percent.alias("pct"),
        F.when(percent > max_percent, F.lit(max_percent) / percent).otherwise(1.0)
        .alias("keep_ratio"),
        sampling_weight(percent, max_percent).alias("sampling_weight"),
    )


def cap_class_share(df: DataFrame, column: str, key: str, max_percent: float = 40.0,
                    seed: int = 42) -> DataFrame:
    """Thin out classes above ``max_percent`` of the rows and add the sampling weight.

    A row stays if its repeatable draw does not exceed its class's keep ratio. The classes enter
    as one literal map, so rows are not shuffled; ``column`` is meant to have few values.
    """
    ratios = keep_ratios(df, column, max_percent)
    named = F.coalesce(F.col(column).cast("string"), F.lit(NO_CLASS))
    entry = F.struct(named, F.struct("keep_ratio", "sampling_weight"))
    known = ratios.agg(F.map_from_entries(F.collect_list(entry))).scalar()
    found = df.withColumn("_known", F.element_at(known, named))
    kept = found.filter(uniform(F.col(key), seed) <= F.col("_known.keep_ratio"))
    return kept.select(*df.columns, F.col("_known.sampling_weight").alias("sampling_weight"))
