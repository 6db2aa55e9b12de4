"""Positions in a globally ordered table, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.session import checkpointed

POSITION_MASK = (1 << 33) - 1


def _placed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``keys``; note each row's partition and place in it.

    Rows with equal keys are told apart by a content hash and, for true copies, by the input
    partition they came from, so a hot key or a large group of copies is spread over many
    partitions. All three are the same on a retry. The result is checkpointed because the
    sampled range bounds must not be drawn again by a second use.
    """
    tie = [c for c in df.columns if c not in keys]
    sort_keys = [*[F.col(k) for k in keys], F.col("_tie"), F.col("_src")]
    placed = (
        df.withColumn("_tie", F.xxhash64(*tie) if tie else F.lit(0))
        .withColumn("_src", F.spark_partition_id())
        .repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .drop("_tie", "_src")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK)))
    )
    return checkpointed(placed)


def _with_offset(placed: DataFrame, amount) -> DataFrame:
    """Add ``_offset``: the total of ``amount`` over all earlier partitions.

    The totals table has one row per range partition, so its running sum and its broadcast
    are bounded by the partition count, not by the data.
    """
    totals = placed.groupBy("_part").agg(F.sum(amount).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    return placed.join(F.broadcast(offsets), "_part")


def with_row_index(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
                   name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the global order, or within its group.

    ``order_by`` are ascending column names. A group of any size is counted across many
    tasks: a row's place is its place in its partition plus the group's rows in earlier ones.
    """
    placed = _placed(df, [*partition_by, *order_by])
    if not partition_by:
        indexed = _with_offset(placed, F.lit(1)).withColumn(name, F.col("_offset") + F.col("_pos"))
        return indexed.select(*df.columns, name)
    indexed = _with_group_offset(placed, partition_by, F.lit(1)).withColumn(
        name, F.col("_before") + F.col("_pos") - F.col("_from")
    )
    return indexed.select(*df.columns, name)


def _with_group_offset(placed: DataFrame, group: Sequence[str], amount: Column) -> DataFrame:
    """Add per (partition, group): ``_before``, the group's total of ``amount`` in earlier
    partitions, ``_all``, its total, and ``_from``, the place of its first row in the partition.

    The order is by group first, so there are at most as many (partition, group) pairs as
    partitions and groups together; a group over many partitions is joined partition by
    partition.
    """
    named = F.to_json(F.struct(*group), {"ignoreNullFields": "false"})
    keyed = placed.withColumn("_group", named)
    totals = keyed.groupBy("_part", "_group").agg(
        F.sum(amount).alias("_total"), F.min("_pos").alias("_from")
    )
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        "_part", "_group", "_from",
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_total").over(Window.partitionBy("_group")).alias("_all"),
    )
    return keyed.join(offsets, ["_part", "_group"])
