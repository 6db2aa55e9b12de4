"""Exact selection by rank without sorting: radix histograms of order-preserving whole numbers.

A rank is looked up digit by digit. Each pass counts the next 16 bits of the keys that agree with
the digits found so far, summed up on the map side, and finds the digit in which the rank falls.
So a pass moves some thousand counts per group however many rows there are, and rows never move.
Once few rows are left below a prefix, their keys are counted whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.common import let
from opsloom.operators.ordering import with_row_index
from opsloom.session import saved

SHIFTS = (48, 32, 16, 0)
FEW = 1 << 16           # keys below one prefix that are counted whole, as many as a digit has values
LARGEST = (1 << 63) - 1


def order_image(value: Column) -> Column:
    """A double as a whole number of the same order: the bits of its absolute value, with its sign.

    Both zeros are 0, and a not-a-number is larger than all others.
    """
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double")).cast("long")
    return let(bits, lambda b: F.when(b < 0, -b.bitwiseAND(F.lit(LARGEST))).otherwise(b))


def double_of(image: Column) -> Column:
    """The double that ``order_image`` maps there."""
    double = F.reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), F.abs(image)).cast("double")
    return F.when(image < 0, -double).otherwise(double)


KEPT = 10_000


def small(df: DataFrame, name: str) -> tuple[DataFrame, list | None]:
    """A table of few rows with these rows, to be broadcast; one of more rows as a written table."""
    rows = df.limit(KEPT + 1).collect()
    if len(rows) <= KEPT:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows
    return saved(df, name), None


def named_group(group: Sequence[str]) -> Column:
    return F.to_json(F.struct(*group), {"ignoreNullFields": "false"}) if group else F.lit("")


def at_ranks(rows: DataFrame, group: Sequence[str], key: Column,
             ranks: Callable[[Column], Mapping[str, Column]], weight: Column | None = None) -> DataFrame:
    """The keys at given 0-based ranks of each group, smallest first.

    ``key`` is a long, ``ranks`` gives named ranks from the group's size; ``weight`` says for how
    many rows a row stands. Returns group columns, _group, name, n (the group's size), key, held (rows
    that have this key) and before (how many of them lie before the rank). ``rows`` is read
    two to four times; the tables in between have one row per group and name, and are kept on the
    driver up to 10,000 rows.
    """
    keyed = rows.select(
        *group, named_group(group).alias("_group"), key.alias("_key"),
        (F.lit(1).cast("long") if weight is None else weight).alias("_w"),
    )
    order = Window.partitionBy("_group").orderBy("_prefix")
    counted = keyed.groupBy(*group, "_group", F.shiftright("_key", SHIFTS[0]).alias("_prefix")).agg(
        F.sum("_w").alias("held"), F.count("*").alias("rows")
    ).withColumns({
        "before": F.sum("held").over(order) - F.col("held"), "n": F.sum("held").over(Window.partitionBy("_group")),
    })
    asked = F.array(*[
        F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank"))
        for name, rank in ranks(F.col("n")).items()
    ])
    inside = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("held"))
    cuts, known = small(
        counted.withColumn("asked", F.explode(asked)).where(inside(F.col("asked.rank"))).select(
            *group, "_group", "asked.name", "n", "_prefix", "held", "rows",
            (F.col("asked.rank") - F.col("before")).alias("before"),
        ), "ranks",
    )
    last = SHIFTS[0]
    for shift in SHIFTS[1:]:
        most = cuts.agg(F.max("rows")).first()[0] if known is None else max((r["rows"] for r in known), default=None)
        if most is None:
            break
        shift = 0 if most <= FEW else shift
        wanted = cuts.select("_group", "_prefix").distinct()
        wanted = F.broadcast(wanted) if known is not None else wanted
        here = keyed.withColumn("_prefix", F.shiftright("_key", last)).join(wanted, ["_group", "_prefix"])
        order = Window.partitionBy("_group", "_prefix").orderBy("_next")
        counted = here.groupBy("_group", "_prefix", F.shiftright("_key", shift).alias("_next")).agg(
            F.sum("_w").alias("_held"), F.count("*").alias("_rows")
        ).withColumn("_from", F.sum("_held").over(order) - F.col("_held"))
        cuts, known = small(
            counted.join(cuts, ["_group", "_prefix"]).where(
                (F.col("_from") <= F.col("before")) & (F.col("before") < F.col("_from") + F.col("_held"))
            ).select(
                *group, "_group", "name", "n", F.col("_next").alias("_prefix"), F.col("_held").alias("held"),
                F.col("_rows").alias("rows"), (F.col("before") - F.col("_from")).alias("before"),
            ), "ranks",
        )
        last = shift
        if not shift:
            break
    return cuts.withColumnRenamed("_prefix", "key").drop("rows")


QUARTILES = {"q25": (0.25, "nearest"), "median": (0.5, "linear"), "q75": (0.75, "nearest")}


def exact_quantiles(df: DataFrame, columns: Sequence[str],
                    quantiles: Mapping[str, tuple[float, str]] = QUARTILES,
                    by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact quantiles of numeric columns, per group: (by..., column, n, one per quantile).

    ``quantiles`` names (probability, method) pairs: ``nearest`` takes the value at the rounded
    rank (n - 1) * p, ``linear`` interpolates between its neighbours. Nulls are left out.
    ``weight`` names a column that says how many rows a row stands for. The input is read two to
    four times, by the columns named alone; write it first if they are costly.
    """
    long = df.select(
        *by, *([F.col(weight).alias("_weight")] if weight else []), F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
        ])).alias("_v"),
    ).where(F.col("_v.value").isNotNull()).select(
        *by, *(["_weight"] if weight else []), "_v.column", order_image(F.col("_v.value")).alias("_image")
    )

    def ranks(n: Column) -> dict[str, Column]:
        out = {}
        for name, (p, method) in quantiles.items():
            place = (n - 1) * F.lit(float(p))
            if method == "nearest":
                out[name] = F.floor(place + 0.5)
            else:
                out[f"{name}:low"], out[f"{name}:high"] = F.floor(place), F.ceil(place)
        return out

    found = at_ranks(long, [*by, "column"], F.col("_image"), ranks, F.col("_weight") if weight else None)
    value = lambda name: F.max(F.when(F.col("name") == name, F.col("_value")))
    picks = [F.max("n").alias("n")]
    for name, (p, method) in quantiles.items():
        if method == "nearest":
            picks.append(value(name).alias(name))
        else:
            place = (F.max("n") - 1) * F.lit(float(p))
            low, high = value(f"{name}:low"), value(f"{name}:high")
            picks.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.withColumn("_value", double_of(F.col("key"))).groupBy(*by, "column").agg(*picks)


def first_by_hash(df: DataFrame, order: str, group: Sequence[str],
                  wanted: Callable[[Column], Column]) -> DataFrame:
    """Add ``_first``, true for the first rows of each group by the hex digits in ``order``, and
    ``_n``, the group's size. ``wanted`` gives how many from that size (and the group's columns).

    A row is compared with its group's cut, a number of the first 60 bits; only rows that share
    the cut with others, of which some are in and some out, are ranked, by all digits and their
    content. No other row moves while the groups are few enough to be broadcast: 10,000, or as many as
    Spark takes by the size of the written cuts. The input is read four to six times.
    """
    key = F.conv(F.substring(order, 1, 15), 16, 10).cast("long")
    cuts, known = small(at_ranks(
        df, group, key, lambda n: {"cut": F.greatest(wanted(n) - 1, F.lit(0))}
    ).select(
        "_group", F.col("n").alias("_n"), F.col("key").alias("_cut"), "held",
        F.when(wanted(F.col("n")) > 0, F.col("before") + 1).otherwise(0).alias("take"),
    ), "cuts")
    shared = (F.col("take") > 0) & (F.col("take") < F.col("held"))
    marked = df.withColumns({"_group": named_group(group), "_key": key}).join(cuts, "_group")
    inside = (F.col("_key") < F.col("_cut")) | ((F.col("_key") == F.col("_cut")) & (F.col("take") == F.col("held")))
    named = [*df.columns, "_n"]
    if cuts.where(shared).isEmpty() if known is None else not any(0 < r["take"] < r["held"] for r in known):
        return marked.select(*named, inside.alias("_first"))
    edge = shared & (F.col("_key") == F.col("_cut"))
    apart = marked.where(edge).withColumnRenamed("_group", "_of").withColumn("_content", F.xxhash64(*df.columns))
    ranked = with_row_index(apart, [order, "_content"], ["_of"], "_rank")
    return marked.where(~edge).select(*named, inside.alias("_first")).unionByName(
        ranked.select(*named, (F.col("_rank") < F.col("take")).alias("_first"))
    )
