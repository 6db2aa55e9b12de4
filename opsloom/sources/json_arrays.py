"""JSON arrays read in splits: one huge document is worked on by many tasks.

Spark's text reader splits files at any one-character separator, so the document is read as pieces
that end at a closing brace. What a piece means depends on all before it: whether it begins inside
a string and how many objects are open. Both are prefix sums. Each split is summed up for either
way it can begin (a few rows), the summaries are added along each file, and every piece then knows
which record it belongs to. No file is read by one task, and records may cross splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CLOSE = "}"
SPLIT = ["file", "block"]
# what may stand before a record: brackets, commas, and elements that are no objects
BEFORE = r'(?s)^(?:[^{"]++|"(?:[^"\\]++|\\.)*+")*+'


def _braces_outside(text: Column) -> Column:
    """Opening braces outside strings; an unclosed string runs to the end."""
    outside = F.regexp_replace(text, r'"[^"]*+(?:"|$)', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, value, quotes, opens0, opens1) of every piece, in order of the text.

    ``opens0`` counts braces if the piece begins outside a string, ``opens1`` if inside one.
    """
    plain = F.regexp_replace("value", r"(?s)\\.", "")       # no escapes, so each quote counts
    return spark.read.option("lineSep", CLOSE).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value",
        (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).alias("quotes"),
        _braces_outside(plain).alias("opens0"),
        _braces_outside(F.concat(F.lit('"'), plain)).alias("opens1"),
    )


def _inside(begin: Column | int) -> Column:
    """0 or 1: whether a piece begins inside a string, if its split begins like ``begin``."""
    order = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (begin + F.coalesce(F.sum("quotes").over(order), F.lit(0))) % 2


def _step(inside: Column) -> tuple[Column, Column]:
    """Braces a piece opens, and 1 if the brace at its end closes an object."""
    return (
        F.when(inside == 0, F.col("opens0")).otherwise(F.col("opens1")),
        F.when((inside + F.col("quotes")) % 2 == 0, 1).otherwise(0),
    )


def _starts(pieces: DataFrame) -> DataFrame:
    """(file, block, inside, depth, records): the state at the beginning of each split."""
    order = Window.partitionBy(*SPLIT, "begin").orderBy("place")
    both = pieces.select(*SPLIT, "place", "quotes", "opens0", "opens1", _inside(F.lit(0)).alias("even"))
    states = both.select(
        *SPLIT, "place", "quotes", "opens0", "opens1",
        F.explode(F.array(F.struct(F.lit(0).alias("begin"), F.col("even").alias("inside")),
                          F.struct(F.lit(1).alias("begin"), (1 - F.col("even")).alias("inside")))).alias("s"),
    ).select(*SPLIT, "place", "quotes", "opens0", "opens1", "s.begin", "s.inside")
    opens, closes = _step(F.col("inside"))
    levels = states.withColumn("opens", opens).withColumn("closes", closes).withColumn(
        "level", F.sum(F.col("opens") - F.col("closes")).over(order)
    ).groupBy(*SPLIT, "begin", "level").agg(
        F.sum("quotes").alias("quotes"), F.sum(F.col("opens") - F.col("closes")).alias("delta"),
        F.sum("closes").alias("closes"),
    )
    # a level is how deep a piece ends, as seen from the split's beginning: few distinct ones
    splits = levels.groupBy(*SPLIT, "begin").agg(
        F.sum("quotes").alias("quotes"), F.sum("delta").alias("delta"),
        F.map_from_entries(F.collect_list(F.struct("level", "closes"))).alias("ends"),
    ).groupBy(*SPLIT).agg(
        F.max(F.when(F.col("begin") == 0, F.col("quotes"))).alias("quotes"),
        *[F.max(F.when(F.col("begin") == b, F.col("delta"))).alias(f"delta{b}") for b in (0, 1)],
        *[F.max_by(F.col("ends"), F.when(F.col("begin") == b, 1)).alias(f"ends{b}") for b in (0, 1)],
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def sum_before(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    known = splits.withColumn("inside", sum_before(F.col("quotes")) % 2)
    outside = F.col("inside") == 0
    known = known.withColumn("depth", sum_before(F.when(outside, F.col("delta0")).otherwise(F.col("delta1"))))
    ends = F.when(outside, F.col("ends0")).otherwise(F.col("ends1"))
    known = known.withColumn("finished", F.coalesce(F.try_element_at(ends, -F.col("depth")), F.lit(0)))
    return known.select(*SPLIT, "inside", "depth", sum_before(F.col("finished")).alias("records"))


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): every object of JSON documents that hold an array of objects, or one.

    ``record`` counts from 0 in each file. Array elements that are no objects are left out. In a file that
    is cut off the end counts as one closing brace; an object still open then is left out. The text is
    as it stands in the file.
    """
    pieces = _pieces(spark, path)
    starts = _starts(pieces).select(
        *SPLIT, F.col("inside").alias("begin"), F.col("depth").alias("begin_depth"), "records"
    )
    order = Window.partitionBy(*SPLIT).orderBy("place")
    placed = pieces.withColumn("even", _inside(F.lit(0))).join(starts, SPLIT)
    inside = (F.col("begin") + F.col("even")) % 2
    opens, closes = _step(inside)
    levels = placed.withColumn("closes", closes).withColumn(
        "depth", F.col("begin_depth") + F.sum(opens - closes).over(order)
    )
    ended = (F.col("depth") == 0) & (F.col("closes") == 1)
    numbered = levels.withColumn("ended", ended).withColumn(
        "record", F.col("records") + F.coalesce(
            F.sum(F.col("ended").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
    )
    whole = F.transform(F.sort_array("pieces"), lambda p: p["value"])
    return numbered.groupBy("file", "record").agg(
        F.collect_list(F.struct("block", "place", "value")).alias("pieces"), F.max("ended").alias("complete")
    ).where("complete").select(
        "file", "record",
        F.concat(F.regexp_replace(F.array_join(whole, CLOSE), BEFORE, ""), F.lit(CLOSE)).alias("text"),
    )


def read_json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Like ``read_json_document``, but a document is read by as many tasks as it has splits.

    ``spark.sql.files.maxPartitionBytes`` sets their size. A record that is no valid JSON gives a
    row of nulls.
    """
    ddl = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return array_records(spark, path).select(F.from_json("text", ddl).alias("row")).select("row.*")
