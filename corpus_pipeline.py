"""A corpus pipeline over documents; each stage's result is written and read before the next.

Toxic documents go, one document of each group of near copies stays, passages that stand earlier
are cut, secrets are masked, and what is left is packed into sequences. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm import near_copies, packing, passages, queries, secrets, toxicity
from opsloom.llm.common import written

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; those without a text (null, empty or blank) stay."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    columns = docs.columns
    scored = docs.select(
        F.struct(*[F.col(c) for c in columns]).alias("row"),
        toxicity.toxicity_score(F.col("text"), model).alias("score"),
    )
    without = F.coalesce(F.col("row.text"), F.lit("")).rlike(r"^\s*$")
    return scored.where(without | (F.col("score") < TOXIC)).select(*[F.col("row")[c].alias(c) for c in columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group, once; documents without an id stay.

    Near copies share 0.8 of their five-word shingles. The thin op5 query has a contract of its own.
    Rows that share an id but not a text are documents of their own; of rows that share both, and of
    texts that share the smallest id in a group, the least in a fixed order stays.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    kept = near_copies.near_copies(known).groupBy("group").agg(
        F.min(F.struct("doc_id", "digest")).alias("least")
    ).select("least.doc_id", "least.digest")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    named = known.withColumn("digest", digest).join(kept, ["doc_id", "digest"], "left_semi")
    once = named.groupBy("doc_id", "digest").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return once.select(*[F.col("row")[c].alias(c) for c in docs.columns]).unionByName(
        docs.where(F.col("doc_id").isNull())
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier; characters cut in two go with them."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    left = passages.remove_repeats(docs, carry=(*others, "n_chars"), as_text=True)
    cut = left.withColumnRenamed("kept", "text").withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    )
    return cut.select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret masked, also those wrapped in other layers."""
    masked = docs.withColumn("masked", secrets.mask_secrets(F.col("text")))
    changed = ~F.col("masked").eqNullSafe(F.col("text"))
    return masked.withColumn(
        "n_chars", F.when(changed, F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    ).withColumn("text", F.col("masked")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "padded",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
