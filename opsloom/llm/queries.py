"""The training-data operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm import (
    best_fit, hard_negatives, licenses, line_quality, neighbours, packing, passages, pieces, prefix_trie, secrets,
    simhash, token_counts, toxicity,
)
from opsloom.llm.common import written

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0
    )


@query
def op2_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    shown = F.transform("notices", lambda n: F.concat_ws(
        ":", n["name"], F.round(n["coverage"], 4), n["start"], n["end"]
    ))
    return found.select("doc_id", "n_notices", F.array_join(shown, ",").alias("notices"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Fitted on labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.fit_toxicity(docs, labels)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query
def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "padded",
    )


@query
def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.clean_lines(table(spark, sf_dir, "documents")).drop("cleaned")


@query
def op9_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long")
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(shown("plain").cast("binary"), 256).alias("base_sha256"),
        shown("spans").alias("spans"),
    )


@query
def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    )
    return hard_negatives.hard_negatives(vectors, vec_id % 50 == 0)


@query
def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit.best_fit_packing(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation begins with up to eight turns of the first of its five."""
    turns = written(prefix_trie.numbered_turns(table(spark, sf_dir, "conversations")), "numbered-turns")
    conv = F.col("conv")
    heads = F.crc32(conv.cast("string").cast("binary")) % 9
    rebuilt = prefix_trie.with_lent_heads(turns, conv - conv % 5, heads, most=8)
    return prefix_trie.prefix_trie(rebuilt, turns.select("conv"))
