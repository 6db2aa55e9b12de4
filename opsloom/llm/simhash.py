"""Near-duplicate groups by SimHash and multi-index hashing.

A fingerprint has 64 bits in two segments of 32. Two fingerprints at most two bits apart differ
in one segment by at most one bit, or have the other segment in common (pigeonhole). So a table
of segment values is probed with the ball of radius one around the first segment and with the
second segment as it is; matches are verified on the whole fingerprint. Of the two values
of a pair that differ in a bit only the one that has it set probes, so a pair is met once.

A segment value that many different fingerprints share would pair them all. Such crowded values
are left out of the tables, and the fingerprints that they concern are linked over the balls of
radius one around the whole fingerprint, segment by segment: two fingerprints are at most two
bits apart exactly if their balls meet, and a value lies in 65 balls at most, however many
documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import id_and_text, id_type, raw, slices, written
from opsloom.session import checkpoint_dir

BITS, SEGMENT = 64, 32
DISTANCE = 2
LOW = (1 << SEGMENT) - 1


def shingle_hashes(text: bytes, shingle: int, seed: int) -> list[int]:
    words = text.lower().split()    # of bytes: A-Z only, ASCII white space only
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(line, seed)]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[:len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], seed) for a, b in zip(begins, ends[shingle - 1:].tolist())]


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half of 64-bit hashes; of none, zero."""
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0]


def simhashes(texts: pa.Array, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """Signed 64-bit fingerprint of each text: bits set in over half of its shingle hashes."""
    offsets, data = raw(texts)
    content = data.tobytes()
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    for row in range(len(out)):
        hashes = shingle_hashes(content[offsets[row]:offsets[row + 1]], shingle, seed)
        if not hashes:
            continue
        out[row] = majority(np.array(hashes, dtype="<u8"))
    return out.view(np.int64)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """(id, fingerprint) of every document; no word at all gives 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = simhashes(part.column("text"), shingle, seed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(found)], names=["id", "fingerprint"]
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"id {id_type(docs, id_col)}, fingerprint long"
    )


def apart(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))


def ball(value: Column, bits: range) -> Column:
    """The values that differ from ``value`` in one of ``bits``."""
    masks = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in bits])
    return F.transform(masks, lambda mask: value.bitwiseXOR(mask))


def links(distinct: DataFrame, crowd: int = 64) -> DataFrame:
    """Pairs (left, right) that connect all fingerprints at most two bits apart.

    ``distinct`` has one column ``fingerprint`` without repeats. ``crowd`` is the number of
    different fingerprints beyond which a segment value is handled by whole balls.
    """
    fingerprint = F.col("fingerprint")
    high = F.shiftrightunsigned(fingerprint, SEGMENT)
    low = fingerprint.bitwiseAND(F.lit(LOW))
    entry = F.struct(F.lit(0).alias("segment"), high.alias("value")), F.struct(
        F.lit(1).alias("segment"), low.alias("value")
    )
    table = distinct.select("fingerprint", F.inline(F.array(*entry)))
    # only bits that are set are cleared: the other value of the pair has no need to probe
    cleared = F.filter(ball(high, range(SEGMENT)), lambda v: v < high)
    probes = distinct.select("fingerprint", F.inline(F.concat(
        F.array(*entry),
        F.transform(cleared, lambda v: F.struct(F.lit(0).alias("segment"), v.alias("value"))),
    )))
    key = ["segment", "value"]
    crowded = written(
        table.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > crowd).select(*key),
        "simhash-crowded",
    )
    probe = probes.join(crowded, key, "left_anti").select(F.col("fingerprint").alias("left"), *key)
    met = (
        probe.join(table.join(crowded, key, "left_anti"), key)
        .where((F.col("left") != fingerprint) & (apart(F.col("left"), fingerprint) <= DISTANCE))
        .select("left", fingerprint.alias("right"))
    )
    concerned = probes.join(crowded, key, "left_semi").select("fingerprint").distinct()
    centres = concerned.select(
        "fingerprint",
        F.explode(F.concat(F.array(fingerprint), ball(fingerprint, range(BITS)))).alias("centre"),
    )
    balls = centres.groupBy("centre").agg(F.collect_list("fingerprint").alias("near"))  # 65 at most
    stars = balls.where(F.size("near") > 1).select(
        F.array_min("near").alias("left"), F.explode("near").alias("right")
    ).where((F.col("left") != F.col("right")) & (apart(F.col("left"), F.col("right")) <= DISTANCE))
    return met.unionByName(stars).select(
        F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")
    ).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs``: the least node that can be reached.

    Each round every node takes the least root among its own and its neighbours', and then the
    root of that root; rounds end when no root changes. Rounds are cut by reliable checkpoints.
    """
    checkpoint_dir(pairs.sparkSession)
    both = pairs.unionByName(pairs.select(F.col("right").alias("left"), F.col("left").alias("right")))
    both = written(both, "simhash-links")
    roots = both.groupBy(F.col("left").alias("node")).agg(F.min("right").alias("near")).select(
        "node", F.least("node", "near").alias("root")
    ).checkpoint()
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("right"), "root"), "right")
            .groupBy(F.col("left").alias("node")).agg(F.min("root").alias("near"))
        )
        closer = roots.join(near, "node").select(
            "node", F.col("root").alias("before"), F.least("root", "near").alias("root")
        )
        far = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = closer.join(far, "root").select(
            "node", F.least("root", "next").alias("root"), "before"
        ).checkpoint()
        changed = after.where(F.col("root") != F.col("before")).limit(1).count()
        roots = after.select("node", "root")
        if not changed:
            return roots


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    seed: int = 42, crowd: int = 64,
) -> DataFrame:
    """One row per document: its fingerprint and the smallest id of its group.

    Words are what lies between ASCII white space, A-Z in lower case; a text of fewer words than
    a shingle counts whole. A null, empty or blank text has fingerprint 0, linked like any
    other. A null id keeps its row and counts in no minimum. Repeated rows give repeated rows;
    other columns are not read. Documents of one fingerprint are one node; the join back to the
    documents has one row a fingerprint on its other side, so that Spark can split a hot one.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fingerprints")
    distinct = written(
        prints.groupBy("fingerprint").agg(F.min("id").alias("first")), "simhash-distinct"
    )
    roots = components(links(distinct.select("fingerprint"), crowd))
    rooted = distinct.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
