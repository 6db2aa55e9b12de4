"""Tables and awkward rows that the tests of the training-data operators share."""

from __future__ import annotations

import random

SMALL = "/root/testdata/sf0.001"

ALPHABET = (
    list("abest rvelmd''  \n\t!?.12  éü世　\U0001f600́²ª_<|>%#")
    + ["'s", "'re", "'LL", "ing", "the", "aaaa", "----", "    ", "<|endoftext|>", "\x00", "\x1c", "\xa0", "▁"]
)


def noise(count: int, seed: int = 1, most: int = 60) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, most))) for _ in range(count)]


def awkward() -> list[str | None]:
    """Null, empty, blank, very long and repeated texts."""
    return [None, "", " ", "\n\n", "x", "x", "word " * 30_000, "a" * 20_000, "é" * 3000, *noise(120)]


def documents(spark, texts, partitions: int = 3):
    """Documents with clashing and nested extra columns and a null id at the end."""
    rows = [(i, t, i, "id", [1], "n") for i, t in enumerate(texts)] + [(None, "no id", 0, "x", None, "y")]
    schema = "doc_id long, text string, id long, fingerprint string, spans array<int>, gram string"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def by_id(frame) -> dict:
    return {r["doc_id"]: r for r in frame.collect()}
