"""Toxicity scores from a classifier regularised by counterfactual sentences.

A linear model over words and word beginnings is fitted to labelled texts. Every labelled sentence
that names a group of people has a counterfactual, the same sentence with the group terms swapped
for terms of another group, and the loss has a penalty on the squared change of the score. So
the weight of a group term can't stand for the company that it kept in the labelled texts, and
neutral mentions of a group don't raise a score.

The labelled sample that the fit reads is bounded by a parameter; everything after it, and every
score, covers all rows and whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import released, releasing, slices, strings, text_slices

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")
PREFIXES = (4, 5)
REMEMBERED = 200_000

# Terms that name groups of people, by kind; a counterfactual swaps terms within a kind.
GROUP_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("black", "white", "asian", "latino"),
    ("immigrants", "natives", "refugees", "citizens"), ("old", "young"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "citoyens"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einwohner"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "ciudadanos"),
)


def swapped_terms(kinds: Iterable[tuple[str, ...]]) -> dict[str, str]:
    """Each term with the term of its kind that takes its place."""
    return {term: kind[(i + 1) % len(kind)] for kind in kinds for i, term in enumerate(kind)}


def features_of(word: str) -> list[int]:
    """Numbers of a word and of its beginnings."""
    beginnings = [f"{word[:n]}*" for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(f.encode()) for f in [word, *beginnings]]


def text_features(words: Iterable[str]) -> set[int]:
    return {f for word in set(words) for f in features_of(word)}


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature number; small, so it travels with the tasks."""

    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, words: Iterable[str], memory: dict[str, tuple]) -> float:
        words = list(set(words))
        known = list(map(memory.get, words))
        if None in known:
            if len(memory) >= REMEMBERED:
                memory.clear()
            for i, have in enumerate(known):
                if have is None:
                    found = tuple(f for f in features_of(words[i]) if f in self.weights)
                    known[i] = memory[words[i]] = found
        met = {f for have in known if have for f in have}
        total = self.bias + sum(self.weights[f] for f in sorted(met))
        return float(sigmoid(total))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Sparse:
    """Rows of 0/1 features, for products with a weight vector and back."""

    def __init__(self, bags: list[np.ndarray], names: np.ndarray):
        flat = np.concatenate(bags) if bags else np.zeros(0, dtype=np.uint32)
        row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        at = np.minimum(np.searchsorted(names, flat), max(len(names) - 1, 0))
        known = names[at] == flat if len(names) else np.zeros(len(flat), dtype=bool)
        self.row, self.column = row[known], at[known]
        self.height, self.width = len(bags), len(names)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.column], minlength=self.height)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=values[self.row], minlength=self.width)


def bag(text: str) -> np.ndarray:
    return np.array(sorted(text_features(WORD.findall(text.lower()))), dtype=np.uint32)


def counterfactuals(text: str, swaps: dict[str, str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of each sentence that has a group term, as it is and with its terms swapped."""
    text = text.lower()
    if swaps.keys().isdisjoint(WORD.findall(text)):
        return []
    out = []
    for sentence in SENTENCE.split(text):
        words = WORD.findall(sentence)
        if not swaps.keys().isdisjoint(words):
            out.append((bag(sentence), bag(" ".join(swaps.get(w, w) for w in words))))
    return out


def fit(
    bags: list[np.ndarray], toxic: list[int], pairs: list[tuple[np.ndarray, np.ndarray]],
    penalty: float = 1.0, chosen: int = 4096, rounds: int = 300, l2: float = 1e-4,
) -> ToxicityModel:
    """Fit the classifier to the features of labelled texts and of counterfactual sentences.

    ``chosen`` features that differ most between the classes are kept. ``penalty`` weighs the mean
    squared change of the logit between a labelled sentence and its counterfactual. Without texts
    of both classes the model is the smoothed rate alone.
    """
    labels = np.array(toxic, dtype=np.float64)
    rate = (labels.sum() + 0.1) / (len(labels) + 1)
    bias = float(np.log(rate / (1 - rate)))
    if not 0 < labels.sum() < len(labels):
        return ToxicityModel(bias)
    flat = np.concatenate(bags)
    owner = np.repeat(labels, [len(b) for b in bags])
    names, number = np.unique(flat, return_inverse=True)
    seen = np.bincount(number).astype(np.float64)
    seen_toxic = np.bincount(number, weights=owner)
    share = labels.mean()
    # deviation of the class share among the texts that have the feature, in standard errors
    lean = (seen_toxic - share * seen) / np.sqrt(seen * share * (1 - share))
    lean[seen < 3] = 0
    kept = np.sort(np.argsort(-np.abs(lean), kind="stable")[:chosen])
    kept = kept[np.abs(lean[kept]) > 3]
    rows = Sparse(bags, names[kept])
    first, second = (Sparse([p[side] for p in pairs], names[kept]) for side in (0, 1))
    weights, moved, moved_bias = np.zeros(len(kept)), np.zeros(len(kept)), 0.0
    for _ in range(rounds):
        error = sigmoid(rows.times(weights) + bias) - labels
        slope = rows.back(error) / len(labels) + l2 * weights
        if pairs:
            change = first.times(weights) - second.times(weights)
            slope += 2 * penalty * (first.back(change) - second.back(change)) / len(pairs)
        moved += slope**2
        moved_bias += error.mean() ** 2
        weights -= 0.5 * slope / np.sqrt(moved + 1e-12)
        bias -= 0.5 * error.mean() / np.sqrt(moved_bias + 1e-12)
    return ToxicityModel(
        float(bias), {int(names[k]): float(w) for k, w in zip(kept, weights) if abs(w) > 1e-3}
    )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = 8000, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
    kinds: Iterable[tuple[str, ...]] = GROUP_TERMS, penalty: float = 1.0,
) -> ToxicityModel:
    """Fit on a bounded sample: the ``sample`` labelled rows whose ids hash lowest.

    The sample's ids are broadcast to find its texts, so documents are not shuffled, and only
    feature numbers come to the driver. Rows without a label or a text and ids without a
    document take no part; of rows that repeat an id one is used.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    swaps = swapped_terms(kinds)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = strings(part.column("text"))
                pairs = [counterfactuals(text, swaps) for text in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("label"),
                    pa.array([bag(text).tobytes() for text in texts], pa.binary()),
                    *[pa.array([[p[side].tobytes() for p in some] for some in pairs], pa.list_(pa.binary()))
                      for side in (0, 1)],
                ], names=["id", "label", "bag", "before", "after"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = (
        texts.join(F.broadcast(chosen), "id").where(F.col("text").isNotNull())
        .groupBy("id", "label")
        .agg(F.min(F.struct(F.xxhash64("text").alias("order"), "text")).getField("text").alias("text"))
        .select(F.col("id").cast("string").alias("id"), "label", "text")
        .mapInArrow(releasing(features), "id string, label int, bag binary, before array<binary>, after array<binary>")
        .toPandas().sort_values("id")
    )
    read = lambda content: np.frombuffer(content, dtype=np.uint32)
    pairs = [
        (read(a), read(b)) for row in rows.itertuples() for a, b in zip(row.before, row.after)
    ]
    return fit([read(b) for b in rows["bag"]], rows["label"].tolist(), pairs, penalty)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score in [0, 1] of whole texts; a null or empty text has the score of the bias alone."""
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory: dict[str, tuple] = {}
        for part in text_slices(batches):
            yield pa.array([model.score(WORD.findall(t.lower()), memory) for t in strings(part)], pa.float64())

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from scores(batches)
        released()

    return score(text)


def held_out(name: Column) -> Column:
    """Rows that no fit may see: CRC32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(name.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: held_out, score, and predicted (1 from ``threshold`` on).

    Repeated rows give repeated rows; other columns are not read.
    """
    scored = docs.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"),
        toxicity_score(F.col(text_col), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
