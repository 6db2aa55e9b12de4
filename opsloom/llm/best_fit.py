"""Best-fit packing by minimum bin slack: as few sequences as possible, documents cut only if too long.

Pass one encodes each partition and notes each piece's place among the pieces of its length in the
partition. How many pieces there are of each length, at most one number per length, decides the
packing: for each sequence a subset-sum over a bit set of the lengths that are left finds the
fullest combination, which is then removed, as often as its lengths last; a second plan gives each sequence
the largest length left and is taken if it needs fewer sequences. The counts of the
partitions give every piece its place among all pieces of its length, and so its sequence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm.common import id_and_text, id_type, released, slices, strings, written
from opsloom.llm.packing import WordIds

FULL_ROWS = 64          # whole windows of one document in one stored row at most
RANKS = 44              # bits of a place among the pieces of one length


def fullest(left: Mapping[int, int], window: int) -> list[tuple[int, int]]:
    """The (length, copies) that fill a window best, out of ``left``, a count for each length."""
    whole = (1 << (window + 1)) - 1
    reached, stages = 1, []
    for length in sorted(left, reverse=True):
        copies, step = min(left[length], window // length), 1
        while copies > 0:
            step = min(step, copies)
            after = (reached | reached << (length * step)) & whole
            if after != reached:
                stages.append((length, step, reached))
                reached = after
                if reached >> window:
                    copies = 0
            copies -= step
            step *= 2
        if reached >> window:
            break
    fill, taken = reached.bit_length() - 1, {}
    for length, step, before in reversed(stages):
        if not before >> fill & 1:
            taken[length] = taken.get(length, 0) + step
            fill -= length * step
    return sorted(taken.items(), reverse=True)


def with_largest(left: Mapping[int, int], window: int) -> list[tuple[int, int]]:
    """The same of the combinations that hold the largest length left."""
    largest = max(left)
    others = {n: c - (n == largest) for n, c in left.items() if n <= window - largest and c > (n == largest)}
    taken = dict(fullest(others, window - largest))
    taken[largest] = taken.get(largest, 0) + 1
    return sorted(taken.items(), reverse=True)


Plan = list[tuple[int, list[tuple[int, int]]]]


def plan(counts: Mapping[int, int], window: int, choose: Callable = fullest) -> Plan:
    """(repeats, combination) of all sequences: each the fullest of what the earlier ones leave.

    A combination stays the fullest while its lengths last, so it is repeated as often as they do.
    """
    left, out = {n: c for n, c in counts.items() if c}, []
    while left:
        taken = choose(left, window)
        repeats = min(left[length] // copies for length, copies in taken)
        out.append((repeats, taken))
        for length, copies in taken:
            left[length] -= copies * repeats
            if not left[length]:
                del left[length]
    return out


def fewest(counts: Mapping[int, int], window: int) -> Plan:
    """The plan of the fullest combinations, or with the largest length in each if that takes fewer
    sequences: the fullest alone can leave large pieces that nothing small is left for."""
    return min((plan(counts, window, c) for c in (fullest, with_largest)), key=lambda p: sum(r for r, _ in p))


@dataclass(frozen=True)
class Slots:
    """For each length the runs of places that go to one repeated combination, in order."""

    keys: np.ndarray        # length and first place
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    @staticmethod
    def of(planned: Plan) -> Slots:
        used: dict[int, int] = {}
        runs, sequence = [], 0
        for repeats, taken in planned:
            offset = 0
            for length, copies in taken:
                runs.append(((length << RANKS) + used.get(length, 0), copies, sequence, offset))
                used[length] = used.get(length, 0) + copies * repeats
                offset += length * copies
            sequence += repeats
        columns = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4).T
        return Slots(*columns, sequence)

    def find(self, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.keys, (length << RANKS) + place, side="right") - 1
        repeat, copy = np.divmod(place - (self.keys[run] & ((1 << RANKS) - 1)), self.copies[run])
        return self.sequence[run] + repeat, self.offset[run] + copy * length


_WORDS: dict[tuple[int, int], WordIds] = {}


def encoded(
    docs: DataFrame, vocabulary: str, window: int, end_id: int, id_col: str, text_col: str, remembered: int
) -> DataFrame:
    """Pass one: whole windows of long documents, and what is left of each document.

    ``place`` is a row's place in its partition: of whole windows among all of these, of the rest
    among those of its length.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    end = np.array([end_id], dtype="<u4").tobytes()
    most = FULL_ROWS * window
    names = ["id", "part", "place", "start", "length", "ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(content.value), remembered
        if key not in _WORDS:
            _WORDS.clear()
            _WORDS[key] = WordIds(content.value, remembered)
        part, windows, places = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for piece in slices(batch, "text"):
                rows = []
                for name, ids in zip(piece.column("id"), _WORDS[key].encode(strings(piece.column("text")))):
                    ids += end
                    total = len(ids) // 4
                    whole = total - total % window
                    for start in range(0, whole, most):
                        upto = min(start + most, whole)
                        rows.append((name, part, windows, start, upto - start, ids[4 * start:4 * upto]))
                        windows += (upto - start) // window
                    if whole < total:
                        rest = total - whole
                        place = places.get(rest, 0)
                        rows.append((name, part, place, whole, rest, ids[4 * whole:]))
                        places[rest] = place + 1
                columns = list(zip(*rows))
                kinds = [piece.column("id").type, pa.int32(), *[pa.int64()] * 3, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        released()

    kind = id_type(docs, id_col)
    return id_and_text(docs, id_col, text_col).mapInArrow(
        encode, f"id {kind}, part int, place long, start long, length long, ids binary"
    )


def best_fit_packing(
    docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 1, id_col: str = "doc_id",
    text_col: str = "text", remembered: int = 400_000,
) -> DataFrame:
    """One row per piece: its document, number and place there, sequence, offset there and ids.

    Every document ends with ``end_id``, so a null or empty text is one id. Documents beyond the
    window are cut into windows, each a sequence of its own, and a rest; all others stay whole.
    Repeated rows are packed as often as they occur, also rows without an id; other columns are not
    read. An empty table gives no rows. The ids are 32-bit little-endian. Only the number of pieces
    of each length, ``window`` numbers at most, comes to the driver.
    """
    spark = docs.sparkSession
    rows = written(encoded(docs, vocabulary, window, end_id, id_col, text_col, remembered), "fitted-ids")
    rest = rows.where(F.col("length") < window)
    counts = rest.groupBy("part", "length").agg(F.count("*").alias("pieces"))
    totals = counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    slots = Slots.of(fewest({r["length"]: r["pieces"] for r in totals}, window))
    shared = spark.sparkContext.broadcast(slots)

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, place: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.find(length.to_numpy(np.int64), place.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    # one row a partition for each length
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("base"))
    fitted = rest.join(bases, ["part", "length"]).withColumn(
        "slot", slot(F.col("length"), F.col("base") + F.col("place"))
    ).select("id", "start", "length", "slot.sequence_id", "slot.offset", "ids")

    full = rows.where(F.col("length") >= window)
    # one row per partition of the input
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    windows = full.groupBy("part").agg(F.sum(F.expr(f"length div {window}")).alias("windows")).select(
        "part", F.coalesce(F.sum("windows").over(ahead), F.lit(0)).alias("base")
    )
    cut = full.join(F.broadcast(windows), "part").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"length div {window} - 1"))).alias("nth")
    ).select(
        "id", (F.col("start") + F.col("nth") * window).alias("start"), F.lit(window).cast("long").alias("length"),
        (F.lit(slots.sequences) + F.col("base") + F.col("place") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.substring(F.col("ids"), (F.col("nth") * (4 * window) + 1).cast("int"), F.lit(4 * window)).alias("ids"),
    )
    return fitted.unionByName(cut).select(
        F.col("id").alias(id_col), F.expr(f"cast(start div {window} as int)").alias("piece"),
        "start", "length", "sequence_id", "offset", "ids",
    )
