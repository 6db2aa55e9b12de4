"""Helpers the training-data operators share: Arrow batches in bounded slices, scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.session import scratch_path

SLICE_BYTES = 2 << 20


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names; a null text is empty."""
    return docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` text bytes, one row at least."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(byte_lengths(batch.column(column)))
    begin = 0
    while begin < batch.num_rows:
        used = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, used + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The texts that a UDF over Arrow arrays gets, in runs of ``SLICE_BYTES``; its results may come so."""
    for texts in batches:
        for part in slices(pa.record_batch([texts], ["text"]), "text"):
            yield part.column("text")


def byte_lengths(texts: pa.Array) -> np.ndarray:
    offsets, _ = raw(texts)
    return np.diff(offsets)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets (from 0) and the UTF-8 bytes of all rows of a text or binary array."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def strings(texts: pa.Array) -> list[str]:
    return [text or "" for text in texts.to_pylist()]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table in the shared folder and read back.

    Later stages read the files, so a lost executor costs them nothing that was written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ROOTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLES: dict = {}
STEP = 1 << 18


def powers(base: int, size: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    have = _TABLES.get(base)
    if have is None or len(have) < size:
        have = np.full(-(-size // STEP) * STEP, base, dtype=np.uint64)
        have[0] = 1
        have = _TABLES[base] = np.multiply.accumulate(have)
    return have[:size]


def released() -> None:
    """Give back the tables of this worker when a task ends; the next makes them anew.

    Workers live on for other tasks, so what Arrow and the C library keep of freed memory goes back
    as well (the latter where it can, as glibc).
    """
    _TABLES.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task; its memory goes back when it no longer holds the last of them."""
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        released()

    return task


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of each span's bytes, with random byte values; ``which`` is 0 or 1."""
    if ("values", which) not in _TABLES:
        _TABLES["values", which] = np.random.default_rng(which).integers(1, 1 << 63, 256, dtype=np.uint64)
    root = _ROOTS[which]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLES["values", which][data] * powers(root, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[begins]) * powers(pow(root, -1, 1 << 64), len(data) + 1)[begins]
    return hashes ^ ((ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[begin:begin + size]`` one after another."""
    ends = np.cumsum(sizes)
    steps = np.arange(int(ends[-1]) if len(ends) else 0)
    return flat[steps + np.repeat(begins - (ends - sizes), sizes)]


class SpanMemory:
    """Ids of byte spans, worked out once for each content while it is remembered.

    Contents are told apart by two 64-bit hashes. Beyond ``remembered`` contents only those of
    the latest block are kept.
    """

    def __init__(self, encode: Callable[[bytes], list[int]], remembered: int):
        self.encode, self.remembered = encode, remembered
        self.hashes, self.checks = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.begins, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def ids(self, blob: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans of ``blob`` one after another, and how many each span has."""
        if not len(begins):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        data = np.frombuffer(blob, dtype=np.uint8)
        wanted, index, number = np.unique(
            span_hashes(data, begins, ends, 0), return_index=True, return_inverse=True
        )
        checks = span_hashes(data, begins, ends, 1)
        if (checks[index][number] != checks).any():     # one hash, two contents
            wanted, index, number = np.unique(
                np.stack([wanted[number], checks], 1), axis=0, return_index=True, return_inverse=True
            )
            wanted, number = wanted[:, 0], number.reshape(-1)
        checks = checks[index]
        at = np.minimum(np.searchsorted(self.hashes, wanted), max(len(self.hashes) - 1, 0))
        known = np.zeros(len(wanted), dtype=bool)
        begin, size = np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=np.int64)
        if len(self.hashes):
            known = (self.hashes[at] == wanted) & (self.checks[at] == checks)
            begin[known], size[known] = self.begins[at[known]], self.sizes[at[known]]
        lacking = np.flatnonzero(~known)
        if len(lacking):
            spans = zip(begins[index[lacking]].tolist(), ends[index[lacking]].tolist())
            new = [self.encode(blob[a:b]) for a, b in spans]
            size[lacking] = [len(ids) for ids in new]
            begin[lacking] = len(self.flat) + np.cumsum(size[lacking]) - size[lacking]
            flat = np.array([i for ids in new for i in ids], dtype=np.uint32)
            self.flat = np.concatenate([self.flat, flat])
            self.remember(wanted, checks, begin, size, lacking)
        out = gathered(self.flat, begin[number], size[number])
        if len(self.hashes) > self.remembered:
            self.flat = gathered(self.flat, begin, size)
            self.hashes, self.checks, self.sizes = wanted, checks, size
            self.begins = np.cumsum(size) - size
        return out, size[number]

    def remember(self, wanted, checks, begin, size, lacking) -> None:
        places = np.searchsorted(self.hashes, wanted[lacking], side="right")    # both in rising order
        self.hashes = np.insert(self.hashes, places, wanted[lacking])
        self.checks = np.insert(self.checks, places, checks[lacking])
        self.begins = np.insert(self.begins, places, begin[lacking])
        self.sizes = np.insert(self.sizes, places, size[lacking])


def edges_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    framed = np.zeros(len(inside) + 2, dtype=np.int8)
    framed[1:-1] = inside
    steps = np.diff(framed)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
