"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by a learned rotation (principal axes, turned so that signs lose
least). A block of vectors is indexed by the substrings of its codes. By the pigeonhole
principle a code within a Hamming radius agrees with the query in some substring up to a share
of the radius, so probing each substring table with a small ball retrieves every code within
the radius; these are verified on the whole code and reranked by the true distance. Where the
balls hold much of a block, as with vectors without structure, its codes are compared one after
the other, which finds the same rows.

Queries meet the index in blocks: each block of queries goes to each block of vectors once. A task
keeps the nearest few of each query over all its blocks and passes only those on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm.common import gathered, id_type, released, written

BYTE, PREFIX = 8, 14
#: Share of a block below which rows are fetched one by one; queries compared at a time; components fetched at a time.
SPARSE, TILE, GATHERED = 1 / 32, 64, 1 << 20
#: Squares between which rough distances are of use: beyond, single or double precision over- or underflows.
SMALL, LARGE = 1e-290, 1e30
#: Blocks of vectors and of queries that a task reads at least, as far as there are enough for all cores.
BLOCKS, QUERY_BLOCKS = 64, 8
DISTANCE = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class CodeModel:
    """Centre, projection to code bits and the Hamming radius that is searched."""

    centre: np.ndarray
    projection: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.projection.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Code bytes, one row a vector; bits beyond the last axis are 0."""
        return np.packbits((vectors - self.centre) @ self.projection > 0, axis=1, bitorder="little")


def learn(sample: np.ndarray, bits: int, rounds: int, nearest: int, covered: float) -> CodeModel:
    """Rotation and radius from a sample; the radius covers the sample's own nearest neighbours.

    Neighbours in the whole table are nearer than those in the sample, so the radius is ample.
    """
    width = sample.shape[1]
    bits = min(bits, width)
    centre = sample.mean(axis=0)
    data = sample - centre
    _, axes = np.linalg.eigh(data.T @ data / len(sample))
    axes = axes[:, ::-1][:, :bits]
    flat = data @ axes
    turn = np.linalg.qr(np.random.default_rng(0).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        signs = np.where(flat @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ flat)
        turn = right.T @ left.T
    model = CodeModel(centre, axes @ turn, bits)
    if len(sample) <= nearest:
        return model
    codes = model.codes(sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // 256))
    seen = []
    for i in asked:
        far = ((sample - sample[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        near = np.argpartition(far, nearest - 1)[:nearest]
        seen.append(hamming(codes[near], codes[i]))
    return CodeModel(centre, axes @ turn, int(np.quantile(np.concatenate(seen), covered, method="higher")))


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


class SubstringIndex:
    """Tables of the byte substrings of a block's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.begins = [
            np.searchsorted(codes[order, s], np.arange(257)) for s, order in enumerate(self.order)
        ]

    def balls(self, radius: int) -> list[int]:
        """Up to how many bits each substring is probed; -1 for not at all."""
        share, rest = divmod(radius, self.codes.shape[1])
        return [share if s <= rest else share - 1 for s in range(self.codes.shape[1])]

    def probed(self, codes: np.ndarray, radius: int) -> np.ndarray:
        """How many entries the balls around each of the given codes hold."""
        out = np.zeros(len(codes), dtype=np.int64)
        for s, ball in enumerate(self.balls(radius)):
            out += ((DISTANCE <= ball) @ np.diff(self.begins[s]))[codes[:, s]]
        return out

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes are within ``radius`` bits, by probing balls around each substring."""
        met = np.zeros(len(self.codes), dtype=bool)
        for s, ball in enumerate(self.balls(radius)):
            begins = self.begins[s]
            for value in np.flatnonzero(DISTANCE[code[s]] <= ball):
                met[self.order[s][begins[value]:begins[value + 1]]] = True
        rows = np.flatnonzero(met)
        return rows[hamming(self.codes[rows], code) <= radius]


class StoredBlock:
    """A block of vectors with the index of its codes and its ids in order."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray, codes: np.ndarray, centre: np.ndarray):
        self.names, self.vectors = names, vectors
        self.index = SubstringIndex(codes)
        self.by_name = np.argsort(names, kind="stable")
        self.sorted_names = names[self.by_name]
        centred = vectors - centre
        self.squares = np.einsum("ij,ij->i", centred, centred)
        self.scale = float(np.sqrt(self.squares.max())) or 1.0
        # scaled to length one at most, with the square as a last component
        scaled = np.column_stack([centred / self.scale, self.squares / self.scale ** 2])
        self.scaled = np.ascontiguousarray(scaled.T, dtype=np.float32)
        self.words = words_of(codes)

    def apart(self, words: np.ndarray) -> np.ndarray:
        """Hamming distance of each given code (one row each) to all of the block."""
        out = np.bitwise_count(words[:, 0, None] ^ self.words[None, :, 0])
        for at in range(1, words.shape[1]):
            out = out.astype(np.uint16) + np.bitwise_count(words[:, at, None] ^ self.words[None, :, at])
        return out

    def own(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``names``, row) of rows that have the same id."""
        begins = np.searchsorted(self.sorted_names, names)
        sizes = np.searchsorted(self.sorted_names, names, side="right") - begins
        return np.repeat(np.arange(len(names)), sizes), self.by_name[gathered(np.arange(len(self.names)), begins, sizes)]


def words_of(codes: np.ndarray) -> np.ndarray:
    """Code bytes as whole 64-bit numbers, filled up with zeros."""
    out = np.zeros((len(codes), -(-codes.shape[1] // BYTE) * BYTE), dtype=np.uint8)
    out[:, :codes.shape[1]] = codes
    return out.view(np.uint64)


class Asked:
    """A block of queries and the nearest rows found for each so far."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray, codes: np.ndarray, nearest: int):
        self.names, self.vectors, self.codes, self.nearest = names, vectors, codes, nearest
        self.scores = np.full((len(names), nearest), np.inf)
        self.found = np.zeros((len(names), nearest), dtype=np.int64)
        self.have = np.zeros(len(names), dtype=np.int64)

    def meet(self, block: StoredBlock, model: CodeModel) -> None:
        """Take over the nearest rows of ``block``; where too few codes are near, the radius grows.

        It grows by steps of two until a query has ``nearest`` rows in the block or there are no more.
        """
        few = block.index.probed(self.codes, model.radius) < SPARSE * len(block.names)
        dense = np.flatnonzero(~few).tolist()
        for at in np.flatnonzero(few).tolist():
            rows = block.index.within(self.codes[at], model.radius)
            rows = rows[block.names[rows] != self.names[at]]
            if len(rows) < self.nearest:
                dense.append(at)
            else:
                self.take(block, np.full(len(rows), at), rows)
        for begin in range(0, len(dense), TILE):
            self.scan(block, np.array(dense[begin:begin + TILE]), model)

    def scan(self, block: StoredBlock, asked: np.ndarray, model: CodeModel) -> None:
        """Compare the queries ``asked`` with all codes of the block, and those near enough by distance."""
        far = block.apart(words_of(self.codes[asked]))
        never = np.iinfo(far.dtype).max
        far[block.own(self.names[asked])] = never
        near = far <= model.radius
        lacking = np.flatnonzero(np.count_nonzero(near, axis=1) < self.nearest)
        if len(lacking):
            last = min(self.nearest, len(block.names)) - 1
            needed = np.partition(far[lacking], last, axis=1)[:, last].astype(np.int64)
            grown = model.radius + 2 * -(-(needed - model.radius) // 2)
            near[lacking] = (far[lacking] <= grown[:, None]) & (far[lacking] < never)
        if np.count_nonzero(near) >= near.size * SPARSE:
            near &= self.rough(block, asked, near, model)
        at, rows = np.divmod(np.flatnonzero(near), near.shape[1])
        self.take(block, asked[at], rows)

    def rough(self, block: StoredBlock, asked: np.ndarray, near: np.ndarray, model: CodeModel) -> np.ndarray:
        """False for rows that are certainly not among the nearest of a query.

        Distances by one product of matrices in single precision, less than their rounding, are compared with
        the last of the nearest so far or, if there are too few, with the last of the nearest of this block.
        """
        own = (self.vectors[asked] - model.centre) / block.scale
        squares = np.einsum("ij,ij->i", own, own)
        most = 1 + squares
        if not (most < LARGE).all() or not SMALL < block.squares.max() < np.inf:
            return np.ones_like(near)
        distance = np.column_stack([-2 * own, np.ones(len(own))]).astype(np.float32) @ block.scaled
        slack = (own.shape[1] + 16) * 4 * np.finfo(np.float32).eps * most
        bound = np.square(self.scores[asked, -1] / block.scale) - squares + slack
        open_ends = np.flatnonzero(~np.isfinite(bound))
        if len(open_ends) and near.shape[1] > self.nearest:
            own_near = np.where(near[open_ends], distance[open_ends], np.float32(np.inf))
            last = np.partition(own_near, self.nearest - 1, axis=1)[:, self.nearest - 1]
            bound[open_ends] = last + 2 * slack[open_ends]
        return distance <= bound.astype(np.float32)[:, None]

    def take(self, block: StoredBlock, at: np.ndarray, rows: np.ndarray) -> None:
        """Merge the given rows into the nearest of the queries in the same place of ``at``."""
        if not len(at):
            return
        scores = np.empty(len(at))
        step = max(1, GATHERED // max(1, self.vectors.shape[1]))
        for begin in range(0, len(at), step):
            part = slice(begin, begin + step)
            scores[part] = np.sqrt(((block.vectors[rows[part]] - self.vectors[at[part]]) ** 2).sum(axis=1))
        changed = np.unique(at)
        had, place = np.nonzero(np.arange(self.nearest) < self.have[changed, None])
        at = np.concatenate([changed[had], at])
        scores = np.concatenate([self.scores[changed[had], place], scores])
        found = np.concatenate([self.found[changed[had], place], block.names[rows]])
        order = np.lexsort((found, scores, at))
        at, scores, found = at[order], scores[order], found[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = rank < self.nearest
        self.scores[at[kept], rank[kept]], self.found[at[kept], rank[kept]] = scores[kept], found[kept]
        self.have[changed] = np.minimum(np.searchsorted(at, changed, side="right") - np.searchsorted(at, changed), self.nearest)

    def rows(self) -> pa.RecordBatch:
        at, place = np.nonzero(np.arange(self.nearest) < self.have[:, None])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.names[at]), pa.array(self.found[at, place]), pa.array(self.scores[at, place])],
            names=["query_id", "found", "score"],
        )


def packed(vectors: DataFrame, model: CodeModel, size: int) -> DataFrame:
    """Rows of ``size`` vectors, fewer in a task's last: ids, components and codes as bytes."""
    def row(names: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([content.tobytes()], pa.binary()) for content in (names, rows, model.codes(rows))],
            names=["names", "vectors", "codes"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = np.zeros(0, dtype=np.int64), np.zeros((0, len(model.centre)))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            new = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at in range(0, batch.num_rows, size):
                part = batch.column("id").slice(at, size).to_numpy(zero_copy_only=False).astype(np.int64)
                names, rows = np.concatenate([names, part]), np.concatenate([rows, new[at:at + size]])
                if len(names) >= size:
                    yield row(names[:size], rows[:size])
                    names, rows = names[size:], rows[size:]
        if len(names):
            yield row(names, rows)

    return vectors.mapInArrow(pack, "names binary, vectors binary, codes binary")


def lowest(rows: DataFrame, counts: DataFrame, sample: int) -> DataFrame:
    """The vectors of the ``sample`` rows whose ids hash lowest.

    ``counts`` says how many rows have each of the ``prefix`` values in rising order of hashes. Only rows up to
    the prefix that completes the sample are sorted, and by executors, so that what meets in one place
    does not grow with the table or its partitions.
    """
    have, cut = 0, None
    for cut, n in sorted(counts.select("prefix", "n").collect()):
        have += n
        if have >= sample:
            break
    hashed = F.xxhash64("id")
    first = rows.where(prefix_of(hashed) <= F.lit(cut)).orderBy(hashed, "id", "vector").limit(sample)
    return written(first.select("vector"), "vector-sample")


def prefix_of(hashed: Column) -> Column:
    return F.shiftright(hashed, 64 - PREFIX).cast("int")


def block_of(names: pa.Buffer, vectors: pa.Buffer, codes: pa.Buffer, width: int) -> tuple[np.ndarray, ...]:
    names = np.frombuffer(names, dtype=np.int64)
    return (
        names, np.frombuffer(vectors).reshape(len(names), width),
        np.frombuffer(codes, dtype=np.uint8).reshape(len(names), -1),
    )


def usable(vector: Column) -> Column:
    """True for vectors without null, infinite or not-a-number components that are not all zero."""
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    table: DataFrame, queries: Column, nearest: int = 10, id_col: str = "vec_id",
    vector_col: str = "embedding", sample: int = 4096, bits: int = 64, rounds: int = 30,
    covered: float = 0.98, block: int = 4096, query_block: int = 4096,
) -> DataFrame:
    """The ``nearest`` neighbours found of every row for which ``queries`` holds.

    Returns query_id, rank (from 1), vec_id and score, the Euclidean distance in double precision;
    ties go to the smaller id. Every usable row is indexed; the rotation is learned from the
    ``sample`` rows whose ids hash lowest, and ``covered`` is the share of their neighbours that
    the radius must hold. Rows with a null id or an unusable vector (null, zero, with null or
    non-finite components, or of another length than most vectors have) take no part. A row is
    no neighbour of its own id; other repeated rows count as often as they occur, and of
    queries with one id the least vector is asked. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = table.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    )
    kind = id_type(table, id_col)
    counts = written(
        rows.groupBy(F.size("vector").alias("width"), prefix_of(F.xxhash64("id")).alias("prefix"))
        .agg(F.count("*").alias("n")), "vector-counts",
    )
    widths = counts.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "width").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score double")
    width = widths[0]["width"]
    rows = rows.where(F.size("vector") == width)
    chosen = lowest(rows, counts.where(F.col("width") == width), sample).toPandas()["vector"]
    model = learn(np.array(chosen.tolist()), bits, rounds, nearest, covered)
    stored = written(packed(rows.select("id", "vector"), model, block), "vector-blocks")
    asked = written(rows.where("asked").groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    asked = asked.coalesce(max(1, asked.count() // (QUERY_BLOCKS * query_block)))
    right = written(packed(asked, model, query_block), "query-blocks").toDF("asked_names", "asked_vectors", "asked_codes")
    left = stored.coalesce(max(stored.count() // BLOCKS, 2 * spark.sparkContext.defaultParallelism))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, Asked] = {}
        last, stored_block = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                content = {n: batch.column(n)[at].as_buffer() for n in batch.schema.names}
                own = [content[n] for n in ("names", "vectors", "codes")]
                if last is None or not all(a.equals(b) for a, b in zip(last, own)):
                    last = [pa.py_buffer(c.to_pybytes()) for c in own]
                    stored_block = StoredBlock(*block_of(*last, width), model.centre)
                key = content["asked_names"].to_pybytes()
                if key not in seen:
                    copied = [pa.py_buffer(content[f"asked_{n}"].to_pybytes()) for n in ("names", "vectors", "codes")]
                    seen[key] = Asked(*block_of(*copied, width), nearest)
                seen[key].meet(stored_block, model)
        for block_asked in seen.values():
            yield block_asked.rows()
        del seen, last, stored_block
        released()

    # every pair of blocks is made where the block of vectors is read; nothing is copied to disk for it
    met = left.crossJoin(right.hint("shuffle_replicate_nl")).mapInArrow(
        search, "query_id long, found long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "found")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select(
        F.col("query_id").cast(kind), "rank", F.col("found").cast(kind).alias(id_col), "score"
    )
