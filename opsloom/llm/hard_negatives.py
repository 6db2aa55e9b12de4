"""Hard negatives by an R-tree: like an anchor, but of another label and not too like.

Vectors become whole numbers and are packed by sort-tile-recursive: slabs along the coordinate
that varies most, slabs along the next one within these, tiles of some thousand rows along a
third, and the same again inside a tile for its leaves. Every tile and leaf has its bounding box,
the labels of a tile are one more coordinate. A box bounds the inner product with an anchor
coordinate by coordinate: above by the larger, below by the smaller product with its two ends.

A search asks for the best few scores in a window, from a block of anchors at once. Every anchor
first goes to the tile of the highest bound in each page of tiles; the scores found there prune the
tiles strictly below, and the anchors that are left are sent to a tile together. In a tile
each takes its leaves best first until the next bound is strictly below its worst kept score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from opsloom.llm.common import written

EXACT = 1 << 53         # whole numbers below are exact as doubles
LONGEST = 1 << 31       # sum of a vector's absolute components, so that products fit a long
NONE = np.iinfo(np.int64).min
TILE = {
    "tile": pa.int64(), "width": pa.int32(), "label_low": pa.int64(), "label_high": pa.int64(),
    "low": pa.binary(), "high": pa.binary(), "leaf_low": pa.binary(), "leaf_high": pa.binary(),
    "ids": pa.binary(), "labels": pa.binary(), "rows": pa.binary(),
}
FOUND = "key long, slot int, found long, score long"


def ddl(fields: dict[str, pa.DataType]) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{n} {kinds[k]}" for n, k in fields.items())


def str_order(rows: np.ndarray, leaf: int) -> np.ndarray:
    """Rows by slabs of whole leaves along their widest coordinate, then along each slab's own."""
    leaves = -(-len(rows) // leaf)
    slab = leaf * int(np.ceil(np.sqrt(leaves)))
    order = np.argsort(rows[:, rows.var(0).argmax()], kind="stable")
    for at in range(0, len(rows), slab):
        part = order[at:at + slab]
        inside = rows[part]
        order[at:at + slab] = part[np.argsort(inside[:, inside.var(0).argmax()], kind="stable")]
    return order


def tiles_of(rows: DataFrame, tile: int, leaf: int) -> DataFrame:
    """Tiles with their leaves' boxes; ``rows`` are sorted and a tile has one vector length."""
    def tile_row(name: int, width: int, part: pa.Table) -> dict:
        ids, labels = (part.column(n).to_numpy() for n in ("id", "label"))
        flat = part.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(len(ids), -1).astype(np.int32)
        order = str_order(vectors, leaf)
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        cuts = np.arange(0, len(ids), leaf)
        low, high = np.minimum.reduceat(vectors, cuts), np.maximum.reduceat(vectors, cuts)
        return {
            "tile": name, "width": width, "label_low": labels.min(), "label_high": labels.max(),
            "low": low.min(0).tobytes(), "high": high.max(0).tobytes(), "leaf_low": low.tobytes(),
            "leaf_high": high.tobytes(), "ids": ids.tobytes(), "labels": labels.tobytes(), "rows": vectors.tobytes(),
        }

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            held = pa.concat_tables([t for t in (held, pa.Table.from_batches([batch])) if t is not None])
            name, held, done = cut(name, held, False)
            yield from done
        if held is not None and held.num_rows:
            yield from cut(name, held, True)[2]

    def cut(name: int, held: pa.Table, last: bool) -> tuple[int, pa.Table, list[pa.RecordBatch]]:
        out = []
        while held.num_rows:
            widths = held.column("width").to_numpy()
            same = int(np.argmax(widths != widths[0])) if (widths != widths[0]).any() else len(widths)
            size = min(same, tile)
            if size == len(widths) < tile and not last:
                break
            row = tile_row(name, int(widths[0]), held.slice(0, size))
            out.append(pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in TILE.items()], names=list(TILE)))
            name, held = name + 1, held.slice(size)
        return name, held, out

    return rows.select("id", "label", "width", "vector").mapInArrow(pack, ddl(TILE))


def laid_out(rows: DataFrame, tile: int) -> DataFrame:
    """Rows sorted by sort-tile-recursive over all partitions, label first.

    The slabs' borders are approximate quantiles: they move rows between tiles, not results. There
    are as many slabs as the cube root of the tiles.
    """
    spread = rows.select("id", F.posexplode("vector").alias("at", "x")).groupBy("at").agg(
        F.variance(F.col("x").cast("double")).alias("spread"), F.count("*").alias("n")
    ).orderBy(F.col("spread").desc_nulls_last(), "at").limit(3).collect()
    axes = [r["at"] for r in spread]
    axes += [0] * (3 - len(axes))
    count = max([r["n"] for r in spread], default=1)
    slabs = max(1, int(np.ceil((count / tile) ** (1 / 3))))
    shares = [i / slabs for i in range(1, slabs)]
    placed = rows.withColumns({
        f"c{i}": F.coalesce(F.try_element_at("vector", F.lit(axis + 1)), F.lit(0)) for i, axis in enumerate(axes)
    })
    if not shares:
        placed = placed.withColumns({"slab0": F.lit(0), "slab1": F.lit(0)})
    else:
        below = lambda cuts, x: F.size(F.filter(cuts, lambda c: c <= x))
        cuts = placed.agg(F.percentile_approx("c0", shares, 10_000)).first()[0]
        placed = placed.withColumn("slab0", below(F.array(*map(F.lit, cuts)), F.col("c0")))
        inner = placed.groupBy("slab0").agg(F.percentile_approx("c1", shares, 10_000).alias("cuts"))
        placed = placed.join(F.broadcast(inner), "slab0").withColumn("slab1", below(F.col("cuts"), F.col("c1"))).drop("cuts")
    keys = ["width", "label", "slab0", "slab1", "c2", "id"]
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys)


@dataclass
class Block:
    """Anchors of one vector length and the windows they ask for."""

    anchors: list[Row]

    def __post_init__(self):
        rows = self.anchors
        self.ids = np.array([r["id"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        self.vectors = np.array([r["vector"] for r in rows], dtype=np.int64).reshape(len(rows), -1)
        flat = [(i, r["key"], w["slot"], w["low"], w["high"], w["floor"]) for i, r in enumerate(rows) for w in r["windows"]]
        self.anchor, self.keys, self.slots, self.low, self.high, self.floor = np.array(flat, dtype=np.int64).reshape(-1, 6).T

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each window's anchor with each box."""
        up, down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        largest = product(up, high) + product(down, low)
        least = product(up, low) + product(down, high)
        return least[self.anchor], largest[self.anchor]


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact."""
    most = [int(np.abs(m.astype(np.int64)).max(initial=0)) for m in (left, right)]
    if most[0] * most[1] * max(1, left.shape[1]) < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def search_tile(tile: dict, block: Block, asked: np.ndarray, same: bool, most: int, leaf: int) -> tuple[np.ndarray, ...]:
    """Window, id and score of the best ``most`` rows of a tile for each window of ``asked``."""
    ids, labels = (np.frombuffer(tile[n], dtype=np.int64) for n in ("ids", "labels"))
    rows = np.frombuffer(tile["rows"], dtype=np.int32).reshape(len(ids), -1)
    boxes = [np.frombuffer(tile[n], dtype=np.int32).reshape(-1, rows.shape[1]) for n in ("leaf_low", "leaf_high")]
    least, largest = block.bounds(*boxes)
    least, largest = least[asked], largest[asked]
    anchor, low, high = block.anchor[asked], block.low[asked], block.high[asked]
    best = np.full((len(asked), most), NONE, dtype=np.int64)
    name = np.zeros_like(best)
    worst = block.floor[asked].copy()
    queue = np.argsort(-largest, axis=1, kind="stable")
    live = np.arange(len(asked))
    for step in range(queue.shape[1]):
        leaves = queue[live, step]
        # bounds only fall along a queue, so a window below its worst kept score is done
        done = largest[live, leaves] < np.maximum(worst[live], low[live])
        live, leaves = live[~done], leaves[~done]
        open_ = least[live, leaves] <= high[live]
        for number in np.unique(leaves[open_]):
            which = live[open_ & (leaves == number)]
            span = slice(number * leaf, (number + 1) * leaf)
            anchors, inverse = np.unique(anchor[which], return_inverse=True)
            score = product(block.vectors[anchors], rows[span])[inverse]
            alike = labels[span] == block.labels[anchor[which], None]
            good = (alike == same) & (ids[span] != block.ids[anchor[which], None])
            good &= (score >= np.maximum(low, worst)[which, None]) & (score <= high[which, None])
            row, column = np.nonzero(good)
            if not len(row):
                continue
            row = np.concatenate([row, np.repeat(np.arange(len(which)), most)])
            value = np.concatenate([score[good], best[which].ravel()])
            found = np.concatenate([ids[span][column], name[which].ravel()])
            # descending scores, ties by id; ~ turns the order of whole numbers without overflow
            order = np.lexsort((found, ~value, row))
            begins = np.searchsorted(row[order], np.arange(len(which)))
            kept = order[begins[:, None] + np.arange(most)]
            best[which], name[which] = value[kept], found[kept]
            worst[which] = np.maximum(worst[which], best[which, -1])
    row, column = np.nonzero(best != NONE)
    return asked[row], name[row, column], best[row, column]


class Search:
    """The R-tree of a table, asked for the best scores in windows."""

    def __init__(self, rows: DataFrame, tile: int, leaf: int, block: int, page: int):
        self.leaf, self.block = leaf, block
        self.tiles = written(tiles_of(laid_out(rows, tile), tile, leaf), "rtree-tiles")
        self.pages = written(self.directory(page), "rtree-pages")
        self.slots = max(1, self.pages.count())

    def directory(self, page: int) -> DataFrame:
        """Boxes and labels of up to ``page`` tiles of one vector length in a row."""
        names = ["tile", "width", "label_low", "label_high", "low", "high"]

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for width in np.unique(batch.column("width").to_numpy()).tolist():
                    which = np.flatnonzero(batch.column("width").to_numpy() == width)
                    for at in range(0, len(which), page):
                        part = batch.take(pa.array(which[at:at + page]))
                        joined = [part.column(n).to_numpy().tobytes() for n in ("tile", "label_low", "label_high")]
                        boxes = [b"".join(part.column(n).to_pylist()) for n in ("low", "high")]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([width], pa.int32()), *[pa.array([c], pa.binary()) for c in (*joined, *boxes)]],
                            names=["width", "tiles", "label_lows", "label_highs", "lows", "highs"],
                        )

        return self.tiles.select(*names).mapInArrow(
            gather, "width int, tiles binary, label_lows binary, label_highs binary, lows binary, highs binary"
        )

    def blocks(self, asked: DataFrame) -> DataFrame:
        """Anchors by hash in blocks of about ``block``, each of one vector length."""
        count = max(1, -(-asked.count() // self.block))
        dealt = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count)))
        grouped = dealt.groupBy("block", "width").agg(
            F.collect_list(F.struct("key", "id", "label", "vector", "windows")).alias("anchors")
        )
        return written(grouped.withColumn("block", F.concat_ws("-", "block", "width")), "anchor-blocks")

    def best(self, asked: DataFrame, same: bool, most: int) -> DataFrame:
        """key, slot, found, score: the ``most`` best rows of each window, of the anchor's own label
        or of all others, but not of its id; higher scores first, ties to the smaller id.

        ``asked`` has key, id, label, width, vector and windows of (slot, low, high); both ends count.
        """
        floor = F.transform("windows", lambda w: w.withField("floor", F.lit(NONE)))
        blocks = self.blocks(asked.withColumn("windows", floor))
        seeds = self.ranked(self.searched(blocks, same, most, seeds=True), most)
        floors = seeds.where(F.col("rank") == most).groupBy("key").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floors")
        )
        raised = F.transform("windows", lambda w: w.withField(
            "floor", F.coalesce(F.try_element_at("floors", w["slot"]), F.lit(NONE))
        ))
        again = asked.join(floors, "key", "left").withColumn("windows", raised).drop("floors")
        return self.ranked(self.searched(self.blocks(again), same, most, seeds=False), most)

    @staticmethod
    def ranked(found: DataFrame, most: int) -> DataFrame:
        order = Window.partitionBy("key", "slot").orderBy(F.col("score").desc(), "found")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    def searched(self, blocks: DataFrame, same: bool, most: int, seeds: bool) -> DataFrame:
        leaf = self.leaf

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    page = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                    tiles, lows, highs = (np.frombuffer(page[n], dtype=np.int64) for n in ("tiles", "label_lows", "label_highs"))
                    low, high = (np.frombuffer(page[n], dtype=np.int32).reshape(len(tiles), -1) for n in ("lows", "highs"))
                    block = Block(page["anchors"])
                    least, largest = block.bounds(low, high)
                    label = block.labels[block.anchor, None]
                    some = (lows <= label) & (label <= highs) if same else (lows != label) | (highs != label)
                    some &= (largest >= np.maximum(block.low, block.floor)[:, None]) & (least <= block.high[:, None])
                    if seeds and len(tiles):
                        first = np.where(some, largest, NONE).argmax(1)
                        some &= np.arange(len(tiles)) == first[:, None]
                    use = np.flatnonzero(some.any(0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tiles[use]), pa.array([page["block"]] * len(use), pa.string()),
                         pa.array([np.flatnonzero(some[:, t]).astype(np.int64).tobytes() for t in use], pa.binary())],
                        names=["tile", "block", "which"],
                    )

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    tile = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                    block = Block(tile["anchors"])
                    which = np.frombuffer(tile["which"], dtype=np.int64)
                    window, found, score = search_tile(tile, block, which, same, most, leaf)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block.keys[window]), pa.array(block.slots[window].astype(np.int32)),
                         pa.array(found), pa.array(score)], names=["key", "slot", "found", "score"],
                    )

        pages = self.pages.withColumn("page", F.pmod(F.xxhash64("tiles"), F.lit(self.slots)))
        spread = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(self.slots - 1)).cast("array<long>")))
        width = F.split_part("block", F.lit("-"), F.lit(-1)).cast("int")
        met = spread.withColumn("width", width).join(pages, ["page", "width"])
        pairs = met.select("block", "anchors", "tiles", "label_lows", "label_highs", "lows", "highs").mapInArrow(
            route, "tile long, block string, which binary"
        )
        return pairs.join(blocks.select("block", "anchors"), "block").join(
            self.tiles.select("tile", "leaf_low", "leaf_high", "ids", "labels", "rows"), "tile"
        ).select("anchors", "which", "leaf_low", "leaf_high", "ids", "labels", "rows").mapInArrow(search, FOUND)


def whole_numbers(vector: Column, scale: int) -> Column:
    """Each component x as floor(scale * x); null for vectors that can't take part."""
    doubles = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    usable = F.forall(doubles, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < LONGEST), F.lit(False)))
    total = F.aggregate(doubles, F.lit(0.0), lambda s, x: s + F.abs(F.floor(x)).cast("double"))
    whole = F.when(usable, F.transform(doubles, lambda x: F.floor(x).cast("long")))
    return F.when(usable & (total < LONGEST), whole)


def hard_negatives(
    table: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    tile: int = 4096, leaf: int = 256, block: int = 256, page: int = 512,
) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels in a score window.

    Scores are inner products of the vectors as whole numbers, floor(scale * x) of each component.
    An anchor's positives are its first ``positives`` rows of the same label; the window goes from
    ``low`` to ``high`` percent of a positive's score, both included (0 <= low < high; none for
    negative scores). Higher scores come first, ties by smaller id. Returns anchor_id, positive_id,
    rank (from 1), negative_id, positive_score and negative_score, ids as long; exact.

    Rows without an id or label, without a vector, with null or non-finite components, or whose whole
    numbers add up to 2**31 or more in absolute value take no part. Vectors of different lengths do
    not meet. A row is not compared with rows of its own id; other repeated rows count as often as
    they occur, repeated anchors are asked once. Labels are whole numbers. An empty table gives no rows.
    """
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        whole_numbers(F.col(vector_col), scale).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asked"),
    ).where("id is not null and label is not null and vector is not null").withColumn("width", F.size("vector"))
    # an empty vector has one coordinate as well, which adds nothing
    rows = rows.withColumn("vector", F.when(F.col("width") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.col("vector")))
    rows = written(rows, "whole-vectors")
    tree = Search(rows.drop("asked"), tile, leaf, block, page)
    named = rows.where("asked").select("id", "label", "vector", "width").distinct()
    asked = written(named.withColumn("key", F.monotonically_increasing_id()), "anchors")
    largest = np.iinfo(np.int64).max
    everything = F.struct(F.lit(0).alias("slot"), F.lit(NONE).alias("low"), F.lit(largest).alias("high"))
    found = written(tree.best(asked.withColumn("windows", F.array(everything)), True, positives).select(
        "key", F.col("rank").alias("slot"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score")
    ), "positives")
    part = lambda percent, up: F.expr(f"(cast(positive_score as decimal(25,0)) * {percent} + {up}) div 100")
    windows = found.where("positive_score >= 0").groupBy("key").agg(F.collect_list(F.struct(
        "slot", part(low, 99).cast("long").alias("low"), part(high, 0).cast("long").alias("high")
    )).alias("windows"))
    best = tree.best(asked.join(windows, "key"), False, negatives)
    return best.join(found, ["key", "slot"]).join(asked.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
