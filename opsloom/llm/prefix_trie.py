"""The prefix trie of conversations: what a cache of shared beginnings saves.

Every prefix of a conversation is named by a sum of digests of its turns with their places, so
equal prefixes meet in one aggregation. A node belongs to the smallest conversation that passes
through it, its owner; the nodes of one owner form a path, and the owners along a conversation
with the depths at which they begin are a short key (each change of owner is a new minimum).
Sorted by key and depth, the nodes lie in preorder.

The sorted nodes are cut into shards anywhere, also inside a path. A shard writes its nodes as
balanced parentheses with the least and largest excess of each block: findclose ends a subtree,
the number of "()" pairs up to there counts its leaves, and a cumulative array gives its savings.
Nodes still open at a shard's end are its right spine; they are closed by the first later shard
that reaches down to their depth, found by one window over the spines of all shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm.common import written

BLOCK = 64              # parentheses in a block
INSIDE, OPEN, CLOSING, SUMMARY = range(4)
NO_END = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A parentheses sequence with least and largest excess of each block, and a tree over them.

    Opening parentheses may stay open; every closing one has its partner.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = np.packbits(bits)
        self.size = len(bits)
        excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        blocks = -(-self.size // BLOCK)
        self.excess = np.full(blocks * BLOCK, np.iinfo(np.int64).max, dtype=np.int64)
        self.excess[:self.size] = excess
        table = self.excess.reshape(blocks, BLOCK)
        self.least = [table.min(1)]
        self.largest = np.where(table == np.iinfo(np.int64).max, -1, table).max(1)
        while len(self.least[-1]) > 1:
            level = self.least[-1]
            if len(level) % 2:
                level = np.append(level, np.iinfo(np.int64).max)
            self.least.append(np.minimum(level[0::2], level[1::2]))
        # "()" pairs and opening parentheses before each place
        pair = np.zeros(self.size + 1, dtype=np.int64)
        if self.size:
            pair[1:self.size] = bits[:-1] & ~bits[1:] & 1
        self.pairs = np.cumsum(pair)
        self.opened = np.append(0, np.cumsum(bits, dtype=np.int64))

    def findclose(self, places: np.ndarray) -> np.ndarray:
        """The partner of each opening parenthesis; -1 where it stays open."""
        found = np.full(len(places), -1, dtype=np.int64)
        wanted = self.excess[places]
        block = places // BLOCK
        # what a block holds in whole above the excess needs no look inside
        left = np.arange(len(places))
        at = places + 1
        while len(left):
            left = left[(at[left] < self.size) & (at[left] // BLOCK == block[left])]
            hit = self.excess[at[left]] < wanted[left]
            found[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
        left = np.flatnonzero(found < 0)
        target = self.block_below(block[left] + 1, wanted[left])
        left, target = left[target >= 0], target[target >= 0]
        at = target * BLOCK
        while len(left):
            hit = self.excess[at] < wanted[left]
            found[left[hit]] = at[hit]
            left, at = left[~hit], at[~hit] + 1
        return found

    def block_below(self, begin: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first block from ``begin`` on whose least excess is below the wanted one, or -1."""
        level = np.zeros(len(begin), dtype=np.int64)
        node, out = begin.copy(), np.full(len(begin), -1, dtype=np.int64)
        rising = np.ones(len(begin), dtype=bool)
        live = np.arange(len(begin))
        while len(live):
            keep = np.ones(len(live), dtype=bool)
            for depth in np.unique(level[live]):
                here = np.flatnonzero(level[live] == depth)
                rows = live[here]
                known = self.least[depth]
                inside = node[rows] < len(known)
                value = np.where(inside, known[np.minimum(node[rows], len(known) - 1)], np.iinfo(np.int64).max)
                low = value < wanted[rows]
                done = low & (depth == 0)
                out[rows[done]] = node[rows[done]]
                down = rows[low & (depth > 0)]
                rising[down] = False
                node[down] *= 2
                level[down] -= 1
                other = rows[~low]
                # a right child is followed by its parent's neighbour
                up = rising[other] & (node[other] % 2 == 1)
                node[other] = np.where(up, (node[other] + 1) // 2, node[other] + 1)
                level[other] += up
                lost = ~low & rising[rows] & ((~inside) | (level[rows] >= len(self.least)))
                keep[here[done | lost]] = False
            live = live[keep]
        return out


def encoded(depth: np.ndarray, last_is_leaf: bool) -> tuple[Parentheses, np.ndarray, np.ndarray]:
    """The parentheses of a preorder run of depths, the place of each node, and the least depth so far.

    Closings of nodes that were opened before the run are left out.
    """
    least = np.minimum.accumulate(depth)
    closed = np.zeros(len(depth), dtype=np.int64)
    closed[1:] = depth[:-1] - np.maximum(depth[1:], least[:-1]) + 1
    places = np.arange(len(depth)) + np.cumsum(closed)
    bits = np.zeros(places[-1] + 1 + last_is_leaf, dtype=np.uint8)
    bits[places] = 1
    return Parentheses(bits), places, least


COLUMNS = ["kind", "shard", "conv", "depth", "parent", "n_convs", "n_children", "leaves", "saved"]
SHARD_SCHEMA = "kind int, " + ", ".join(f"{c} long" for c in COLUMNS[1:])


def shard_rows(shard: int, nodes: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Closed nodes with the sums of their subtrees, open ones and closings with the sums before
    them, and a summary: first depth (as depth), last depth (as parent) and the sums of all."""
    depth, n = nodes["depth"], len(nodes["depth"])
    trie, places, least = encoded(depth, bool(nodes["n_children"][-1] == 0))
    before = np.append(0, np.cumsum(nodes["own"]))
    ends = trie.findclose(places)
    closed = ends >= 0
    end = np.where(closed, ends, trie.size)
    leaves = np.where(closed, trie.pairs[end] - trie.pairs[places], trie.pairs[places])
    saved = np.where(closed, before[trie.opened[end]] - before[:n], before[:n])

    def batch(kind, *columns):
        rows = len(columns[0])
        arrays = [pa.array(np.full(rows, kind), pa.int32()), pa.array(np.full(rows, shard), pa.int64())]
        arrays += [c if isinstance(c, pa.Array) else pa.array(np.asarray(c, dtype=np.int64)) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=COLUMNS)

    for kind, which in ((INSIDE, np.flatnonzero(closed)), (OPEN, np.flatnonzero(~closed))):
        if len(which):
            parent = pa.array(nodes["parent"][which], pa.int64(), mask=depth[which] == 0)
            yield batch(
                kind, nodes["conv"][which], depth[which], parent, nodes["n_convs"][which],
                nodes["n_children"][which], leaves[which], saved[which],
            )
    lower = np.flatnonzero(depth[1:] < least[:-1]) + 1
    if len(lower):
        # the nodes of depths from this one up to the least so far end here
        zero = np.zeros(len(lower), dtype=np.int64)
        yield batch(CLOSING, zero, depth[lower], least[lower - 1] - 1, zero, zero, trie.pairs[places[lower]], before[lower])
    yield batch(
        SUMMARY, [0], depth[:1], depth[-1:], [0], [0], [trie.pairs[trie.size]], [before[-1]],
    )


def shards(nodes: DataFrame, size: int) -> DataFrame:
    """Every shard's rows; ``nodes`` are in preorder within and across partitions."""
    names = ["conv", "depth", "parent", "n_convs", "n_children", "own"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, count = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - count)
                held.append(part)
                count += part.num_rows
                batch = batch.slice(part.num_rows)
                if count == size:
                    yield from shard_rows(shard, joined(held))
                    shard, held, count = shard + 1, [], 0
        if held:
            yield from shard_rows(shard, joined(held))

    def joined(held: Sequence[pa.RecordBatch]) -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {n: table.column(n).fill_null(0).to_numpy().astype(np.int64) for n in names}

    return nodes.select(*names).mapInArrow(encode, SHARD_SCHEMA)


def merged(parts: DataFrame) -> DataFrame:
    """All nodes with the sums of their whole subtrees; open spines end in later shards."""
    # one row a shard
    order = Window.orderBy("shard")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = parts.where(F.col("kind") == SUMMARY).select(
        "shard", F.col("depth").alias("first"), F.lag("parent").over(order).alias("last_before"),
        *[f(c) for c in ("leaves", "saved") for f in (
            lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before"),
            lambda c: F.sum(c).over(everything).alias(f"{c}_all"),
        )],
    )
    sums = [(F.col(c) + F.col(f"{c}_before")).alias(c) for c in ("leaves", "saved")]
    at_start = summary.where(F.col("last_before") >= F.col("first")).select(
        "shard", F.col("first").alias("low"), F.col("last_before").alias("high"),
        F.col("leaves_before").alias("leaves"), F.col("saved_before").alias("saved"),
    )
    later = parts.where(F.col("kind") == CLOSING).join(summary, "shard").select(
        "shard", F.col("depth").alias("low"), F.col("parent").alias("high"), *sums
    )
    empty = [F.lit(None).cast("long").alias(c) for c in ("conv", "parent", "n_convs", "n_children", "leaves_all", "saved_all")]
    closings = at_start.unionByName(later).select(
        F.explode(F.sequence("low", "high")).alias("depth"), "shard", F.lit(False).alias("opens"),
        "leaves", "saved", *empty,
    )
    opens = parts.where(F.col("kind") == OPEN).join(summary, "shard").select(
        "depth", "shard", F.lit(True).alias("opens"), *sums, "conv", "parent", "n_convs",
        "n_children", "leaves_all", "saved_all",
    )
    # at most two rows of a depth for each shard
    turn = Window.partitionBy("depth").orderBy("shard", "opens")
    spines = opens.unionByName(closings).withColumns({
        f"{c}_end": F.coalesce(F.lead(c).over(turn), F.col(f"{c}_all")) for c in ("leaves", "saved")
    }).where("opens")
    names = ["conv", "depth", "parent", "n_convs", "n_children"]
    return spines.select(
        *names, *[(F.col(f"{c}_end") - F.col(c)).alias(c) for c in ("leaves", "saved")]
    ).unionByName(parts.where(F.col("kind") == INSIDE).select(*names, "leaves", "saved"))


def running(df: DataFrame, group: str, order: Sequence[str], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with running sums in each group's order, the row itself counted.

    Rows are sorted over all partitions, so a group of any size is dealt out; only the first group
    of a partition can go on from earlier ones, so what is broadcast is one row a partition.
    """
    keys = [group, *order]
    placed = written(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()), name
    )
    inside = Window.partitionBy("part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part", group).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    carried = totals.select("part", group, *[F.sum(k).over(ahead).alias(f"{k}_before") for k in sums]).where(
        F.col(f"{next(iter(sums))}_before").isNotNull()
    )
    return placed.withColumns({k: F.sum(v).over(inside) for k, v in sums.items()}).join(
        F.broadcast(carried), ["part", group], "left"
    ).withColumns({k: F.col(k) + F.coalesce(F.col(f"{k}_before"), F.lit(0)) for k in sums}).drop(
        "part", *[f"{k}_before" for k in sums]
    )


def numbered_turns(
    table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv, place (from 1, by turn, null first), digest of role and text, and the text's bytes.

    A null role or text is empty. Rows of one conversation and turn are placed by their digest;
    repeated rows are turns of their own. Rows without a conversation take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = table.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.spark_partition_id().alias("source"),
    )
    return running(turns, "conv", ["turn", "digest", "source"], {"place": F.lit(1).cast("long")}, "turns").select(
        "conv", "place", "digest", "bytes"
    )


def with_lent_heads(turns: DataFrame, lender: Column, heads: Column, most: int) -> DataFrame:
    """Conversations whose first ``heads`` turns (``most`` at most) are those of their ``lender``.

    Both columns read ``conv``. A lender that has fewer turns lends all, an absent one none. Returns
    the columns of ``numbered_turns``; a conversation left without turns has no row.
    """
    sizes = turns.groupBy("conv").agg(F.count("*").alias("size"))
    convs = sizes.select("conv", lender.alias("lender"), heads.alias("heads"))
    lent = convs.join(
        sizes.select(F.col("conv").alias("lender"), "size"), "lender", "left"
    ).select("conv", "lender", "heads", F.least("heads", F.coalesce("size", F.lit(0))).alias("lent"))
    own = turns.join(lent, "conv").where(F.col("place") > F.col("heads")).select(
        "conv", (F.col("place") - F.col("heads") + F.col("lent")).alias("place"), "digest", "bytes"
    )
    first = turns.where(F.col("place") <= most).withColumnRenamed("conv", "lender").join(
        lent, "lender"
    ).where(F.col("place") <= F.col("lent")).select("conv", "place", "digest", "bytes")
    return own.unionByName(first)


def ends_digests(ends: DataFrame, chunk: int = 1024) -> DataFrame:
    """SHA-256 of each node's conversations that end there, ascending and comma-joined.

    The ids are sorted over all partitions and written there as short texts; a node's texts then
    pass one task in order, which holds one batch of them.
    """
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, depth, conv = (batch.column(n).to_numpy() for n in ("owner", "depth", "conv"))
            fresh = np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1
            begins = np.union1d(np.append(0, fresh), np.arange(0, len(conv), chunk)) if len(conv) else []
            pieces = [",".join(map(str, part.tolist())) for part in np.split(conv, begins[1:])] if len(conv) else []
            begins = np.asarray(begins, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[begins]), pa.array(depth[begins]), pa.array(conv[begins]), pa.array(pieces, pa.string())],
                names=["owner", "depth", "first", "piece"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, node, state = ["owner", "depth", "ends_sha256"], None, None
        for batch in batches:
            out = []
            for owner, depth, piece in zip(*(batch.column(n).to_pylist() for n in ("owner", "depth", "piece"))):
                if node == (owner, depth):
                    state.update(b"," + piece.encode())
                    continue
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (owner, depth), hashlib.sha256(piece.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, state.hexdigest())], names=names)

    keys = ["owner", "depth", "conv"]
    pieces = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        texts, "owner long, depth long, first long, piece string"
    )
    return pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(
        digests, "owner long, depth long, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, shard: int = 1 << 18) -> DataFrame:
    """One row per node of the prefix trie.

    ``turns`` has conv (long), place (from 1 without gaps), digest and bytes, as ``numbered_turns``
    gives them; ``convs`` has the conv of all conversations, also those without turns. Returns, as
    long, conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, members but one times the bytes of the
    last text) and ends_sha256 (of the members that end at the node). No conversations give no
    rows. The sort key of a node holds 16 bytes for each smaller conversation that parts from its
    path, a logarithm of the members on average.
    """
    spark = turns.sparkSession
    tagged = F.md5(F.concat_ws(":", F.col("place").cast("string"), "digest").cast("binary"))
    number = lambda at: F.conv(F.substring(tagged, at, 15), 16, 10).cast("decimal(20,0)")
    prefixes = written(
        running(turns, "conv", ["place"], {"a": number(1), "b": number(17)}, "rebuilt-turns").select(
            "conv", F.col("place").alias("depth"), "a", "b", "bytes"
        ), "prefixes",
    )
    members = convs.select(F.col("conv").cast("long").alias("conv")).distinct()
    root, total = members.agg(F.min("conv"), F.count("*")).first()
    out = (
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string"
    )
    if not total:
        return spark.createDataFrame([], out)
    name = ["depth", "a", "b"]
    groups = written(prefixes.groupBy(*name).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("owner"), F.min("bytes").alias("bytes")
    ), "trie-nodes")
    runs = prefixes.join(groups.select(*name, "owner"), name).groupBy("conv", "owner").agg(
        F.min("depth").alias("begin"), F.max("depth").alias("end")
    )
    paths = written(runs.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("begin", "owner", "end"))).alias("runs")
    ), "trie-paths")
    last = F.element_at("runs", -1)
    # a conversation that branches off deeper comes first
    owners = paths.where(last["owner"] == F.col("conv")).select(
        F.col("conv").alias("owner"), last["begin"].alias("begin"), last["end"].alias("end"),
        F.when(F.size("runs") > 1, F.try_element_at("runs", F.lit(-2))["owner"]).otherwise(root).alias("above"),
        F.transform("runs", lambda r: F.struct((-r["begin"]).alias("begin"), r["owner"].alias("owner"))).alias("key"),
    )
    branches = owners.groupBy(F.col("above").alias("owner"), (F.col("begin") - 1).alias("depth")).agg(
        F.count("*").alias("branches")
    )
    path = groups.join(owners, "owner").select(
        "key", "owner", "depth", F.when(F.col("depth") > F.col("begin"), F.col("owner")).otherwise(F.col("above")).alias("parent"),
        "n_convs", (F.col("depth") < F.col("end")).cast("long").alias("next"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"),
    )
    key_type = path.schema["key"].dataType.simpleString()
    top = spark.range(1).select(
        F.array().cast(key_type).alias("key"), F.lit(root).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent"), F.lit(total).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("next"), F.lit(0).cast("long").alias("own"),
    )
    nodes = path.unionByName(top).join(branches, ["owner", "depth"], "left").select(
        "key", F.col("owner").alias("conv"), "depth", "parent", "n_convs", "own",
        (F.col("next") + F.coalesce("branches", F.lit(0))).alias("n_children"),
    )
    preorder = nodes.repartitionByRange("key", "depth").sortWithinPartitions("key", "depth")
    found = merged(written(shards(preorder, shard), "trie-shards"))
    ends = members.join(
        paths.select("conv", last["owner"].alias("owner"), last["end"].alias("depth")), "conv", "left"
    ).select("conv", F.coalesce("owner", F.lit(root)).alias("owner"), F.coalesce("depth", F.lit(0)).alias("depth"))
    digests = ends_digests(ends).withColumnRenamed("owner", "conv")
    return found.join(digests, ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256"),
    )
