"""Near copies by SimHash and, beyond its radius, MinHash; every link is verified by shingles.

Two documents are near copies if they share at least ``similarity`` of all word shingles that
either has. Candidates come by two ways. The first is SimHash: a 64-bit fingerprint of each shingle
set, and multi-index hashing finds all fingerprints at most two bits apart (``simhash.links``). At
similarity 0.8 fingerprints are about 10 bits apart, with tails to 16 and more, and probing that far
meets a growing share of all documents. So the second way finds the pairs beyond the radius: they
share a band of ``ROWS`` MinHash values; two documents of similarity 0.8 miss all ``BANDS`` bands
with a chance of 3 in a million.

Pairs are compared in three rounds. The first has the SimHash pairs and, for each document, one
leader: the member with most partners in all bands among those it shares a band value with, most
likely the one with the fewest changes; where changes are independent of each other, what is similar
to any member is similar to it. So there is one such pair a document at most. What the first
round links is not compared again. Then members of different groups are: all pairs of a value with
up to ``crowd`` members, and in larger ones all members with one of them, a different one in each
band, and with its ``HUBS`` first leaders. So a group of any size gives a number of pairs that grows
with its members. Of these pairs only those are joined to their shingle sets that can be similar: two
sets differ in at least as many shingles as their numbers of shingles by leading hash bits do in
sum. Pairs are verified on the shingle sets, and the second round's links join the first's groups.

The third round has what is left of values above ``crowd`` whose members are still in more than one
group. Two members of similarity 0.8 share a shingle among the rarest fifth of each, and what follows that
shingle in either must hold all that they have in common (prefix and positional filter). So shingles are
ordered by how many of these members have them, and members of different groups meet on the rare ones only.
No similar pair is left out by these filters, and pairs that pass are verified like the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm import simhash
from opsloom.llm.common import id_and_text, id_type, raw, releasing, slices, written
from opsloom.llm.simhash import components, majority, shingle_hashes

BANDS, ROWS, HUBS = 24, 4, 8
BLOCK, COUNTS = 1 << 14, 256
#: Members of a shingle that one task compares with all others of it, and pairs compared at a time; pairs a group
#: from which on only the most promising pair of each group is verified first.
SLICE, TILE, FEW = 1 << 14, 1 << 20, 8


def shingle_set(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """Distinct shingle hashes in rising order; no word at all gives none."""
    return np.unique(np.array(shingle_hashes(text, shingle, seed), dtype="<u8"))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return values ^ (values >> np.uint64(32))


def counts_of(hashes: np.ndarray) -> np.ndarray:
    """How many hashes begin with each byte, 255 at most."""
    return np.minimum(np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=COUNTS), 255).astype(np.uint8)


def node_and_bands(hashes: np.ndarray, factors: np.ndarray) -> tuple[int, np.ndarray]:
    """A number for the whole set, and the value of each band of MinHashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at:at + BLOCK]
        for i, factor in enumerate(factors):
            least[i] = min(least[i], (part * factor).min())
    rows = mixed(least).reshape(BANDS, ROWS)
    bands = np.zeros(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        bands = mixed(bands ^ rows[:, row])
    total = mixed(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0]), bands.view(np.int64)


def factors_of(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    """(id, digest of the text, node, SimHash fingerprint, bands) of every document.

    One node is one shingle set.
    """
    factors = factors_of(seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, data = raw(part.column("text"))
                content = data.tobytes()
                found, prints = [], np.zeros(part.num_rows, dtype=np.uint64)
                for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                    hashes = shingle_set(content[a:b], shingle, seed)
                    prints[row] = majority(hashes)
                    found.append(node_and_bands(hashes, factors))
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("digest"), pa.array([n for n, _ in found], pa.int64()),
                    pa.array(prints.view(np.int64)), pa.array([b.tolist() for _, b in found], pa.list_(pa.int64())),
                ], names=["id", "digest", "node", "fingerprint", "bands"])

    rows = id_and_text(docs, id_col, text_col).withColumn("digest", F.md5(F.col("text").cast("binary")))
    return rows.mapInArrow(
        releasing(run), f"id {id_type(docs, id_col)}, digest string, node long, fingerprint long, bands array<bigint>"
    )


def ordered(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("left"), F.greatest(a, b).alias("right")


def simhash_pairs(distinct: DataFrame) -> DataFrame:
    """Pairs (left, right) of nodes that connect all whose fingerprints are at most two bits apart.

    ``distinct`` has one row per node. Nodes of one fingerprint are paired with the least of them,
    which stands for them in the pairs of different fingerprints.
    """
    firsts = written(distinct.groupBy("fingerprint").agg(F.min("node").alias("first")), "near-copies-fingerprints")
    same = distinct.select("node", "fingerprint").join(firsts, "fingerprint").where(F.col("node") != F.col("first"))
    end = lambda name: firsts.select(F.col("fingerprint").alias(name), F.col("first").alias(f"{name}_first"))
    near = simhash.links(firsts.select("fingerprint")).join(end("left"), "left").join(end("right"), "right")
    return same.select(*ordered("node", "first")).unionByName(near.select(*ordered("left_first", "right_first")))


def sets_of(
    docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, chosen: DataFrame, shingle: int, seed: int
) -> DataFrame:
    """(node, shingles, size, counts) of the given nodes, each from the one document that is chosen for it."""
    chosen = chosen.join(nodes, "node").select("node", "digest", F.col("id").alias("own"))
    rows = id_and_text(docs, id_col, text_col).withColumn("digest", F.md5(F.col("text").cast("binary")))
    # by id as well, so that the copies of a text do not meet in one task
    texts = rows.join(
        chosen, (rows["digest"] == chosen["digest"]) & rows["id"].eqNullSafe(chosen["own"])
    ).dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, data = raw(part.column("text"))
                content = data.tobytes()
                sets = [shingle_set(content[a:b], shingle, seed) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([counts_of(s).tobytes() for s in sets], pa.binary()),
                ], names=["node", "shingles", "size", "counts"])

    return texts.select("node", "text").mapInArrow(
        releasing(run), "node long, shingles binary, size long, counts binary"
    )


def possible(pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs of members ``one`` and ``other`` that can be at least that similar, each once.

    Sets that differ in d of s shingles in all have a similarity of (s - d) / (s + d). Their counts
    differ in sum by d at most. Returns the nodes (left, right) and their groups (low, high).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("one_size").to_numpy() + batch.column("other_size").to_numpy()
            one, other = (
                raw(batch.column(name))[1].reshape(-1, COUNTS).astype(np.int16) for name in ("one_counts", "other_counts")
            )
            differ = np.abs(one - other).sum(axis=1, dtype=np.int64)
            keep = both - differ >= similarity * (both + differ) - 1e-6 * both
            yield batch.select(["left", "right", "low", "high"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select(
        *ordered("one.node", "other.node"),
        *[c.alias(name) for c, name in zip(ordered("one.root", "other.root"), ("low", "high"))],
        *[F.col(f"{end}.{name}").alias(f"{end}_{name}") for end in ("one", "other") for name in ("size", "counts")],
    ).mapInArrow(releasing(run), "left long, right long, low long, high long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs`` whose shingle sets are at least that similar; all columns are numbers."""
    columns = pairs.columns
    both = pairs.join(
        sets.select(F.col("node").alias("left"), F.col("shingles").alias("one")), "left"
    ).join(sets.select(F.col("node").alias("right"), F.col("shingles").alias("two")), "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one"), batch.column("two")):
                a, b = (np.frombuffer(s.as_py(), dtype="<u8") for s in (one, two))
                if min(len(a), len(b)) < similarity * max(len(a), len(b)):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(common >= similarity * (len(a) + len(b) - common))
            yield batch.select(columns).filter(pa.array(keep, pa.bool_()))

    return both.select(*columns, "one", "two").mapInArrow(
        releasing(run), ", ".join(f"{c} long" for c in columns)
    )


def rare_shingles(sets: DataFrame, left: DataFrame, similarity: float) -> DataFrame:
    """(token, node, root, size, place, n) of the shingles that a similar member must share one of.

    ``left`` has (node, root). ``place`` counts a member's rarer shingles; ``n`` is how many members have this one.
    Shingles of one member alone are left out, as no other shares them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "shingles"):
                sizes = part.column("size").to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array(raw(part.column("shingles"))[1].view(np.int64)),
                    *[pa.array(np.repeat(part.column(name).to_numpy(), sizes)) for name in ("node", "root", "size")],
                ], names=["token", "node", "root", "size"])

    tokens = sets.join(left, "node").select("shingles", "node", "root", "size").mapInArrow(
        releasing(run), "token long, node long, root long, size long"
    )
    shared = tokens.withColumn("n", F.count("*").over(Window.partitionBy("token"))).where("n > 1")
    own = Window.partitionBy("node")
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "token")) - 1
    return shared.withColumn("place", place.cast("long")).where(
        F.col("place") <= F.floor(F.col("size") * (1 - similarity + 1e-6))
    )


def met_on(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (left, right, low, high, most) of members of different groups that the filters leave, each once.

    ``rows`` are those of ``rare_shingles``; ``low`` and ``high`` are the groups, ``most`` the share of both sets that
    can be common. The members of a shingle that very many have are dealt to several tasks, each of which
    compares its own with all of them.
    """
    share = similarity / (1 + similarity) - 1e-6

    def pairs_of(root, size, node, rest, asks) -> Iterator[pa.RecordBatch]:
        roots, counts = np.unique(root, return_counts=True)
        asking = np.flatnonzero(asks & (root != roots[counts.argmax()]))
        step = max(1, TILE // len(root))
        for at in range(0, len(asking), step):
            own = asking[at:at + step]
            common = np.minimum(rest[own, None], rest[None, :])
            both = size[own, None] + size[None, :]
            smaller = np.minimum(size[own, None], size[None, :])
            one, other = np.nonzero(
                (common >= share * both) & (root[own, None] != root[None, :])
                & (smaller >= (similarity - 1e-6) * (both - smaller))
            )
            if not len(one):
                continue
            ends = node[own[one]], node[other]
            groups = root[own[one]], root[other]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends)),
                pa.array(np.minimum(*groups)), pa.array(np.maximum(*groups)),
                pa.array(common[one, other] / both[one, other]),
            ], names=["left", "right", "low", "high", "most"])

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, part, node, root, size, place, asks = (
            c.to_numpy() for c in table.select(["token", "slice", "node", "root", "size", "place", "asks"]).columns
        )
        begins = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (part[1:] != part[:-1])])
        mixed_groups = np.minimum.reduceat(root, begins) != np.maximum.reduceat(root, begins)
        ends = np.r_[begins[1:], len(token)]
        for begin, end in zip(begins[mixed_groups].tolist(), ends[mixed_groups].tolist()):
            at = slice(begin, end)
            yield from pairs_of(root[at], size[at], node[at], size[at] - place[at], asks[at] > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []             # the last token's rows may go on in the next batch
        for batch in batches:
            if batch.num_rows == 0:
                continue
            token, part = (batch.column(name).to_numpy() for name in ("token", "slice"))
            others = np.flatnonzero((token != token[-1]) | (part != part[-1]))
            last = int(others[-1]) + 1 if len(others) else 0
            if last or held and (held[-1].column("token")[0].as_py(), held[-1].column("slice")[0].as_py()) != (
                token[-1], part[-1]
            ):
                yield from found(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from found(pa.Table.from_batches(held))

    parts = F.ceil(F.col("n") / SLICE).cast("long")
    dealt = rows.withColumn("parts", parts).withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    ).withColumn("asks", (F.pmod(F.xxhash64("node"), F.col("parts")) == F.col("slice")).cast("int"))
    return dealt.select("token", "slice", "node", "root", "size", "place", "asks").repartition(
        "token", "slice"
    ).sortWithinPartitions("token", "slice").mapInArrow(
        releasing(run), "left long, right long, low long, high long, most double"
    ).groupBy("left", "right", "low", "high").agg(F.max("most").alias("most"))


def linked(waiting: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (left, right) of groups that similar pairs connect.

    While there are many pairs a group, the most promising of each group goes first, as its link may settle
    others. All pairs are verified that are not within one group by then.
    """
    end = lambda name, as_name: sets.select(
        F.col("node").alias(name), F.struct("node", "size", "counts").alias(as_name)
    )
    links, first = None, True
    while True:
        waiting = written(waiting, "near-copies-waiting")
        ends = waiting.select(F.explode(F.array("low", "high")).alias("root"), F.struct(
            (-F.col("most")).alias("order"), "left", "right", "low", "high"
        ).alias("pair"))
        total = waiting.count()
        some = first and total > FEW * ends.select("root").distinct().count()
        chosen = waiting.drop("most")
        if some:
            chosen = ends.groupBy("root").agg(F.min("pair").alias("pair")).select("pair.*").drop("order").distinct()
        both = chosen.join(end("left", "one"), "left").join(end("right", "other"), "right").select(
            F.struct("one.node", F.col("low").alias("root"), "one.size", "one.counts").alias("one"),
            F.struct("other.node", F.col("high").alias("root"), "other.size", "other.counts").alias("other"),
        )
        found = written(
            verified(written(possible(both, similarity), "near-copies-chosen"), sets, similarity)
            .select(F.col("low").alias("left"), F.col("high").alias("right")).distinct(), "near-copies-more-links",
        )
        links = found if links is None else written(links.unionByName(found), "near-copies-more-links")
        if not some:
            return links
        first = found.limit(1).count() > 0
        waiting = regrouped(waiting.join(chosen, ["left", "right", "low", "high"], "left_anti"), components(found))


def regrouped(pairs: DataFrame, tops: DataFrame) -> DataFrame:
    """``pairs`` of groups (low, high) by the groups that they now belong to; pairs within one go."""
    for name in ("low", "high"):
        pairs = pairs.join(tops.select(F.col("node").alias(name), "root"), name, "left").withColumn(
            name, F.coalesce("root", name)
        ).drop("root")
    low, high = F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")
    return pairs.where(F.col("low") != F.col("high")).select("left", "right", low, high, "most")


def joined_groups(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after ``links`` (left, right) between groups."""
    tops = components(links)
    top = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(
        tops.join(roots, "node", "left_anti")
    )


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
    similarity: float = 0.8, seed: int = 42, crowd: int = 32,
) -> DataFrame:
    """One row per document: its id, the MD5 digest of its text and its group's least node.

    Words and short texts are as in SimHash groups. Texts without a word are copies of each other.
    Groups are what links of at least ``similarity`` connect. Pairs that share no band, 3 in a million
    at 0.8 and fewer above, do not meet. Values that more than ``crowd`` nodes share are worked on in
    another way, with the same result. Repeated rows give repeated rows.
    """
    prints = written(signatures(docs, id_col, text_col, shingle, seed), "near-copies-signatures")
    distinct = written(
        prints.groupBy("node").agg(F.min(F.struct("digest", "id", "fingerprint", "bands")).alias("least"))
        .select("node", "least.digest", "least.id", "least.fingerprint", "least.bands"), "near-copies-nodes"
    )
    close = written(simhash_pairs(distinct), "near-copies-simhash-pairs")
    key = ["band", "value"]
    table = distinct.select("node", F.posexplode("bands").alias(*key))
    shared = table.join(table.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), key)
    partners = shared.groupBy("node").agg(F.sum("n").alias("partners"))
    shared = written(shared.join(partners, "node"), "near-copies-shared")
    # each band has its own centre: the member whose number comes first when mixed with the band
    centre = F.min(F.struct(F.xxhash64("node", "band").alias("order"), "node"))["node"]
    leader = F.min(F.struct((-F.col("partners")).alias("order"), "node"))
    heads = shared.groupBy(*key).agg(centre.alias("centre"), leader.alias("leader"))
    members = written(shared.join(heads, key), "near-copies-members")
    compared = members.select("node").unionByName(
        close.select(F.explode(F.array("left", "right")).alias("node"))
    ).distinct()
    sets = written(
        sets_of(docs, id_col, text_col, compared, distinct.select("node", "digest", "id"), shingle, seed),
        "near-copies-sets",
    )
    stars = members.groupBy("node").agg(F.min("leader")["node"].alias("leader")).where(F.col("node") != F.col("leader"))
    links = written(
        verified(close.unionByName(stars.select(*ordered("node", "leader"))).distinct(), sets, similarity),
        "near-copies-links",
    )
    roots = components(links)
    about = written(
        sets.select("node", "size", "counts").join(roots, "node", "left")
        .select("node", F.struct("node", F.coalesce("root", "node").alias("root"), "size", "counts").alias("one")),
        "near-copies-grouped",
    )
    small = members.where(F.col("n") <= crowd).join(about, "node").groupBy(*key).agg(
        F.collect_list("one").alias("all"), F.min("one.root").alias("least"), F.max("one.root").alias("most")
    )
    within = small.where(F.col("least") != F.col("most")).select("all", F.explode("all").alias("one")).select(
        "one",
        F.explode(F.filter(
            "all", lambda m: (m["node"] > F.col("one.node")) & (m["root"] != F.col("one.root"))
        )).alias("other"),
    )
    large = members.where(F.col("n") > crowd)
    most = Window.partitionBy(*key).orderBy(F.desc("partners"), "node")
    hubs = shared.where(F.col("n") > crowd).withColumn("place", F.row_number().over(most)).where(
        F.col("place") <= HUBS
    ).select(*key, "node").unionByName(large.select(*key, F.col("centre").alias("node"))).distinct()
    met = hubs.join(about, "node").groupBy(*key).agg(F.collect_list("one").alias("hubs"))
    crowded = large.select("node", *key).join(about, "node").join(met, key).select(
        "one", F.explode(F.filter("hubs", lambda m: m["root"] != F.col("one.root"))).alias("other")
    )
    chosen = written(possible(within.unionByName(crowded), similarity), "near-copies-chosen")
    more = written(verified(chosen, sets, similarity), "near-copies-more-links")
    # from here on a group of the first round is one node
    roots = written(
        joined_groups(roots, more.select(F.col("low").alias("left"), F.col("high").alias("right")).distinct()),
        "near-copies-roots",
    )
    grouped = large.select("node", *key).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_groups = grouped.groupBy(*key).agg(F.min("root").alias("least"), F.max("root").alias("most")).where(
        F.col("least") != F.col("most")
    )
    left = written(grouped.join(mixed_groups, key, "left_semi").select("node", "root").distinct(), "near-copies-left")
    if left.limit(1).count():
        rest = linked(met_on(rare_shingles(sets, left, similarity), similarity), sets, similarity)
        roots = joined_groups(roots, rest)
    return prints.select("id", "digest", "node").join(roots, "node", "left").select(
        F.col("id").alias(id_col), "digest", F.coalesce("root", "node").alias("group")
    )
