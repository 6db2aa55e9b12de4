"""Removal of repeated passages by induced suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts earlier is removed. Sorting
all suffixes of a corpus moves many times its size, so, as in induced sorting, only a sample
of the suffixes is sorted and the others are induced from the next sampled suffix after them.
The sampled suffixes are anchors: in each window of ``length`` bytes the gram with the least
hash is one, so two equal windows have the same anchors at the same places.

1. Anchors (gram, context, document, place) are sorted by Spark's disk-backed shuffle. An anchor
   whose whole context (all that a window around it can reach) stood earlier repeats entirely.
2. Anchors whose gram repeats in different contexts are sorted by the bytes that follow, with
   the common-prefix values of neighbours. The order of the suffixes that begin d bytes
   before an anchor is induced: two of them share a window exactly if the d bytes before the
   anchors agree and the anchors' suffixes share ``length - d`` bytes.
3. Grams with very many different contexts are settled window by window with aggregates, so no
   task holds all rows of a gram.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import edges_of, id_type, raw, releasing, slices, span_hashes, written

LENGTH, GRAM = 100, 24
CROWD = 20_000
BLOCK_ROWS = 20_000
ANCHOR_BYTES = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each run of ``width`` values, by doubling."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    if reach < width:
        out = pick(out[:len(out) - (width - reach)], out[width - reach:])
    return out


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    begins = np.arange(len(data) - gram + 1)
    return mixed(span_hashes(data, begins, begins + gram, 0))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Places of the anchors in a buffer of several texts, and their gram hashes."""
    if len(data) < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    width = length - gram + 1
    hashes = gram_hashes(data, gram)
    windows = np.zeros(len(data) - length + 1, dtype=bool)
    for begin, end in zip(offsets[:-1], offsets[1:]):
        if end - begin >= length:
            windows[begin:end - length + 1] = True
    least = np.where(windows, sliding(hashes, width, np.minimum), np.uint64(0))
    border = np.zeros(width - 1, dtype=np.uint64)
    greatest = sliding(np.concatenate([border, least, border]), width, np.maximum)
    places = np.flatnonzero((greatest == hashes) & (greatest > 0))
    return places, hashes[places]


def spans_of(names: list[np.ndarray], begins: np.ndarray, ends: np.ndarray):
    """Spans of each document merged where they touch; the arrays are sorted by document and begin."""
    if not len(begins):
        return np.zeros(0, dtype=np.int64), begins, ends
    same = np.ones(len(begins), dtype=bool)
    same[0] = False
    for name in names:
        same[1:] &= name[1:] == name[:-1]
    run = np.cumsum(~same)
    reach = np.maximum.accumulate(ends + run * (1 << 40)) - run * (1 << 40)
    fresh = ~same
    fresh[1:] |= begins[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(begins)) - 1
    return first, begins[first], reach[last]


ROWS = "gram long, context long, id long, tag int, place int, upto int"
HITS = "id long, tag int, place int, upto int, gram long"


def find_anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors of every text, and as spans those whose context stands earlier in the same slice."""
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", ANCHOR_BYTES):
                offsets, data = raw(part.column("text"))
                places, grams = anchors(data, offsets, length, gram)
                if not len(places):
                    continue
                row = np.searchsorted(offsets, places, side="right") - 1
                start, end = offsets[row], offsets[row + 1]
                left, right = np.maximum(start, places - before), np.minimum(end, places + length)
                context = mixed(
                    span_hashes(data, left, right, 1) ^ (places - left).astype(np.uint64)
                )
                ids = part.column("id").to_numpy(zero_copy_only=False)[row]
                tags = part.column("tag").to_numpy(zero_copy_only=False)[row]
                place = places - start
                order = np.lexsort((place, tags, ids, context, grams))
                again, first = repeats(order, grams, context, ids, tags, place)
                kept = order[first]
                hits = order[again]
                hits = hits[np.lexsort((place[hits], tags[hits], ids[hits]))]
                at, begin, upto = spans_of(
                    [ids[hits], tags[hits]], (left - start)[hits], (right - start)[hits]
                )
                hits = hits[at]
                yield batch_of(
                    ROWS,
                    np.concatenate([grams[kept], mixed(ids[hits].astype(np.uint64))]).view(np.int64),
                    np.concatenate([context[kept], np.zeros(len(hits), dtype=np.uint64)]).view(np.int64),
                    np.concatenate([ids[kept], ids[hits]]),
                    np.concatenate([tags[kept], tags[hits]]),
                    np.concatenate([place[kept], begin]).astype(np.int32),
                    np.concatenate([np.zeros(len(kept), dtype=np.int64), upto]).astype(np.int32),
                )

    return rows.mapInArrow(releasing(run), ROWS)


def repeats(order, grams, context, ids, tags, place):
    """For sorted anchors: which repeat the first of their context elsewhere, and which are first."""
    g, c = grams[order], context[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    head = order[first]
    same = (ids[order] == ids[head]) & (tags[order] == tags[head]) & (place[order] == place[head])
    return ~fresh & ~same, fresh


def batch_of(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names, kinds = zip(*[c.split() for c in schema.split(", ")])
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[k]) for c, k in zip(columns, kinds)], names=list(names)
    )


def sift(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of anchors whose context stands earlier, and anchors whose gram has more contexts.

    Rows come sorted by gram, context, document and place. Of the rows read so far only the first
    of the current context, and of the current gram while it has one context, are held.
    """
    before = length - gram
    key = ["gram", "context", "id", "tag", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None       # first row of the current context
        single = False    # the current gram has had one context, not passed on yet
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in [*key, "upto"]]
            ready = columns[5] > 0
            passed = [c[ready] for c in columns]
            columns = [c[~ready] for c in columns]
            if len(columns[0]):
                if head is not None:     # the carried first row leads the batch
                    columns = [np.append(h, c).astype(c.dtype) for h, c in zip(head, columns)]
                grams, context, ids, tags, place, _ = columns
                order = np.arange(len(grams))
                again, fresh = repeats(order, grams, context, ids, tags, place)
                new_gram = np.ones(len(grams), dtype=bool)
                new_gram[1:] = grams[1:] != grams[:-1]
                run_of = np.cumsum(new_gram) - 1
                contexts = np.bincount(run_of, weights=fresh)
                open_ = fresh & (contexts[run_of] > 1)
                if head is not None and not single:     # its contexts were passed on before
                    open_[run_of == 0] = fresh[run_of == 0]
                    open_[0] = False
                last = np.flatnonzero(fresh)[-1]
                carried_on = head is not None and not single and run_of[-1] == 0
                single = contexts[run_of[-1]] == 1 and not carried_on
                head = [c[last] for c in columns]
                yield batch_of(
                    HITS,
                    np.concatenate([ids[again], ids[open_]]),
                    np.concatenate([tags[again], tags[open_]]),
                    np.concatenate([np.maximum(place[again] - before, 0), place[open_]]),
                    np.concatenate([place[again] + length, np.zeros(open_.sum(), dtype=np.int32)]),
                    np.concatenate([np.zeros(again.sum(), dtype=np.int64), grams[open_]]),
                )
            if len(passed[0]):
                _, _, ids, tags, place, upto = passed
                yield batch_of(HITS, ids, tags, place, upto, np.zeros(len(ids), dtype=np.int64))

    return (
        rows.repartition("gram").sortWithinPartitions(*key).mapInArrow(releasing(run), HITS)
    )


CONTEXTS = "gram long, id long, tag int, place int, before binary, after binary"
WINDOWS = "gram long, first long, second long, id long, tag int, place int"


def contexts(opened: DataFrame, length: int, gram: int) -> DataFrame:
    """The bytes before (nearest first) and after each anchor; rows have a text and its anchors."""
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for row in zip(*[part.column(n).to_pylist() for n in ("id", "tag", "text", "found")]):
                    name, tag, text, found = row
                    for one in found:
                        at = one["place"]
                        out.append((one["gram"], name, tag, at, text[max(0, at - before):at][::-1],
                                    text[at:at + length]))
                if out:
                    yield batch_of(CONTEXTS, *zip(*out))

    return opened.mapInArrow(releasing(run), CONTEXTS)


def windows_of(opened: DataFrame, length: int, gram: int) -> DataFrame:
    """Every window around each anchor as two hashes of its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for row in zip(*[part.column(n).to_pylist() for n in ("id", "tag", "text", "found")]):
                    name, tag, text, found = row
                    data = np.frombuffer(text, dtype=np.uint8)
                    at = np.array([one["place"] for one in found], dtype=np.int64)
                    grams = np.array([one["gram"] for one in found], dtype=np.int64)
                    begin = (at[:, None] - np.arange(length - gram + 1)[None]).ravel()
                    grams = np.repeat(grams, length - gram + 1)
                    inside = (begin >= 0) & (begin + length <= len(data))
                    begin, grams = begin[inside], grams[inside]
                    size = len(begin)
                    yield batch_of(
                        WINDOWS, grams,
                        *[mixed(span_hashes(data, begin, begin + length, k)).view(np.int64) for k in (0, 1)],
                        np.full(size, name, dtype=np.int64), np.full(size, tag, dtype=np.int32),
                        begin.astype(np.int32),
                    )

    return opened.mapInArrow(releasing(run), WINDOWS)


def classes(matrix: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by group and bytes, and common prefix of each with the one before (0: group border)."""
    wide = np.zeros((len(matrix), -(-matrix.shape[1] // 4) * 4), dtype=">u2")
    wide[:, :matrix.shape[1]] = matrix
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], group))
    common = np.zeros(len(matrix), dtype=np.int64)
    unlike = matrix[order[1:]] != matrix[order[:-1]]
    common[1:] = np.where(unlike.any(1), unlike.argmax(1), matrix.shape[1])
    common[1:] = np.minimum(common[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    common[1:][group[order[1:]] != group[order[:-1]]] = -1
    common[:1] = -1
    return order, common


def induced(group, before, before_size, after, after_size, length: int, gram: int):
    """(row, begin, end) spans, relative to the anchors, of windows that an earlier row has too.

    Rows are sorted by document and place within their group.
    """
    size, reach = len(group), length - gram
    left_order, left_common = classes(before, before_size, group)
    right_order, right_common = classes(after, after_size, group)

    def most(order, common):
        out = np.zeros(size, dtype=np.int64)
        out[order] = np.maximum(common, np.append(common[1:], -1))
        return out

    able = most(left_order, left_common) + most(right_order, right_common) >= length
    found = np.zeros((reach + 1, size), dtype=bool)
    left, right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for d in range(reach + 1):
        fits = np.flatnonzero(able & (before_size >= d) & (after_size >= length - d))
        if not len(fits):
            continue
        left[left_order] = np.cumsum(left_common < d)
        right[right_order] = np.cumsum(right_common < length - d)
        _, first = np.unique(left[fits] * (size + 1) + right[fits], return_index=True)
        later = np.ones(len(fits), dtype=bool)
        later[first] = False
        found[d, fits[later]] = True
    framed = np.zeros((reach + 3, size), dtype=np.int8)
    framed[1:-1] = found
    steps = np.diff(framed, axis=0)
    begin_row, begin_d = np.nonzero((steps == 1).T)
    end_row, end_d = np.nonzero((steps == -1).T)
    # distances begin_d .. end_d - 1 repeat: from the farthest begin to the nearest window's end
    return begin_row, 1 - end_d, length - begin_d


def settle(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans found by inducing within each gram; whole grams are read in blocks."""
    reach = length - gram

    def matrix(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
        offsets, data = raw(values)
        sizes = np.diff(offsets)
        out = np.zeros((len(sizes), width), dtype=np.uint16)    # bytes from 1 on; 0: no byte
        column = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
        out[np.repeat(np.arange(len(sizes)), sizes), column] = data.astype(np.uint16) + 1
        return out, sizes

    def block(table: pa.Table) -> pa.RecordBatch:
        part = table.combine_chunks().to_batches()[0]
        grams, ids, tags, place = [
            part.column(n).to_numpy(zero_copy_only=False) for n in ("gram", "id", "tag", "place")
        ]
        group = np.cumsum(np.append(False, grams[1:] != grams[:-1]))
        row, begin, end = induced(
            group, *matrix(part.column("before"), reach), *matrix(part.column("after"), length),
            length, gram,
        )
        return batch_of(HITS, ids[row], tags[row], (place[row] + begin).astype(np.int32),
                        (place[row] + end).astype(np.int32), grams[row])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column("gram").to_numpy(zero_copy_only=False)
            if count and count + batch.num_rows > BLOCK_ROWS:
                borders = np.flatnonzero(np.append(held[-1].column("gram")[-1].as_py(), grams[:-1]) != grams)
                if len(borders):     # up to the last gram border, rows can be settled
                    cut = int(borders[-1])
                    yield block(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                    held, count = [], 0
                    batch = batch.slice(cut)
            held.append(batch)
            count += batch.num_rows
        if held:
            yield block(pa.Table.from_batches(held))

    return (
        rows.repartition("gram").sortWithinPartitions("gram", "id", "tag", "place")
        .mapInArrow(releasing(run), HITS)
    )


def earlier_windows(windows: DataFrame, length: int) -> DataFrame:
    """Windows that an earlier document or place has too, by aggregates that combine on the map side."""
    key = ["gram", "first", "second"]
    least = windows.groupBy(*key).agg(
        F.min(F.struct("id", "tag", "place")).alias("least"), F.count("*").alias("n")
    ).where(F.col("n") > 1)
    return windows.join(least, key).where(F.struct("id", "tag", "place") > F.col("least")).select(
        "id", "tag", "place", (F.col("place") + length).cast("int").alias("upto"), "gram"
    )


def once(texts: DataFrame) -> DataFrame:
    """Texts with repeated rows of one id and tag once; copies meet first where they are read."""
    again = texts.groupBy("id", "tag").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    if again.isEmpty():
        return texts
    return written(texts.groupBy("id", "tag").agg(F.min("text").alias("text")), "passages-once")


def repeated_spans(texts: DataFrame, length: int, gram: int, crowd: int) -> DataFrame:
    """(id, tag, spans): what to remove from each text, spans as they were found."""
    texts = once(texts)
    hits = written(sift(find_anchors(texts, length, gram), length, gram), "passage-anchors")
    opened = hits.where(F.col("upto") == 0)
    crowded = written(
        opened.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("gram"),
        "passage-crowded",
    )
    def with_texts(rows: DataFrame) -> DataFrame:
        found = rows.groupBy("id", "tag").agg(F.collect_list(F.struct("place", "gram")).alias("found"))
        return texts.join(found, ["id", "tag"]).select("id", "tag", "text", "found")

    plain = settle(
        contexts(with_texts(opened.join(crowded, "gram", "left_anti")), length, gram), length, gram
    )
    every = hits.where(F.col("upto") > 0).unionByName(plain)
    if not crowded.isEmpty():
        many = with_texts(opened.join(crowded, "gram", "left_semi"))
        every = every.unionByName(earlier_windows(windows_of(many, length, gram), length))
    return every.groupBy("id", "tag").agg(F.collect_list(F.struct("place", "upto")).alias("spans"))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
    crowd: int = CROWD, carry: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs, digest and bytes of what is kept.

    Texts are read as UTF-8 bytes. A byte goes if it lies in a string of ``length`` bytes that
    also starts earlier: in a document of smaller id, or earlier in the same one. Rows that repeat
    id and text are one document; rows that share an id but not a text are documents of their own,
    ordered by a hash of the text. Rows without an id come last. A null text is empty. Other
    columns are read only if ``carry`` names them, and come behind the others. ``crowd`` is the
    number of contexts beyond which a gram is settled by aggregates. With ``as_text`` the kept
    bytes come as text, without the characters that a cut has split.
    """
    last = (1 << 63) - 1
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"),
        F.hash(F.col(text_col)).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        *[F.col(name).alias(f"carried_{i}") for i, name in enumerate(carry)],
    )
    gram = min(GRAM, length)
    found = repeated_spans(texts.select("id", "tag", "text"), length, gram, crowd)
    kind = id_type(docs, id_col)
    extra = [f"carried_{i}" for i in range(len(carry))]
    joined = texts.join(found, ["id", "tag"], "left").select(
        F.when(F.col("id") < last, F.col("id")).cast(kind).alias("own_id"), "text", "spans", *extra
    )
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *carry]
    kinds = [kind, "long", "long", "long", "string", "string" if as_text else "binary",
             *[docs.schema[name].dataType.simpleString() for name in carry]]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [removed(text, spans) for text, spans in zip(
                    part.column("text").to_pylist(), part.column("spans").to_pylist()
                )]
                if as_text:
                    rows = [(*row[:-1], row[-1].decode(errors="ignore")) for row in rows]
                types = [pa.int64()] * 3 + [pa.string(), pa.string() if as_text else pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("own_id"), *[pa.array(c, t) for c, t in zip(zip(*rows), types)],
                     *[part.column(name) for name in extra]],
                    names=names,
                )

    return joined.mapInArrow(releasing(cut), ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def removed(text: bytes, spans: list[dict] | None) -> tuple[int, int, int, str, bytes]:
    kept, runs = text, 0
    if spans:
        marked = np.zeros(len(text) + 1, dtype=np.int32)
        begins = np.array([s["place"] for s in spans])
        ends = np.minimum(np.array([s["upto"] for s in spans]), len(text))
        np.add.at(marked, begins, 1)
        np.add.at(marked, ends, -1)
        gone = np.cumsum(marked)[:-1] > 0
        runs = len(edges_of(gone)[0])
        kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
    return len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept
