"""Concatenate and cut: documents packed into fixed windows of token ids.

Pass one encodes each partition of the input and writes the ids with their place in the
partition. The totals of the partitions, one number each, give every partition its global offset
by a prefix sum. Pass two adds the offset to each row and cuts it at the multiples of the window;
a row that crosses a border leaves a piece on either side. No partition waits for another, and
only the totals meet in one place.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm.common import (
    SpanMemory, edges_of, id_and_text, id_type, released, slices, strings, written,
)
from opsloom.llm.token_counts import byte_symbols

BLOCK = 1 << 18      # ids in one stored row at most
SLICE = 1 << 19      # bytes of text encoded at once; the hashes at each of them take a multiple


class WordIds:
    """Ids of texts under a word-level byte-pair file, through the library's own merges.

    The library lower-cases a text, cuts it at white space and character classes and merges each
    word by itself. Texts of plain Latin characters are cut here by the same classes, and only
    words not met lately are merged; all other texts, and those that may hold special strings,
    go to the library whole.
    """

    def __init__(self, content: bytes, remembered: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content.decode())
        self.merge = self.library.model.tokenize
        split = self.library.pre_tokenizer.pre_tokenize_str
        kinds = {"a": [], "!": [], "1": []}
        space = []
        for point in range(256):
            character = chr(point)
            if not split(character):
                space.append(character)
            elif character.lower() == character:
                kind = next((k for k in "a!" if len(split(k + character)) == 1), "1")
                kinds[kind].append(re.escape(character))
        letters, numbers, others = ("".join(kinds[k]) for k in "a1!")
        self.words = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{numbers}]|[{others}]+")
        # the bytes of a word as the vocabulary writes them
        self.shown = {b: c for c, b in byte_symbols().items()}
        # texts with other white space than ASCII's go to the library
        odd = {c for c in map(chr, range(256)) if c.isspace()} | set(space)
        odd -= set("\t\n\v\f\r ")
        self.plain = re.compile("[\x00-\xff]*").fullmatch
        self.odd = ["<|", *sorted(odd)]
        self.memory = SpanMemory(self.chunk, remembered)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def chunk(self, content: bytes) -> list[int]:
        """Ids of a lower-case text without white space."""
        ids = []
        for word in self.words.findall(content.decode()):
            if not word.isascii() or not word.isprintable():
                word = "".join([self.shown[b] for b in word.encode()])
            ids += [token.id for token in self.merge(word)]
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out = [b""] * len(texts)
        rows, lower = [], []
        for row, text in enumerate(texts):
            if not self.plain(text) or any(map(text.__contains__, self.odd)):
                out[row] = self.whole(text)
            else:
                rows.append(row)
                lower.append(text.lower().encode())
        if not rows:
            return out
        blob = b"\n".join(lower)
        data = np.frombuffer(blob, dtype=np.uint8)
        begins, ends = edges_of(~((data == 32) | ((data >= 9) & (data <= 13))))
        ids, sizes = self.memory.ids(blob, begins, ends)
        places = np.cumsum(np.append(0, [len(t) + 1 for t in lower]))
        reached = np.append(0, np.cumsum(sizes))
        cuts = reached[np.searchsorted(begins, places)].tolist()
        for row, begin, end in zip(rows, cuts, cuts[1:]):
            out[row] = ids[begin:end].tobytes()
        return out


_WORDS: dict[tuple[int, int], WordIds] = {}


def id_rows(
    batches: Iterator[pa.RecordBatch], words: WordIds, part: int, end: bytes
) -> Iterator[pa.RecordBatch]:
    """Rows of ids, each text ended by ``end``, with their place in the partition."""
    names = ["id", "part", "place", "start", "length", "doc_tokens", "ids"]
    place = 0
    for batch in batches:
        for piece in slices(batch, "text", SLICE):
            rows = []
            for name, ids in zip(piece.column("id"), words.encode(strings(piece.column("text")))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, BLOCK):
                    block = ids[4 * start:4 * (start + BLOCK)]
                    rows.append((name, part, place, start, len(block) // 4, total, block))
                    place += len(block) // 4
            columns = list(zip(*rows))
            kinds = [piece.column("id").type, pa.int32(), *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )


def encoded(
    docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str, remembered: int
) -> DataFrame:
    """Pass one: rows of ids with their partition and their place in it."""
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(content.value), remembered
        if key not in _WORDS:
            _WORDS.clear()
            _WORDS[key] = WordIds(content.value, remembered)
        yield from id_rows(batches, _WORDS[key], TaskContext.get().partitionId(), end)
        _WORDS.clear()
        released()

    kind = id_type(docs, id_col)
    return id_and_text(docs, id_col, text_col).mapInArrow(
        encode,
        f"id {kind}, part int, place long, start long, length long, doc_tokens long, ids binary",
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id",
    text_col: str = "text", remembered: int = 400_000,
) -> DataFrame:
    """One row per piece: its document, place in the document, sequence, offset there and ids.

    Every document ends with ``end_id``, so a null or empty text is one id. Sequences are full
    but for the last. Pieces are cut at sequence borders, and in documents beyond 262,144 ids also
    between stored rows. Repeated rows are packed as often as they occur; other columns are not
    read. ``padded`` is the length the piece's sequence is padded to: the window, or for the last
    sequence the least power of two that holds it. The ids are 32-bit little-endian.
    """
    rows = written(encoded(docs, vocabulary, end_id, id_col, text_col, remembered), "packed-ids")
    totals = rows.groupBy("part").agg(F.sum("length").alias("total"))
    # one row per partition of the input
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(
        "part", (F.sum("total").over(running) - F.col("total")).alias("base"),
        F.sum("total").over(everything).alias("all_ids"),
    )
    placed = rows.join(F.broadcast(offsets), "part").withColumn(
        "begin", F.col("base") + F.col("place")
    ).withColumn("end", F.col("begin") + F.col("length"))
    cut = placed.select(
        "id", "start", "begin", "end", "doc_tokens", "all_ids", "ids",
        F.explode(F.sequence(
            F.expr(f"begin div {window}"), F.expr(f"(end - 1) div {window}")
        )).alias("sequence_id"),
    )
    begin = F.greatest("begin", F.col("sequence_id") * window)
    end = F.least("end", (F.col("sequence_id") + 1) * window)
    rest = F.col("all_ids") - F.col("sequence_id") * window
    padded = F.when(rest >= window, window).otherwise(
        F.pow(F.lit(2), F.ceil(F.log2(rest.cast("double"))))
    )
    return cut.select(
        F.col("id").alias(id_col),
        (F.col("start") + begin - F.col("begin")).alias("start"),
        (end - begin).alias("length"),
        "doc_tokens", "sequence_id",
        (begin - F.col("sequence_id") * window).alias("offset"),
        padded.cast("long").alias("padded"),
        F.substring(
            F.col("ids"), ((begin - F.col("begin")) * 4 + 1).cast("int"),
            ((end - begin) * 4).cast("int"),
        ).alias("ids"),
    )
