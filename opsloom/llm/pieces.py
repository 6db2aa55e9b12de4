"""SentencePiece encoding and decoding by a table of last tokens.

Merging pieces by score gives every prefix of a text exactly one last piece: of the pieces that
end there (matches of the piece automaton), the one that may stand next to the last piece of the
prefix before it. Whether two pieces may stand side by side is found by merging the text of the
pair alone and is remembered. The table is filled from left to right; the ids are then read
backwards, from the last piece of the whole text to the first. No piece reaches over the
border before a word mark, so a text is encoded word by word and words are remembered.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opsloom.llm.automaton import TokenAutomaton
from opsloom.llm.common import SpanMemory, gathered, id_and_text, id_type, slices, strings

MARK = "▁"
PROBES = ["", " ", "a", "  a  b ", "a\nb\t", "▁x", "ﬁéé", "<s></s><unk>", "\U0001f600世"]


class PieceModel:
    """Pieces, scores and byte pieces of a byte-pair model, and its last-token tables."""

    def __init__(self, content: bytes, remembered: int):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=content)
        plain = [
            i for i in range(library.piece_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i)
                    or library.is_unused(i))
        ]
        self.id = {library.id_to_piece(i): i for i in plain}
        self.score = {piece: library.get_score(i) for piece, i in self.id.items()}
        self.text = {i: piece for piece, i in self.id.items()}
        bytes_ = [i for i in range(library.piece_size()) if library.is_byte(i)]
        self.byte_id = {int(library.id_to_piece(i)[1:-1], 16): i for i in bytes_}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        if len(self.byte_id) != 256 or any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("byte pieces, and word marks at the start of pieces only, are expected")
        together = {c for p in self.id if len(p) > 1 for c in p}
        if together - self.id.keys():
            raise ValueError("a longer piece holds a character that is no piece")
        # line breaks and other characters that no longer piece holds stand alone
        self.alone = [ord(c) for c in "\n\t|" if c not in together]
        self.known: dict[tuple[int, int], bool] = {}
        self.whole = {p: i for p, i in self.id.items() if len(p) == 1 or self.merged(p) == [p]}
        self.automaton = TokenAutomaton(self.whole)
        self.memory = SpanMemory(lambda word: self.word_ids(word.decode().replace(" ", MARK)), remembered)
        shown = [self.shown(i) for i in range(library.piece_size())]
        self.pieces = Flat(shown)
        self.numbers = Flat([b"%d," % i for i in range(library.piece_size())])
        for probe in PROBES:
            [(ids, numbers, decoded)] = self.encode([probe])
            if ids.tolist() != library.encode(probe) or decoded.decode() != library.decode(ids.tolist()):
                raise ValueError("a byte-pair model with a leading mark and no normalisation is expected")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best neighbours again and again, leftmost first."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        waiting: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            both = parts[left] + parts[right]
            if both in self.score:
                heapq.heappush(waiting, (-self.score[both], left, right, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while waiting:
            _, left, right, both = heapq.heappop(waiting)
            if parts[left] is None or parts[right] is None or parts[left] + parts[right] != both:
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [p for p in parts if p is not None]

    def compatible(self, left: int, right: int) -> bool:
        found = self.known.get((left, right))
        if found is None:
            pair = [self.text[left], self.text[right]]
            found = self.known[left, right] = self.merged("".join(pair)) == pair
        return found

    def word_ids(self, word: str) -> list[int]:
        """Fill the table of last pieces, then read the ids backwards."""
        automaton, known, node = self.automaton, self.known, 0
        goto, ends, fail = automaton.goto, automaton.ends, automaton.fail
        last: list[int] = [-1]      # last piece of each prefix; -1: a piece border like the start
        size: list[int] = [0]
        begin = 0                   # places before this one can't be reached back to
        for i, symbol in enumerate(word):
            while node and symbol not in goto[node]:
                node = fail[node]
            node = goto[node].get(symbol, 0)
            for piece, length in ends[node]:
                at = i + 1 - length
                if at < begin:
                    continue
                left = last[at]
                if at == begin:
                    break
                fits = known.get((left, piece))
                if fits is None:
                    fits = self.compatible(left, piece)
                if fits:
                    break
            else:                   # a character without a piece becomes its bytes
                piece, length, node, begin = -1, 1, 0, i + 1
            last.append(piece)
            size.append(length)
        ids: list[int] = []
        at = len(word)
        while at:
            if last[at] >= 0:
                ids.append(last[at])
            else:
                ids += [self.byte_id[b] for b in reversed(word[at - 1].encode())]
            at -= size[at]
        return ids[::-1]

    def shown(self, i: int) -> bytes:
        """What an id decodes to: its piece with marks as blanks, or its byte."""
        if i in self.byte_of:
            return bytes([self.byte_of[i]])
        return self.text.get(i, "").replace(MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes, bytes]]:
        """For each text its ids, the ids as decimal text, and the text they decode to.

        Decoding joins the pieces and bytes of the ids and takes off the blank before the text.
        """
        parts = [b" " + text.replace(MARK, " ").encode() + b"\0" if text else b"\0" for text in texts]
        blob = b"".join(parts)
        data = np.frombuffer(blob, dtype=np.uint8)
        closing = np.cumsum([len(p) for p in parts]) - 1
        # a word begins at a blank behind another character, and around characters that stand alone
        blank = data == 32
        begin = np.ones(len(data) + 1, dtype=bool)
        begin[1:-1] = blank[1:] & ~blank[:-1]
        alone = np.isin(data, np.array(self.alone, dtype=np.uint8))
        alone[closing] = True
        begin[:-1] |= alone
        begin[1:] |= alone
        borders = np.flatnonzero(begin)
        begins, ends = borders[:-1], borders[1:]
        kept = np.ones(len(begins), dtype=bool)
        kept[np.searchsorted(begins, closing)] = False
        begins, ends = begins[kept], ends[kept]
        ids, sizes = self.memory.ids(blob, begins, ends)
        reached = np.append(0, np.cumsum(sizes))
        cuts = np.append(0, reached[np.searchsorted(begins, closing)])
        numbers, number_cuts = self.numbers.joined(ids, cuts)
        decoded, decoded_cuts = self.pieces.joined(ids, cuts)
        return [
            (ids[cuts[i]:cuts[i + 1]], numbers[number_cuts[i]:number_cuts[i + 1]][:-1],
             decoded[decoded_cuts[i]:decoded_cuts[i + 1]].removeprefix(b" "))
            for i in range(len(texts))
        ]


class Flat:
    """Byte strings by number, joined for arrays of numbers."""

    def __init__(self, strings_: list[bytes]):
        self.sizes = np.array([len(s) for s in strings_], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings_), dtype=np.uint8)

    def joined(self, numbers: np.ndarray, cuts: np.ndarray) -> tuple[bytes, list[int]]:
        """All strings one after another, and where in the bytes each cut of the numbers lies."""
        sizes = self.sizes[numbers]
        reached = np.append(0, np.cumsum(sizes))
        return gathered(self.data, self.begins[numbers], sizes).tobytes(), reached[cuts].tolist()


_MODELS: dict[tuple[int, int], PieceModel] = {}


def loaded(content: bytes, remembered: int) -> PieceModel:
    key = hash(content), remembered
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = PieceModel(content, remembered)
    return _MODELS[key]


def encode_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = 600_000,
) -> DataFrame:
    """One row per document: its ids under a sentencepiece byte-pair model and their decoded text.

    ``remembered`` bounds the words a worker keeps; others are encoded anew. A null or
    empty text has no ids and decodes to an empty text; repeated rows give repeated rows; other
    columns are not read.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    kind = id_type(docs, id_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(content.value, remembered)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = pieces.encode(strings(part.column("text")))
                ids = [row[0].astype(np.int32) for row in rows]
                decoded = [row[2].decode() for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                    names=[id_col, "ids", "decoded"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        encode, f"`{id_col}` {kind}, ids array<int>, decoded string"
    )


def piece_digests(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = 600_000,
) -> DataFrame:
    """As ``encode_pieces``, with digests in place of ids and decoded text.

    The ids never leave the worker: ``n_tokens``, the SHA-256 of the decimal ids joined by commas
    and the SHA-256 of the decoded text.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    kind = id_type(docs, id_col)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(content.value, remembered)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [
                    (len(ids), hashlib.sha256(numbers).hexdigest(), hashlib.sha256(text).hexdigest())
                    for ids, numbers, text in pieces.encode(strings(part.column("text")))
                ]
                n, ids, decoded = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        digest, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
