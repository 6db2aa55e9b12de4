"""Token counts by a compiled finite-state transducer.

Byte-pair encoding of one pre-token is a deterministic transducer over its bytes. What the rest
of a pre-token needs to know about a prefix is small: which tokens may still be under way (a
node of the token automaton), and for each place where one of them began, the last token of
the prefix that ends there and how many tokens came after it. That is the state. The last token
of a longer prefix is the one automaton match that is compatible with the last token before it,
and each transition carries the change of the token count. States and transitions are compiled
when a text first needs them and kept in a table that numpy reads for thousands of chunks in
step.

A chunk of text begins in a state not known yet. Its map from begin state to end state and count
is a constant from its first pre-token on, and a function of the state only for the bytes before
it. The maps compose from left to right: first all constant parts run side by side, then the
heads, each from the end state of the chunk before; a chunk inside one long pre-token waits for
the chunk before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opsloom.llm.automaton import TokenAutomaton
from opsloom.llm.common import SLICE_BYTES, id_and_text, id_type, raw, slices

NEVER = 1 << 60
BEGIN = -1          # "last token" of the empty prefix
LETTER, NUMBER, SPACE, OTHER, UNKNOWN, OUTSIDE = 0, 1, 2, 3, 8, 9
CHUNK = 512
COUNT_BITS = 12
HALF = 1 << (COUNT_BITS - 1)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Merge ranks, and which token pairs may stand next to each other."""

    def __init__(self, model: dict):
        vocabulary, symbols = model["vocab"], byte_symbols()
        self.text = {i: bytes(symbols[c] for c in token) for token, i in vocabulary.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = vocabulary[left], vocabulary[right]
            token = vocabulary[left + right]
            self.rank[pair] = rank
            if token not in self.made:
                self.made[token], self.parts[token] = rank, pair
        self.edges: dict[tuple[int, int], list[int]] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self.whole = {t for t in self.text if t not in self.made and len(self.text[t]) == 1}
        for token in sorted(self.made, key=self.made.get):
            left, right = self.parts[token]
            if left in self.whole and right in self.whole and self.side_by_side(
                left, right, self.made[token]
            ):
                self.whole.add(token)

    def edge(self, token: int, side: int) -> list[int]:
        """The token and the parts at its left (0) or right (1) edge, down to one byte."""
        found = self.edges.get((token, side))
        if found is None:
            found, part = [token], token
            while part in self.parts:
                part = self.parts[part][side]
                found.append(part)
            self.edges[token, side] = found
        return found

    def side_by_side(self, left: int, right: int, until: int = NEVER) -> bool:
        """True if no merge of a rank below ``until`` joins the edges of two tokens.

        A part at an edge exists from its own merge to the merge that takes it up; a merge across
        the border happens if its rank lies within the life of both parts.
        """
        left_gone = until
        for l in self.edge(left, 1):
            right_gone = until
            for r in self.edge(right, 0):
                rank = self.rank.get((l, r))
                if rank is not None and rank < until and rank < left_gone and rank <= right_gone:
                    return False
                right_gone = self.made.get(r, -1)
            left_gone = self.made.get(l, -1)
        return True

    def compatible(self, left: int, right: int) -> bool:
        found = self.known.get((left, right))
        if found is None:
            found = self.known[left, right] = self.side_by_side(left, right)
        return found


class Transducer:
    """Compiled states and transitions. State 0 is "not known yet", state 1 begins a pre-token."""

    def __init__(self, merges: Merges, max_states: int):
        self.merges, self.max_states = merges, max_states
        self.automaton = TokenAutomaton({merges.text[t]: t for t in merges.whole})
        self.clear()

    def clear(self) -> None:
        begin = (0, ((BEGIN, 0),))
        self.states = [None, begin]
        self.numbers = {begin: 1}
        # pages of the table that no state has reached yet take no memory
        self.table = np.zeros((self.max_states + (1 << 16)) << 8, dtype=np.int32)
        self.table[:256] = HALF

    def put(self, key: int, value: int) -> None:
        if key >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros(len(self.table) // 2, dtype=np.int32)])
        self.table[key] = value

    def look(self, keys: np.ndarray) -> np.ndarray:
        """Next state and change for each (state, byte); compiles the transitions that are missing."""
        if keys.max(initial=0) >= len(self.table):
            self.put(int(keys.max()), 0)
        found = self.table[keys]
        if not found.all():
            missing = np.flatnonzero(found == 0)
            for key in set(keys[missing].tolist()):
                self.compile(key)
            found[missing] = self.table[keys[missing]]
        return found

    def compile(self, key: int) -> None:
        state, byte = key >> 8, key & 255
        node, lasts = self.states[state]
        automaton = self.automaton
        before = dict(zip(automaton.starts[node], lasts))   # distance back -> (last token, tokens since)
        after = automaton.step(node, byte)
        for token, length in automaton.ends[after]:
            last, since = before[length - 1]
            if last == BEGIN or self.merges.compatible(last, token):
                break
        change = 1 - since          # tokens(prefix) = tokens(where the last token began) + 1
        moved = {d + 1: (t, n + change) for d, (t, n) in before.items()}
        moved[0] = (token, 0)
        name = (after, tuple(moved[d] for d in automaton.starts[after]))
        self.put(key, self.number(name) << COUNT_BITS | (change + HALF))

    def number(self, name: tuple) -> int:
        found = self.numbers.get(name)
        if found is None:
            found = self.numbers[name] = len(self.states)
            self.states.append(name)
        return found

    def bounded(self, *live: np.ndarray) -> None:
        """Forget compiled states beyond the bound, all but those in ``live``, numbered anew there."""
        if len(self.states) <= self.max_states:
            return
        names = {n: self.states[n] for n in set(np.concatenate(live).tolist())}
        self.clear()
        anew = {n: 0 if name is None else self.number(name) for n, name in names.items()}
        for numbers in live:
            numbers[:] = [anew[n] for n in numbers.tolist()]

    def run(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Change of the token count at each byte; ``starts`` marks where pre-tokens begin."""
        out = np.zeros(len(data), dtype=np.int32)
        enter = np.ones(1, dtype=np.int32)
        for begin in range(0, len(data), SLICE_BYTES):
            end = begin + SLICE_BYTES
            out[begin:end], enter = self.block(data[begin:end], starts[begin:end], enter)
        return out

    def block(self, data: np.ndarray, starts: np.ndarray, enter: np.ndarray):
        """The same for one block that is entered in a known state; also the state at its end."""
        size = len(data)
        lanes = -(-size // CHUNK)
        padded = np.zeros(lanes * CHUNK, dtype=np.uint8)
        padded[:size] = data
        marks = np.zeros(lanes * CHUNK, dtype=bool)
        marks[:size] = starts
        rows = marks.reshape(lanes, CHUNK)
        first = np.where(rows.any(1), rows.argmax(1), CHUNK)
        columns = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T).astype(np.int32)
        unmarked = np.ascontiguousarray(~rows.T)
        changes = np.zeros((CHUNK, lanes), dtype=np.int16)
        last = size - (lanes - 1) * CHUNK       # bytes in the last lane
        state = np.zeros(lanes, dtype=np.int32)
        state[0], first[0] = enter[0], 0
        low = (1 << COUNT_BITS) - 1
        for i in range(CHUNK):
            n = lanes if i < last else lanes - 1
            value = self.look((np.where(unmarked[i, :n], state[:n], 1) << 8) | columns[i, :n])
            changes[i, :n] = (value & low) - HALF
            state[:n] = value >> COUNT_BITS
            self.bounded(state)
        waiting = np.flatnonzero(first > 0)
        while len(waiting):
            ready = waiting[state[waiting - 1] > 0]
            order = ready[np.argsort(-first[ready], kind="stable")]
            heads = first[order]
            now = state[order - 1]
            for i in range(int(heads[0])):
                n = int(np.searchsorted(-heads, -i, side="left"))
                if n and order[:n].max() == lanes - 1 and i >= last:
                    keep = order[:n] < lanes - 1
                    lane, at = order[:n][keep], np.flatnonzero(keep)
                else:
                    lane, at = order[:n], np.arange(n)
                value = self.look((now[at] << 8) | columns[i, lane])
                changes[i, lane] = (value & low) - HALF
                now[at] = value >> COUNT_BITS
                self.bounded(state, now)
            through = heads == CHUNK
            state[order[through]] = now[through]
            waiting = waiting[~np.isin(waiting, ready)]
        return changes.T.reshape(-1)[:size], state[-1:].copy()


class CharacterClasses:
    """Letter, number, space or other for code points, asked of the tokenizer's own splitter."""

    def __init__(self, split):
        self.split = split
        self.known = np.full(0x110000, UNKNOWN, dtype=np.uint8)

    def of(self, points: np.ndarray) -> np.ndarray:
        classes = self.known[points]
        if (classes == UNKNOWN).any():
            for point in np.unique(points[classes == UNKNOWN]).tolist():
                self.known[point] = self.ask(chr(point))
            classes = self.known[points]
        return classes

    def ask(self, character: str) -> int:
        for kind, neighbour in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.split(neighbour + character)) == 1:
                return kind
        return SPACE


def pre_token_starts(points: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin: contractions, runs of one class with a blank before, white space.

    ``first`` marks the characters that begin a text of their own.
    """
    size = len(points)
    before = np.empty(size, dtype=np.uint8)
    before[:1], before[1:] = OUTSIDE, classes[:-1]
    before[first] = OUTSIDE
    after = np.empty(size, dtype=np.uint8)
    after[-1:], after[:-1] = OUTSIDE, np.where(first[1:], OUTSIDE, classes[1:])
    blank = points == 32
    blank_before = np.zeros(size, dtype=bool)
    blank_before[1:] = blank[:-1]
    blank_before[first] = False
    space = classes == SPACE
    starts = np.where(
        space,
        (before != SPACE) | ((after != SPACE) & (after != OUTSIDE)),
        ~blank_before & (classes != before),
    )
    marks = np.flatnonzero((points == 39) & starts)
    if len(marks):
        padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
        alone = np.concatenate([first, np.ones(3, dtype=bool)])
        one, two = padded[marks + 1], padded[marks + 2]
        inside, inside_two = ~alone[marks + 1], ~alone[marks + 1] & ~alone[marks + 2]
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        long = inside_two & (
            (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l")))
        )
        starts[marks[short | long] + 1] = False
        ends = np.concatenate([marks[short] + 2, marks[long] + 3])
        ends = ends[ends < size]
        ends = ends[classes[ends] == LETTER]
        starts[ends] = True
    return starts | first


class TokenCounter:
    """Counts tokens of UTF-8 texts under one byte-level vocabulary file."""

    def __init__(self, content: bytes, max_states: int):
        from tokenizers import Tokenizer

        described = json.loads(content)
        splitter = described["pre_tokenizer"]
        if described["model"]["type"] != "BPE" or described.get("normalizer") or (
            splitter["type"], splitter["add_prefix_space"], splitter["use_regex"]
        ) != ("ByteLevel", False, True):
            raise ValueError("a byte-level vocabulary without normalisation is expected")
        self.special = [
            t["content"].encode() for t in described["added_tokens"] if not t["normalized"]
        ]
        self.transducer = Transducer(Merges(described["model"]), max_states)
        tokenizer = Tokenizer.from_str(content.decode())
        self.classes = CharacterClasses(tokenizer.pre_tokenizer.pre_tokenize_str)

    def counts(self, texts: pa.Array) -> np.ndarray:
        offsets, data = raw(texts)
        rows = len(offsets) - 1
        extra = np.zeros(rows, dtype=np.int64)
        owner, begins = np.arange(rows), offsets[:-1]
        content = data.tobytes()
        if any(s in content for s in self.special):
            content, begins, owner, extra = self.without_special(offsets, content)
            data = np.frombuffer(content, dtype=np.uint8)
        if len(data) == 0:
            return extra
        points = np.frombuffer(content.decode().encode("utf-32-le"), dtype=np.uint32)
        places = np.flatnonzero((data & 0xC0) != 0x80)
        sizes = np.diff(np.append(begins, len(data)))
        begins, owner = begins[sizes > 0], owner[sizes > 0]
        first = np.zeros(len(points), dtype=bool)
        first[np.searchsorted(places, begins)] = True
        starts = np.zeros(len(data), dtype=bool)
        starts[places[pre_token_starts(points, self.classes.of(points), first)]] = True
        changes = self.transducer.run(data, starts)
        sums = np.add.reduceat(changes, begins, dtype=np.int64)
        return extra + np.bincount(owner, weights=sums, minlength=rows).astype(np.int64)

    def without_special(self, offsets: np.ndarray, content: bytes):
        """Texts cut at the special strings, which count one token each."""
        pieces, owner = [], []
        extra = np.zeros(len(offsets) - 1, dtype=np.int64)
        for row in range(len(offsets) - 1):
            parts = [content[offsets[row]:offsets[row + 1]]]
            for special in self.special:
                parts = [p for part in parts for p in part.split(special)]
            extra[row] = len(parts) - 1
            pieces += parts
            owner += [row] * len(parts)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        return b"".join(pieces), np.cumsum(sizes) - sizes, np.array(owner), extra


_COUNTERS: dict[tuple[int, int], TokenCounter] = {}


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
    text_col: str = "text", max_states: int = 200_000,
) -> DataFrame:
    """One row per document: UTF-8 bytes, tokens, and whether it has more than ``limit`` tokens.

    ``vocabulary`` is a byte-level file for the tokenizers library; special strings in a text count
    as one token each, as that library has it. ``max_states`` bounds the compiled states a worker
    keeps; beyond it they are compiled anew, which changes no count. A null or empty text has 0
    tokens; repeated rows give repeated rows; other columns are not read.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    kind = id_type(docs, id_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(content.value), max_states
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = TokenCounter(content.value, max_states)
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = _COUNTERS[key].counts(part.column("text"))
                offsets, _ = raw(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(offsets)), pa.array(tokens),
                     pa.array(tokens > limit)],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
