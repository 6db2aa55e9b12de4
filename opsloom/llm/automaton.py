"""Prefix tree with failure links over token strings, for matching all tokens that end at a place."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence


class TokenAutomaton:
    """Finds, after each symbol, the tokens that end there, longest first.

    ``tokens`` maps a token's symbols (bytes or str) to its id. Node 0 is the root;
    ``ends[node]`` lists (id, length), ``depth[node]`` is the length of the longest token
    beginning that the text read so far ends with, and ``starts[node]`` are the distances back
    to every place at which a longer token may still have begun.
    """

    def __init__(self, tokens: dict[Sequence, int]):
        self.goto: list[dict] = [{}]
        own = [-1]
        for symbols, token in tokens.items():
            node = 0
            for symbol in symbols:
                after = self.goto[node].get(symbol)
                if after is None:
                    after = self.goto[node][symbol] = len(self.goto)
                    self.goto.append({})
                    own.append(-1)
                node = after
            own[node] = token
        size = len(self.goto)
        self.depth, self.fail = [0] * size, [0] * size
        self.ends: list[tuple] = [()] * size
        self.starts: list[tuple] = [(0,)] * size
        waiting = deque([0])
        while waiting:
            node = waiting.popleft()
            for symbol, after in self.goto[node].items():
                self.depth[after] = self.depth[node] + 1
                back = self.step(self.fail[node], symbol) if node else 0
                self.fail[after] = back
                mine = ((own[after], self.depth[after]),) if own[after] >= 0 else ()
                self.ends[after] = mine + self.ends[back]
                longer = (self.depth[after],) if self.goto[after] else ()
                self.starts[after] = longer + self.starts[back]
                waiting.append(after)

    def step(self, node: int, symbol) -> int:
        while node and symbol not in self.goto[node]:
            node = self.fail[node]
        return self.goto[node].get(symbol, 0)
