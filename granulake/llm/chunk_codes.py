"""Tokenized chunks, remembered: what the operators on tokenizers share.

A tokenizer that never merges across certain places codes the text between two
such places the same wherever it stands. Chunks are numbered as they turn up,
their tokens lie one after the other in flat arrays, and the tokens of a batch
of texts are gathered from there in a few array operations.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

#: Chunks remembered at most; beyond it a task starts afresh, with the same results.
KNOWN_CHUNKS = 200_000


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()), dtype=np.int64)


class ChunkCodes:
    """The token ids of each chunk met; what is new in a batch is coded together.

    `code` gives the token ids of several chunks.
    """

    def __init__(self, code: Callable[[list[str]], list[list[int]]], known: int = KNOWN_CHUNKS) -> None:
        self.code, self.known = code, known
        self._fresh()

    def _fresh(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self, chunks: list[str]) -> None:
        rows = self.code(chunks)
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks)), strict=True))
        ends = np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)))
        new = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(ends[-1]))
        self.ids = np.concatenate([self.ids, new])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])

    def tokens(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts given as their chunks, and where each text ends."""
        if len(self.number) > self.known:
            self._fresh()
        new = [c for c in dict.fromkeys(chain.from_iterable(texts)) if c not in self.number]
        if new:
            self._learn(new)
        chunk_ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
        numbers = np.fromiter(
            map(self.number.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(chunk_ends[-1])
        )
        counts = self.ends[numbers + 1] - self.ends[numbers]
        at = ranges(self.ends[numbers], counts)
        return self.ids[at], np.concatenate([[0], np.cumsum(counts)])[chunk_ends]
