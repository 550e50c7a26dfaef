"""A run-length index over a small collection of byte strings, and matching statistics from it.

The strings are laid end to end, each closed by a byte that UTF-8 never has. Suffixes are ordered
by prefix doubling; the Burrows-Wheeler transform is kept as its runs, and suffixes are sampled at
both ends of every run. At a run's end the common prefix with the neighbour is measured; anywhere
else the suffix's left neighbours agree as well, so the common prefix is one less than that of
the suffix one place to the left. Streaming over the text from sample to sample therefore gives
the longest match of every place with any other place, from r samples instead of n.
"""

from __future__ import annotations

import numpy as np

CLOSE = 0xFF


class RunIndex:
    """strings: total bytes without closing bytes; matches are measured up to ``depth`` bytes."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, depth: int = 256):
        n = len(sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.text = np.full(self.first[-1], CLOSE, np.uint8)
        inside = np.ones(self.first[-1], bool)
        inside[self.first[1:] - 1] = False
        self.text[inside] = data
        self.sizes, self.depth = sizes, depth
        order = self._order()
        before = self.text[order - 1].astype(np.int32)  # the transform
        lead = np.isin(order, self.first[:-1]) if n else np.zeros(0, bool)  # a string's start has nothing before it
        turn = np.ones(len(order), bool)
        turn[1:] = (before[1:] != before[:-1]) | lead[1:] | lead[:-1]
        self.runs = int(turn.sum())
        # run heads meet the run before them, run tails the one after: one measurement serves both
        head = np.flatnonzero(turn)
        head = head[head > 0]
        common = self._common(order[head - 1], order[head])
        self.up = order[head], common  # with the suffix before
        self.down = order[head - 1], common  # with the suffix after
        if len(order):
            self.up = np.append(self.up[0], order[0]), np.append(common, 0)
            self.down = np.append(self.down[0], order[-1]), np.append(common, 0)

    def _order(self) -> np.ndarray:
        """Suffixes by their first ``depth`` bytes, ties by place."""
        n = len(self.text)
        if not n:
            return np.zeros(0, np.int64)
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for k in range(8):
            key = key << np.uint64(8) | padded[k : k + n]
        order = np.argsort(key, kind="stable")
        rank, most = self._ranks(key, order)
        length = 8
        open_ = np.arange(n)
        while length < self.depth and most < n:
            far = np.zeros(n, np.int64)
            far[: n - length] = rank[length:] + 1
            # only places that still share their rank are sorted again
            size = np.bincount(rank)
            open_ = order[size[rank[order]] > 1]
            pair = rank[open_] * np.int64(n + 2) + far[open_]
            again = np.argsort(pair, kind="stable")
            slots = np.flatnonzero(size[rank[order]] > 1)
            order[slots] = open_[again]
            new = np.empty(n, np.int64)
            key2 = pair[again]
            step = np.zeros(n, bool)
            r = rank[order]
            step[1:] = r[1:] != r[:-1]
            step[slots[1:]] |= key2[1:] != key2[:-1]
            new[order] = np.cumsum(step)
            rank, most = new, int(new[order[-1]]) + 1
            length *= 2
        return order

    @staticmethod
    def _ranks(key: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
        step = np.zeros(len(order), bool)
        step[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(step)
        return rank, int(rank[order[-1]]) + 1

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common prefix of suffixes, pair by pair, up to ``depth`` bytes."""
        n = len(self.text)
        words = np.concatenate([self.text, np.zeros(self.depth + 16, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(words, 8)
        out = np.full(len(a), self.depth, np.int64)
        live = np.arange(len(a))
        for at in range(0, self.depth, 8):
            if not len(live):
                break
            same = view[np.minimum(a[live] + at, n + 8)] == view[np.minimum(b[live] + at, n + 8)]
            differ = ~same.all(1)
            out[live[differ]] = at + same[differ].argmin(1)
            live = live[~differ]
        return np.minimum(out, np.minimum(n - a, n - b))

    def statistics(self) -> np.ndarray:
        """For every place of the strings (closing bytes too): the longest match elsewhere, within its string."""
        n = len(self.text)
        best = np.zeros(n, np.int64)
        for place, common in (self.up, self.down):
            at = np.full(n, -1, np.int64)
            at[place] = np.arange(len(place))
            last = np.maximum.accumulate(np.where(at >= 0, np.arange(n), 0))
            best = np.maximum(best, common[at[last]] - (np.arange(n) - last)) if n else best
        ends = np.repeat(self.first[1:] - 1, self.sizes + 1)
        return np.maximum(0, np.minimum(best, ends - np.arange(n)))
