"""A run-length index of a block of texts: compressed Burrows-Wheeler transform with sampled run ends."""

from __future__ import annotations

import numpy as np

#: Symbols of 9 bits in the first sort key, and the bits of a place: a sort key holds two ranks and a place.
_FIRST, _PLACE = 4, 20


class RunIndex:
    """Built from texts that are laid end to end with separators.

    Kept are the runs of the transform and, for the first and last row of each run, its place in the text and the length of
    the match with the row before or after it. Between two sampled places a match only loses its first byte, so the matches of
    every place stream from these samples.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        symbols = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
        for s, t in zip(self.starts, texts, strict=True):
            symbols[s : s + len(t)] = np.frombuffer(t, np.uint8).astype(np.int64) + 2
        symbols[:-1][symbols[:-1] == 0] = 1  # separators; the last symbol is the end, smaller than all
        order, levels = self._sorted(symbols)
        last = symbols[order - 1]
        change = np.flatnonzero(last[1:] != last[:-1]) + 1
        self.heads, self.symbols, self.size = np.concatenate([[0], change]), last[np.concatenate([[0], change])], len(symbols)
        tails = np.concatenate([change - 1, [self.size - 1]])
        self.first = self._samples(order, levels, symbols, self.heads, -1)
        self.last = self._samples(order, levels, symbols, tails, 1)

    @staticmethod
    def _sorted(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Suffix array by prefix doubling, with the ranks of every length on the way."""
        n = len(symbols)
        if n >= 1 << _PLACE:
            raise ValueError(f"a block holds fewer than {1 << _PLACE} symbols")
        padded = np.concatenate([symbols, np.zeros(_FIRST, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(_FIRST):
            key = (key << 9) | padded[k : k + n]
        place = np.arange(n)
        levels, length = [], _FIRST
        while True:
            ranked = np.sort((key << _PLACE) | place)  # faster than an argsort
            order = ranked & ((1 << _PLACE) - 1)
            ranked >>= _PLACE
            new = np.zeros(n, np.int64)
            new[1:] = ranked[1:] != ranked[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            levels.append((length, rank))
            if rank[order[-1]] == n - 1:
                return order, levels
            key = rank << _PLACE
            key[: n - length] |= rank[length:] + 1
            length *= 2

    @staticmethod
    def _samples(order, levels, symbols, rows, side) -> tuple[np.ndarray, np.ndarray]:
        """Places of some rows of the suffix array, in text order, and their matches with the row on one side."""
        inside = (rows + side >= 0) & (rows + side < len(order))
        a = order[rows]
        b = np.where(inside, order[np.clip(rows + side, 0, len(order) - 1)], 0)
        n, match = len(symbols), np.zeros(len(rows), np.int64)
        for length, rank in reversed(levels):
            x, y = a + match, b + match
            fits = inside & (np.maximum(x, y) + length <= n)
            same = fits & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
            match[same] += length
        going = inside.copy()
        for _ in range(_FIRST):
            x, y = a + match, b + match
            going &= (np.maximum(x, y) < n) & (symbols[np.minimum(x, n - 1)] == symbols[np.minimum(y, n - 1)])
            match[going] += 1
        by = np.argsort(a)
        return a[by], match[by]

    def matches(self) -> np.ndarray:
        """For every place, the length of its longest match with another place."""
        out = np.zeros(self.size, np.int64)
        place = np.arange(self.size)
        for at, length in (self.first, self.last):
            from_sample = np.searchsorted(at, place, "right") - 1
            np.maximum(out, np.where(from_sample >= 0, length[from_sample] - (place - at[from_sample]), 0), out=out)
        return out

    def repeated(self, least: int) -> list[np.ndarray]:
        """For each text, the starts of its strings of ``least`` bytes that also start elsewhere in the block."""
        long = self.matches() >= least
        ends = np.append(self.starts[1:], self.size - 1) - 1
        return [np.flatnonzero(long[s : max(s, e - least + 1)]) for s, e in zip(self.starts, ends, strict=True)]
