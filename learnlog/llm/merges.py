"""Pair merging of many token sequences side by side.

A byte-pair vocabulary joins, again and again, the neighbours of least rank (of
equals the leftmost). Here one such step is taken for all sequences at once:
sequences of like length are rows of a matrix, ranks of neighbours come from a
hash table of pairs, and rows that have no pair left drop out.
"""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)
#: Longest sequence that is merged in a matrix; longer ones are merged one by one with a heap.
WIDEST = 64
#: Cells of a matrix, about.
CELLS = 1 << 20


class Pairs:
    """``(left, right) -> (rank, joined)`` as an open-addressed hash table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, joined: np.ndarray) -> None:
        key = left.astype(np.int64) << 32 | right
        bits = max(8, int(np.ceil(np.log2(max(1, 4 * len(key))))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank, self.joined = np.full(1 << bits, NONE, np.int32), np.zeros(1 << bits, np.int32)
        todo, at = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.keys[at] == -1
            slot, first = np.unique(at[free], return_index=True)
            put = todo[free][first]
            self.keys[slot], self.rank[slot], self.joined[slot] = key[put], rank[put], joined[put]
            left_over = self.keys[at] != key[todo]
            todo, at = todo[left_over], (at[left_over] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE``: no such pair) and joined token of each pair."""
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        todo = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            todo = todo[(self.keys[at[todo]] != key[todo]) & (self.keys[at[todo]] != -1)]
        return np.where(self.keys[at] == key, self.rank[at], NONE), self.joined[at]

    def merge(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences ``tokens[bounds[i]:bounds[i + 1]]`` after all merges, one after the other; their bounds."""
        size = np.diff(bounds)
        out = np.full(len(tokens), -1, np.int32)      # at the places of the input, then closed up
        low = 0
        for width in (1, 2, 4, 6, 8, 10, 12, 16, 24, 32, WIDEST):
            rows = np.flatnonzero((size > low) & (size <= width))
            step = max(1, CELLS // width)
            for a in range(0, len(rows), step):
                self._merge_matrix(tokens, bounds, rows[a:a + step], width, out)
            low = width
        for i in np.flatnonzero(size > WIDEST).tolist():
            got = self._merge_long(tokens[bounds[i]:bounds[i + 1]].tolist())
            out[bounds[i]:bounds[i] + len(got)] = got
        kept = out >= 0
        return out[kept], np.concatenate([[0], np.cumsum(kept)])[bounds]

    def _merge_matrix(self, tokens, bounds, rows, width, out) -> None:
        size = bounds[rows + 1] - bounds[rows]
        columns = np.arange(width)
        inside = columns < size[:, None]
        place = np.where(inside, bounds[rows][:, None] + columns, 0)
        s = np.where(inside, tokens[place], -1).astype(np.int32)
        if width > 1:
            ranks, joined = self.find(s[:, :-1].ravel(), s[:, 1:].ravel())
            ranks = np.where(s[:, 1:].ravel() < 0, NONE, ranks).reshape(len(rows), width - 1)
            joined = joined.reshape(len(rows), width - 1)
            live = np.arange(len(rows))
            while True:
                at = ranks[live].argmin(1)
                more = ranks[live, at] < NONE
                live, at = live[more], at[more]
                if not len(live):
                    break
                t, r, j = s[live], ranks[live], joined[live]
                row = np.arange(len(live))
                t[row, at] = j[row, at]
                # close the gap: what is right of the joined token moves one to the left
                t = np.take_along_axis(np.pad(t, ((0, 0), (0, 1)), constant_values=-1), columns + (columns > at[:, None]), 1)
                pair = columns[:-1] + (columns[:-1] >= at[:, None])
                r = np.take_along_axis(np.pad(r, ((0, 0), (0, 1)), constant_values=NONE), pair, 1)
                j = np.take_along_axis(np.pad(j, ((0, 0), (0, 1))), pair, 1)
                for place in (at - 1, at):
                    ok = np.flatnonzero((place >= 0) & (place < width - 1))
                    p = place[ok]
                    a, b = t[ok, p], t[ok, p + 1]
                    new, to = self.find(a, b)
                    r[ok, p], j[ok, p] = np.where(b < 0, NONE, new), to
                s[live], ranks[live], joined[live] = t, r, j
        out[(bounds[rows][:, None] + columns)[inside]] = s[inside]

    def _merge_long(self, tokens: list[int]) -> list[int]:
        n = len(tokens)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(places: list[int]) -> None:
            places = [i for i in places if i >= 0 and after[i] < n]
            if places:
                left = np.array([tokens[i] for i in places])
                right = np.array([tokens[after[i]] for i in places])
                for i, a, b, r, j in zip(places, left.tolist(), right.tolist(), *(x.tolist() for x in self.find(left, right))):
                    if r < NONE:
                        heapq.heappush(heap, (r, i, a, b, j))

        offer(list(range(n)))
        while heap:
            _, i, a, b, j = heapq.heappop(heap)
            if not alive[i] or tokens[i] != a or after[i] >= n or tokens[after[i]] != b:
                continue
            gone = after[i]
            alive[gone], tokens[i], after[i] = False, j, after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer([before[i], i])
        return [t for t, ok in zip(tokens, alive) if ok]
