"""Longest common extensions from a sparse suffix order on a difference cover."""

from __future__ import annotations

import numpy as np

#: Every distance modulo 13 is the difference of two of these: 4 of 13 places are sampled.
PERIOD = 13
COVER = (0, 1, 3, 9)

_SAMPLED = np.full(PERIOD, -1, dtype=np.int64)
_SAMPLED[list(COVER)] = np.arange(len(COVER))
# By place modulo 13 and distance modulo 13: the least step after which both are sampled.
_STEP = np.array(
    [
        [
            next(s for s in range(PERIOD) if (i + s) % PERIOD in COVER and (i + s + d) % PERIOD in COVER)
            for d in range(PERIOD)
        ]
        for i in range(PERIOD)
    ],
    dtype=np.int64,
)


class Extensions:
    """How far two places of an array of symbols (from 0 on) agree, for many pairs at once.

    ``owner`` numbers the parts of the array; extensions are only asked for inside a part, and
    a symbol that occurs once must end each part.

    Only the suffixes at places of the cover are sorted: by their first 13 symbols, and
    where these repeat in a part, by prefix doubling over blocks of 13. Neighbours in this
    order get the number of blocks in which they agree, in a sparse table for minima. An
    extension compares a few symbols up to the next pair of sampled places, asks the table
    there, and compares fewer than 13 symbols behind the last whole block.
    """

    def __init__(self, symbols: np.ndarray, owner: np.ndarray) -> None:
        n = len(symbols)
        self.symbols = np.concatenate((symbols, np.full(2 * PERIOD, -1, dtype=np.int64)))
        blocks = -(-n // PERIOD)
        places = (np.arange(blocks)[:, None] * PERIOD + np.array(COVER)).ravel()
        self.m = int(np.searchsorted(places, n))
        self._sort(places[: self.m], owner)

    def _sort(self, places: np.ndarray, owner: np.ndarray) -> None:
        if not self.m:
            self.rank, self.least = np.zeros(0, dtype=np.int64), [np.zeros(0, dtype=np.int32)]
            return
        bits = max(int(self.symbols.max()).bit_length(), 1)
        each = max(1, 63 // bits)
        keys = []
        for start in range(0, PERIOD, each):
            key = np.zeros(self.m, dtype=np.int64)
            for k in range(start, min(start + each, PERIOD)):
                key = key << bits | np.maximum(self.symbols[places + k], 0)
            keys.append(key)
        own = owner[places]
        order = np.lexsort([*keys[::-1], own])
        new = np.ones(self.m, dtype=bool)
        new[1:] = own[order[1:]] != own[order[:-1]]
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        group = np.maximum.accumulate(np.where(new, np.arange(self.m), 0))
        rank = np.empty(self.m, dtype=np.int64)
        rank[order] = group
        ranks, step = [rank], len(COVER)
        while True:
            # Places in the order whose group has more members.
            shared = ~new
            shared[:-1] |= ~new[1:]
            at = np.flatnonzero(shared)
            if not len(at):
                break
            active = order[at]
            ahead = active + step
            second = np.where(ahead < self.m, rank[np.minimum(ahead, self.m - 1)], -1)
            resorted = np.lexsort((second, rank[active]))
            active, second = active[resorted], second[resorted]
            order[at] = active
            first = rank[active]
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            new[at] = fresh
            rank = rank.copy()
            rank[active] = np.maximum.accumulate(np.where(fresh, at, 0))
            ranks.append(rank)
            step *= 2
        self.rank = np.empty(self.m, dtype=np.int64)
        self.rank[order] = np.arange(self.m)
        self._table(order, ranks)

    def _table(self, order: np.ndarray, ranks: list[np.ndarray]) -> None:
        """Minima of the blocks in which neighbours agree, over 1, 2, 4, .. neighbours."""
        agree = np.zeros(self.m - 1, dtype=np.int32)
        a, b = order[:-1].copy(), order[1:].copy()
        for level in range(len(ranks) - 1, -1, -1):
            rank, step = ranks[level], len(COVER) << level
            inside = np.flatnonzero(np.maximum(a, b) < self.m)
            same = inside[rank[a[inside]] == rank[b[inside]]]
            agree[same] += 1 << level
            a[same] += step
            b[same] += step
        self.least = [agree]
        width = 1
        while 2 * width <= len(agree):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Symbols that agree from ``i`` and ``j`` on, up to ``most``, one after another."""
        found = np.zeros(len(i), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        for k in range(PERIOD):
            live = live[self.symbols[i[live] + k] == self.symbols[j[live] + k]]
            found[live] = k + 1
            live = live[most[live] > k + 1]
            if not len(live):
                break
        return found

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that agree from each ``i`` and its ``j`` on, for ``i < j`` of one part."""
        step = _STEP[i % PERIOD, (j - i) % PERIOD]
        found = self._compared(i, j, step)
        on = np.flatnonzero(found == step)
        a, b = i[on] + step[on], j[on] + step[on]
        inside = b < self._end()
        on, a, b = on[inside], a[inside], b[inside]
        if not len(on):
            return found
        x, y = (self.rank[p // PERIOD * len(COVER) + _SAMPLED[p % PERIOD]] for p in (a, b))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        blocks = np.zeros(len(on), dtype=np.int64)
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            least = self.least[k]
            blocks[own] = np.minimum(least[low[own]], least[high[own] - (1 << k)])
        a, b = a + blocks * PERIOD, b + blocks * PERIOD
        found[on] += blocks * PERIOD + self._compared(a, b, np.full(len(on), PERIOD))
        return found

    def _end(self) -> int:
        return len(self.symbols) - 2 * PERIOD
