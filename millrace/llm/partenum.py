"""Signatures of sets by PartEnum, for Jaccard joins on hashed features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from millrace.llm.shingles import mixed

#: Each partition of the first level has so many parts; a signature leaves one of them out.
PARTS = 3
#: One partition in so many is there beyond those that differences can spoil.
SPARE = 4
_STRIDE = np.uint64(0xD1342543DE82EF95)
#: Where weak sets meet by their single features.
ANY_BAND = -1


@dataclass(frozen=True)
class PartEnum:
    """Signatures for sets with Jaccard similarity of at least ``num / den``.

    Sizes form bands such that similar sets lie in the same band or in adjacent ones; a set
    sends signatures for its own band and the next. A band cuts the feature domain (64-bit
    hashes) into partitions, and each of them into three parts. Of every partition all
    subsets of two parts are enumerated; a signature is a hash of all features of the set in
    such a subset. Two sets that differ in one feature of a partition agree in the two
    parts without it.

    Two similar sets differ in at most ``budget(size, band)`` features, so in more than one
    feature of at most half as many partitions, and share a signature in each of the others.
    Subsets without features are not sent; a partition with such a subset is not relied on.
    What is left is ``need``, the number of signatures that a similar set surely shares. A
    few spare partitions keep it above zero; sets for which it is not (``weak``) also send a
    signature for each feature, so that two such sets meet as well.
    """

    num: int = 75
    den: int = 100
    lows: list[int] = field(default_factory=list, compare=False)

    def __post_init__(self) -> None:
        low = 1
        while low < 1 << 40:
            self.lows.append(low)
            low = low * self.den // self.num + 1

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def high(self, band: int) -> int:
        return self.lows[band + 1] - 1

    def budget(self, size: int, band: int) -> int:
        """Features in which a set and a similar one, both of this band or below, may differ."""
        other = min(self.high(band), size * self.den // self.num)
        return (size + other) * (self.den - self.num) // (self.den + self.num)

    def partitions(self, band: int) -> int:
        most = self.budget(self.high(band), band) // 2 + 1
        return most + -(-most // SPARE) if most > 1 else most

    def signatures(self, features: np.ndarray) -> list[tuple[int, np.ndarray, int]]:
        """(band, signatures, need) for the own band, the next and, if weak, ``ANY_BAND``.

        ``features`` are distinct and ascending.
        """
        return self.of_sets([features])[0]

    def of_sets(self, sets: list[np.ndarray]) -> list[list[tuple[int, np.ndarray, int]]]:
        """``signatures`` of each set, worked out for all of them together."""
        found: list[list] = [[] for _ in sets]
        full = [k for k, features in enumerate(sets) if len(features)]
        if not full:
            return found
        sizes = np.array([len(sets[k]) for k in full])
        flat = np.concatenate([sets[k] for k in full])
        scattered = mixed(flat, 1)
        own = np.searchsorted(self.lows, sizes, side="right") - 1
        for step in (0, 1):
            signs, ends, need = self._of_bands(flat, scattered, sizes, own + step)
            starts = [0, *ends[:-1].tolist()]
            for k, band, a, b, n in zip(full, (own + step).tolist(), starts, ends.tolist(), need.tolist()):
                found[k].append((band, signs[a:b], n))
        for k in full:
            if min(need for _, _, need in found[k]) < 1:
                found[k].append((ANY_BAND, mixed(sets[k], 2), 1))
        return found

    def _of_bands(
        self, flat: np.ndarray, scattered: np.ndarray, sizes: np.ndarray, bands: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signatures of all sets one after another, where each set's end, and its ``need``."""
        n, first, part, starts, used = self._occupied(flat, sizes, bands)
        total = len(used)
        content = np.zeros(PARTS * total, dtype=np.uint64)
        content[part[starts]] = np.add.reduceat(scattered, starts)
        content = content.reshape(total, PARTS)
        place = np.arange(total) - np.repeat(first, n)
        signs = np.empty((total, PARTS), dtype=np.uint64)
        sent = np.empty((total, PARTS), dtype=bool)
        for left_out in range(PARTS):
            a, b = (k for k in range(PARTS) if k != left_out)
            sent[:, left_out] = used[:, a] | used[:, b]
            name = (place * PARTS + left_out).astype(np.uint64) * _STRIDE
            signs[:, left_out] = mixed(name + content[:, a] + (content[:, b] ^ _STRIDE) * _STRIDE, 3)
        ends = np.cumsum(np.add.reduceat(sent.sum(axis=1), first))
        return signs[sent], ends, self._need(first, used, sizes, bands)

    def _occupied(
        self, flat: np.ndarray, sizes: np.ndarray, bands: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Partitions of each set, the first one's number, and the parts that hold features.

        Of the features come their part and where a part's features start.
        """
        each = {band: self.partitions(band) for band in np.unique(bands).tolist()}
        n = np.array([each[band] for band in bands.tolist()])
        first = np.cumsum(n) - n
        parts = np.repeat((PARTS * n).astype(np.uint64), sizes)
        part = ((flat >> np.uint64(32)) * parts >> np.uint64(32)).astype(np.int64)
        part += np.repeat(PARTS * first, sizes)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1))
        used = np.zeros(PARTS * int(n.sum()), dtype=bool)
        used[part[starts]] = True
        return n, first, part, starts, used.reshape(-1, PARTS)

    def _need(self, first: np.ndarray, used: np.ndarray, sizes: np.ndarray, bands: np.ndarray) -> np.ndarray:
        # With features in one part only, or none, some subset of parts is empty.
        relied_on = np.add.reduceat((used.sum(axis=1) >= 2).astype(np.int64), first)
        spoilt = [self.budget(size, band) // 2 for size, band in zip(sizes.tolist(), bands.tolist())]
        return relied_on - np.array(spoilt)

    def needs(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """``need`` of each set in its own band and in the next, without the signatures."""
        found = [(0, 0)] * len(sets)
        full = [k for k, features in enumerate(sets) if len(features)]
        if not full:
            return found
        sizes = np.array([len(sets[k]) for k in full])
        flat = np.concatenate([sets[k] for k in full])
        own = np.searchsorted(self.lows, sizes, side="right") - 1
        both = []
        for bands in (own, own + 1):
            _, first, _, _, used = self._occupied(flat, sizes, bands)
            both.append(self._need(first, used, sizes, bands).tolist())
        for k, *need in zip(full, *both, strict=True):
            found[k] = tuple(need)
        return found


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sets of distinct ascending features have Jaccard of ``num / den`` or more."""
    if not len(a) or not len(b):
        return False
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return den * shared >= num * (len(both) - shared)
