"""Word-aligned Simple-8b coding of unsigned integers, encoded and decoded in whole arrays."""

from __future__ import annotations

import numpy as np

# Fixed values of the code: how many values a word holds under each selector, and their bits.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

#: The payload of selector 15 that says: the value stands in the list of escaped ones.
ESCAPE = (1 << 60) - 1
#: Values of a block; blocks are coded apart, so they can be decoded apart and at once.
BLOCK = 1024


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; zero needs none."""
    upper = np.frexp((values >> np.uint64(32)).astype(np.float64))[1]
    lower = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(upper > 0, upper + 32, lower).astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of each block, the selector that takes most values from there on.

    ``bits`` has a row per block and zeros behind its values, enough for the longest run.
    The most bits within a run come from those of two shorter runs that cover it.
    """
    most = {1: bits}
    for count in COUNTS[-2::-1]:
        half = max(n for n in most if n < count and 2 * n >= count)
        step, known = count - half, most[half]
        most[count] = np.maximum(known[:, :-step], known[:, step:])
    best = np.full((len(bits), BLOCK), len(COUNTS) - 1, dtype=np.uint8)
    for k in range(len(COUNTS) - 2, -1, -1):
        best[most[COUNTS[k]][:, :BLOCK] <= WIDTHS[k]] = k
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block, and the escaped values, in order.

    All blocks advance together, each by the selector that takes most of its next values.
    """
    values = np.asarray(values, dtype=np.uint64)
    escaped = values >= ESCAPE
    escapes = values[escaped]
    if len(escapes):
        values = np.where(escaped, np.uint64(ESCAPE), values)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), escapes
    blocks = -(-n // BLOCK)
    lengths = np.full(blocks, BLOCK)
    lengths[-1] = n - (blocks - 1) * BLOCK
    padded = np.zeros((blocks, BLOCK + COUNTS[0]), dtype=np.uint64)
    padded[:, :BLOCK].flat[:n] = values
    best = _selectors(_bits(padded))
    counts = np.array(COUNTS)
    lanes, at = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    froms, lane, chosen = [], [], []
    while len(lanes):
        selector = best[lanes, at]
        froms.append(at)
        lane.append(lanes)
        chosen.append(selector)
        at = at + counts[selector]
        going = at < lengths[lanes]
        at, lanes = at[going], lanes[going]
    froms, lane, chosen = map(np.concatenate, (froms, lane, chosen))
    order = np.lexsort((froms, lane))
    froms, lane, chosen = froms[order], lane[order], chosen[order]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat = padded.reshape(-1)
    starts = lane * padded.shape[1] + froms
    for k, (count, width) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        rows = np.flatnonzero(chosen == k)
        if not len(rows) or not width:
            continue
        packed, places = words[rows], starts[rows]
        for i in range(count):
            packed |= flat[places + i] << np.uint64(i * width)
        words[rows] = packed
    return words, np.searchsorted(lane, np.arange(blocks)).astype(np.int64), escapes


def decode(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of :func:`encode`; any run of whole blocks can be decoded alone."""
    if not n:
        return np.zeros(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    room = np.array(COUNTS)[selectors]
    before = np.cumsum(room) - room
    block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    # Places inside the block, then in the whole; a word may hold more than its block needs.
    at = before - before[first][block] + block * BLOCK
    stops = np.minimum((block + 1) * BLOCK, n)
    values = np.zeros(n, dtype=np.uint64)
    for k, (count, width) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        rows = np.flatnonzero(selectors == k)
        if not len(rows) or not width:
            continue
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
        held = words[rows, None] >> shifts & np.uint64((1 << width) - 1)
        places = at[rows, None] + np.arange(count)
        inside = places < stops[rows, None]
        values[places[inside]] = held[inside]
    if len(escapes):
        values[values == ESCAPE] = escapes
    return values
