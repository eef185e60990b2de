"""Sets of hashed word shingles of whole texts, computed on arrays of bytes."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Bytes that are hashed at a time; a longer text counts for itself. A byte takes some 80
#: more meanwhile, in each of an executor's workers.
CHUNK_BYTES = 1 << 19

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LETTER = np.random.default_rng(20).integers(1, 2**64, 256, dtype=np.uint64)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the value."""
    x = values + np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
_KNOWN: dict[str, np.ndarray] = {}


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    """Powers of ``base``; those that a chunk needs are kept."""
    if n > 4 * CHUNK_BYTES:
        return _powers(base, n)
    if name not in _KNOWN or len(_KNOWN[name]) < n:
        _KNOWN[name] = _powers(base, n)
    return _KNOWN[name][:n]


def word_hashes(data: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word; a word is a polynomial in random numbers for its bytes.

    ``blank`` tells of each byte whether it parts words.
    """
    word = ~blank[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[data] * _table("up", _STEP, len(data)), out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * _table("down", _INVERSE, len(data) + 1)[starts])


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the ascending hashes of its distinct shingles of five words.

    A-Z count as lower case, words are what stands between blanks and control breaks, and a
    text of fewer words is one shingle; a text without words, or null, has none.
    """
    if not texts:
        return []
    parts = [(text or "").encode().lower() for text in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    places, words = word_hashes(data)
    bounds = np.cumsum([len(part) + 1 for part in parts])
    ends = np.searchsorted(places, bounds)
    scale = _powers(_ODD, SHINGLE + 1)
    n = max(len(words) - SHINGLE + 1, 0)
    sums = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        sums += words[i : i + n] * scale[i]
    hashes = mixed(sums, SHINGLE)
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= SHINGLE:
            out.append(np.unique(hashes[start : end - SHINGLE + 1]))
        elif end > start:
            own = (words[start:end] * scale[: end - start]).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(own, end - start))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        start = end
    return out


def chunks(texts: list[str | None]):
    """Ranges of texts of some ``CHUNK_BYTES`` together."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_BYTES:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
