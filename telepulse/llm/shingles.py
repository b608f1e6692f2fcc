"""Word shingles of whole texts as 64-bit hashes, computed over the bytes of a batch at once."""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_rng = np.random.default_rng(20240229)
BYTES = _rng.integers(0, 1 << 64, 256, np.uint64)
ROUND = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order (A-Z lower-cased), and where each text's words begin (n + 1 places)."""
    parts = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)])
    solid = ~WHITE[data]
    edge = np.diff(np.concatenate([[False], solid]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    length = end - start
    letters = data[solid]
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(len(letters)) - np.repeat(first, length)
    powers = np.cumprod(np.full(int(length.max()), ROUND, np.uint64))
    hashes = mixed(np.add.reduceat(BYTES[letters] * powers[place], first) ^ length.astype(np.uint64))
    return hashes, np.searchsorted(start, begins)


def shingle_sets(texts: list[str], size: int = 3) -> list[np.ndarray]:
    """The sorted distinct shingles of each text. Fewer words than ``size`` make one shingle, none an empty set."""
    words, begins = word_hashes(texts)
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled += words[k : k + len(rolled)] * factors[k]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = np.uint64(b - a) + (words[a:b] * factors[: b - a]).sum(dtype=np.uint64)
            out.append(mixed(mixed(np.array([short], np.uint64))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
