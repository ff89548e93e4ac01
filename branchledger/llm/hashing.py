"""Vectorised word and shingle hashes of UTF-8 texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: The bytes that separate words: space, tab, line feed, vertical tab, form feed, return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes | None], most: int = 2 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts (null: empty) of about ``most`` bytes together, each text whole."""
    first, size, held = 0, 0, []
    for i, text in enumerate(texts):
        held.append(text or b"")
        size += len(held[-1])
        if size >= most:
            yield first, held
            first, size, held = i + 1, 0, []
    if held:
        yield first, held


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of all texts: hash, index of text, start and end in the joined bytes; the bytes."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~SPACES[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    if start.size == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, data
    length = end - start
    at = np.flatnonzero(inside)
    place = np.arange(at.size) - np.repeat(np.cumsum(length) - length, length)
    value = (_LOWER if lower else _BYTE)[data[at]]
    # Within a word the hash is a polynomial in an odd number over random byte values.
    powers = np.ones(int(length.max()), np.uint64)
    powers[1:] = _ODD
    value *= np.cumprod(powers)[place]
    hashed = mix(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    text = np.searchsorted(begins, start, side="right") - 1
    return hashed, text, start, end, data


def windows(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values."""
    count = hashed.size - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += mix(hashed[k : k + count] * _PLACE[k])
    return mix(total)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``size``-word shingles, A-Z lower-cased.

    A text of fewer words gives one shingle of all of them, one without words none.
    """
    hashed, text, _, _, _ = words(texts, lower=True)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    runs = windows(hashed, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            whole = windows(hashed[a:b], b - a)
            out.append(mix(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
