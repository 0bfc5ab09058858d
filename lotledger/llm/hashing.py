"""Hashes of the words and word n-grams of a text, with numpy over its bytes."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ROLL = 0xD1342543DE82EF95
CHUNK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_ROLL, CHUNK + 1), _powers(pow(_ROLL, -1, 2**64), CHUNK + 1)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _chunk_words(a: np.ndarray) -> np.ndarray:
    """Hashes of the words of one chunk: sums of byte values times powers, moved to power 0."""
    up, down = _UP, _DOWN
    if len(a) > CHUNK:
        up, down = _powers(_ROLL, len(a) + 1), _powers(pow(_ROLL, -1, 2**64), len(a) + 1)
    gap = np.ones(len(a) + 2, bool)
    np.take(_GAP, a, out=gap[1:-1])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[:len(a)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word; words are runs of bytes other than space and 0x09-0x0D.

    Long texts are read in chunks that end at a space, so memory follows the chunk, not the text.
    """
    a = np.frombuffer(text, np.uint8)
    if len(a) <= CHUNK:
        return _chunk_words(a)
    parts, at = [], 0
    while at < len(a):
        end = at + CHUNK
        while end < len(a):
            gaps = np.flatnonzero(_GAP[a[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end += CHUNK  # a word longer than the chunk
        parts.append(_chunk_words(a[at:end]))
        at = end
    return np.concatenate(parts)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text, A-Z lower-cased (n below 64).

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words = word_hashes(utf8(text).lower())
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out += words[i:len(words) - n + 1 + i] * _FACTORS[i]
    return distinct(mix(out))
