"""Word-shingle sets as sorted 60-bit hashes, computed in numpy over blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

TOKEN_BITS = 60
_UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
BLOCK_BYTES = 1 << 22  # hashed at once; a longer text is a block of its own


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each blank-separated word."""
    codes = np.frombuffer(data, np.uint8)
    blank = _BLANK[codes]
    edges = np.diff(blank.view(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _STEP)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = _BYTE[codes[~blank]] * powers[place]
    return starts, _mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """Per text its distinct shingles of ``size`` words, ascending.

    A-Z are lower-cased. A text of fewer words is one shingle, one without words has none.
    """
    encoded = [(t or "").encode().translate(_UPPER_TO_LOWER) for t in texts]
    a = 0
    while a < len(encoded):
        b, total = a + 1, len(encoded[a])
        while b < len(encoded) and total + len(encoded[b]) <= BLOCK_BYTES:
            total += len(encoded[b])
            b += 1
        starts, words = _word_hashes(b" ".join(encoded[a:b]))
        text_at = np.cumsum([0] + [len(e) + 1 for e in encoded[a:b]])
        word_at = np.searchsorted(starts, text_at)
        joined = words.copy()
        for i in range(1, size):
            joined = joined[:-1] * _STEP + words[i:] if len(joined) > 1 else joined[:0]
        joined = _mixed(joined) >> np.uint64(64 - TOKEN_BITS)
        for p, q in zip(word_at[:-1], word_at[1:]):
            if q - p >= size:
                yield np.unique(joined[p : q - size + 1])
            elif q > p:
                whole = np.array([q - p], np.uint64) * _ODD
                for i in range(p, q):
                    whole = whole * _STEP + words[i : i + 1]
                yield _mixed(whole) >> np.uint64(64 - TOKEN_BITS)
            else:
                yield joined[:0]
        a = b


def digest(tokens: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    a = _mixed(tokens + _ODD).sum(dtype=np.uint64)
    b = _mixed(tokens ^ _STEP).sum(dtype=np.uint64)
    return np.array([a, b + np.uint64(len(tokens))]).tobytes()
