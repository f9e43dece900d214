"""Distinct word shingles of many texts at once, as 64-bit hashes from bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256, dtype=np.uint8)
_SPACE = np.isin(_BYTES, [32, 9, 10, 11, 12, 13])
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
_VALUE = np.random.default_rng(11).integers(1, 2**63, 256).astype(np.uint64)[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed * 0x632BE59BD9B4E019 % 2**64) + _BASE
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 2 * len(_powers)), _BASE, np.uint64)
        more[0] = 1
        with np.errstate(over="ignore"):
            _powers = np.multiply.accumulate(more)
    return _powers


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and where each text starts, the end last; null texts are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, A-Z lower-cased, and the number of its text."""
    data, at = _bytes_of(texts)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = inside[heads]
    place = np.flatnonzero(inside)
    begins = np.flatnonzero(first[place])
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(begins, len(place)))
    within = np.arange(len(place)) - np.repeat(begins, lengths)
    with np.errstate(over="ignore"):
        value = _VALUE[data[place]] * _powers_to(int(lengths.max()))[within]
        hashes = mix(np.add.reduceat(value, begins) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(at, place[begins], "right") - 1


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingles of ``n`` words of each text; fewer words are one shingle, none are none."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    out = []
    with np.errstate(over="ignore"):
        run = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n if len(run) else 0):
            run = mix(run + words[k : k + len(run)], k)
        for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            if b - a >= n:
                out.append(np.unique(run[a : b - n + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for w in words[a:b]:
                    short = mix(np.array([short + w]), n)[0]
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
