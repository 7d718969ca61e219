"""Word and word-shingle hashing of Arrow text batches with numpy (runs inside Spark tasks).

A word is a maximal run of bytes other than space and 0x09-0x0D, after lowering A-Z. A word's hash is a
64-bit polynomial of its bytes, mixed; a shingle's hash combines the hashes of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes hashed at a time; only a single longer word makes a larger piece.
PIECE = 1 << 19
BASE = 0x9E3779B97F4A7C15
_POW = [np.ones(1, U), np.ones(1, U)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, PIECE + 1)
        for i, base in ((0, BASE), (1, pow(BASE, -1, 1 << 64))):
            p = np.full(size, U(base))
            p[0] = 1
            _POW[i] = np.cumprod(p)
    return _POW[0], _POW[1]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text array; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def spans(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes; texts begin at ``off``."""
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[low]
    cut = np.zeros(len(low) + 1, bool)
    cut[off[off <= len(low)]] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | cut[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hashes(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(low) + 1)
    total = np.zeros(len(low) + 1, U)
    np.cumsum((low.astype(U) + U(1)) * power[: len(low)], out=total[1:])
    return mix((total[e] - total[s]) * inverse[s])


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most PIECE bytes each (or one longer text)."""
    _, off = buffer_of(texts)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + PIECE, "right")) - 1)
        yield i, j
        i = j


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and offsets of each text's words."""
    data, off = buffer_of(texts)
    if len(off) == 2 and len(data) > PIECE:  # one long text: hash it piece by piece, cut at white space
        out, at = [], 0
        while at < len(data):
            to = min(len(data), at + PIECE)
            if to < len(data):
                gap = np.flatnonzero(SPACE[data[at:to]])
                if len(gap):
                    to = at + int(gap[-1]) + 1
                else:
                    rest = np.flatnonzero(SPACE[data[to:]])
                    to = to + int(rest[0]) + 1 if len(rest) else len(data)
            low = LOWER[data[at:to]]
            out.append(span_hashes(low, *spans(low, np.zeros(1, np.int64))))
            at = to
        h = np.concatenate(out)
        return h, np.array([0, len(h)])
    low = LOWER[data]
    s, e = spans(low, off[:-1])
    return span_hashes(low, s, e), np.searchsorted(s, off)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct k-word shingle hashes; fewer words make one shingle, none make none."""
    for i, j in pieces(texts):
        words, off = word_hashes(texts.slice(i, j - i))
        h = words[: max(0, len(words) - k + 1)].copy()
        for d in range(1, k):
            h = mix(h * U(0xD6E8FEB86659FD93) + words[d : d + len(h)])
        for t in range(j - i):
            a, b = off[t], off[t + 1]
            if b - a >= k:
                yield np.unique(h[a : b - k + 1])
            elif b > a:
                x = words[a : a + 1]
                for w in words[a + 1 : b]:
                    x = mix(x * U(0xD6E8FEB86659FD93) + w)
                yield mix(x + U(int(b - a)))
            else:
                yield words[:0]
