"""Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 texts as numpy arrays.

Whole Arrow batches are split and hashed at once: byte masks give word bounds, a
polynomial prefix hash modulo 2**64 gives each word's hash from two look-ups, and
n-gram hashes roll over the word hashes.  Byte-level arrays cover one chunk of a
text at a time, so memory follows the chunk, and word-level arrays the text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

from .util import mix64

CHUNK = 1 << 18        # bytes whose masks and prefix hashes are held at once
LONG_WORD = 1 << 16    # longer words are hashed by blake2b
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None:
        n = CHUNK + LONG_WORD + 2
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """Words of some rows, row by row: byte bounds, hash, code points, row, line."""
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    chars: np.ndarray
    row: np.ndarray


def _chunk_words(data, lo, hi, fresh):
    """Words of data[lo:hi]; ``fresh`` marks byte positions that begin a row."""
    b = data[lo:hi]
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    if not inside.any():
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cut = np.zeros(len(b), bool)
    cut[fresh - lo] = True
    starts = np.flatnonzero(inside & (~before | cut))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:] & ~cut[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables()
    length = ends - starts
    points = np.zeros(len(b) + 1, np.int64)
    np.cumsum((b & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    if len(b) < len(up):
        prefix = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_TABLE[b] * up[:len(b)], out=prefix[1:])
        h = (prefix[ends] - prefix[starts]) * down[starts]
    else:
        h = np.zeros(len(starts), np.uint64)
    for i in np.flatnonzero(length > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(b[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    if len(b) >= len(up):  # only where one word is longer than a chunk: its neighbours are hashed one by one
        for i in np.flatnonzero(length <= LONG_WORD):
            w = b[starts[i]:ends[i]]
            h[i] = (_TABLE[w] * up[:len(w)]).sum(dtype=np.uint64)
    return starts + lo, ends + lo, mix64(h + length.astype(np.uint64) * _U(0xD6E8FEB86659FD93)), chars


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the rows ``data[offsets[i]:offsets[i + 1]]``."""
    parts, lo, stop = [], int(offsets[0]), int(offsets[-1])
    begins = np.unique(offsets[:-1][np.diff(offsets) > 0])
    while lo < stop:
        hi = min(stop, lo + CHUNK)
        while hi < stop:  # a chunk ends at white space or at a row's end
            at = begins[np.searchsorted(begins, hi - LONG_WORD):np.searchsorted(begins, hi, "right")]
            b = data[max(lo, hi - LONG_WORD):hi]
            space = np.flatnonzero((b == 32) | ((b >= 9) & (b <= 13)))
            cuts = ([int(at[-1])] if len(at) and at[-1] > lo else []) + \
                ([max(lo, hi - LONG_WORD) + int(space[-1]) + 1] if len(space) else [])
            if cuts:
                hi = max(cuts)
                break
            hi = min(stop, hi + LONG_WORD)
        fresh = begins[np.searchsorted(begins, lo):np.searchsorted(begins, hi)]
        parts.append(_chunk_words(data, lo, hi, fresh))
        lo = hi
    if not parts:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, np.uint64), z, z)
    start, end, h, chars = (np.concatenate(x) for x in zip(*parts))
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, h, chars, row)


def ngrams(words: Words, n: int, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of n-word windows that stay in one row, and their hashes."""
    size = len(words.hash) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.row[:size] == words.row[n - 1:])
    return at, ngram_hash(words.hash, at, n)


def ngram_hash(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = h[at]
    for j in range(1, n):
        out = out * _U(_BASE) + h[at + j]
    return mix64(out)
