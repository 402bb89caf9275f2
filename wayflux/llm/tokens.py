"""Vectorised words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word's hash is a polynomial over random 64-bit values of its bytes, taken from one running sum,
so words need no loop. Texts are handled in blocks of rows, long texts in blocks of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACES = bytes([0x20, *range(0x09, 0x0E)])
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z, and no other letter
NOT_SPACE = ~np.isin(np.arange(256), list(SPACES))
ALNUM = np.zeros(256, bool)  # of lower-cased text: digits, a-z and all bytes of other characters
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NOT_NEWLINE = np.arange(256) != 10

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    if len(_powers.get("p", ())) < n:
        size = max(n, BLOCK + 1)
        for name, base in (("p", _P), ("i", _PINV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=np.uint64)
    return _powers["p"][:n], _powers["i"][:n]


_S32, _S29, _M1, _M2 = np.uint64(32), np.uint64(29), np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9FB21C651E98DF25)
_seeds: dict[int, np.uint64] = {}


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of h and of the seed."""
    if seed not in _seeds:
        _seeds[seed] = np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) % (1 << 64))
    h = h ^ _seeds[seed]
    h ^= h >> _S32
    h *= _M1
    h ^= h >> _S29
    h *= _M2
    h ^= h >> _S32
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its n + 1 row bounds; a null is an empty text."""
    a = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(a.type) else np.int32
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(a.buffers()[1], kind)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    raw = a.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_blocks(bounds: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes, one row at least."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield i, j
        i = j


def _words(block: np.ndarray, cuts: np.ndarray, keep: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(block)
    folded = fold[block]
    inside = keep[folded]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begin[cuts] = inside[cuts]
    finish[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_RANDOM[folded] * up[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return start, end, mix(h + (end - start).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray = NOT_SPACE, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a block of rows, and the word bounds of its rows.

    `data` holds the rows' bytes, `bounds` their bounds in it.
    """
    if len(data) <= 4 * BLOCK:
        start, end, h = _words(data, bounds, keep, fold)
    else:  # one long text: cut between words
        parts, at = [], 0
        while at < len(data):
            stop = min(at + BLOCK, len(data))
            while stop < len(data):
                gaps = np.flatnonzero(~keep[fold[data[stop : stop + BLOCK]]])
                if len(gaps):
                    stop += int(gaps[0])
                    break
                stop = min(stop + BLOCK, len(data))
            s, e, h = _words(data[at:stop], bounds - at, keep, fold)
            parts.append((s + at, e + at, h))
            at = stop
        start, end, h = (np.concatenate([p[k] for p in parts]) for k in range(3))
    return start, end, h, np.searchsorted(start, bounds)


def shingles(h: np.ndarray, word_bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of n words; a shorter text is one run, an empty one none."""
    out = []
    acc = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n if len(h) >= n else 0):
        acc = acc * np.uint64(_P) + h[k : len(h) - n + 1 + k]
    runs = mix(acc, n)
    for a, b in zip(word_bounds[:-1], word_bounds[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = np.uint64((int(one) * _P + int(x)) % (1 << 64))
            out.append(mix(np.array([one], np.uint64), 1000 + int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a flag or number per byte (or word) over each row."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
