"""Vectorised hashing of words and word shingles over the bytes of Arrow string columns (numpy, no per-word Python)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21  # bytes hashed at a time; a longer text is one chunk of its own
MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = _PLAIN.copy()
_LOWER[65:91] = _PLAIN[97:123]
_BASE, _INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        for k, b in enumerate((_BASE, _INVERSE)):
            t = np.full(size, np.uint64(b))
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers[0][:n], _powers[1][:n]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    at = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, row) of every word (maximal run of bytes other than ASCII white space) of consecutive texts."""
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets[:-1][offsets[:-1] < len(raw)]] = True
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = word[1:]
    edge[len(raw)] = True
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    up, down = _power_tables(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum((_LOWER if lower else _PLAIN)[raw] * up[:-1], out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return h, start, end, np.searchsorted(offsets, start, "right") - 1


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by row): every run of ``k`` words of a row; fewer words count as one shingle."""
    count = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])
    n = len(words)
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h += mix(words[j : n - k + 1 + j], j + 1)
        h, whole = mix(h), rows[: n - k + 1] == rows[k - 1 :]
        h, at = h[whole], rows[: n - k + 1][whole]
    else:
        h, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.array([mix(np.array([sum(int(mix(words[first[r] + j : first[r] + j + 1], 100 * int(count[r]) + j)[0]) for j in range(count[r])) & (2**64 - 1)], np.uint64))[0] for r in short], np.uint64)
        h, at = np.concatenate([h, extra]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
    return h, np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n_rows))])


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column, in order."""
    raw, offsets = texts_of(column)
    for lo, hi in chunks(offsets):
        part, at = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        h, _, _, row = word_hashes(part, at)
        s, cut = shingle_hashes(h, row, hi - lo, k)
        for i in range(hi - lo):
            yield np.unique(s[cut[i] : cut[i + 1]])
