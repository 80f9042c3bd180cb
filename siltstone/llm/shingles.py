"""Hashes of words and word shingles of whole blocks of texts, without a loop.

A word's hash is a polynomial of its bytes modulo 2**64, with random byte values
and a random odd base, taken from running sums. A shingle's hash is a second
polynomial of its words' hashes, finished by a mixer. Both only depend on the
bytes, so they agree between tasks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, count: int) -> np.ndarray:
    """``count`` reproducible 64-bit values."""
    return mix((np.arange(count, dtype=_U) + _U(1)) * _BASE + _U(seed))


@lru_cache(maxsize=8)
def _byte_values(lower: bool) -> np.ndarray:
    values = stream(7, 256)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_powers: list[np.ndarray] = []


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < count:
        size = max(1 << 16, 1 << (count - 1).bit_length())
        with np.errstate(over="ignore"):
            up = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(size - 1, _BASE)]))
            down = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(size - 1, _INVERSE)]))
        _powers[:] = [up, down]
    return _powers[0], _powers[1]


#: Bytes hashed at once, so that tables and running sums stay small for a whole block.
PORTION = 1 << 16


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of the bytes starts[i]:ends[i], for sorted, disjoint ranges."""
    out = np.empty(len(starts), _U)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PORTION, side="right")))
        low, high = int(starts[first]), int(ends[last - 1])
        up, down = _power_tables(high - low + 1)
        sums = np.zeros(high - low + 1, _U)
        np.cumsum(_byte_values(lower)[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U) * _U(0xA24BAED4963EE407))
        first = last
    return out


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """(row, start, end) of every word: bytes of a set, up to the end of a text."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    member = inside[data]
    new = np.empty(len(data), bool)
    new[0] = True
    new[1:] = ~member[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    new[edges] = True
    starts = np.flatnonzero(member & new)
    over = np.empty(len(data), bool)
    over[-1] = True
    over[:-1] = ~member[1:]
    over[edges - 1] = True
    ends = np.flatnonzero(member & over) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def byte_set(*parts) -> np.ndarray:
    table = np.zeros(256, bool)
    for part in parts:
        table[part] = True
    return table


#: Words between ASCII white space.
NOT_WHITE = ~byte_set(0x20, slice(0x09, 0x0E))


def shingles(rows: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words; a shorter text is one run."""
    n = len(hashes)
    if not n:
        return rows, hashes
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    counts = np.diff(np.append(first, n))
    full = np.ones(n, bool)
    for i in range(1, width):
        full[max(0, n - i) :] = False
        full[: n - i] &= rows[i:] == rows[: n - i]
    code = np.zeros(n, _U)
    factor = 1
    for i in range(width):
        part = np.zeros(n, _U)
        part[: max(0, n - i)] = hashes[i:]
        code += part * _U(factor)
        factor = factor * _WORD_BASE % (1 << 64)
    short = first[counts < width]
    for i, size in zip(short.tolist(), counts[counts < width].tolist()):
        total, factor = 0, 1
        for word in hashes[i : i + size].tolist():
            total += word * factor
            factor = factor * _WORD_BASE
        # The length tells a short text from a run of the same words.
        code[i] = _U((total + size * 0x632BE59BD9B4E019) % (1 << 64))
        full[i] = True
    return rows[full], mix(code[full])


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value) pairs, sorted."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.append(True, (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])) if len(rows) else rows > 0
    return rows[keep], values[keep]
