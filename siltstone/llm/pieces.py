"""Cutting text into pieces before the merges of a byte-level vocabulary.

The pattern: a contraction; an optional space before letters, before numbers,
or before other characters that aren't white space; white space up to the last
one before a word; other white space. Each rule only looks at neighbouring
characters, so all cuts of a block are found at once from character classes.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)
# Unicode's white space; what may follow an apostrophe.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
SHORT, LONG = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
    )
    table[[ord(c) for c in WHITE_SPACE]] = SPACE
    return table


def cut(data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int]) -> np.ndarray:
    """Byte positions at which pieces begin; ``data`` must be valid UTF-8."""
    if not len(data):
        return np.empty(0, np.int64)
    raw = data.tobytes()
    if raw.isascii():
        chars, byte_at = data, None
    else:
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
    places = _special_places(raw, offsets, special)
    edges = np.unique(np.concatenate([offsets, *places])) if places else offsets
    edges = edges[(edges > 0) & (edges < len(data))]
    if byte_at is not None:
        edges = np.searchsorted(byte_at, edges)

    kind = classes()[chars]
    same = kind[1:] == kind[:-1]
    white = kind == SPACE
    start = np.empty(len(chars), bool)
    start[0] = True
    # A space belongs to the word after it; other white space doesn't.
    start[1:] = ~same & (chars[:-1] != 32)
    # The last white space of a run stands apart if a word follows.
    start[1:] |= white[1:] & ~white[:-1]
    start[:-1] |= white[:-1] & ~white[1:]
    # Texts begin and end here: no run goes on across, and a run before isn't cut.
    start[edges] = True
    before = edges - 1
    run_goes_on = white[before] & (before > 0)
    inner = before[run_goes_on]
    tops = np.zeros(len(chars), bool)
    tops[edges] = True
    start[inner] = ~white[inner - 1] | tops[inner]
    _contractions(chars, start, tops)

    at = np.flatnonzero(start)
    at = at.astype(np.int64) if byte_at is None else byte_at[at]
    for first, last in places:
        at = at[(at <= first) | (at >= last)]
    return at


def _contractions(chars: np.ndarray, start: np.ndarray, tops: np.ndarray) -> None:
    marks = np.flatnonzero((chars == 39) & start)
    n = len(chars)
    for i in marks[marks < n - 1].tolist():
        if tops[i + 1]:
            continue
        if chr(chars[i + 1]) in SHORT:
            length = 2
        elif i < n - 2 and not tops[i + 2] and chr(chars[i + 1]) + chr(chars[i + 2]) in LONG:
            length = 3
        else:
            continue
        start[i + 1 : i + length] = False
        if i + length < n:
            start[i + length] = True


def _special_places(raw: bytes, offsets: np.ndarray, special: dict[bytes, int]) -> list[np.ndarray]:
    found = []
    for token in special:
        at = raw.find(token)
        while at >= 0:
            end = at + len(token)
            if np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, end, side="left"):
                found.append(np.array([at, end], np.int64))
                at = raw.find(token, end)
            else:
                at = raw.find(token, at + 1)
    return found
