"""Exact substring dedup: every stretch of bytes that a document before has, too.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document of smaller id. No step holds more than its part of the texts:

1. **Shards.** Texts are dealt to shards of bounded size. Each gets a suffix
   array of the text under strings whose mark (step 2) stands in it at two places
   or more; others are unique in the shard. Suffixes are ordered by their first
   bytes, and groups that are still alike are refined by the ranks of the suffixes
   behind them, the known depth doubling each round (Larsson and Sadakane), until
   they are ordered by ``length`` bytes. Common prefixes follow by Kasai's rule: a
   suffix shares with its neighbour at most one byte less than the suffix before
   it; many places of the text walk at once. Neighbours that share ``length`` bytes
   are one string, and the smallest id that has it is known in the shard. Only that
   one matters outside, so what stands in a third of all documents leaves a shard
   once.
2. **Marks.** A string's mark is the smallest hash among the pieces of
   ``MARK_GRAM`` bytes in it; neighbouring strings mostly share theirs, from the
   same place. Equal strings have equal marks from different places. Shards
   exchange their marks, a few bytes for each, cut to a width that follows from
   the number of marks. Strings whose mark no other shard has are unique.
3. **Merging.** The other strings go to bins as stretches of text, by the smallest
   hash of shorter pieces (about 20 strings in 70 bytes), so equal strings meet
   wherever they come from. A bin cuts its strings into parts, sorts each by
   fingerprint and merges the sorted parts by binary search; a hit counts if all
   bytes agree.
4. **Cutting.** Spans return to the shards, where the texts still are: the texts
   are shuffled once, and that exchange serves the steps 1, 3 and 4.

The numbers of shards and bins follow from the bytes, so each is as large at any
scale. Texts longer than a shard are read in overlapping pieces.

Defined results: null and empty texts, and those shorter than ``length``, lose
nothing; rows with a null id are left as they are and not compared; rows that
share an id aren't compared with each other, and repeated rows lose the same;
ties can't occur, as only a smaller id takes a byte. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.arrow_text import flat

LENGTH = 50
#: Bytes that a suffix array takes (places in it fit into 21 bits), and mean bytes of a shard.
UNIT, SHARD_BYTES = (1 << 21) - 4096, 3 << 19
#: Bytes of the pieces whose smallest hash marks a string, and of those that pick its bin.
MARK_GRAM, GRAM = 24, 12
#: Places hashed at once.
STRETCH = 1 << 14
#: Bytes of text for each bin of marks and of strings, and strings sorted at once in one.
MARKS_BYTES, BIN_BYTES, PART = 16 << 20, 4 << 20, 1 << 19

_BITS = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)
_NUMBER = np.uint64(PART - 1)


# Suffix arrays ----------------------------------------------------------------


def words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a big-endian number; zeros follow the end."""
    n = len(data)
    out = np.zeros(n + 8, np.uint64)
    out[:n] = data
    for have in (1, 2, 4):
        ahead = out[have:].copy()
        out <<= np.uint64(8 * have)
        out[: len(ahead)] |= ahead
    return out[:n]


def suffix_array(word: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of a text, given by its :func:`words`, in order of the ``depth`` bytes that begin there, and where in it the last round was.

    Keys and places are packed into one number, so that plain sorting orders
    places; that bounds a shard to 2**21 bytes. A suffix that isn't refined in the
    last round, or earlier, shares fewer than ``depth`` bytes with all others.
    """
    n = len(word)
    assert n <= 1 << 21
    known = min(5, depth)
    packed = ((word >> np.uint64(64 - 8 * known)) << _BITS) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & _MASK).astype(np.int32)
    packed >>= _BITS
    first = np.empty(n, bool)
    first[:1] = True
    np.not_equal(packed[1:], packed[:-1], out=first[1:])
    # The rank of a suffix is the place of its group in the order, counted from 1.
    rank = np.zeros(n + depth, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(1, n + 1, dtype=np.int32), 0))
    alone = first.copy()
    alone[:-1] &= first[1:]
    active = np.flatnonzero(~alone).astype(np.int32)
    while known < depth and len(active):
        step = min(known, depth - known)
        members = order[active]
        begins = first[active]
        # A group has two members at least: 20 bits, and 22 bits for a rank.
        packed = (np.cumsum(begins, dtype=np.int64) - 1).astype(np.uint64)
        packed <<= np.uint64(22)
        packed |= rank[members + np.int32(step)].astype(np.uint64)
        packed <<= _BITS
        packed |= np.arange(len(active), dtype=np.uint64)
        packed.sort()
        members = members[(packed & _MASK).astype(np.int32)]
        packed >>= _BITS
        begins = np.append(True, packed[1:] != packed[:-1])
        order[active] = members
        first[active] = begins
        rank[members] = np.maximum.accumulate(np.where(begins, active + np.int32(1), 0))
        known += step
        if known < depth:
            active = active[~(begins & np.append(begins[1:], True))]
    return order, active


def common_prefixes(word: np.ndarray, order: np.ndarray, depth: int, wanted: np.ndarray, lanes: int = 4096) -> np.ndarray:
    """How many bytes the suffixes at ``wanted`` places of the order share with the ones before them, up to ``depth``.

    Kasai's rule, in order of the text: one byte less than the place before. It
    holds for prefixes below ``depth``, to which the suffixes are ordered; after a
    full one the count starts anew, as it does behind a place that isn't wanted.
    Several parts of the text are walked at once.
    """
    n = len(word)
    shared = np.zeros(len(wanted), np.int32)
    if not len(wanted):
        return shared
    # In order of the text; the first suffix of all has none before it.
    in_text = np.argsort(order[wanted])
    places = order[wanted][in_text]
    before = np.where(wanted > 0, order[np.maximum(wanted - 1, 0)], -1)[in_text]
    follows = np.append(False, np.diff(places) == 1)
    stride = -(-len(places) // lanes)
    lane = np.arange(0, len(places), stride)
    h = np.zeros(len(lane), np.int64)
    for _ in range(stride):
        at, other = places[lane], before[lane]
        h = np.where((h < depth) & follows[lane] & (other >= 0), np.maximum(h - 1, 0), 0)
        # Zeros behind the end agree with each other; bytes that don't exist don't count.
        room = np.minimum(depth, n - np.maximum(at, other))
        live = np.flatnonzero((other >= 0) & (h < room))
        while len(live):
            differ = word[at[live] + h[live]] ^ word[other[live] + h[live]]
            # The highest bit stays alone with the one below clear, so that no rounding moves it.
            highest = np.frexp((differ & ~(differ >> np.uint64(1))).astype(np.float64))[1]
            equal = (64 - highest) >> 3
            h[live] += equal
            live = live[(equal == 8) & (h[live] < room[live])]
        h = np.minimum(h, room)
        shared[in_text[lane]] = h
        inside = lane + 1 < len(places)
        lane, h = lane[inside] + 1, h[inside]
    return shared


def least_of_equal(word: np.ndarray, owner: np.ndarray, valid: np.ndarray, depth: int) -> np.ndarray:
    """For each place the smallest owner of an equal string; ``valid`` places count only."""
    least = owner.copy()
    order, refined = suffix_array(word, depth)
    alike = common_prefixes(word, order, depth, refined) >= depth
    # A suffix that is alike stands right behind one that was refined with it.
    grouped = alike.copy()
    grouped[:-1] |= alike[1:]
    places, group = order[refined[grouped]], np.cumsum(~alike[grouped])
    counted = valid[places]
    places, group = places[counted], group[counted]
    if len(places):
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        smallest = np.minimum.reduceat(owner[places], begin)
        least[places] = np.repeat(smallest, np.diff(np.append(begin, len(places))))
    return least


# Shards -----------------------------------------------------------------------


@dataclass
class Unit:
    """Pieces of texts end to end: what one suffix array takes."""

    ids: pa.Array
    codes: np.ndarray
    at: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def __post_init__(self) -> None:
        self.text = np.repeat(np.arange(len(self.codes), dtype=np.int32), np.diff(self.offsets))
        self.word = words(self.data)

    def strings(self, length: int) -> np.ndarray:
        """Where a string of ``length`` bytes ends inside its piece."""
        valid = np.ones(len(self.data), bool)
        for begin, end in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            valid[max(begin, end - length + 1) : end] = False
        return valid


def units(texts: pa.Table, limit: int, overlap: int) -> Iterator[Unit]:
    """The distinct texts of a shard, (id, code, text), in at most ``limit`` bytes at once.

    The pieces of a long text share ``overlap`` bytes.
    """
    if not texts.num_rows:
        return
    ids, codes, rank = texts["id"].combine_chunks(), texts["code"].to_numpy(), ranks(texts["id"])
    data, offsets = flat(texts["text"].combine_chunks())
    order = np.lexsort((codes, rank))
    first = np.append(True, (np.diff(rank[order]) != 0) | (np.diff(codes[order]) != 0))
    held, size = [], 0
    for i in order[first].tolist():
        text, at = data[offsets[i] : offsets[i + 1]], 0
        while len(text) - at > overlap:
            piece = text[at : at + limit]
            if size + len(piece) > limit:
                yield _unit(held, ids, codes)
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
            at += len(piece) - overlap
    if held:
        yield _unit(held, ids, codes)


def _unit(held: list, ids: pa.Array, codes: np.ndarray) -> Unit:
    rows, at, pieces = zip(*held, strict=True)
    offsets = np.append(0, np.cumsum([len(p) for p in pieces]))
    rows = np.array(rows, np.int64)
    return Unit(ids.take(pa.array(rows)), codes[rows], np.array(at, np.int64), np.concatenate(pieces), offsets)


def ranks(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Numbers that order and compare as the ids do."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)[1].astype(np.int32)


def smallest_pieces(word: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places): the hash of the piece of ``gram`` bytes at each place, and where the smallest one within ``length`` bytes from there is.

    Hashes are ordered by their upper 43 bits; of equal ones the first counts. The
    text is worked on in stretches that stay in a processor's cache.
    """
    n, width = len(word), length - gram + 1
    hashes, places = np.empty(n, np.uint64), np.empty(n, np.int32)
    for low in range(0, n, STRETCH):
        # Hashes of this stretch and of the places that its last windows reach.
        part = word[low : low + STRETCH + width + gram]
        h = np.zeros(len(part), np.uint64)
        for step in range(0, gram, 8):
            ahead = part[step:]
            h[: len(ahead)] ^= ahead >> np.uint64(8 * max(0, step + 8 - gram))
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        hashes[low : low + STRETCH] = h[:STRETCH]
        least = h & ~_MASK
        least |= np.arange(low, low + len(h), dtype=np.uint64)
        have, other = 1, np.empty_like(h)
        while have < width and have < len(h):
            shift = min(have, width - have)
            np.minimum(least[:-shift], least[shift:], out=other[:-shift])
            other[-shift:] = least[-shift:]
            least, other, have = other, least, have + shift
        places[low : low + STRETCH] = least[:STRETCH] & _MASK
    return hashes, places


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Smallest hashes are small; these are spread over all 64 bits again."""
    h = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def mark_bytes(total: int) -> int:
    """Bytes of a mark: at most one unique mark in a hundred should meet another by chance."""
    marks = max(1, 2 * total // (LENGTH - MARK_GRAM + 2))
    return min(8, max(4, -(-(marks.bit_length() + 7) // 8)))


def to_bytes(marks: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(marks.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def from_bytes(blob: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(blob) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(blob, np.uint8).reshape(-1, size)
    return out.reshape(-1).view("<u8")


def marks_of(unit: Unit, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(marks, counts): the marks of the strings at all places, and at how many in a row from the same place.

    Equal strings have equal marks from different places: each is in a run of its own.
    """
    hashes, at = smallest_pieces(unit.word, MARK_GRAM, length)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    marks = mixed(hashes[at[first]])
    marks = marks & np.uint64((1 << (8 * size)) - 1) if size < 8 else marks
    return marks, np.diff(np.append(first, len(at)))


def covered(places: np.ndarray, length: int) -> np.ndarray:
    """The bytes of the strings that begin where ``places`` is true."""
    begun = np.cumsum(places, dtype=np.int32)
    out = begun > 0
    out[length:] = begun[length:] > begun[:-length]
    return out


def owned_before(unit: Unit, valid: np.ndarray, marks: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Where a string begins that a smaller id of the unit has, too.

    Strings whose mark is in one run only are unique; the others' text, with what
    lies between taken out, gets a suffix array. No string of it crosses a gap.
    """
    begin = np.cumsum(counts) - counts
    held = np.sort(marks[np.logical_or.reduceat(valid, begin)])
    may = valid & np.repeat(_among(marks, held[1:][held[1:] == held[:-1]]), counts)
    before = np.zeros(len(valid), bool)
    kept = np.flatnonzero(covered(may, length))
    if len(kept):
        owner = ranks(unit.ids)[unit.text[kept]]
        before[kept] = least_of_equal(words(unit.data[kept]), owner, may[kept], length) < owner
    return before


def runs_of(places: np.ndarray, edges: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the strings at ascending ``places``, neighbours together; none crosses an edge."""
    if not len(places):
        return places, places
    text = np.searchsorted(edges, places, side="right")
    new = np.append(True, (np.diff(places) > 1) | (np.diff(text) > 0))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(places) - 1)
    return places[new], places[last] + length


def _lists(values: np.ndarray | pa.Array, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))


def _blobs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, count: np.ndarray) -> pa.Array:
    """Stretches of ``data`` end to end, ``count`` of them in each value."""
    total = np.append(0, np.cumsum(size))
    take = np.arange(total[-1]) + np.repeat(begin - total[:-1], size)
    offsets = total[np.append(0, np.cumsum(count))].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(offsets), pa.py_buffer(data[take])])


#: What travels between shards and bins: spans of texts, and bytes. Marks have
#: bytes only, known spans have none, stretches have both.
PIECES = ["bin", "shard", "ids", "codes", "begins", "sizes", "bytes"]


def _pieces(unit: Unit, shard: int, bins: np.ndarray, begin: np.ndarray, size: np.ndarray, count: np.ndarray, blobs):
    of = unit.text[begin]
    return pa.record_batch(
        [
            pa.array(bins),
            pa.array(np.full(len(bins), shard)),
            _lists(unit.ids.take(pa.array(of)), count),
            _lists(unit.codes[of], count),
            _lists(begin - unit.offsets[of] + unit.at[of], count),
            _lists(size.astype(np.int32), count),
            blobs,
        ],
        PIECES,
    )


def shard_marks(texts: pa.Table, bins: int, size: int, length: int, limit: int = UNIT) -> Iterator[pa.RecordBatch]:
    """Strings that a smaller id of the shard has, and the marks of all others."""
    shard = texts["shard"][0].as_py() if texts.num_rows else 0
    for unit in units(texts, limit, length - 1):
        valid = unit.strings(length)
        marks, counts = marks_of(unit, length, size)
        known = owned_before(unit, valid, marks, counts, length)
        begin, end = runs_of(np.flatnonzero(known), unit.offsets[1:], length)
        if len(begin):
            one = np.array([len(begin)])
            yield _pieces(unit, shard, np.array([shard % bins]), begin, end - begin, one, pa.nulls(1, pa.binary()))
        marks = np.sort(marks[np.logical_or.reduceat(valid & ~known, np.cumsum(counts) - counts)])
        if len(marks):
            marks = marks[np.append(True, marks[1:] != marks[:-1])]
            bin_ = (marks % np.uint64(bins)).astype(np.int64)
            order = np.argsort(bin_, kind="stable")
            edge = np.flatnonzero(np.append(True, np.diff(bin_[order]) > 0))
            blobs = [to_bytes(part, size) for part in np.split(marks[order], edge[1:])]
            none = np.empty(0, np.int64)
            yield _pieces(unit, shard, bin_[order][edge], none, none, np.zeros(len(edge), np.int64), pa.array(blobs, pa.binary()))


def shared_marks(pieces: pa.Table, size: int) -> pa.Table:
    """The rows of one bin with the marks only that several units have."""
    blobs = pieces["bytes"].to_pylist()
    marks = [from_bytes(b or b"", size) for b in blobs]
    every = np.sort(np.concatenate(marks))
    shared = every[1:][every[1:] == every[:-1]]
    kept = [b if b is None else to_bytes(m[_among(m, shared)], size) for b, m in zip(blobs, marks, strict=True)]
    at = pieces.schema.get_field_index("bytes")
    return pieces.set_column(at, pieces.schema.field(at), pa.array(kept, pa.binary()))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def shard_strings(
    texts: pa.Table, replies: pa.Table, bins: int, size: int, length: int, limit: int = UNIT
) -> Iterator[pa.RecordBatch]:
    """The strings of a shard with shared marks, dealt to bins; what was known goes along."""
    if not replies.num_rows:
        return
    marks = replies.filter(pc.is_valid(replies["bytes"]))
    shared = np.unique(from_bytes(b"".join(marks["bytes"].to_pylist()), size))
    known = replies.filter(pc.is_null(replies["bytes"])).select(PIECES)
    spans = _table(known["shard"], known["ids"], known["codes"], known["begins"], known["sizes"])
    shard = texts["shard"][0].as_py()
    yield from known.set_column(0, "bin", pa.array(np.full(known.num_rows, shard % bins))).to_batches()
    if not len(shared):
        return
    for unit in units(texts, limit, length - 1):
        marks, counts = marks_of(unit, length, size)
        open_ = unit.strings(length) & np.repeat(_among(marks, shared), counts)
        open_[_places(unit, spans, length)] = False
        places = np.flatnonzero(open_)
        if not len(places):
            continue
        # Only the text under open strings is hashed, with what lies between taken out.
        kept = covered(open_, length)
        hashes, at = smallest_pieces(words(unit.data[kept]), GRAM, length)
        smallest = hashes[at[open_[kept]]]
        new = (np.diff(places) > 1) | (smallest[1:] != smallest[:-1]) | (np.diff(unit.text[places]) != 0)
        first = np.flatnonzero(np.append(True, new))
        strings = np.diff(np.append(first, len(places)))
        bin_ = (mixed(smallest[first]) % np.uint64(bins)).astype(np.int64)
        by_bin = np.argsort(bin_, kind="stable")
        bin_, begin, long = bin_[by_bin], places[first][by_bin], strings[by_bin] + length - 1
        edge = np.flatnonzero(np.append(True, bin_[1:] != bin_[:-1]))
        count = np.diff(np.append(edge, len(bin_)))
        yield _pieces(unit, shard, bin_[edge], begin, long, count, _blobs(unit.data, begin, long, count))


def _places(unit: Unit, spans: pa.Table, length: int) -> np.ndarray:
    """Where the strings of ``spans`` begin in the unit."""
    of = {}
    for i, key in enumerate(zip(unit.ids.to_pylist(), unit.codes.tolist(), strict=True)):
        of.setdefault(key, []).append(i)
    out = [np.empty(0, np.int64)]
    columns = [spans[c].to_pylist() for c in SPANS[1:]]
    for id_, code, begin, end in zip(*columns, strict=True):
        for i in of.get((id_, code), ()):
            # A text cut into pieces has several; each holds the strings within.
            low, high = unit.at[i], unit.at[i] + unit.offsets[i + 1] - unit.offsets[i]
            if begin >= low and end <= high:
                out.append(np.arange(begin, end - length + 1) - low + unit.offsets[i])
    return np.concatenate(out)


# Bins -------------------------------------------------------------------------


def fingerprints(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit number for the ``length`` bytes from each place of a part."""
    low = places[0] if len(places) else 0
    word = words(data[low : (places[-1] if len(places) else 0) + length])
    places = places - low
    out = np.zeros(len(places), np.uint64)
    for step in [*range(0, length - 8, 8), length - 8]:
        out = (out ^ word[places + step]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def alike(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at ``a`` and ``b`` are equal in all bytes."""
    whole = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])] if length >= 8 else []
    if whole:
        view = np.ndarray(max(0, len(data) - 7), np.uint64, data, strides=(1,))
    else:
        view, whole = data, range(length)
    out = np.empty(len(a), bool)
    for at in range(0, len(a), 1 << 14):
        left, right = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
        same = np.ones(len(left), bool)
        for step in whole:
            same &= view[left + step] == view[right + step]
        out[at : at + (1 << 14)] = same
    return out


class Merged:
    """Distinct strings in order of their fingerprints, with the smallest owner of each.

    Strings are places in ``data``. Fingerprints lack the bits that number the
    strings of a part, so that one plain sort orders both. Different ones of equal fingerprint are all
    but unheard of: such fingerprints are remembered, and their strings are told
    apart by their bytes in the end.
    """

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.prints = np.empty(0, np.uint64)
        self.places = np.empty(0, np.int64)
        self.least = np.empty(0, np.int32)
        self.clashing = np.empty(0, np.uint64)
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, places: np.ndarray, owner: np.ndarray) -> None:
        """One part, places ascending: sorted, folded to distinct strings, merged by binary search."""
        assert len(places) <= PART
        ordered = self._prints(places)
        ordered |= np.arange(len(places), dtype=np.uint64)
        ordered.sort()
        order = (ordered & _NUMBER).astype(np.int32)
        ordered &= ~_NUMBER
        first = np.append(True, ordered[1:] != ordered[:-1])
        begin, number = np.flatnonzero(first), np.cumsum(first) - 1
        heads, prints = places[order[begin]], ordered[begin]
        later = np.flatnonzero(~first)
        self._note(places[order[later]], alike(self.data, heads[number[later]], places[order[later]], self.length))
        group = np.empty(len(places), np.int32)
        group[order] = number
        self.parts.append((places, owner, group, prints))
        least = np.minimum.reduceat(owner[order], begin)
        at, known, hit = self._find(prints, heads)
        self._note(heads[known], hit[known])
        self.least[at[hit]] = np.minimum(self.least[at[hit]], least[hit])
        # New ones go in between, each behind those that stand before it.
        new = np.flatnonzero(~known)
        into = at[new] + np.arange(len(new))
        old = np.ones(len(self.prints) + len(new), bool)
        old[into] = False
        for name, values in (("prints", prints), ("places", heads), ("least", least)):
            held = getattr(self, name)
            whole = np.empty(len(old), held.dtype)
            whole[old], whole[into] = held, values[new]
            setattr(self, name, whole)

    def _prints(self, places: np.ndarray) -> np.ndarray:
        return fingerprints(self.data, places, self.length) & ~_NUMBER

    def _find(self, prints: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each stands or would stand, whether its fingerprint does, whether it does itself."""
        at = np.searchsorted(self.prints, prints)
        known = at < len(self.prints)
        known[known] = self.prints[at[known]] == prints[known]
        hit = known.copy()
        hit[known] = alike(self.data, self.places[at[known]], places[known], self.length)
        return at, known, hit

    def _bytes(self, place: int) -> bytes:
        return self.data[place : place + self.length].tobytes()

    def _note(self, places: np.ndarray, fine: np.ndarray) -> None:
        """Strings that share a fingerprint only are judged by their bytes in the end."""
        if not fine.all():
            clashing = self._prints(np.sort(places[~fine]))
            self.clashing = np.union1d(self.clashing, clashing)

    def taken(self) -> np.ndarray:
        """The places, ascending, whose string a smaller owner has."""
        out = []
        for _, _, group, prints in self.parts:
            out.append(self.least[np.searchsorted(self.prints, prints)][group])
        least = np.concatenate(out)
        places, owner = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        if len(self.clashing):
            some = np.flatnonzero(np.isin(self._prints(places), self.clashing))
            by_bytes: dict[bytes, int] = {}
            for i in some.tolist():
                text = self._bytes(int(places[i]))
                by_bytes[text] = min(int(owner[i]), by_bytes.get(text, int(owner[i])))
            least[some] = [by_bytes[self._bytes(int(places[i]))] for i in some.tolist()]
        return places[least < owner]


def bin_spans(pieces: pa.Table, length: int) -> pa.Table:
    """(shard, id, code, begin, end) of what smaller ids have, of all pieces of one bin."""
    blank = pc.is_null(pieces["bytes"])
    known, stretches = pieces.filter(blank), pieces.filter(pc.invert(blank))
    parts = [_table(known["shard"], known["ids"], known["codes"], known["begins"], known["sizes"])]
    if stretches.num_rows:
        ids = pc.list_flatten(stretches["ids"]).combine_chunks()
        begins, sizes = (pc.list_flatten(stretches[c]).to_numpy() for c in ("begins", "sizes"))
        codes = pc.list_flatten(stretches["codes"])
        shards = np.repeat(stretches["shard"].to_numpy(), pc.list_value_length(stretches["sizes"]).to_numpy())
        data = np.frombuffer(b"".join(stretches["bytes"].to_pylist()), np.uint8)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = ends - sizes
        strings = (sizes - length + 1).astype(np.int64)
        total = np.cumsum(strings)
        owner = ranks(ids)
        merged = Merged(data, length)
        for at in range(0, int(total[-1]), PART):
            number = np.arange(at, min(at + PART, total[-1]))
            of = np.searchsorted(total, number, side="right")
            merged.add(first[of] + number - (total[of] - strings[of]), owner[of])
        begin, end = runs_of(merged.taken(), ends, length)
        of = np.searchsorted(ends, begin, side="right")
        moved = begins[of] - first[of]
        parts.append(
            pa.table([pa.array(shards[of]), ids.take(pa.array(of)), codes.take(pa.array(of)), begin + moved, end + moved], SPANS)
        )
    return pa.concat_tables(parts)


SPANS = ["shard", "id", "code", "begin", "end"]


def _table(shard, ids, codes, begins, sizes) -> pa.Table:
    many = pc.fill_null(pc.list_value_length(sizes), 0).to_numpy()
    ids, codes, begins, sizes = (pc.list_flatten(c) for c in (ids, codes, begins, sizes))
    return pa.table(
        [pa.array(np.repeat(shard.to_numpy(), many)), ids, codes, begins, pc.add(begins, sizes.cast(pa.int64()))], SPANS
    )


# Plans ------------------------------------------------------------------------


def _dealt(docs: DataFrame, id_col: str, text: str, total: int) -> DataFrame:
    """(shard, id, code, text) of texts; the code tells texts of one id apart.

    The partition a row comes from spreads even equal rows. Three steps read what
    is dealt here, mostly from one exchange; so that a lost executor recomputes the
    same partitions, ``docs`` should be a scan of files or a written table.
    """
    shards = max(1, -(-total // SHARD_BYTES))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("code"), F.col(text).alias("text"))
    place = F.pmod(F.xxhash64("id", "code", F.spark_partition_id()), F.lit(shards).cast("long"))
    return keyed.select(place.alias("shard"), "id", "code", "text")


def _total_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def _spans(dealt: DataFrame, total: int, length: int, unit: int = UNIT) -> DataFrame:
    """(shard, id, code, begin, end) in bytes: what is to go; spans may touch, overlap or repeat."""
    assert GRAM < MARK_GRAM < length
    kind = dealt.schema["id"].dataType
    long = T.LongType()
    lists = {"ids": kind, "codes": long, "begins": long, "sizes": T.IntegerType()}
    pieces = T.StructType(
        [
            T.StructField("bin", long),
            T.StructField("shard", long),
            *[T.StructField(n, T.ArrayType(k)) for n, k in lists.items()],
            T.StructField("bytes", T.BinaryType()),
        ]
    )
    spans = T.StructType([T.StructField(n, k) for n, k in zip(SPANS, [long, kind, long, long, long], strict=True)])
    size, mark_bins, bins = mark_bytes(total), max(1, -(-total // MARKS_BYTES)), max(1, -(-total // BIN_BYTES))

    def long_enough(texts: pa.Table) -> pa.Table:
        enough = pc.greater_equal(pc.binary_length(texts["text"]), length)
        return texts.filter(pc.and_(pc.is_valid(texts["id"]), pc.fill_null(enough, False))).combine_chunks()

    def joined(texts: pa.Table, batches: Iterable[pa.RecordBatch]) -> pa.Table:
        whole, ids = pa.int64(), pa.list_(texts.schema.field("id").type)
        kinds = [whole, whole, ids, pa.list_(whole), pa.list_(whole), pa.list_(pa.int32()), pa.binary()]
        schema = pa.schema(list(zip(PIECES, kinds, strict=True)))
        return pa.Table.from_batches([b.cast(schema) for b in batches], schema)

    def mark(texts: pa.Table) -> pa.Table:
        return joined(texts, shard_marks(long_enough(texts), mark_bins, size, length, unit))

    def deal(texts: pa.Table, replies: pa.Table) -> pa.Table:
        return joined(texts, shard_strings(long_enough(texts), replies, bins, size, length, unit))

    replies = (
        dealt.groupBy("shard")
        .applyInArrow(mark, pieces)
        .groupBy("bin")
        .applyInArrow(lambda t: shared_marks(t, size), pieces)
        .withColumn("shard", F.col("shard") + 0)  # a column of its own
    )
    strings = dealt.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(deal, pieces)
    return strings.groupBy("bin").applyInArrow(lambda t: bin_spans(t, length), spans)


def repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text: str = "text", unit: int = UNIT
) -> DataFrame:
    """(id, code, begin, end) in bytes: what is to go; spans may touch, overlap or repeat.

    ``code`` is the 64-bit hash of the text, as xxhash64 gives it.
    """
    total = _total_bytes(docs, text)
    found = _spans(_dealt(docs, id_col, text, total), total, length, unit)
    return found.select(F.col("id").alias(id_col), "code", "begin", "end").distinct()


def merged_spans(spans: pa.Table) -> pa.Table:
    """(id, code, begin, end) of maximal spans, in this order; those that touch or overlap are one."""
    code, begin, end = (spans[c].to_numpy() for c in ("code", "begin", "end"))
    rank = ranks(spans["id"])
    order = np.lexsort((begin, code, rank))
    code, begin, end, rank = code[order], begin[order], end[order], rank[order]
    text = np.append(0, np.cumsum((np.diff(code) != 0) | (np.diff(rank) != 0)))[: len(order)]
    # A place in a text is below 2**31: numbers of texts go above it.
    until = np.maximum.accumulate((text << 32) | end)
    new = np.flatnonzero(np.append(True, ((text << 32) | begin)[1:] > until[:-1])[: len(order)])
    last = np.append(new[1:], len(order))[: len(new)] - 1
    ids = spans["id"].combine_chunks().take(pa.array(order[new]))
    return pa.table([ids, pa.array(code[new]), pa.array(begin[new]), pa.array(until[last] & 0xFFFFFFFF)], SPANS[1:])


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_bytes, removed, kept): maximal removed spans in bytes, and the bytes that stay."""
    total = _total_bytes(docs, text)
    dealt = _dealt(docs, id_col, text, total)
    spans = _spans(dealt, total, length).withColumn("shard", F.col("shard") + 0)  # a column of its own
    long = T.LongType()
    ends = T.StructType([T.StructField("begin", long), T.StructField("end", long)])
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", long),
            T.StructField("removed", T.ArrayType(ends)),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(texts: pa.Table, spans: pa.Table) -> pa.Table:
        found: dict[tuple, list[tuple[int, int]]] = {}
        for id_, code, begin, end in zip(*[c.to_pylist() for c in merged_spans(spans).columns], strict=True):
            found.setdefault((id_, code), []).append((begin, end))
        sizes, removed, kept = [], [], []
        for id_, code, text in zip(texts["id"].to_pylist(), texts["code"].to_pylist(), texts["text"], strict=True):
            raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            gone = found.get((id_, code), [])
            at, left = 0, []
            for begin, end in gone:
                left.append(raw[at:begin])
                at = end
            sizes.append(len(raw))
            kept.append(b"".join([*left, raw[at:]]))
            removed.append([{"begin": b, "end": e} for b, e in gone])
        columns = [texts["id"], pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())]
        return pa.table(columns, out.names)

    return dealt.groupBy("shard").cogroup(spans.groupBy("shard")).applyInArrow(cut, out)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return without_repeats(docs, length).select(
        "doc_id",
        "n_bytes",
        lost.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
