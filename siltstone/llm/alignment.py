"""Two tokenizers' tokens of the same text, linked through its bytes.

A text is encoded by both. Each tokenizer gives a sparse matrix of tokens by
bytes, 1 where a token covers a byte, in compressed rows: the places where rows
begin, and their columns. The product A * B^T, worked out row by row after
Gustavson, holds for each pair of tokens how many bytes they share: its entries
are the overlap links. Bytes where tokens of both end cut the text into groups;
the products of tokens-by-groups matrices link all tokens of a group.

Texts go through Arrow tasks in chunks of bounded size. A chunk writes its
documents once, with their links as numbers into the chunk's list of id pairs,
so that no text is encoded twice. Only id pairs, folded for each chunk, are
counted across the corpus; the counts come back to the chunks, and no task sees
a table of all pairs. A frequent pair is one row for each chunk that has it.

Texts are encoded in words, cut at each space that has no white space beside it:
there the first tokenizer always cuts, and the second has no token that goes on
across a space (checked when it is loaded; else texts stay whole). So a worker
encodes a word once and looks it up from then on, in a lexicon of bounded size.

Defined results: texts that are null, empty, or whose bytes the tokens of either
don't spell (such as a text that holds the second one's sign for a space) have
no tokens and no links; strings of special tokens are plain text; rows count as
they come, also repeated ones or those with null ids; of pairs with the same
count all are the best. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.arrow_text import narrow_batches
from siltstone.llm.bpe import byte_letters
from siltstone.runtime import durable

#: Characters in a chunk, links worked out at once, words and characters in a lexicon.
CHUNK, ROWS, WORDS, LEXICON = 2 << 20, 1 << 22, 400_000, 8 << 20
#: New words encoded in one text.
TOGETHER = 4096
#: Fixed value: the second vocabulary's sign for a space.
SPACE = "▁"


# Matrices ---------------------------------------------------------------------


@dataclass
class Rows:
    """A sparse matrix in compressed rows; entry values are counts."""

    begin: np.ndarray
    column: np.ndarray
    value: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.begin) - 1


def incidence(sizes: np.ndarray) -> Rows:
    """Tokens by bytes, for tokens that follow each other."""
    begin = np.append(0, np.cumsum(sizes, dtype=np.int64))
    total = int(begin[-1])
    return Rows(begin, np.arange(total), np.ones(total, np.int32), total)


def membership(group: np.ndarray, groups: int) -> Rows:
    """Tokens by groups; each token is in one."""
    return Rows(np.arange(len(group) + 1), group, np.ones(len(group), np.int32), groups)


def transposed(m: Rows) -> Rows:
    """Columns become rows; within one, entries keep the order of the rows they came from."""
    row = np.repeat(np.arange(len(m)), np.diff(m.begin))
    order = np.argsort(m.column, kind="stable") if (np.diff(m.column) < 0).any() else slice(None)
    counts = np.bincount(m.column, minlength=m.width)
    return Rows(np.append(0, np.cumsum(counts)), row[order], m.value[order], len(m))


def row_sizes(a: Rows, b: Rows) -> np.ndarray:
    """How many products each row of a * b sums up, before equal columns are joined."""
    sizes = np.append(0, np.cumsum(np.diff(b.begin)[a.column]))
    return sizes[a.begin[1:]] - sizes[a.begin[:-1]]


def product(a: Rows, b: Rows, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of rows ``first`` to ``last`` of a * b.

    Gustavson's rule: row i is the sum of the rows of b that row i of a names,
    each times its entry. Rows are kept apart by number while equal columns of
    one are added up.
    """
    last = len(a) if last is None else last
    inside = slice(a.begin[first], a.begin[last])
    row = np.repeat(np.arange(first, last), np.diff(a.begin[first : last + 1]))
    named = a.column[inside]
    many = np.diff(b.begin)[named]
    ends = np.cumsum(many)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(b.begin[named] - (ends - many), many)
    key = np.repeat(row, many) * np.int64(b.width) + b.column[take]
    value = np.repeat(a.value[inside], many) * b.value[take]
    if (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.append(True, np.diff(key) != 0)) if len(key) else np.empty(0, np.int64)
    value = np.add.reduceat(value, new) if len(new) else value
    return key[new] // max(b.width, 1), key[new] % max(b.width, 1), value


def products(a: Rows, b: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`product` in blocks of rows, so that none sums up many more than ``ROWS`` products."""
    work = np.append(0, np.cumsum(row_sizes(a, b)))
    first = 0
    while first < len(a):
        last = max(first + 1, int(np.searchsorted(work, work[first] + ROWS, side="right")) - 1)
        yield product(a, b, first, last)
        first = last


# Tokenizers -------------------------------------------------------------------


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        spelled = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if all(c in letters for c in token)}
        self.bytes_a = _table([spelled.get(i, b"") for i in range(self.a.get_vocab_size())])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = _table(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        )
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.decimals = _table([str(i).encode() for i in range(max(len(self.bytes_a[0]), len(self.bytes_b[0])))])
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        none = np.empty(0, np.int32)
        self.sizes, self.ids = [none, none], [none, none]

    def _learn(self, words: list[str]) -> None:
        """Encode words by both libraries and add them to the lexicon."""
        joined = [w for w in words if not w[0].isspace() and not w[-1].isspace()]
        others = [w for w in words if w[0].isspace() or w[-1].isspace()]
        for side, table in enumerate((self.bytes_a, self.bytes_b)):
            for part in (self._joined(side, table, joined), self._encoded(side, others)):
                self.sizes[side] = np.append(self.sizes[side], part[0])
                self.ids[side] = np.append(self.ids[side], part[1])
        self.place.update(zip(joined + others, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.held += sum(map(len, words))

    def _encoded(self, side: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each text, ids) of one library."""
        if side:
            found = self.b.encode(texts, num_threads=1) if texts else []
        else:
            found = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))

    def _joined(self, side: int, table: tuple, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_encoded`, for words that may stand in one text: a call costs more than a word.

        Tokens are told apart by their bytes. If a word doesn't end where a token
        does, its tokens don't spell it, and words are encoded one by one.
        """
        texts = [" ".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        ids = self._encoded(side, texts)[1]
        token_ends = np.cumsum(table[0][ids])
        word_ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words)))
        last = np.searchsorted(token_ends, word_ends)
        inside = last < len(token_ends)
        if not inside.all() or (token_ends[last] != word_ends).any():
            return self._encoded(side, words)
        return np.diff(np.append(-1, last)).astype(np.int32), ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids a, tokens a of each text, ids b, tokens b of each text); nothing of an empty text."""
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            of_text = words_of(text) if self.cuts else [text] * bool(text)
            counts[i] = len(of_text)
            words += of_text
        distinct = set(words)
        if len(self.place) + len(distinct) > WORDS or self.held > LEXICON:
            self._forget()
        new = [w for w in distinct if w not in self.place]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(texts)), counts)
        out = []
        for sizes, ids in zip(self.sizes, self.ids, strict=True):
            begins = np.cumsum(sizes, dtype=np.int64) - sizes
            many = sizes[place].astype(np.int64)
            ends = np.cumsum(many)
            out.append(ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[place] - (ends - many), many)])
            out.append(np.bincount(owner, many, len(texts)).astype(np.int64))
        return tuple(out)


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, begins, bytes) of tokens by id."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    return sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)


_CUT = re.compile(r"(?<=\S) (?=\S)")
_BESIDE = re.compile(r" \s|\s |\A | \Z")


def words_of(text: str) -> list[str]:
    """A text cut at spaces without white space beside them, which belong to neither word."""
    if not text:
        return []
    return _CUT.split(text) if _BESIDE.search(text) else text.split(" ")


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


# Chunks -----------------------------------------------------------------------


class Aligned:
    """The tokens of several texts, their groups and links.

    Texts stand end to end, each after a space. ``a`` and ``b`` are token ids,
    ``of_a`` and ``of_b`` the texts they belong to, ``group_a`` and ``group_b``
    their groups, counted over all texts.
    """

    def __init__(self, pair: Pair, texts: list[str | None]) -> None:
        texts = [t or "" for t in texts]
        self.n = len(texts)
        a, count_a, b, count_b = pair.encode(texts)
        raw = [b" " + t.encode() if t else b"" for t in texts]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        fine = _spelled(pair.bytes_a, a, count_a, sizes, data) & _spelled(pair.bytes_b, b, count_b, sizes, data)
        of_a, of_b = np.repeat(np.arange(self.n), count_a), np.repeat(np.arange(self.n), count_b)
        self.a, self.of_a = a[fine[of_a]], of_a[fine[of_a]]
        self.b, self.of_b = b[fine[of_b]], of_b[fine[of_b]]
        self.size_a, self.size_b = pair.bytes_a[0][self.a], pair.bytes_b[0][self.b]
        end_a, end_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        self.groups = len(cuts)
        self.group_a, self.group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        self.pair = pair

    def by_bytes(self) -> tuple[Rows, Rows]:
        """The matrices whose product links tokens that share bytes."""
        return incidence(self.size_a), transposed(incidence(self.size_b))

    def by_groups(self) -> tuple[Rows, Rows]:
        """The matrices whose product links all tokens of a group."""
        return membership(self.group_a, self.groups), transposed(membership(self.group_b, self.groups))

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text, groups in order."""
        sizes, begins, digits = self.pair.decimals
        ids = np.concatenate([self.a, self.b])
        text = np.concatenate([self.of_a, self.of_b])
        side = np.repeat(np.array([0, 1], np.int8), [len(self.a), len(self.b)])
        group = np.concatenate([self.group_a, self.group_b])
        order = np.argsort(group * 2 + side, kind="stable")
        ids, text, side, group = ids[order], text[order], side[order], group[order]
        mark = np.full(len(order), ord(","), np.uint8)
        mark[:-1][side[1:] != side[:-1]] = ord("|")
        mark[:-1][group[1:] != group[:-1]] = ord(";")
        many = sizes[ids] + 1  # a number and the mark behind it
        ends = np.cumsum(many)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[ids] - (ends - many), many)
        flat = digits[np.minimum(take, len(digits) - 1)]
        flat[ends - 1] = mark
        edges = np.append(0, ends)[np.searchsorted(text, np.arange(self.n + 1))].tolist()
        raw = flat.tobytes()
        # The last mark of a text belongs to no one.
        return [raw[i : max(i, j - 1)] for i, j in zip(edges[:-1], edges[1:], strict=True)]

    def per_text(self, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, minlength=self.n).astype(np.int64)


def _spelled(table, ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each text whether its tokens' bytes are those of the text."""
    lengths, begins, tokens = table
    many = lengths[ids]
    text = np.repeat(np.arange(len(counts)), counts)
    spelled = np.bincount(text, many, len(counts)).astype(np.int64)
    fine = (spelled == sizes) & (sizes > 0)
    # Texts of another length are left out, so that the rest stands alike in both.
    keep = fine[text]
    ids, many = ids[keep], many[keep]
    ends = np.cumsum(many)
    joined = tokens[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[ids] - (ends - many), many)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = fine[owner]
    wrong = owner[inside][joined != data[inside]]
    fine[wrong] = False
    return fine


def chunks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """(ids, texts) with at most ``limit`` characters, or one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for id_, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            if texts and size + len(text or "") > limit:
                yield pa.array([i.as_py() for i in ids], batch.schema.field(0).type), texts
                ids, texts, size = [], [], 0
            ids.append(id_)
            texts.append(text)
            size += len(text or "")
    if texts:
        yield pa.array([i.as_py() for i in ids], ids[0].type), texts


def _lists(values: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    offsets = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def chunk_rows(pair: Pair, number: int, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """One row for each text, with its links as numbers into the chunk's list of id pairs.

    The first row holds that list: ids of both and how many links have them.
    """
    found = Aligned(pair, texts)
    parts = [(a, b) for a, b, _ in products(*found.by_bytes())] or [(np.empty(0, np.int64),) * 2]
    a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
    width = len(pair.bytes_b[0])
    pairs, link, count = np.unique(found.a[a].astype(np.int64) * width + found.b[b], return_inverse=True, return_counts=True)
    link = link.astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
    of = found.of_a[a]
    n_links = found.per_text(of)
    shared = np.bincount(found.of_a, row_sizes(*found.by_groups()), found.n).astype(np.int64)
    first_group = np.append(True, np.diff(found.group_a) > 0)[: len(found.a)]
    ends = np.append(0, np.cumsum(n_links)) * link.itemsize
    blobs = pa.BinaryArray.from_buffers(
        pa.binary(), found.n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(link.tobytes())]
    )
    first = np.zeros(len(pairs), np.int64)
    lists = [_lists(v.astype(np.int32), first, found.n) for v in (pairs // width, pairs % width, count)]
    return pa.record_batch(
        [
            ids,
            pa.array(np.full(found.n, number)),
            pa.array(found.per_text(found.of_a)),
            pa.array(found.per_text(found.of_b)),
            pa.array(found.per_text(found.of_a[first_group])),
            pa.array(n_links),
            pa.array(shared),
            pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in found.group_texts()]),
            blobs,
            *lists,
        ],
        [f.name for f in _STORED],
    )


_LONG = T.LongType()
_STORED = [
    T.StructField("id", T.NullType()),
    *[T.StructField(n, _LONG) for n in ("chunk", "n_a", "n_b", "n_groups", "n_links", "n_shared")],
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("links", T.BinaryType()),
    *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("pair_a", "pair_b", "pair_n")],
]


# Plans ------------------------------------------------------------------------


def _mapped(docs: DataFrame, function, fields: list[T.StructField], path_a, path_b, id_col: str, text: str, limit: int):
    """``function(pair, number, ids, texts)`` gives record batches; the first field is the id."""
    narrow_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *fields[1:]])

    def run(batches):
        task = TaskContext.get().partitionId() << 33
        for number, (ids, texts) in enumerate(chunks(batches, limit)):
            yield from function(pair(path_a, path_b), task + number, ids, texts)

    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids_a, ids_b, sizes_a, sizes_b, groups_a, groups_b) of every text.

    Sizes are bytes; tokens with the same group number of a text end together.
    """
    ints = T.ArrayType(T.LongType())
    fields = [T.StructField(n, ints) for n in ("id", "ids_a", "ids_b", "sizes_a", "sizes_b", "groups_a", "groups_b")]

    def rows(pair, number, ids, texts):
        found = Aligned(pair, texts)
        start = np.searchsorted(found.of_a, np.arange(found.n))
        base = np.append(found.group_a, 0)[start]
        lists = [
            _lists(v.astype(np.int64), of, found.n)
            for v, of in (
                (found.a, found.of_a),
                (found.b, found.of_b),
                (found.size_a, found.of_a),
                (found.size_b, found.of_b),
                (found.group_a - base[found.of_a], found.of_a),
                (found.group_b - base[found.of_b], found.of_b),
            )
        ]
        yield pa.record_batch([ids, *lists], [f.name for f in fields])

    return _mapped(docs, rows, fields, path_a, path_b, id_col, text, CHUNK).withColumnRenamed("id", id_col)


def links(
    docs: DataFrame, path_a: str, path_b: str, kind: str = "overlap", id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, token_a, token_b, id_a, id_b, n_bytes) of every link; tokens count from 0 in their text.

    ``kind`` is ``overlap`` or ``group``: all tokens of a group are linked, and
    ``n_bytes`` is null. A group's links are as many as the product of its sizes;
    they leave in blocks of rows, never all at once.
    """
    if kind not in ("overlap", "group"):
        raise ValueError(f"no links of kind {kind}")
    whole = T.IntegerType()
    fields = [T.StructField(n, whole) for n in ("id", "token_a", "token_b", "id_a", "id_b", "n_bytes")]

    def rows(pair, number, ids, texts):
        found = Aligned(pair, texts)
        before_a, before_b = (np.searchsorted(of, np.arange(found.n)) for of in (found.of_a, found.of_b))
        for a, b, shared in products(*(found.by_bytes() if kind == "overlap" else found.by_groups())):
            of = found.of_a[a]
            yield pa.record_batch(
                [
                    ids.take(pa.array(of)),
                    pa.array((a - before_a[of]).astype(np.int32)),
                    pa.array((b - before_b[of]).astype(np.int32)),
                    pa.array(found.a[a]),
                    pa.array(found.b[b]),
                    pa.array(shared.astype(np.int32)) if kind == "overlap" else pa.nulls(len(a), pa.int32()),
                ],
                [f.name for f in fields],
            )

    return _mapped(docs, rows, fields, path_a, path_b, id_col, text, CHUNK).withColumnRenamed("id", id_col)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, total, best): links of each id pair, and whether no pair of its b has more."""
    listed = stored.where(F.size("pair_a") > 0).select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p"))
    totals = listed.groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b")).agg(
        F.sum(F.col("p.pair_n").cast("long")).alias("total")
    )
    return totals.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b")))


def summary(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text", limit: int = CHUNK
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared) of every text.

    ``n_best`` counts links whose id pair is as frequent as any of its second id,
    ``count_sum`` adds up how frequent each link's pair is, and ``n_shared`` is
    the number of links within groups.
    """
    stored = durable(
        _mapped(docs, lambda *args: [chunk_rows(*args)], _STORED, path_a, path_b, id_col, text, limit), "aligned"
    )
    listed = stored.where(F.size("pair_a") > 0).select("chunk", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("slot", "p"))
    counts = pair_counts(stored)
    back = listed.join(counts, (F.col("p.pair_a") == F.col("a")) & (F.col("p.pair_b") == F.col("b"))).select(
        (F.col("chunk") + 0).alias("chunk"), "slot", "total", "best"  # a column of its own
    )
    told = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_shared"]
    kind = docs.schema[id_col].dataType
    out = T.StructType(
        [
            T.StructField("id", kind),
            *[stored.schema[n] for n in told],
            T.StructField("n_best", _LONG),
            T.StructField("count_sum", _LONG),
        ]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        slot = right["slot"].to_numpy()
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        total[slot] = right["total"].to_numpy()
        best[slot] = right["best"].to_numpy()
        kind_of_link = np.uint16 if right.num_rows <= 1 << 16 else np.uint32
        link = np.frombuffer(b"".join(left["links"].to_pylist()), kind_of_link)
        ends = np.append(0, np.cumsum(left["n_links"].to_numpy()))
        sums = [np.append(0, np.cumsum(v[link])) for v in (best, total)]
        return left.select(["id", *told]).append_column("n_best", pa.array(sums[0][ends[1:]] - sums[0][ends[:-1]])).append_column(
            "count_sum", pa.array(sums[1][ends[1:]] - sums[1][ends[:-1]])
        )

    done = (
        stored.select("id", "chunk", *told, "links")
        .groupBy("chunk")
        .cogroup(back.groupBy("chunk"))
        .applyInArrow(run, out)
    )
    return done.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"
    )
