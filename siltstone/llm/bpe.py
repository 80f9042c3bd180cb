"""Byte-level BPE as a transducer with bounded lookahead, and its way back.

Text is first cut into pieces by the usual pattern of byte-level vocabularies
(:mod:`siltstone.llm.pieces`). Inside a piece the transducer reads bytes from
left to right and keeps, for each position, the last token of the encoding of
everything up to it; following these links backwards gives that encoding. The
merge list itself tells how far the future can reach: whether a token ends at
a place is settled ``lookahead`` bytes later, whatever follows. Tokens that end
earlier are emitted and forgotten, so memory stays constant however long a
piece is.

Two tokens may stand side by side if no merge that comes early enough joins the
bytes at their seam; an encoding is right if all its neighbours may.

Decoding feeds the bytes of each token to an incremental UTF-8 state machine.
A character that is split between tokens comes out with the last of them, and
bytes that form no character become U+FFFD.

Defined results: a null text counts as empty and has no tokens; special tokens
written in a text are recognised as such; repeated rows each get their row.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.llm.arrow_text import Block, map_blocks
from siltstone.llm.pieces import cut

#: Pieces up to this length are remembered, in two generations of so many.
CACHED_BYTES, CACHED_PIECES = 48, 150_000
#: Token ids turned to text at once.
STEP = 1 << 16


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and the lookahead that the merges need."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        ids = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes_of[i] = raw(token)
        for content, i in self.special.items():
            self.bytes_of[i] = content
        self.ids = {raw(token): i for token, i in ids.items() if i not in self.special.values()}
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.formed = [-1] * len(self.bytes_of)
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = ids[left], ids[right]
            made = ids[left + right]
            self.merge_rank[pair] = rank
            if made not in self.parts:
                self.parts[made], self.formed[made] = pair, rank
        self.longest = max(map(len, self.ids))
        self.lookahead = self._sufficient_lookahead()
        self.fits: dict[tuple[int, int], bool] = {}
        self.branch, self.token_at = self._tree()

    def _tree(self) -> tuple[dict[int, int], list[int]]:
        """Prefix tree of the tokens: (node << 8 | byte) -> node, and token or -1 of a node."""
        branch: dict[int, int] = {}
        token_at = [-1]
        for token, i in self.ids.items():
            node = 0
            for byte in token:
                step = node << 8 | byte
                node = branch.get(step, -1)
                if node < 0:
                    node = branch[step] = len(token_at)
                    token_at.append(-1)
            token_at[node] = i
        return branch, token_at

    def _sufficient_lookahead(self) -> int:
        """Bytes after a place that settle whether a token ends there.

        A merge of l and r at a place needs r, and that no earlier merge takes
        the end of r away: a merge whose left part is a tail of r, for which
        the same holds. Merges are visited in their order, so what the earlier
        ones need is known.
        """
        needs: dict[int, int] = {}
        most = 1
        for left, right in self.merge_rank:
            tail = self.bytes_of[right]
            beyond = max(
                (needs.get(self.ids.get(tail[k:], -1), 0) for k in range(len(tail))), default=0
            )
            need = len(tail) + beyond
            most = max(most, need)
            needs[left] = max(needs.get(left, 0), need)
        return most

    def fit(self, left: int, right: int) -> bool:
        """Whether ``left`` may stand before ``right`` in an encoding."""
        pair = left, right
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= 1 << 19:
                self.fits.clear()
            known = self.fits[pair] = self._fit(left, right)
        return known

    def _fit(self, left: int, right: int) -> bool:
        # The seam's neighbours are taken apart, the one formed last first, back
        # to single bytes. At each step a merge of the two that comes before
        # either is merged on would have joined them across the seam.
        used_left, used_right = len(self.merge_rank), len(self.merge_rank)
        while True:
            rank = self.merge_rank.get((left, right))
            # At equal rank the leftmost merge comes first.
            if rank is not None and rank < used_left and rank <= used_right:
                return False
            born_left, born_right = self.formed[left], self.formed[right]
            if born_left < 0 and born_right < 0:
                return True
            if born_left > born_right:
                used_left, left = born_left, self.parts[left][1]
            elif born_right > born_left:
                used_right, right = born_right, self.parts[right][0]
            else:
                # Formed by the same rule: the left one was there first.
                used_right, right = born_right, self.parts[right][0]


class Transducer:
    """Bytes of one piece in, stable tokens out."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.data = bytearray()
        self.last: list[int | None] = [-1]

    def feed(self, data: bytes) -> list[int]:
        step = max(4 * self.v.lookahead, 4096)
        out: list[int] = []
        for at in range(0, len(data), step):
            self._read(data[at : at + step])
            if len(self.data) > 2 * self.v.lookahead:
                out += self._emit(len(self.data) - self.v.lookahead)
        return out

    def close(self) -> list[int]:
        return self._emit(len(self.data))

    def _read(self, more: bytes) -> None:
        begin = len(self.data)
        self.data += more
        data, last, fits, size = self.data, self.last, self.v.fits, len(self.data)
        branch, token_at = self.v.branch, self.v.token_at
        last += [None] * len(more)
        # Every position has just one last token; starts before ``begin`` may
        # still reach into the new bytes.
        for start in range(max(0, begin - self.v.longest + 1), size):
            left, node = last[start], 0
            for end in range(start, size):
                node = branch.get(node << 8 | data[end])
                if node is None:
                    break
                token = token_at[node]
                if token >= 0 and last[end + 1] is None:
                    if left >= 0:
                        fit = fits.get((left, token))
                        if not (self.v.fit(left, token) if fit is None else fit):
                            continue
                    last[end + 1] = token

    def _emit(self, settled: int) -> list[int]:
        tokens, end = [], len(self.data)
        keep = 0
        while end > 0:
            if end <= settled:
                keep = keep or end
                tokens.append(self.last[end])
            end -= len(self.v.bytes_of[self.last[end]])
        del self.data[:keep]
        del self.last[:keep]
        return tokens[::-1]


class Encoder:
    """Encodes blocks of texts; remembers the tokens of short pieces."""

    def __init__(self, path: str) -> None:
        self.v = Vocabulary(path)
        self.young: dict[bytes, tuple[int, ...]] = {}
        self.old: dict[bytes, tuple[int, ...]] = {}
        self.token_bytes = np.array([len(b) for b in self.v.bytes_of], np.int64)
        self.decimal = [str(i) for i in range(len(self.v.bytes_of))]

    def piece(self, data: bytes) -> tuple[int, ...]:
        found = self.young.get(data)
        if found is not None:
            return found
        found = self.old.get(data)
        if found is None:
            special = self.v.special.get(data)
            if special is not None:
                found = (special,)
            else:
                machine = Transducer(self.v)
                found = (*machine.feed(data), *machine.close())
        if len(data) <= CACHED_BYTES:
            if len(self.young) >= CACHED_PIECES:
                self.old, self.young = self.young, {}
            self.young[data] = found
        return found

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts end to end, and where each text's begin."""
        at = cut(data, offsets, self.v.special)
        if not len(at):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        bounds = np.append(at, len(data))
        spans = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
        )
        coded = spans.dictionary_encode()
        tokens = list(map(self.piece, coded.dictionary.to_pylist()))
        index = coded.indices.to_numpy()
        counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
        every = np.fromiter(chain.from_iterable(tokens), np.int32, int(counts.sum()))
        begin = np.cumsum(counts) - counts
        each = counts[index]
        ends = np.cumsum(each)
        ids = every[np.repeat(begin[index] - (ends - each), each) + np.arange(ends[-1])]
        first = np.searchsorted(at, offsets)
        return ids, np.append(0, ends)[first]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(path)


class Decoder:
    """Token ids in, text out, in any portions."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.bytes_of = vocabulary.bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def close(self) -> str:
        return self.machine.decode(b"", final=True)


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> Iterator[str]:
    machine = Decoder(vocabulary)
    for at in range(0, len(ids), STEP):
        yield machine.feed(ids[at : at + STEP].tolist())
    yield machine.close()


def _id_field(df: DataFrame, id_col: str) -> T.StructField:
    return T.StructField(id_col, df.schema[id_col].dataType)


def encode(
    df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", verify: bool = False
) -> DataFrame:
    """(id, n_tokens, token_ids) of every row.

    With ``verify``, ``lossless`` tells whether the tokens decode to the text.
    """

    def run(block: Block) -> pa.RecordBatch:
        coder = encoder(path)
        ids, begin = coder.block(block.data, block.offsets)
        lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()))
        columns = [block.rows.column(0), pa.array(np.diff(begin)), lists]
        if verify:
            raw = memoryview(block.data.tobytes())
            texts = (raw[a:b] for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True))
            back = (
                "".join(decoded(coder.v, ids[a:b])).encode()
                for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)
            )
            columns.append(pa.array([x == y for x, y in zip(texts, back, strict=True)]))
        return pa.record_batch(columns, schema.names)

    schema = T.StructType(
        [
            _id_field(df, id_col),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            *([T.StructField("lossless", T.BooleanType())] if verify else []),
        ]
    )
    return map_blocks(df.select(id_col, text), run, schema, text)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", tokens: str = "token_ids") -> DataFrame:
    """(id, text) of rows of token ids; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            texts = [
                "".join(decoded(encoder(path).v, np.array(ids or [], np.int64)))
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    schema = T.StructType([_id_field(df, id_col), T.StructField("text", T.StringType())])
    return df.select(id_col, tokens).mapInArrow(run, schema)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids."""

    def run(block: Block) -> pa.RecordBatch:
        coder = encoder(path)
        ids, begin = coder.block(block.data, block.offsets)
        codes, texts = [], []
        for i in range(len(block)):
            own = ids[begin[i] : begin[i + 1]]
            code, text_code = hashlib.sha256(), hashlib.sha256()
            machine = Decoder(coder.v)
            for at in range(0, len(own), STEP):
                some = own[at : at + STEP].tolist()
                if at:
                    code.update(b",")
                code.update(",".join(map(coder.decimal.__getitem__, some)).encode())
                text_code.update(machine.feed(some).encode())
            text_code.update(machine.close().encode())
            codes.append(code.hexdigest())
            texts.append(text_code.hexdigest())
        return pa.record_batch(
            [block.rows.column(0), pa.array(np.diff(begin)), pa.array(codes), pa.array(texts)],
            [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = T.StructType(
        [
            _id_field(df, id_col),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return map_blocks(df.select(id_col, text), run, schema, text)
