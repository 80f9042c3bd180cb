"""Repeated passages, found through content-defined chunks.

A gear hash rolls over the bytes of a text: h = 2 * h + gear[byte], kept to 16
bits, so that it depends on the last 16 bytes only. A chunk ends after white
space where the hash falls under a threshold, one place in six on average; a
stretch of 128 bytes without white space may be cut anywhere. Cuts depend on
the bytes around them alone, so an insertion shifts no cut beyond it.

Chunks are deduplicated by a 128-bit digest. A chunk counts as repeated if the
same chunk stands in a document of smaller id or earlier in its own. Chunks are
short, so that a passage holds several whole ones; single ones repeat by
chance. Only runs of repeated chunks with at least ``min_words`` words are
passages. Of each passage one place stays: the first one.

The tables of chunks are narrow. Digests are counted with partial aggregation,
so a line that stands in a third of all documents is one row per task.

Defined results: null and empty texts have no chunks; rows with a null id are
left as they are and not compared; rows that share an id are not compared with
each other, but each within itself; of ties the smallest id keeps its passage.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.arrow_text import Block, map_blocks
from siltstone.llm.shingles import NOT_WHITE, range_hashes, stream

GEAR = stream(3, 256).astype(np.uint16)
WINDOW = 16


@dataclass(frozen=True)
class Chunking:
    """Mean words of a chunk, bytes without white space that force cuts, words of a passage."""

    mean_words: int = 6
    unbroken: int = 128
    min_words: int = 16


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash after every byte, by doubling the window."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        later = h.copy()
        later[step:] += h[:-step] << np.uint16(step)
        h = later
    return h


def chunks(data: np.ndarray, offsets: np.ndarray, how: Chunking) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every chunk; chunks tile the texts."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = gear_hashes(data)
    white = ~NOT_WHITE[data]
    place = np.arange(len(data))
    begin = np.zeros(len(data), bool)
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    text_start = np.maximum.accumulate(np.where(begin, place, 0))
    last_white = np.maximum.accumulate(np.where(white | begin, place, 0))
    inner = np.append((data[1:] & 0xC0) != 0x80, False)  # not inside a character
    cut = white & (h < (1 << 16) // how.mean_words)
    cut |= inner & (place - last_white >= how.unbroken) & (h < (1 << 16) // (6 * how.mean_words))
    cut &= place - text_start >= WINDOW
    begin[1:] |= cut[:-1]
    starts = np.flatnonzero(begin)
    return np.searchsorted(offsets, starts, side="right") - 1, starts


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = memoryview(data.tobytes())
    md5 = hashlib.md5
    joined = b"".join(
        [md5(raw[s:e], usedforsecurity=False).digest() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    )
    pairs = np.frombuffer(joined, np.int64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _chunk_rows(block: Block, how: Chunking, id_col: str) -> pa.RecordBatch | None:
    rows, starts = chunks(block.data, block.offsets, how)
    if not len(rows):
        return None
    ends = np.append(starts[1:], len(block.data))
    d1, d2 = _digests(block.data, starts, ends)
    first_of_row = np.searchsorted(rows, np.arange(len(block)))
    number = np.arange(len(rows)) - first_of_row[rows]
    order = np.lexsort((number, d2, d1, rows))
    same = (
        (rows[order][1:] == rows[order][:-1])
        & (d1[order][1:] == d1[order][:-1])
        & (d2[order][1:] == d2[order][:-1])
    )
    again = np.zeros(len(rows), bool)
    again[order[1:][same]] = True
    char = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))
    word_start = NOT_WHITE[block.data].copy()
    word_start[1:] &= ~word_start[:-1]
    word_start[block.offsets[:-1][np.diff(block.offsets) > 0]] = NOT_WHITE[
        block.data[block.offsets[:-1][np.diff(block.offsets) > 0]]
    ]
    word = np.append(0, np.cumsum(word_start))
    # Rows of one id may differ in text: the content tells them apart.
    texts = np.flatnonzero(np.diff(block.offsets) > 0)
    content = np.zeros(len(block), np.uint64)
    content[texts] = range_hashes(block.data, block.offsets[:-1][texts], block.offsets[1:][texts])
    base = char[block.offsets[:-1]][rows]
    return pa.record_batch(
        [
            block.rows.column(0).take(pa.array(rows)),
            pa.array((content & np.uint64(0x7FFFFFFF)).astype(np.int32)[rows]),
            pa.array(number, pa.int32()),
            pa.array(d1),
            pa.array(d2),
            pa.array(again),
            pa.array(char[starts] - base, pa.int32()),
            pa.array(char[ends] - base, pa.int32()),
            pa.array(word[ends] - word[starts], pa.int32()),
        ],
        ["_id", "_text", "_number", "_d1", "_d2", "_again", "_start", "_end", "_words"],
    )


def chunk_table(docs: DataFrame, how: Chunking, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text).alias("_body"))
    whole, long, flag = T.IntegerType(), T.LongType(), T.BooleanType()
    kinds = [docs.schema[id_col].dataType, whole, whole, long, long, flag, whole, whole, whole]
    names = ["_id", "_text", "_number", "_d1", "_d2", "_again", "_start", "_end", "_words"]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return map_blocks(named, lambda b: _chunk_rows(b, how, id_col), schema, "_body")


def passages(
    docs: DataFrame, how: Chunking = Chunking(), id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, char_start, char_end, n_words, first_id) of every repeated passage.

    ``first_id`` is the document that keeps the passage, or for a passage put
    together from several ones, the smallest of theirs. Rows of one id that
    differ in text are told apart by ``_text``, which comes with the result.
    """
    table = chunk_table(docs, how, id_col, text)
    shared = (
        table.where(~F.col("_again"))
        .groupBy("_d1", "_d2")
        .agg(F.min("_id").alias("_keeper"), F.max("_id").alias("_latest"))
        .where(F.col("_keeper") < F.col("_latest"))
        .select("_d1", "_d2", "_keeper")
    )
    here = ["_id", "_text", "_number", "_start", "_end", "_words"]
    elsewhere = (
        table.join(shared, ["_d1", "_d2"])
        .where(F.col("_id") > F.col("_keeper"))
        .select(*here, F.col("_keeper"))
    )
    inside = table.where("_again").select(*here, F.col("_id").alias("_keeper"))
    repeated = elsewhere.union(inside).groupBy(*here).agg(F.min("_keeper").alias("_keeper"))
    run = F.col("_number") - F.row_number().over(Window.partitionBy("_id", "_text").orderBy("_number"))
    return (
        repeated.withColumn("_run", run)
        .groupBy("_id", "_text", "_run")
        .agg(
            F.min("_start").alias("char_start"),
            F.max("_end").alias("char_end"),
            F.sum("_words").alias("n_words"),
            F.min("_keeper").alias("first_id"),
        )
        .where(F.col("n_words") >= how.min_words)
        .select(F.col("_id").alias(id_col), "_text", "char_start", "char_end", "n_words", "first_id")
    )


def remove_repeats(docs: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """``docs`` with each repeated passage left in one place only.

    ``n_chars``, if there is such a column, follows the text. A text that
    consists of repeats becomes empty.
    """
    spans = (
        passages(docs, how)
        .groupBy("doc_id", "_text")
        .agg(F.array_sort(F.collect_list(F.struct("char_start", "char_end"))).alias("_spans"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("_text", "_spans")).alias("_found"))
    )
    # Columns go by number, so that their names can't clash with ours.
    names = [f"_c{i}" for i in range(len(docs.columns))]
    body = names[docs.columns.index("text")]
    counted = names[docs.columns.index("n_chars")] if "n_chars" in docs.columns else None
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema, strict=True)])

    def cut(block: Block) -> pa.RecordBatch:
        found = block.rows.column(block.rows.schema.get_field_index("_found")).to_pylist()
        column = block.rows.column(body).to_pylist()
        changed = {}
        for i, spans_of in enumerate(found):
            if not spans_of or not column[i]:
                continue
            data = block.data[block.offsets[i] : block.offsets[i + 1]]
            code = int(range_hashes(data, np.array([0]), np.array([len(data)]))[0]) & 0x7FFFFFFF
            for entry in spans_of:
                if entry["_text"] == code:
                    parts, at = [], 0
                    for span in entry["_spans"]:
                        parts.append(column[i][at : span["char_start"]])
                        at = span["char_end"]
                    changed[i] = "".join([*parts, column[i][at:]])
        out = block.rows.select(names)
        if changed:
            texts = [changed.get(i, t) for i, t in enumerate(column)]
            k = names.index(body)
            out = out.set_column(k, out.schema.field(k), pa.array(texts, out.schema.field(k).type))
            if counted:
                k = names.index(counted)
                sizes = out.column(k).to_pylist()
                sizes = [len(changed[i]) if i in changed else n for i, n in enumerate(sizes)]
                out = out.set_column(k, out.schema.field(k), pa.array(sizes, out.schema.field(k).type))
        return out

    numbered = docs.toDF(*names)
    key = names[docs.columns.index("doc_id")]
    spans = spans.withColumnRenamed("doc_id", "_spans_of")
    joined = numbered.join(spans, F.col(key) == F.col("_spans_of"), "left").select(*names, "_found")
    return map_blocks(joined, cut, schema, body).toDF(*docs.columns)
