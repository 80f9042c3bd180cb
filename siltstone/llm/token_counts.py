"""Tokens of a document's sections, from one encoding of the whole document.

Encoding sections one by one would give other tokens than the model sees, as
pieces and merges reach across their borders. So each document is encoded once,
the tokens' byte spans are joined to the sections' spans by position, and a
token on a border goes to a section by one of these rules:

``first``  the section that holds the character in which the token begins;
``most``   the section that holds most of its bytes, the earlier one of equals;
``split``  every section gets the share of the token's bytes that it holds.

Sections are the lines of a text, each with its line break, or given spans of
characters: an array of structs (start, end), sorted and without overlap, in a
column. Text between given spans counts for no section.

Defined results: a null or empty text is one empty line; null spans give no
sections; empty spans hold no tokens; repeated rows each give their sections.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.llm.arrow_text import Block, map_blocks
from siltstone.llm.bpe import encoder

RULES = ("first", "most", "split")
NEWLINE = 10


def _lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last byte of every line of a block, in order."""
    breaks = np.flatnonzero(block.data == NEWLINE) + 1
    rows = np.concatenate(
        [np.arange(len(block)), np.searchsorted(block.offsets, breaks, side="left") - 1]
    )
    starts = np.concatenate([block.offsets[:-1], breaks])
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    ends = np.append(starts[1:], len(block.data))
    last = np.append(rows[1:] != rows[:-1], True)
    ends[last] = block.offsets[1:][rows[last]]
    return rows, starts, ends


def _given(block: Block, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    spans = block.rows.column(column)
    lengths = [len(s) if s is not None else 0 for s in spans.to_pylist()]
    rows = np.repeat(np.arange(len(block)), lengths)
    inner = spans.flatten()
    char_at = np.flatnonzero((block.data & 0xC0) != 0x80)
    begin = np.searchsorted(char_at, block.offsets)
    byte_at = np.append(char_at, len(block.data))

    def to_bytes(name: str) -> np.ndarray:
        chars = inner.field(name).to_numpy(zero_copy_only=False).astype(np.int64)
        return byte_at[np.clip(begin[rows] + chars, begin[rows], begin[rows + 1])]

    return rows, to_bytes("start"), to_bytes("end")


def _shares(ends: np.ndarray, sizes: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str):
    """(tokens, tokens on a border) of each section; spans are sorted byte spans."""
    begins = ends - sizes
    real = np.flatnonzero(stops > starts)
    tokens, border = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
    if not len(real) or not len(ends):
        return tokens, border
    first = np.searchsorted(starts[real], begins, side="right") - 1
    last = np.searchsorted(starts[real], ends - 1, side="right") - 1
    held = (first >= 0) & (first == last)
    held &= (ends <= stops[real][np.maximum(first, 0)]) | (
        (rule == "first") & (begins < stops[real][np.maximum(first, 0)])
    )
    tokens[real] += np.bincount(first[held], minlength=len(real))
    # What is left touches a border: few tokens, one by one.
    for i in np.flatnonzero(~held).tolist():
        touched = real[max(first[i], 0) : last[i] + 1]
        shared = np.minimum(stops[touched], ends[i]) - np.maximum(starts[touched], begins[i])
        touched, shared = touched[shared > 0], shared[shared > 0]
        if not len(touched):
            continue
        border[touched] += 1
        if rule == "split":
            tokens[touched] += shared / sizes[i]
        elif rule == "most":
            tokens[touched[np.argmax(shared)]] += 1
        elif starts[touched[0]] <= begins[i]:
            tokens[touched[0]] += 1
    return tokens, border


def attribute(
    df: DataFrame,
    path: str,
    rule: str = "first",
    spans: str | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, section, char_start, char_end, n_tokens, n_border) of every section.

    Sections count from 0 in each document. ``n_tokens`` is a double, as the
    rule may split tokens.
    """
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {RULES}")

    def run(block: Block) -> pa.RecordBatch:
        coder = encoder(path)
        ids, begin = coder.block(block.data, block.offsets)
        rows, starts, stops = _given(block, spans) if spans else _lines(block)
        sizes = coder.token_bytes[ids]
        tokens, border = _shares(np.cumsum(sizes), sizes, starts, stops, rule)
        char = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))
        base = char[block.offsets[rows]]
        first = np.searchsorted(rows, np.arange(len(block)))
        return pa.record_batch(
            [
                block.rows.column(0).take(pa.array(rows)),
                pa.array(np.arange(len(rows)) - first[rows], pa.int32()),
                pa.array(char[starts] - base, pa.int64()),
                pa.array(char[stops] - base, pa.int64()),
                pa.array(tokens, pa.float64()),
                pa.array(border, pa.int64()),
            ],
            names,
        )

    names = [id_col, "section", "char_start", "char_end", "n_tokens", "n_border"]
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.LongType()]
    schema = T.StructType(
        [T.StructField(id_col, df.schema[id_col].dataType), *map(T.StructField, names[1:], kinds)]
    )
    return map_blocks(df.select(id_col, text, *([spans] if spans else [])), run, schema, text)
