"""Text columns as flat byte arrays inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text worked on at once; a single longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Rows handed to Python at once, so that a batch of long texts stays small.
BATCH_ROWS = "256"


def narrow_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for texts of any length."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) <= 0 or int(spark.conf.get(name)) > int(BATCH_ROWS):
        spark.conf.set(name, BATCH_ROWS)


@dataclass
class Block:
    """Rows with their texts end to end: row i holds bytes offsets[i]:offsets[i + 1]."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of all batches in blocks of whole texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = flat(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            part = offsets[first : last + 1]
            yield Block(batch.slice(first, last - first), data[part[0] : part[-1]], part - part[0])
            first = last


def map_blocks(df: DataFrame, function, schema, text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """``function(block)`` for each block of rows; it returns a record batch or None."""
    narrow_batches(df.sparkSession)

    def run(batches):
        for block in blocks(batches, text, limit):
            found = function(block)
            if found is not None and found.num_rows:
                yield found

    return df.mapInArrow(run, schema)
