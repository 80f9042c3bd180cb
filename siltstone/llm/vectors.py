"""Vector columns as matrices inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handed to Python at once.
BATCH_ROWS = "2048"


ID_KINDS = {"bigint": pa.int64(), "int": pa.int32()}


def id_kind(df: DataFrame, id_col: str) -> str:
    """The type of the ids, which searches return and break ties by."""
    kind = df.schema[id_col].dataType.simpleString()
    if kind not in ID_KINDS:
        raise TypeError(f"ids must be of type {' or '.join(ID_KINDS)}, {id_col} is {kind}")
    return kind


def narrow_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) <= 0 or int(spark.conf.get(name)) > int(BATCH_ROWS):
        spark.conf.set(name, BATCH_ROWS)


def sound(column: pa.Array, zero: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, numbers, lengths): the rows whose vectors hold finite numbers only."""
    rows = np.arange(len(column))
    lengths = np.array(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    values = column.flatten()
    gaps = np.array(values.is_null())
    numbers = np.array(pc.fill_null(values.cast(pa.float64()), np.nan), np.float64)
    bad = gaps | ~np.isfinite(numbers)
    owner = np.repeat(rows, lengths)
    broken = np.zeros(len(column), bool)
    broken[owner[bad]] = True
    fine = (lengths > 0) & ~broken
    if not zero:
        fine &= np.bincount(owner[numbers != 0], minlength=len(rows)) > 0
    return rows[fine], numbers[fine[owner]], lengths[fine]


def packed(
    df: DataFrame, convert, id_col: str = "vec_id", vector: str = "embedding", zero: bool = True
) -> DataFrame:
    """(id, dim, vec) of the sound rows; ``convert`` turns finite doubles into the stored numbers.

    ``zero`` tells whether vectors of zeros count as sound.
    """
    narrow_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            rows, numbers, lengths = sound(batch.column(1), zero)
            stored = np.ascontiguousarray(convert(numbers))
            ends = np.cumsum(lengths) * stored.itemsize
            offsets = np.append(0, ends).astype(np.int32)
            blobs = pa.BinaryArray.from_buffers(
                pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(stored)]
            )
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)), pa.array(lengths, pa.int32()), blobs],
                [id_col, "dim", "vec"],
            )

    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("dim", T.IntegerType()),
            T.StructField("vec", T.BinaryType()),
        ]
    )
    named = df.where(F.col(id_col).isNotNull())
    return named.select(id_col, vector).mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """Packed vectors of one length as rows."""
    blobs = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(blobs)
    return np.frombuffer(b"".join(blobs.to_pylist()), dtype).reshape(n, -1) if n else np.empty((0, 1), dtype)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest scores; ties go to the smaller column."""
    n = scores.shape[1]
    if n <= k:
        rows, columns = np.nonzero(scores > -np.inf)
        return rows, columns
    least = np.partition(scores, n - k, axis=1)[:, n - k]
    least = np.maximum(least, np.finfo(np.float64).min)
    above = scores > least[:, None]
    equal = scores == least[:, None]
    room = k - above.sum(axis=1)
    chosen = above | (equal & (np.cumsum(equal, axis=1) <= room[:, None]))
    return np.nonzero(chosen)
