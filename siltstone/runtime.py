"""Session helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is
    unset, the warehouse folder holds the scratch files: tables live there, so
    every executor sees it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables made inside once the block ends, also by an error.

    For work whose results are stored elsewhere when the block ends. Plans that
    are read later need theirs, so they are made outside of such a block.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def durable(df: DataFrame, label: str = "durable") -> DataFrame:
    """``df`` written once and read back.

    Rows that carry a position (``monotonically_increasing_id``) must not be
    computed twice. Reading them from a written table keeps them fixed even
    when executors are lost, and later reads are columnar and pruned.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
