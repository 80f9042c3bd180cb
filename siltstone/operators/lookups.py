"""Left lookups into tables with a unique key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = 1024


def lookup(rows: DataFrame, table: DataFrame, key: Column, table_key: str) -> DataFrame:
    """``rows`` LEFT JOIN ``table`` ON ``key = table_key``; ``table_key`` is dropped.

    No side is broadcast by hint: Catalyst and AQE broadcast ``table`` when its
    size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle
    otherwise, splitting partitions of a hot key (``rows`` is the streamed
    side). Rows without a key match nothing but would all hash to one
    partition, so a second join key spreads them over many.
    """
    spread = F.when(
        F.col("_key").isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(_SPREAD))
    ).otherwise(F.lit(0).cast("long"))
    # Two steps: the key is an expression used twice and is computed once.
    left = rows.withColumn("_key", key).withColumn("_spread", spread)
    # Always 0, but written so that the optimizer keeps it as a join key.
    zero = F.pmod(F.col(table_key).cast("long"), F.lit(1).cast("long"))
    right = table.withColumn("_zero", zero)
    return left.join(
        right,
        (F.col("_key") == F.col(table_key)) & (F.col("_spread") == F.col("_zero")),
        "left",
    ).drop("_key", "_spread", "_zero", table_key)


def with_membership(rows: DataFrame, table: DataFrame, key: str, flag: str) -> DataFrame:
    """``key IN (SELECT key FROM table)`` as a column; NULL where the key is NULL.

    ``key`` is the primary key of ``table``, so the join adds no rows.
    """
    known = table.select(F.col(key).alias("_known"))
    hit = F.when(F.col(key).isNotNull(), F.col("_known").isNotNull())
    return rows.join(known, F.col(key) == F.col("_known"), "left").withColumn(flag, hit).drop("_known")
