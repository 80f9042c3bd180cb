"""Counting operators shared by reports and source preparation.

Each one aggregates before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.numbers import WHOLE, percent
from siltstone.runtime import durable


def frequency(df: DataFrame, *keys: str, **more: Column) -> DataFrame:
    """Rows per key, most frequent first, ties in key order; NULL is a key."""
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), *[c.alias(name) for name, c in more.items()]
    )
    return counted.orderBy(F.desc("count"), *[F.asc(k) for k in keys])


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per value; NULL is left out. Unordered."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def with_share(
    counted: DataFrame, count: str = "count", pct: str = "pct", places: int = 2, kind: str = WHOLE
) -> DataFrame:
    """Add each row's share of all counts in percent.

    For rows grouped by a key with a bounded domain (segments, regions,
    rarities, combinations of tags): the window takes all groups into one task,
    and in return the counts are computed once.
    """
    whole = F.sum(count).over(Window.partitionBy())
    return counted.withColumn(pct, percent(F.col(count), whole, places, kind))


def with_share_written(
    counted: DataFrame, count: str = "count", pct: str = "pct", places: int = 2, kind: str = WHOLE
) -> DataFrame:
    """As :func:`with_share` for keys without a bounded domain.

    The counts are written once, so that summing them up does not compute them
    a second time and no task has to hold every group.
    """
    written = durable(counted, "counts")
    whole = written.agg(F.sum(count)).scalar()
    return written.withColumn(pct, percent(F.col(count), whole, places, kind))


def coverage(df: DataFrame, column: str, present: str, absent: str, pct: str, places: int = 2) -> DataFrame:
    """How many rows have ``column``, how many lack it, and the share that has it."""
    have = F.count(column)
    rows = F.count(F.lit(1))
    return df.agg(
        have.alias(present), (rows - have).alias(absent), percent(have, rows, places).alias(pct)
    )


def removed_by(df: DataFrame, keep: Column, label: str = "removed") -> DataFrame:
    """Rows before, after and lost to a filter, from one pass."""
    rows = F.count(F.lit(1))
    kept = F.count_if(F.coalesce(keep, F.lit(False)))
    return df.agg(rows.alias("before"), kept.alias("after"), (rows - kept).alias(label))


def keep_first(df: DataFrame, key: str, order_by: list[str | Column]) -> DataFrame:
    """The first row per key in a given order (which must be unique per key)."""
    return first_per_group(df, key, order_by, 1)


def first_per_group(df: DataFrame, key: str, order_by: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows per key.

    Spark limits each group inside every task before the shuffle
    (WindowGroupLimit), so a hot key never gathers more than ``n`` rows per
    task.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
