"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import dates

CALENDAR_COLUMNS = (
    "date_key",
    "date",
    "year",
    "quarter",
    "month",
    "month_name",
    "week",
    "day_of_month",
    "day_of_week",
    "day_name",
    "is_weekend",
    "is_month_start",
    "is_month_end",
)


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``; ``week`` is the ISO week."""
    bounds = spark.range(1, numPartitions=1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_between(bounds)


def calendar_covering(df: DataFrame, day: Column) -> DataFrame:
    """The whole years that hold every ``day`` of a table; empty if it has none."""
    first, last = F.min(day), F.max(day)
    bounds = df.agg(
        F.trunc(first, "year").alias("start"),
        F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1).alias("end"),
    )
    return calendar_between(bounds.where(F.col("start").isNotNull()))


def calendar_between(bounds: DataFrame) -> DataFrame:
    """The calendar of one row with the dates ``start`` and ``end``."""
    d = F.col("date")
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        dates.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        dates.month_name(d).alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        dates.day_of_week_from_sunday(d).alias("day_of_week"),
        dates.day_name(d).alias("day_name"),
        dates.is_weekend(d).alias("is_weekend"),
        dates.is_month_start(d).alias("is_month_start"),
        dates.is_month_end(d).alias("is_month_end"),
    )
