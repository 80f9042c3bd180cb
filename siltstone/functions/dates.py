"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shape of a date text, and the date spellings read
# by the lenient parser. \z, because $ would also accept a trailing newline.
ISO_DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
LENIENT_FORMATS = ("yyyy-MM-dd", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "yyyy/MM/dd", "M/d/yyyy")


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as an integer; arithmetic, so no string is built per row."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_of_week_from_sunday(d: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def is_month_start(d: Column) -> Column:
    return F.dayofmonth(d) == 1


def is_month_end(d: Column) -> Column:
    return d == F.last_day(d)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def guarded_date(text: Column) -> Column:
    """A date where the text has the shape of one, else NULL.

    Well-shaped but impossible dates (month 13) give NULL instead of an error.
    """
    return F.when(text.rlike(ISO_DATE_SHAPE), text.try_cast("date"))


def lenient_date(text: Column, formats: tuple[str, ...] = LENIENT_FORMATS) -> Column:
    """The first of ``formats`` that reads the whole text, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("date")
