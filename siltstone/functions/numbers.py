"""Numeric expressions with the rounding rules of SQL NUMERIC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of operands: whole numbers, and amounts in cents.
WHOLE = "decimal(20,0)"
CENTS = "decimal(24,2)"
_DIGITS = "decimal(38,0)"


def round_to_long(x: Column) -> Column:
    """Round half away from zero; a plain cast would cut the fraction off."""
    return F.round(x, 0).cast("long")


def ratio(numerator: Column, denominator: Column, places: int = 2, kind: str = WHOLE) -> Column:
    """An exact quotient rounded half away from zero; NULL over zero.

    Worked out in whole numbers, as a decimal quotient is itself rounded: with
    u units of the last place, (2 * u * n + d) div 2d. An operand has up to 20
    digits before the point, in cents 22, and every step fits into 38: the
    largest, 2 * u * n with two places, has 27.
    """
    return _quotient(_whole(numerator, kind), denominator, places, kind)


def percent(part: Column, whole: Column, places: int = 2, kind: str = WHOLE) -> Column:
    """``part`` in percent of ``whole``, rounded; NULL of nothing.

    The operands are widened before anything is multiplied, so that neither
    counts nor amounts overflow; the largest step has 29 digits.
    """
    return _quotient((_whole(part, kind) * 100).cast(_DIGITS), whole, places, kind)


def _quotient(n: Column, denominator: Column, places: int, kind: str) -> Column:
    d = F.nullif(_whole(denominator, kind), F.lit(0).cast(_DIGITS))
    top, bottom = 2 * 10**places * F.abs(n) + F.abs(d), 2 * F.abs(d)
    # Without its remainder the division leaves no fraction to be rounded.
    units = ((top - top % bottom) / bottom).cast("decimal(30,0)")
    signed = units * F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    return (signed / F.lit(10**places)).cast(f"decimal(34,{places})")


def ratio_sql(numerator: str, denominator: str, places: int = 2, kind: str = WHOLE) -> str:
    """:func:`ratio` as text, for views in the catalog."""

    def whole(x: str) -> str:
        return f"CAST(CAST({x} AS {kind}) * {100 if kind == CENTS else 1} AS {_DIGITS})"

    n, d = whole(numerator), f"NULLIF({whole(denominator)}, CAST(0 AS {_DIGITS}))"
    top, bottom = f"({2 * 10**places} * abs({n}) + abs({d}))", f"(2 * abs({d}))"
    units = f"CAST(({top} - {top} % {bottom}) / {bottom} AS DECIMAL(30,0))"
    signed = f"{units} * CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    return f"CAST({signed} / {10**places} AS DECIMAL(34,{places}))"


def _whole(x: Column, kind: str) -> Column:
    """A value of this kind in whole units of its last place."""
    cents = 100 if kind == CENTS else 1
    return (x.cast(kind) * cents).cast(_DIGITS)


def count_where(condition: Column) -> Column:
    """COUNT(*) FILTER (WHERE condition)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum_where(x: Column, condition: Column) -> Column:
    """SUM(x) FILTER (WHERE condition); NULL where no row qualifies."""
    return F.sum(F.when(condition, x))
