"""Declared constraints, run as validation of a DataFrame.

A constraint states what may be stored. :func:`audit` counts the rows that
break each one; :func:`enforce` applies a policy to them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.rules import POLICIES
from siltstone.runtime import durable

VIOLATIONS = "violations"
_SOUND = "_sound"


class ConstraintError(ValueError):
    """Raised by the ``fail`` policy; the message names each broken constraint."""


@dataclass(frozen=True)
class Check:
    """A row is broken where ``condition`` is FALSE; NULL passes."""

    name: str
    condition: Column

    def broken(self) -> Column:
        return ~F.coalesce(self.condition, F.lit(True))


@dataclass(frozen=True)
class Unique:
    """No two rows share the non-NULL value of ``column``."""

    column: str

    @property
    def name(self) -> str:
        return f"unique_{self.column}"


@dataclass(frozen=True)
class ForeignKey:
    """Every non-NULL ``column`` occurs as ``parent_column`` of table ``parent``."""

    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"fk_{self.column}"


Constraint = Check | Unique | ForeignKey


def not_null(*columns: str) -> list[Check]:
    return [Check(f"not_null_{c}", F.col(c).isNotNull()) for c in columns]


def max_length(lengths: Mapping[str, int]) -> list[Check]:
    return [Check(f"length_{c}", F.char_length(c) <= n) for c, n in lengths.items()]


def one_of(column: str, values: Sequence[str]) -> Check:
    return Check(f"domain_{column}", F.col(column).isin(*values))


@dataclass(frozen=True)
class Enforced:
    kept: DataFrame
    rejected: DataFrame


def audit(
    df: DataFrame, constraints: Sequence[Constraint], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per constraint: its name and the number of rows breaking it.

    One scan serves all of them. A row becomes a pair (constraint, value) for each
    value that has to be unique or known, and one without a value for each check it
    breaks. Pairs are counted inside each task before they are shuffled, so a hot
    value or a check that many rows break moves as a single row. The keys of all
    parents meet the counted pairs in one join.
    """
    value = T.StringType()
    pairs = [
        F.when(c.broken(), F.struct(F.lit(i).alias("_which"), F.lit(None).cast(value).alias("_value")))
        if isinstance(c, Check)
        else F.when(
            F.col(c.column).isNotNull(),
            F.struct(F.lit(i).alias("_which"), F.col(c.column).cast(value).alias("_value")),
        )
        for i, c in enumerate(constraints)
    ]
    counted = (
        df.select(F.inline(F.array_compact(F.array(*pairs))))
        .groupBy("_which", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = [
        _keys(c, parents).select(F.lit(i).alias("_of"), F.col(c.column).cast(value).alias("_key"))
        for i, c in enumerate(constraints)
        if isinstance(c, ForeignKey)
    ]
    orphan = F.lit(True)
    if known:
        keys = reduce(DataFrame.union, known)
        counted = counted.join(keys, (F.col("_which") == F.col("_of")) & (F.col("_value") == F.col("_key")), "left")
        orphan = F.col("_key").isNull()
    breaking = {Check: F.col("_n"), Unique: F.col("_n") - 1, ForeignKey: F.when(orphan, F.col("_n"))}
    totals = counted.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("_which") == i, breaking[type(c)])), F.lit(0)).alias(f"_{i}")
            for i, c in enumerate(constraints)
        ]
    )
    found = [
        F.struct(F.lit(c.name).alias("constraint"), F.col(f"_{i}").alias(VIOLATIONS))
        for i, c in enumerate(constraints)
    ]
    return totals.select(F.inline(F.array(*found)))


def enforce(
    df: DataFrame,
    constraints: Sequence[Constraint],
    policy: str,
    parents: Mapping[str, DataFrame] | None = None,
) -> Enforced:
    """Apply ``policy``: ``fail`` raises, the others split kept from rejected rows.

    Rejected rows carry the names of the constraints they break. Of rows that
    share a unique value one is kept: of those that break nothing else, if there
    are any, the first by a hash of all their columns. ``quarantine`` writes the
    judged rows once, as both results are read. ``fail`` runs one counting job
    and brings one number per constraint to the driver.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    if policy == "fail":
        broken = audit(df, constraints, parents).where(F.col(VIOLATIONS) > 0).collect()
        if broken:
            found = ", ".join(f"{r['constraint']}: {r[VIOLATIONS]}" for r in broken)
            raise ConstraintError(f"rows break constraints ({found})")
        return Enforced(df, df.limit(0).withColumn(VIOLATIONS, _names([])))

    marked = _mark(df, constraints, parents)
    if policy == "quarantine":
        marked = durable(marked, "judged")
    # Rows are told apart by a flag: no list of names is made for those that are kept.
    kept, rejected = marked.where(_SOUND), marked.where(f"NOT {_SOUND}")
    return Enforced(kept.select(*df.columns), rejected.drop(_SOUND))


def _mark(df: DataFrame, constraints: Sequence[Constraint], parents) -> DataFrame:
    """``df`` with the names of the constraints each row breaks and whether there are none."""
    columns = df.columns
    unique = [c for c in constraints if isinstance(c, Unique)]
    if unique:
        # The row number tells copies apart, so it has to be fixed first.
        df = durable(df.withColumn("_row", F.monotonically_increasing_id()), "unique")
    broken: list[tuple[str, Column]] = []
    content = F.xxhash64(*[F.col(f"`{name}`") for name in columns])
    # Unique values come last: which copy stays depends on everything else.
    for i, c in enumerate(sorted(constraints, key=lambda c: isinstance(c, Unique))):
        if isinstance(c, Check):
            df = df.withColumn(f"_broken{i}", c.broken())
        elif isinstance(c, Unique):
            faulty = reduce(lambda x, y: x | y, [flag for _, flag in broken], F.lit(False))
            df = df.withColumn("_place", F.struct(faulty.alias("faulty"), content.alias("content"), "_row"))
            first = (
                df.where(F.col(c.column).isNotNull())
                .groupBy(F.col(c.column).alias("_value"))
                .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
                .where("_n > 1")
            )
            df = (
                df.join(first, F.col(c.column) == F.col("_value"), "left")
                .withColumn(f"_broken{i}", F.coalesce(F.col("_place") != F.col("_first"), F.lit(False)))
                .drop("_value", "_first", "_n", "_place")
            )
        else:
            keys = _keys(c, parents).withColumnRenamed(c.column, "_parent")
            df = (
                df.join(keys, F.col(c.column) == F.col("_parent"), "left")
                .withColumn(f"_broken{i}", F.col(c.column).isNotNull() & F.col("_parent").isNull())
                .drop("_parent")
            )
        broken.append((c.name, F.col(f"_broken{i}")))
    sound = reduce(lambda x, y: x & y, [~flag for _, flag in broken], F.lit(True))
    return df.select(*columns, _names(broken).alias(VIOLATIONS), sound.alias(_SOUND))


def _names(broken: list[tuple[str, Column]]) -> Column:
    if not broken:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in broken]))


def _keys(c: ForeignKey, parents: Mapping[str, DataFrame] | None) -> DataFrame:
    if not parents or c.parent not in parents:
        raise ValueError(f"{c.name} needs the table {c.parent!r}")
    # A parent key is a primary key: it is unique already.
    return parents[c.parent].select(F.col(c.parent_column).alias(c.column))
