"""Text extraction over a table of documents.

A document is one row; its matches become rows by ``posexplode``, in text
order, without leaving the task. Patterns use possessive loops so that the
regex engine iterates where it would otherwise recurse per nested group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_matches(
    docs: DataFrame, text: str, pattern: str, groups: dict[str, int], position: str
) -> DataFrame:
    """One row per match of ``pattern``, with the named groups and its position.

    The column ``text`` is consumed; the others are kept.
    """
    found = {
        name: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
        for name, group in groups.items()
    }
    zipped = F.arrays_zip(*[column.alias(name) for name, column in found.items()])
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, F.posexplode(zipped).alias(position, "_match")).select(
        *kept, position, *[F.col(f"_match.{name}").alias(name) for name in groups]
    )


def explode_matches_in_context(
    docs: DataFrame,
    text: str,
    pattern: str,
    groups: dict[str, int],
    position: str,
    context: str,
    width: int,
    shortest: int,
) -> DataFrame:
    """As :func:`explode_matches`, with the ``width`` characters left of each match.

    Matches and the text between them alternate, so the context is the tail of
    the pieces before a match. As no match is shorter than ``shortest``
    characters, ``width / shortest`` matches and the gaps between them always
    cover it; no offsets are needed and the document is not repeated per row.
    """
    whole = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    gaps = F.split(F.col(text), pattern, -1)
    reach = -(-width // shortest)
    kept = [c for c in docs.columns if c != text]

    def seen(piece: Column) -> Column:
        return F.right(piece, F.lit(width))

    def left_of(i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0))
        past = F.slice("_pieces", first + 1, i - first)
        # No piece is copied beyond the characters that can still be seen.
        tail = F.transform(past, lambda p: F.concat(seen(p["gap"]), seen(p["match"])))
        return seen(F.concat(F.concat_ws("", tail), seen(F.get("_gaps", i))))

    found = {
        name: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
        for name, group in groups.items()
    }
    rows = docs.select(
        *kept,
        gaps.alias("_gaps"),
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("match")).alias(
            "_pieces"
        ),
        F.arrays_zip(*[column.alias(name) for name, column in found.items()]).alias("_matches"),
    )
    with_context = F.transform(
        "_matches", lambda m, i: F.struct(m.alias("m"), left_of(i).alias("left"))
    )
    return rows.select(*kept, F.posexplode(with_context).alias(position, "_row")).select(
        *kept,
        position,
        *[F.col(f"_row.m.{name}").alias(name) for name in groups],
        F.col("_row.left").alias(context),
    )


def extract_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; NULL where nothing matches."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def carry_forward(rows: DataFrame, document: str, position: str, value: Column, name: str) -> DataFrame:
    """The last non-NULL ``value`` at or before each row of its document.

    A document arrived as one row, so its matches fit in one window partition.
    """
    so_far = (
        Window.partitionBy(document)
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
