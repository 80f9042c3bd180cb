"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(name: Column) -> Column:
    """Lower case, letters a-z and digits only; NULL becomes the empty text."""
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def trim_commas(text: Column) -> Column:
    return F.btrim(text, F.lit(","))


def append_tag(tags: Column, tag: str) -> Column:
    """``tag`` behind the tags already there; an absent list starts a new one."""
    return F.concat_ws(",", tags, F.lit(tag))


def tag_list(conditions: list[tuple[str, Column]]) -> Column:
    """The names whose condition holds, comma separated, in the given order.

    A condition that is NULL does not count; no name gives the empty text.
    """
    return F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in conditions])


def contains_any(text: Column, keywords: tuple[str, ...]) -> Column:
    """Case-insensitive search for any keyword; NULL contains none.

    The keywords are alternatives of one pattern, so the text is read once.
    """
    return F.coalesce(F.lower(text).rlike("|".join(keywords)), F.lit(False))
