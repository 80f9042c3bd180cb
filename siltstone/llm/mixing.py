"""Mixing sources to target weights by a curriculum that varies over training.

Each source has a weight schedule over the training run, a line from a start to
an end weight. Its integral gives the source's share of all words, capped at a
multiple of what the source holds; the excess is shared out again by weight
until no source is above its cap. The documents of a source, in the order of a
hash, then meet its cumulative demand: the k-th pass over a source covers the
words k * S to (k + 1) * S, and where demand ends inside a document, the
document gives its first words only. A word's position in training is where
its source's cumulative demand reaches it, so inverting the demand gives each
copy of a document a position, and a range sort by it gives the training order.

:func:`schedule` is the mix in that order, one row per copy of a document;
:func:`mixture` adds up what each document gives to it, and
:func:`training_order` puts the texts into it.

Everything is built-in DataFrame functions. No window holds a whole source: a
source is cut into 2**16 hash segments, windows run inside a segment and over
the segments of a source. The plan over the sources has one row per source.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; null ids are ordered by their text; repeated rows are separate
documents, placed by size and text; documents of size 0 and documents beyond
their source's demand take part with 0 words; an empty table gives an empty
result. Extra columns are carried by :func:`training_order` only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.runtime import durable

WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_GAP = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


@dataclass(frozen=True)
class Mix:
    """Mean weights of the sources in order, repeating; tilts of their schedules.

    A tilt of a lets the weight run from (1 - a) to (1 + a) times its mean, so
    the schedule's integral over training is that mean.
    """

    weights: Sequence[float] = (5.0, 2.0, 1.0)
    tilts: Sequence[float] = (-0.5, 0.0, 0.5)
    share: float = 1.5
    cap: int = 2


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _repeating(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def targets(sources: DataFrame, mix: Mix, order: Sequence[Column]) -> DataFrame:
    """``sources`` (one row per source, ``_source_size``) with target, tilt and totals.

    The level L at which shares min(cap * S, L * w) add up to the total is found
    without a loop. Sources reach their cap in order of cap * S / w; for each
    place in that order it is known which level would use up the rest. These
    levels rise while the sources before a place are rightly taken as full and
    fall from there on, so the largest one is L.
    """
    ranked = sources.withColumn("_rank", F.row_number().over(Window.orderBy(*order)) - 1)
    weighted = (
        ranked.withColumn("_weight", _repeating(mix.weights, F.col("_rank")))
        .withColumn("_tilt", _repeating(mix.tilts, F.col("_rank")))
        .withColumn("_cap", F.col("_source_size") * mix.cap)
        .withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    )
    everything = Window.partitionBy()
    by_level = Window.orderBy("_full_at", "_rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        weighted.withColumn("_total", F.sum("_source_size").over(everything) * mix.share)
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_open", F.sum("_weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_open"))
    )
    return (
        levels.withColumn("_reached", F.max("_level").over(everything))
        .withColumn(
            "_target",
            F.when(F.col("_full_at") < F.col("_reached"), F.col("_cap").cast("double")).otherwise(
                F.col("_reached") * F.col("_weight")
            ),
        )
        .withColumn("_words", F.round("_target").cast("long"))
        .withColumn("_all_words", F.sum("_words").over(everything))
        .withColumn("_drift", F.sum(F.col("_words") * F.col("_tilt")).over(everything))
    )


def sized(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source"):
    """One narrow row per document: what mixing looks at."""
    order = F.md5(
        F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text).cast("binary")), F.lit("")).cast(
            "binary"
        )
    )
    return docs.select(
        F.col(id_col).alias("_id"),
        words(F.col(text)).alias("_size"),
        F.col(source).isNull().alias("_no_source"),
        F.coalesce(F.col(source), F.lit("")).alias("_source"),
        order.alias("_order"),
        F.substring(order, 1, 4).alias("_segment"),
        F.xxhash64(text).alias("_content"),
    )


def demand(docs: DataFrame, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """For each document its source's target and the words taken of it.

    ``_at`` is where its words begin in its source. The documents are read and
    counted once; what follows works on the narrow rows written then.
    """
    rows = durable(sized(docs, **columns), "sized")
    source, segment = ["_no_source", "_source"], ["_no_source", "_source", "_segment"]
    segments = rows.groupBy(*segment).agg(F.sum("_size").alias("_segment_size"))
    by_source = segments.groupBy(*source).agg(F.sum("_segment_size").alias("_source_size"))
    planned = targets(by_source, mix, [F.col("_no_source"), F.col("_source")])
    in_source = Window.partitionBy(*source).orderBy("_segment")
    offsets = segments.join(planned, source).withColumn(
        "_segment_at",
        F.coalesce(F.sum("_segment_size").over(in_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    in_segment = Window.partitionBy(*segment).orderBy("_order", "_size", "_content", "_id")
    before = F.sum("_size").over(in_segment.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        rows.withColumn("_before", F.coalesce(before, F.lit(0)))
        .join(offsets, segment)
        .withColumn("_at", F.col("_segment_at") + F.col("_before"))
    )
    passes = [_taken(F.lit(k)) for k in range(mix.cap)]
    return placed.withColumn("_taken", sum(passes[1:], passes[0]))


def _taken(k: Column) -> Column:
    """The words of a document that pass ``k`` over its source takes."""
    left = F.col("_words") - (k * F.col("_source_size") + F.col("_at"))
    return F.greatest(F.lit(0), F.least(F.col("_size"), left)).cast("long")


def _position(k: Column) -> Column:
    """Training position of a copy's first word.

    With u the part of its demand that the source has met before, solve
    t + a * (t * t - t) = u for the time t; the words of all sources up to t
    follow from the same integral.
    """
    a = F.col("_tilt")
    u = (k * F.col("_source_size") + F.col("_at")) / F.col("_words")
    t = F.when(F.abs(a) < 1e-9, u).otherwise(
        2 * u / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * u))
    )
    return F.col("_all_words") * t + F.col("_drift") * (t * t - t)


_PLAN = ("_words", "_source_size", "_tilt", "_all_words", "_drift")


def _copies(placed: DataFrame, cap: int) -> DataFrame:
    """A row for each pass that takes words of a document: how many, and where they come in training."""
    return (
        placed.withColumn("_pass", F.explode(F.array(*[F.lit(k) for k in range(cap)])))
        .withColumn("_part", _taken(F.col("_pass")))
        .where(F.col("_part") > 0)
        .withColumn("_position", _position(F.col("_pass")))
    )


def _in_training_order(copies: DataFrame) -> DataFrame:
    """A range sort; source and place tell apart copies of repeated rows."""
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    return copies.orderBy("_position", key, "_pass", "_no_source", "_source", "_at")


def _scheduled(placed: DataFrame, cap: int) -> DataFrame:
    """The copies of all documents in training order, written once."""
    document = ["_id", "_size", "_no_source", "_source", "_at", "_target"]
    narrow = placed.where(F.col("_taken") > 0).select(*document, *_PLAN)
    return durable(_in_training_order(_copies(narrow, cap)), "training")


def schedule(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, source, pass, words, position): the mix in training order, one row per copy.

    ``position`` is how many words of all sources training has met before.
    """
    return _scheduled(demand(docs, mix), mix.cap).select(
        F.col("_id").alias("doc_id"),
        F.when(~F.col("_no_source"), F.col("_source")).alias("source"),
        F.col("_pass").alias("pass"),
        F.col("_part").alias("words"),
        F.col("_position").alias("position"),
    )


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_at, last_at) of every document.

    ``taken`` adds up the document's copies in the training order, ``first_at``
    and ``last_at`` are where the first and the last of them come in training;
    null for documents that take no part. A document that takes part has words,
    so its place in its source is its own.
    """
    placed = durable(demand(docs, mix), "placed")
    document = ["_id", "_size", "_no_source", "_source", "_at", "_source_size", "_target"]
    taken = (
        _scheduled(placed, mix.cap)
        .groupBy(*document)
        .agg(
            F.sum("_part").alias("taken"),
            F.min("_position").alias("first_at"),
            F.max("_position").alias("last_at"),
        )
    )
    nowhere = F.lit(None).cast("double")
    others = placed.where(F.col("_taken") == 0).select(
        *document, F.col("_taken").alias("taken"), nowhere.alias("first_at"), nowhere.alias("last_at")
    )
    return taken.union(others).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        "taken",
        "first_at",
        "last_at",
    )


def training_order(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mix in training order, with the columns of ``docs``.

    A document stands once for each pass that takes it. The last one of a
    source is cut after the words still wanted, and ``n_chars``, if there is
    such a column, follows. Repeated rows are matched one to one.
    """
    same = ["_key", "_content", "_no_source", "_source"]
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    placed = demand(docs, mix).where(F.col("_taken") > 0).withColumn("_key", key)
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("_at"))
    places = placed.select(*same, nth.alias("_nth"), *["_id", "_size", "_at", *_PLAN])
    # The row travels as one column, so that its names can't clash with ours.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    texts = docs.select(
        row.alias("_row"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"),
        F.xxhash64("text").alias("_content"),
        F.col("source").isNull().alias("_no_source"),
        F.coalesce(F.col("source"), F.lit("")).alias("_source"),
    ).withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64("_row"))))
    copies = _in_training_order(_copies(texts.join(places, [*same, "_nth"]), mix.cap))
    cut = F.col("_part") < F.col("_size")
    first_words = F.array_join(
        F.slice(
            F.regexp_extract_all("_row.text", F.lit(WORD_AND_GAP), F.lit(0)), 1, F.col("_part").cast("int")
        ),
        "",
    )
    # The words are cut out in a step of their own: two columns read them.
    out = copies.select("_row", F.when(cut, first_words).alias("_cut"))
    changed = {"text": F.col("_cut")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_cut").cast(docs.schema["n_chars"].dataType)
    return out.select(
        *[
            F.when(F.col("_cut").isNotNull(), changed[c]).otherwise(F.col("_row")[c]).alias(c)
            if c in changed
            else F.col("_row")[c].alias(c)
            for c in docs.columns
        ]
    )
