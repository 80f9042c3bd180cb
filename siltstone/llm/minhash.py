"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

1. A document is the set of its distinct word shingles. Equal sets are one
   class from here on, so exact copies are never compared.
2. A class has a signature of 64 symbols of 16 bits, the last bits of 64
   MinHash values. Two sets of similarity s differ in a symbol with a chance
   of 1 - s, so a similarity threshold becomes a distance threshold whose tail
   probability is below ``MISSED``.
3. Multi-index join: with the symbols split into chunks, two signatures within
   distance d agree up to d // chunks symbols in some chunk. Enumerating the
   chunk's symbols that may be wrong gives each signature a few exact keys, and
   every pair within the distance meets under one of them.
4. Pairs are not formed inside a bucket. First its members meet just one of
   them. Confirmed links give components, and then just the
   members of different components that share a bucket meet, with the distance
   checked before texts are. What is left out could only repeat a connection.
5. A link counts if the full shingle sets, taken from the texts, are similar
   enough. Components of links are the groups.

Defined results: a document without words has no shingles and no links; with
fewer words than a shingle, its words are its only shingle; rows that share an
id are one document; rows with a null id are linked with nothing, have no
component and are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.arrow_text import Block, flat, map_blocks
from siltstone.llm.components import components
from siltstone.llm.shingles import NOT_WHITE, distinct, mix, range_hashes, shingles, stream, words
from siltstone.runtime import durable

SYMBOLS, SYMBOL_BITS = 64, 16
PER_LONG = 64 // SYMBOL_BITS
SIGNATURE = [f"_s{i}" for i in range(SYMBOLS // PER_LONG)]
#: Chance that a pair at the similarity threshold exceeds the distance threshold.
MISSED = 1e-6
_U = np.uint64
_XOR, _MULTIPLY = stream(11, SYMBOLS), stream(13, SYMBOLS) | _U(1)


@dataclass(frozen=True)
class Near:
    """Shingle width, similarity threshold (hundredths), wrong symbols per chunk."""

    width: int = 5
    percent: int = 80
    chunk_errors: int = 1
    lower: bool = True

    @property
    def distance(self) -> int:
        """Largest distance, such that a pair at the threshold rarely exceeds it."""
        p = 1 - self.percent / 100
        tail, d = 1.0, -1
        while tail > MISSED:
            d += 1
            tail -= comb(SYMBOLS, d) * p**d * (1 - p) ** (SYMBOLS - d)
        return d

    @property
    def chunks(self) -> list[range]:
        count = self.distance // (self.chunk_errors + 1) + 1
        ends = [SYMBOLS * i // count for i in range(count + 1)]
        return [range(a, b) for a, b in zip(ends, ends[1:], strict=False)]


def block_shingles(data: np.ndarray, offsets: np.ndarray, near: Near):
    """The distinct (row, shingle) pairs of a block of texts, sorted."""
    rows, starts, ends = words(data, offsets, NOT_WHITE)
    hashes = range_hashes(data, starts, ends, lower=near.lower)
    return distinct(*shingles(rows, hashes, near.width))


def _digests(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two numbers for each row's set of shingles; rows have ``counts`` of them in turn."""
    filled = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[filled]
    digests = np.zeros((2, len(counts)), _U)
    if len(values):
        digests[0, filled] = np.add.reduceat(mix(values ^ _XOR[0]), first)
        digests[1, filled] = np.add.reduceat(mix(values ^ _XOR[1]), first)
    return digests


def _sketch(block: Block, near: Near, id_col: str) -> pa.RecordBatch:
    rows, values = block_shingles(block.data, block.offsets, near)
    counts = np.bincount(rows, minlength=len(block))
    filled = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[filled]
    digests = _digests(values, counts)
    signature = np.zeros((len(SIGNATURE), len(block)), _U)
    if len(values):
        for i in range(SYMBOLS):
            least = np.minimum.reduceat((values ^ _XOR[i]) * _MULTIPLY[i], first)
            symbol = mix(least) & _U((1 << SYMBOL_BITS) - 1)
            signature[i // PER_LONG, filled] |= symbol << _U(i % PER_LONG * SYMBOL_BITS)
    columns = [counts, *(x.view(np.int64) for x in (*digests, *signature))]
    return pa.record_batch(
        [block.rows.column(0), *(pa.array(c, pa.int64()) for c in columns)],
        [id_col, "_count", "_d1", "_d2", *SIGNATURE],
    )


def sketches(docs: DataFrame, near: Near, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size and digest of the shingle set, signature) of every row."""
    names = ["_count", "_d1", "_d2", *SIGNATURE]
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            *[T.StructField(n, T.LongType()) for n in names],
        ]
    )
    return map_blocks(docs.select(id_col, text), lambda b: _sketch(b, near, id_col), schema, text)


def _symbol(i: int) -> Column:
    bits = F.shiftrightunsigned(F.col(SIGNATURE[i // PER_LONG]), i % PER_LONG * SYMBOL_BITS)
    return bits.bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1))


def index_keys(near: Near) -> Column:
    """The keys of a signature: each chunk, less each choice of symbols that may be wrong."""
    keys = []
    for number, chunk in enumerate(near.chunks):
        for choice, wrong in enumerate(combinations(chunk, min(near.chunk_errors, len(chunk)))):
            sound = [_symbol(i) for i in chunk if i not in wrong]
            keys.append(F.xxhash64(F.lit(number), F.lit(choice), *sound))
    return F.array(*keys)


def signature_distance(left: str, right: str) -> Column:
    """Number of differing symbols: each 16-bit lane of the xor is folded to one bit."""
    total = F.lit(0)
    for name in SIGNATURE:
        x = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        for shift, mask in ((8, 0x00FF), (4, 0x000F), (2, 0x0003), (1, 0x0001)):
            lanes = sum(mask << lane for lane in range(0, 64, SYMBOL_BITS))
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(lanes))
        total = total + F.bit_count(x)
    return total


def _close(pairs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """The pairs whose signatures are within the distance."""
    signed = classes.select("_id", *SIGNATURE)
    return (
        pairs.join(signed.alias("x"), F.col("a") == F.col("x._id"))
        .join(signed.alias("y"), F.col("b") == F.col("y._id"))
        .where(signature_distance("x", "y") <= near.distance)
        .select("a", "b")
        .distinct()
    )


def _ordered(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _one_of_each(docs: DataFrame, near: Near) -> DataFrame:
    """(_id, _set, _text) of ``docs`` (_id, _text, _again): one row for each id and set of shingles.

    Just the rows whose ids are ``_again``, stored several times, are compared.
    """

    def named(block: Block) -> pa.RecordBatch:
        rows, values = block_shingles(block.data, block.offsets, near)
        digests = _digests(values, np.bincount(rows, minlength=len(block)))
        return pa.record_batch(
            [
                block.rows.column(block.rows.schema.get_field_index("_id")),
                pa.array([d.tobytes() for d in np.ascontiguousarray(digests.T)], pa.binary()),
                block.rows.column(block.rows.schema.get_field_index("_text")),
            ],
            ["_id", "_set", "_text"],
        )

    kinds = [docs.schema["_id"], T.StructField("_set", T.BinaryType()), docs.schema["_text"]]
    again = map_blocks(docs.where("_again").select("_id", "_text"), named, T.StructType(kinds), "_text")
    once = docs.where(~F.col("_again")).select("_id", F.lit(b"").alias("_set"), "_text")
    return once.union(again.dropDuplicates(["_id", "_set"]))


def confirmed(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity; ``texts`` is (_id, _text)."""
    both = pairs.join(
        texts.select(F.col("_id").alias("a"), F.col("_text").alias("_text_a")), "a"
    ).join(texts.select(F.col("_id").alias("b"), F.col("_text").alias("_text_b")), "b")

    def similar(block: Block) -> pa.RecordBatch:
        left = block_shingles(block.data, block.offsets, near)
        right = block_shingles(*flat(block.rows.column("_text_b")), near)
        shared, _ = _repeated(np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]]))
        n = len(block)
        common = np.bincount(shared, minlength=n)
        union = np.bincount(left[0], minlength=n) + np.bincount(right[0], minlength=n) - common
        linked = (100 * common >= near.percent * union) & (union > 0)
        return block.rows.select(["a", "b"]).filter(pa.array(linked))

    ends = [T.StructField(c, pairs.schema[c].dataType) for c in ("a", "b")]
    return map_blocks(both.select("_text_a", "_text_b", "a", "b"), similar, T.StructType(ends), "_text_a", 1 << 20)


def rarest(texts: DataFrame, near: Near) -> DataFrame:
    """(_id, _shingle, _place, _count): each set's rarest shingles, as many as matter.

    ``texts`` is (_id, _set, _text), with one row for each id and set.

    In an order shared by all sets, here by how many of the texts hold a
    shingle, similar sets have one of their first ones in common: with more
    than 1 - s of a set gone, too little is left for similarity s.
    """

    def each(block: Block) -> pa.RecordBatch:
        rows, values = block_shingles(block.data, block.offsets, near)
        ids = block.rows.column(block.rows.schema.get_field_index("_id")).take(pa.array(rows))
        sets = block.rows.column(block.rows.schema.get_field_index("_set")).take(pa.array(rows))
        counts = np.bincount(rows, minlength=len(block))[rows]
        return pa.record_batch(
            [ids, sets, pa.array(values.view(np.int64)), pa.array(counts)], ["_id", "_set", "_shingle", "_count"]
        )

    schema = T.StructType(
        [
            texts.schema["_id"],
            texts.schema["_set"],
            T.StructField("_shingle", T.LongType()),
            T.StructField("_count", T.LongType()),
        ]
    )
    each_shingle = map_blocks(texts.select("_id", "_set", "_text"), each, schema, "_text")
    holders = each_shingle.groupBy("_shingle").agg(F.count(F.lit(1)).alias("_holders"))
    place = F.row_number().over(Window.partitionBy("_id", "_set").orderBy("_holders", "_shingle"))
    needed = F.col("_count") - F.ceil(F.col("_count") * near.percent / 100) + 1
    return (
        each_shingle.join(holders, "_shingle")
        .withColumn("_place", place.cast("long"))
        .where(F.col("_place") <= needed)
        .select("_id", "_shingle", "_place", "_count")
    )


def _repeated(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    twice = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
    return rows[1:][twice], values[1:][twice]


@dataclass(frozen=True)
class Groups:
    """``sets``: a row for each document; ``links``: confirmed pairs of classes."""

    sets: DataFrame
    links: DataFrame
    members: DataFrame


def groups(docs: DataFrame, near: Near, id_col: str = "doc_id", text: str = "text") -> Groups:
    """``members`` is (_d1, _d2, component): the group of every shingle set."""
    named = docs.where(F.col(id_col).isNotNull())
    sets = durable(sketches(named, near, id_col, text), "sketches")
    classes = durable(
        sets.where(F.col("_count") > 0)
        .groupBy("_d1", "_d2")
        .agg(F.min(id_col).alias("_id"), *[F.first(s).alias(s) for s in SIGNATURE]),
        "classes",
    )
    keys = classes.select("_id", F.explode(index_keys(near)).alias("_key"))
    # One member stands for a bucket. Whole-number ids are shuffled by the key, so
    # that a group in many buckets has another one in each.
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    place = F.col("_id").cast("long").bitwiseXOR(F.col("_key")) if whole else F.col("_id")

    def member(place: Column) -> Column:
        return place.bitwiseXOR(F.col("_key")).cast(docs.schema[id_col].dataType) if whole else place

    buckets = (
        keys.groupBy("_key")
        .agg(F.min(place).alias("_low"), F.max(place).alias("_high"))
        .where(F.col("_low") < F.col("_high"))
        .select("_key", member(F.col("_low")).alias("_first"))
    )
    members = durable(keys.join(buckets, "_key"), "buckets")
    again = sets.groupBy(F.col(id_col).alias("_id")).agg((F.count(F.lit(1)) > 1).alias("_again"))
    shared = durable(members.select("_id").distinct().join(again, "_id"), "shared")
    named_texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    texts = durable(_one_of_each(named_texts.join(shared, "_id"), near), "bucket_texts")

    spokes = members.where(F.col("_id") != F.col("_first")).select(*_ordered("_id", "_first")).distinct()
    tried = durable(_close(spokes, classes, near), "pairs")
    links = durable(confirmed(tried, texts, near), "links")

    rest = durable(
        _across(members, components(links), classes, texts, near).join(tried, ["a", "b"], "left_anti"), "pairs"
    )
    links = durable(links.union(confirmed(rest, texts, near)).distinct(), "links")
    joined = links.select("a", "b").union(_same_id(sets, classes, id_col))
    found = components(joined).withColumnRenamed("node", "_id")
    named_groups = classes.join(found, "_id", "left").select(
        "_d1", "_d2", F.coalesce("component", "_id").alias("component")
    )
    return Groups(sets, links, named_groups)


def _same_id(sets: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    """(a, b) that tie the sets of one id together, each named by its class.

    Rows that share an id are one document, whatever their texts: it belongs to
    one group. Few ids have several sets, and only theirs meet the classes.
    """
    held = sets.where(F.col("_count") > 0)
    several = (
        held.groupBy(F.col(id_col).alias("_several"))
        .agg(*[f(d).alias(f"{f.__name__}{d}") for f in (F.min, F.max) for d in ("_d1", "_d2")])
        .where((F.col("min_d1") != F.col("max_d1")) | (F.col("min_d2") != F.col("max_d2")))
        .select("_several")
    )
    return (
        held.join(several, F.col(id_col) == F.col("_several"))
        .select("_several", "_d1", "_d2")
        .distinct()
        .join(classes.select("_d1", "_d2", "_id"), ["_d1", "_d2"])
        .select(F.least("_several", "_id").alias("a"), F.greatest("_several", "_id").alias("b"))
        .where(F.col("a") != F.col("b"))
    )


def _across(
    members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, near: Near
) -> DataFrame:
    """Pairs of different components that may be links and share a bucket.

    Outsiders, members outside the largest component of one of their buckets,
    meet members of other components over the rarest shingles they share. What
    stands before a shingle in either order isn't shared, if it is the first one
    that is, so its place bounds the rest: s * (both sizes) must not exceed
    (1 + s) * (1 + what is left of either set). A large group's outsiders differ
    from everyone in shingles of their own, which come first, so they are seen
    off here and not one by one.
    """
    labelled = durable(
        members.select("_key", "_id")
        .join(labels.withColumnRenamed("node", "_id"), "_id", "left")
        .withColumn("_component", F.coalesce("component", "_id"))
        .select("_key", "_id", "_component"),
        "labelled",
    )
    largest = (
        labelled.groupBy("_key", "_component")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy("_key")
        .agg(
            F.max(F.struct("_rows", "_component"))["_component"].alias("_main"),
            F.count(F.lit(1)).alias("_parts"),
        )
        .where(F.col("_parts") > 1)
        .select("_key", "_main")
    )
    mixed = durable(
        labelled.join(largest, "_key")
        .groupBy("_id", "_component")
        .agg(F.max(F.col("_component") != F.col("_main")).alias("_outside")),
        "mixed",
    )
    first = durable(
        rarest(texts.join(mixed.select("_id"), "_id", "left_semi"), near).join(mixed, "_id"), "rarest"
    )
    x, y = first.where("_outside").alias("x"), first.alias("y")
    left = 1 + F.least(F.col("x._count") - F.col("x._place"), F.col("y._count") - F.col("y._place"))
    pairs = (
        x.join(
            y,
            (F.col("x._shingle") == F.col("y._shingle"))
            & (F.col("x._component") != F.col("y._component"))
            & (~F.col("y._outside") | (F.col("x._id") < F.col("y._id")))
            & ((100 + near.percent) * left >= near.percent * (F.col("x._count") + F.col("y._count"))),
        )
        .select(F.least("x._id", "y._id").alias("a"), F.greatest("x._id", "y._id").alias("b"))
        .distinct()
    )
    return _close(pairs, classes, near)


def near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    found = groups(docs, near, id_col, text)
    named = (
        found.sets.select(id_col, "_count", "_d1", "_d2")
        .join(found.members, ["_d1", "_d2"], "left")
        .select(
            F.col(id_col),
            F.col("_count").alias("n_shingles"),
            F.when(F.col("_count") > 0, F.col("component")).otherwise(F.col(id_col)).alias("component_id"),
        )
        .withColumn("kept", F.col(id_col) == F.col("component_id"))
    )
    unnamed = sketches(docs.where(F.col(id_col).isNull()), near, id_col, text).select(
        id_col,
        F.col("_count").alias("n_shingles"),
        F.lit(None).cast(docs.schema[id_col].dataType).alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return named.union(unnamed)


def keep_one(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates."""
    found = near_duplicates(docs, near, id_col, text)
    dropped = found.where(~F.col("kept")).select(id_col).distinct()
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)
