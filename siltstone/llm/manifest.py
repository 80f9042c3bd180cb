"""Merkle manifest of a dataset: leaves, roots and proofs, with SQL functions only.

A leaf is the hash of a row. The leaves of a group (a language), in order of
their ids, form a tree: every two consecutive nodes become the hash of both, a
single last one the hash of itself, until one node remains, the subroot. The
subroots in order of their groups form a tree likewise, which ends in the root.

A level is kept as the concatenation of its nodes' hex digests. Nodes are cut
into aligned blocks of ``2**BLOCK_BITS``; a block folds its levels on its own,
one string for each: the parents are the hashes of substrings of two digests,
and the siblings of a node are the substrings at its flanks. What remains of the
blocks, one digest each, are the nodes of the next tier, so roots recurse: a
tier has ``2**BLOCK_BITS`` times fewer rows than the one below, and no group of
any size meets in one task. Paths are put together downwards, a block's path
above it being the same for all its nodes.

The text of a row is read once, for its leaf; what is shuffled is the narrow row
of digests. Positions come from a range sort, not from a global window.

Defined results: a null field counts as ``-``, unlike any value; a null group is
a group, the first one; null ids come first in theirs; rows that share an id are
ordered by their leaf, and equal rows among themselves in any order; a lone node
is its own root and has an empty path; an empty table has an empty manifest.
Texts of any length become one digest in the scan. Columns other than the named
ones aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.keys import dense_index
from siltstone.runtime import durable

#: A block holds 2**BLOCK_BITS digests of DIGEST characters.
BLOCK_BITS = 8
DIGEST = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(content: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(content, 256)


def framed(value: Column) -> Column:
    """A value as its byte count and its text, so that neighbours can't run into each other."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[framed(v) for v in values]))


def _whole(nodes: Column) -> Column:
    """The levels, counted from 0, that a block folds if its group has so many nodes."""
    levels = F.sequence(F.lit(0), F.lit(BLOCK_BITS - 1))
    return F.filter(levels, lambda d: nodes > F.call_function("shiftleft", F.lit(1).cast("long"), d))


def _parents(level: Column) -> Column:
    pairs = F.sequence(F.lit(0), F.call_function("div", F.length(level) - 1, F.lit(2 * DIGEST)).cast("int"))
    return F.array_join(
        F.transform(pairs, lambda i: digest(F.substring(level, i * (2 * DIGEST) + 1, F.lit(2 * DIGEST)))), ""
    )


def _flanks(levels: Column, depths: Column, place: Column) -> Column:
    """Of a node at ``place`` of its block: what stands left and right of it, level by level."""

    def beside(d: Column) -> Column:
        level = F.get(levels, d)
        at = F.call_function("shiftright", place, d)
        odd = at.bitwiseAND(F.lit(1)) == 1
        near = F.when(odd, at - 1).otherwise(at + 1)
        sibling = F.substring(level, near * DIGEST + 1, F.lit(DIGEST))
        return F.struct(
            F.when(odd, sibling).otherwise("").alias("left"), F.when(odd, "").otherwise(sibling).alias("right")
        )

    return F.transform(depths, beside)


def _blocks(nodes: DataFrame) -> DataFrame:
    """(group, block, n, members, levels, hash) of each aligned block of nodes (group, pos, n, hash, row)."""
    size = 1 << BLOCK_BITS
    gathered = (
        nodes.withColumn("block", F.shiftright("pos", BLOCK_BITS))
        .withColumn("place", F.col("pos").bitwiseAND(size - 1).cast("int"))
        .groupBy("group", "block")
        .agg(
            F.max("n").alias("n"),
            F.array_sort(F.collect_list(F.struct("place", "hash", "row"))).alias("members"),
        )
        .withColumn("depths", _whole(F.col("n")))
        .withColumn("base", F.array_join("members.hash", ""))
    )
    levels = F.aggregate(
        "depths",
        F.array("base"),
        lambda levels, _: F.array_append(levels, _parents(F.element_at(levels, -1))),
    )
    return (
        gathered.withColumn("levels", levels)
        .withColumn("hash", F.element_at("levels", -1))
        .drop("base")
    )


def _tree(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The tiers of blocks over all groups at once; no group has more than ``largest`` nodes."""
    tiers = []
    while True:
        tiers.append(durable(_blocks(nodes), "manifest"))
        if largest <= 1 << BLOCK_BITS:
            return tiers
        largest = -(-largest >> BLOCK_BITS)
        nodes = tiers[-1].select(
            "group",
            F.col("block").alias("pos"),
            F.shiftright(F.col("n") + ((1 << BLOCK_BITS) - 1), BLOCK_BITS).alias("n"),
            "hash",
            F.lit(None).cast("int").alias("row"),
        )


def _roots(tiers: list[DataFrame]) -> DataFrame:
    return tiers[-1].select("group", "hash")


def _paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """(group, hash, row, path, more) of all nodes; ``above`` has (group, path, more) of each root."""
    known = above.withColumn("block", F.lit(0).cast("long"))
    for i, tier in enumerate(reversed(tiers)):
        members = F.transform(
            "members",
            lambda m: F.struct(
                m["place"].alias("place"),
                m["hash"].alias("hash"),
                m["row"].alias("row"),
                _flanks(F.col("levels"), F.col("depths"), m["place"]).alias("flanks"),
            ),
        )
        nodes = (
            tier.join(known, ["group", "block"])
            .select("group", "block", "path", "more", F.explode(members).alias("node"))
            .select(
                "group",
                (F.shiftleft("block", BLOCK_BITS) + F.col("node.place")).alias("block"),
                F.col("node.hash").alias("hash"),
                F.col("node.row").alias("row"),
                F.concat("node.flanks", "path").alias("path"),
                "more",
            )
        )
        known = nodes.select("group", "block", "path", "more") if i < len(tiers) - 1 else nodes
    return known.drop("block")


def manifest(leaves: DataFrame, group: str, id_col: str, leaf_col: str, *more: str) -> DataFrame:
    """(group, id, leaf, more, subroot, root, path) of each row of a table of leaves.

    ``path`` lists what stands left and right of the node on each level, leaf
    first, root last: see :func:`proof` and :func:`folded`.
    """
    named = leaves.select(
        F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(leaf_col).alias("leaf"), F.struct(*more, F.lit(0)).alias("more")
    )
    # Equal rows are told apart by their place in the written table, so that even
    # a large group of them splits.
    written = durable(named, "leaves").withColumn("tie", F.monotonically_increasing_id())
    numbered = dense_index(written, [F.asc_nulls_first("g"), F.asc_nulls_first("id"), "leaf", "tie"], "at")
    groups = durable(
        numbered.groupBy("g").agg((F.min("at") - 1).alias("group"), F.count(F.lit(1)).alias("n")), "groups"
    )
    largest = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    nodes = numbered.join(groups, numbered["g"].eqNullSafe(groups["g"])).select(
        "group",
        (F.col("at") - 1 - F.col("group")).alias("pos"),
        "n",
        F.col("leaf").alias("hash"),
        F.struct(numbered["g"], "id", "more").alias("row"),
    )
    tiers = _tree(nodes, largest[0] or 0)

    # The subroots: one group of as many nodes as there are groups.
    subroots = dense_index(_roots(tiers), ["group"], "at").select(
        F.lit(0).cast("long").alias("group"),
        (F.col("at") - 1).alias("pos"),
        F.lit(largest[1]).cast("long").alias("n"),
        "hash",
        F.col("group").alias("row"),
    )
    top = _tree(subroots, largest[1])
    root = _roots(top).select(
        "group", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("more")
    )
    above = _paths(top, root).select(
        F.col("row").alias("group"), "path", F.struct(F.col("hash").alias("subroot"), F.col("more").alias("root")).alias("more")
    )
    return _paths(tiers, above).select(
        F.col("row.g").alias(group),
        F.col("row.id").alias(id_col),
        F.col("hash").alias(leaf_col),
        *[F.col("row.more")[name].alias(name) for name in more],
        "more.subroot",
        "more.root",
        "path",
    )


def proof(path: Column) -> Column:
    """The digests that lead from a leaf to the root, end to end."""
    return F.array_join(F.transform(path, lambda f: F.concat(f["left"], f["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path make."""
    return F.aggregate(path, leaf, lambda node, f: digest(F.concat(f["left"], node, f["right"])))


def tampered(docs: DataFrame) -> DataFrame:
    """Leaves of ``documents``, and for one id in seven the leaf of a row whose n_chars is one more."""
    fields = [F.col(c) for c in FIELDS]
    more = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return docs.select("doc_id", "lang", leaf(fields).alias("leaf"), F.when(hit, leaf(more)).alias("tampered"))


def audit(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document."""
    found = manifest(tampered(docs), "lang", "doc_id", "leaf", "tampered")
    again = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", digest(proof(F.col("path"))).alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
