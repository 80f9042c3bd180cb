"""Approximate nearest neighbours: a navigable small-world graph for each shard.

Equal vectors are one node: copies would fill each other's links and the beam.
A node keeps its k + 1 smallest ids, as no list has room for more besides the
query's own. Nodes are dealt to shards of bounded size by a hash. Each shard's graph is a
hierarchy: every node is in layer 0, one in ``WIDTH`` in layer 1, and so on.
A layer is a flat array of neighbours, -1 where there is none. Nodes enter in
batches; a batch searches the graph so far for all its nodes at once, keeps
neighbours that are nearer to the node than to each other, and links back.
Shards are rows of a written table (ids, vectors, layers as bytes), so a lost
executor loads a shard again instead of building it.

Nearness is the largest inner product. For the graph, a vector gets one more
component that lifts all vectors of a shard to the same length; then the
nearest ones are those with the largest product, also if lengths differ.
Every block of queries is searched in every shard, the products of what is
found are taken again in double precision on the original vectors, nodes are
spelled out as their ids, and the shards' lists are merged.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; only vectors of the same
length are compared; rows that share a query's id are its own; repeated queries
count once, repeated candidates each; ties go to the smaller id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shingles import stream
from siltstone.llm.vectors import ID_KINDS, id_kind, matrix, packed
from siltstone.runtime import durable

SHARD = 8192
QUERY_BLOCK = 2048
#: Links of a node in upper layers; layer 0 has twice as many.
WIDTH = 24
#: Beam of a search while building, and for queries.
EF_BUILD, EF_SEARCH = 200, 800
#: Nodes that enter at once, and beam entries expanded at once.
BATCH, AT_ONCE = 128, 4


@dataclass
class Graph:
    vectors: np.ndarray
    layers: list[np.ndarray]
    entry: int


def lifted(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.sqrt((x**2).sum(1).max())
    rest = np.sqrt(np.maximum(0.0, 1 - (x**2).sum(1)))
    return np.ascontiguousarray(np.column_stack([x, rest]).astype(np.float32))


def search_layer(x, links, queries, entries, beam, seen):
    """(ids, similarities) of the ``beam`` nearest found for each query, nearest first.

    ``entries`` are node ids of each query, ``seen`` a matrix of queries by nodes.
    """
    n, width = len(queries), links.shape[1]
    every = np.arange(n)
    size = max(beam, entries.shape[1])
    ids = np.full((n, size), -1, np.int64)
    sims = np.full((n, size), -np.inf, np.float32)
    ids[:, : entries.shape[1]] = entries
    sims[:, : entries.shape[1]] = np.einsum("bed,bd->be", x[entries], queries)
    seen[every[:, None], entries] = True
    open_ = ids >= 0
    live = every
    while len(live):
        waiting = np.where(open_[live], sims[live], -np.inf)
        step = min(AT_ONCE, size)
        pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step] if step < size else np.tile(np.arange(size), (len(live), 1))
        good = np.take_along_axis(waiting, pick, 1) > -np.inf
        some = good.any(1)
        live, pick, good = live[some], pick[some], good[some]
        if not len(live):
            break
        picked = np.where(good, ids[live[:, None], pick], -1)
        open_[live[:, None], pick] = False
        found = np.full((len(live), step * width), -1, np.int64)
        for p in range(step):
            next_ = np.where(picked[:, p : p + 1] >= 0, links[picked[:, p]], -1)
            fresh = (next_ >= 0) & ~seen[live[:, None], next_]
            rows, cols = np.nonzero(fresh)
            seen[live[rows], next_[rows, cols]] = True
            found[:, p * width : (p + 1) * width] = np.where(fresh, next_, -1)
        near = np.full(found.shape, -np.inf, np.float32)
        rows, cols = np.nonzero(found >= 0)
        near[rows, cols] = np.einsum("id,id->i", x[found[rows, cols]], queries[live[rows]])
        all_ids = np.concatenate([ids[live], found], 1)
        all_sims = np.concatenate([sims[live], near], 1)
        all_open = np.concatenate([open_[live], found >= 0], 1)
        top = np.argpartition(-all_sims, size - 1, axis=1)[:, :size]
        ids[live] = np.take_along_axis(all_ids, top, 1)
        sims[live] = np.take_along_axis(all_sims, top, 1)
        open_[live] = np.take_along_axis(all_open, top, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
    """Up to ``width`` of each row's candidates (nearest first, -1 for none).

    A candidate is taken if no candidate taken before is nearer to it than the
    row's own node; places left go to the nearest of the others.
    """
    n, m = ids.shape
    v = x[ids]
    between = np.matmul(v, v.transpose(0, 2, 1))
    taken = np.zeros((n, m), bool)
    for j in range(m):
        rival = np.where(taken[:, :j], between[:, j, :j], -np.inf).max(1) if j else np.full(n, -np.inf)
        taken[:, j] = (ids[:, j] >= 0) & (rival < sims[:, j]) & (taken[:, :j].sum(1) < width)
    # Taken ones first, then the rest by nearness.
    rank = np.where(ids < 0, 3 * m, np.where(taken, 0, m)) + np.arange(m)
    order = np.argsort(rank, axis=1)[:, :width]
    out = np.take_along_axis(ids, order, 1)
    if m < width:
        out = np.concatenate([out, np.full((n, width - m), -1, np.int64)], 1)
    return out


def _link_back(x: np.ndarray, links: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    rows, cols = np.nonzero(chosen >= 0)
    target, source = chosen[rows, cols], nodes[rows]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    unique, first, count = np.unique(target, return_index=True, return_counts=True)
    extra = np.full((len(unique), count.max()), -1, np.int64)
    extra[np.repeat(np.arange(len(unique)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    width = links.shape[1]
    for at in range(0, len(unique), 1024):
        own, more = unique[at : at + 1024], extra[at : at + 1024]
        # Nodes of one batch may have chosen each other already.
        known = (links[own][:, :, None] == more[:, None, :]).any(1)
        ids = np.concatenate([links[own], np.where(known, -1, more)], 1)
        sims = np.where(ids >= 0, np.einsum("bed,bd->be", x[ids], x[own]), -np.inf).astype(np.float32)
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        full = (ids >= 0).sum(1) > width
        links[own[~full]] = ids[~full][:, :width]
        if full.any():
            links[own[full]] = diverse(x, ids[full], sims[full], width)


def build(vectors: np.ndarray) -> Graph:
    """The graph over the rows; ``vectors`` of any lengths, none of them zero."""
    x = lifted(vectors)
    n = len(x)
    uniform = (stream(17, n) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    level = np.minimum((-np.log(np.maximum(uniform, 1e-12)) / np.log(WIDTH)).astype(int), 8)
    level[0] = top = level.max()  # the entry is in every layer
    layers = [np.full((n, WIDTH * (2 if not i else 1)), -1, np.int64) for i in range(top + 1)]
    at = 1
    while at < n:
        nodes = np.arange(at, min(n, at + min(BATCH, max(1, at))))
        at = nodes[-1] + 1
        entries = np.zeros((len(nodes), 1), np.int64)
        inner = x[nodes] @ x[nodes].T
        for layer in range(top, -1, -1):
            inside = level[nodes] >= layer
            seen = np.zeros((len(nodes), n), bool)
            ids, sims = search_layer(
                x, layers[layer], x[nodes], entries, EF_BUILD if inside.any() else 1, seen
            )
            entries = ids[:, :1]
            if not inside.any():
                continue
            new = nodes[inside]
            # Nodes of the batch are candidates for each other, too.
            peers = np.where(np.eye(len(new), dtype=bool), -np.inf, inner[np.ix_(inside, inside)])
            ids = np.concatenate([ids[inside], np.tile(new, (len(new), 1))], 1)
            sims = np.concatenate([sims[inside], peers.astype(np.float32)], 1)
            ids = np.where(sims > -np.inf, ids, -1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :EF_BUILD]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            chosen = diverse(x, ids, sims, WIDTH)
            links = layers[layer]
            links[new, :WIDTH] = chosen
            _link_back(x, links, new, chosen)
    return Graph(x, layers, 0)


def search(graph: Graph, queries: np.ndarray, beam: int) -> np.ndarray:
    """Node ids of the ``beam`` nearest found for each query, -1 for none."""
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))[:, None]
    q = np.column_stack([queries / lengths, np.zeros(len(queries))]).astype(np.float32)
    out = []
    for at in range(0, len(q), BATCH):
        part = q[at : at + BATCH]
        entries = np.full((len(part), 1), graph.entry, np.int64)
        for layer in range(len(graph.layers) - 1, -1, -1):
            seen = np.zeros((len(part), len(graph.vectors)), bool)
            ids, _ = search_layer(graph.vectors, graph.layers[layer], part, entries, beam if not layer else 4, seen)
            entries = ids if layer == 0 else np.where(ids >= 0, ids, ids[:, :1])
        out.append(ids[:, :beam])
    return np.concatenate(out)


def distinct(table: DataFrame, k: int) -> DataFrame:
    """(dim, vec, ids, copies): each vector's k + 1 smallest ids, ascending, and how many rows have them."""
    rows = table.groupBy("dim", "vec", "vec_id").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.row_number().over(Window.partitionBy("dim", "vec").orderBy("vec_id"))
    return (
        rows.withColumn("_place", place)
        .where(F.col("_place") <= k + 1)
        .groupBy("dim", "vec")
        .agg(F.array_sort(F.collect_list(F.struct("vec_id", F.least("_rows", F.lit(k)).alias("copies")))).alias("_own"))
        .select("dim", "vec", F.col("_own.vec_id").alias("ids"), F.col("_own.copies").alias("copies"))
    )


def index(table: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """One row for each shard of ``distinct`` vectors: ids and copies end to end, sizes, vectors and layers."""
    sizes = durable(table.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("_shards")), "sizes")
    # A task for each shard: they are few bytes and much work, so sizes must not merge them.
    tasks = max(1, sizes.agg(F.sum("_shards")).first()[0] or 0)
    dealt = (
        table.withColumn("_row", F.monotonically_increasing_id())
        .join(sizes, "dim")
        .withColumn("shard", F.pmod(F.xxhash64("_row"), F.col("_shards")))
        .select("dim", "shard", F.col("ids")[0].alias("_least"), "ids", "copies", "vec")
    )

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_least")
        graph = build(matrix(rows["vec"], np.float64))
        layers = [layer.astype(np.int32).tobytes() for layer in graph.layers]
        return pa.table(
            {
                "dim": rows["dim"][:1],
                "shard": rows["shard"][:1],
                "ids": [pc.list_flatten(rows["ids"]).to_numpy().tobytes()],
                "copies": [pc.list_flatten(rows["copies"]).to_numpy().tobytes()],
                "sizes": [pc.list_value_length(rows["ids"]).to_numpy().tobytes()],
                "vectors": [b"".join(rows["vec"].to_pylist())],
                "layers": [layers],
            },
            schema=pa.schema(
                [
                    ("dim", pa.int32()),
                    ("shard", pa.int64()),
                    ("ids", pa.binary()),
                    ("copies", pa.binary()),
                    ("sizes", pa.binary()),
                    ("vectors", pa.binary()),
                    ("layers", pa.list_(pa.binary())),
                ]
            ),
        )

    return dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(
        run,
        "dim int, shard long, ids binary, copies binary, sizes binary, vectors binary, layers array<binary>",
    )


def spelled_out(found, scores, ids, copies, sizes, q_ids, k):
    """(query row, id, score): each query's k best rows among the nodes found, -1 for none.

    Ids of a query are its own and don't count; ties go to the smaller id.
    """
    first = np.cumsum(sizes) - sizes
    r, c = np.nonzero(found >= 0)
    nodes, scores = found[r, c], scores[r, c]
    many = sizes[nodes]
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    place = np.repeat(first[nodes], many) + inside
    r, scores = np.repeat(r, many), np.repeat(scores, many)
    other = ids[place] != q_ids[r]
    r, scores, place = r[other], scores[other], place[other]
    order = np.lexsort((ids[place], -scores, r))
    r, scores, place = r[order], scores[order], place[order]
    for repeat in (False, True):
        if repeat:
            r, scores, place = (np.repeat(a, copies[place]) for a in (r, scores, place))
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        r, scores, place = r[rank < k], scores[rank < k], place[rank < k]
    return r, ids[place], scores


def beam_of(beam: int, k: int, shards: int) -> int:
    """The beam in one of ``shards`` shards that ``beam`` in a single one amounts to.

    Nodes are dealt by a hash, so a shard holds k / shards of a query's k nearest,
    give or take a few roots of that, and the beam keeps its width for each of those.
    """
    share = k / shards
    return max(k + 1, min(beam, math.ceil(beam / k * (share + 3 * math.sqrt(share) + 1))))


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    beam: int = EF_SEARCH,
    shard_rows: int = SHARD,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found."""
    named = df.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("embedding"))
    kind = id_kind(named, "vec_id")
    table = durable(packed(named, lambda x: x + 0.0, zero=False), "vectors")  # -0.0 is 0.0
    shards = durable(index(durable(distinct(table, k), "distinct"), shard_rows), "shards")
    asked = durable(table.where(is_query).dropDuplicates(["vec_id", "vec"]), "queries")
    blocks = F.lit(max(1, -(-asked.count() // QUERY_BLOCK)))
    queries = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", "vec"), blocks).cast("long"))
    together = F.count(F.lit(1)).over(Window.partitionBy("dim"))
    places = shards.select("dim", (F.col("shard") + 0).alias("shard"), together.alias("_of"))
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1))
    out = pa.schema([("query_id", ID_KINDS[kind]), ("vec_id", ID_KINDS[kind]), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        shard = right.to_pylist()[0]
        ids = np.frombuffer(shard["ids"], np.int64 if kind == "bigint" else np.int32)
        copies, sizes = np.frombuffer(shard["copies"], np.int64), np.frombuffer(shard["sizes"], np.int32)
        vectors = np.frombuffer(shard["vectors"], np.float64).reshape(len(sizes), -1)
        layers = [
            np.frombuffer(layer, np.int32).reshape(len(sizes), -1).astype(np.int64) for layer in shard["layers"]
        ]
        q, q_ids = matrix(left["vec"], np.float64), left["vec_id"].to_numpy()
        found = search(Graph(lifted(vectors), layers, 0), q, beam_of(beam, k, left["_of"][0].as_py()))
        parts = []
        for at in range(0, len(q), BATCH):
            some = slice(at, at + BATCH)
            scores = np.einsum("bkd,bd->bk", vectors[found[some]], q[some])
            parts.append(spelled_out(found[some], scores, ids, copies, sizes, q_ids[some], k))
        owner = np.concatenate([q_ids[at * BATCH :][r] for at, (r, _, _) in enumerate(parts)])
        _, near, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.table({"query_id": owner, "vec_id": near, "score": scores}, schema=out)

    keys = ["dim", "shard", "qb"]
    merged = (
        queries.join(places, "dim")
        .groupBy(*keys)
        .cogroup(shards.withColumn("qb", every_block).groupBy(*keys))
        .applyInArrow(run, f"query_id {kind}, vec_id {kind}, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
