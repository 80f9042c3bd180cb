"""Exact top-k by inner product: norm-bucketed retrieval.

Candidates are grouped by length: a bucket holds vectors whose lengths are
within a factor, cut into blocks of bounded size. A first pass over the longest
vectors gives each query a lower bound of its k-th score. With the bound, the
query's length and the block's largest length, a block has a local threshold:
the cosine that a candidate needs there. Above 1 nothing in the block can enter.
For a high threshold, coordinates prune: a candidate with that cosine must lie
near the query in the query's largest coordinates. For a low one, lengths prune:
only a block's longer vectors can reach the bound. What is left is verified by
whole-number products, and each query's k best of all blocks are merged.

Queries are cut into blocks too; a task gets one block of each. Queries meet all
candidates in blocks, as asked for; no group grows with the table.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows with a null id; only vectors of the same
length are compared; rows that share a query's id are its own; repeated queries
count once, repeated candidates each; ties go to the smaller id. Scores are
exact whole numbers of any size on the way; only a score among a query's best
that is no 64-bit number stops the query, as does a component whose scaled value
is no double (from 2.8e306). Ids are 32 or 64 bit numbers, others are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.vectors import ID_KINDS, best, id_kind, matrix, packed
from siltstone.runtime import durable

BLOCK = 4096
QUERY_BLOCK = 1024
#: Lengths within a bucket differ by this factor at most.
FACTOR = 0.9
#: Cosine from which coordinates prune, and how many of them.
COORDINATES_FROM, COORDINATES = 0.8, 4
#: Fixed value: the first number that is no signed 64-bit one.
TOO_LONG = 1 << 63
#: What doubles compare in place of even larger scores.
FAR = 10**300


def whole_numbers(scale: float):
    """Scaled and rounded down; a double holds the floor of a double exactly."""

    def convert(x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            scaled = np.floor(scale * x) + 0.0  # -0.0 is 0.0
        if not np.isfinite(scaled).all():
            raise ValueError("a scaled component is beyond the range of doubles")
        return scaled

    return convert


def _norm(v: np.ndarray) -> float:
    """The length, scaled on the way so that squares don't overflow; at most the largest double."""
    largest = float(np.abs(v).max())
    length = largest * float(np.sqrt(((v / largest) ** 2).sum())) if largest else 0.0
    return min(length, float(np.finfo(np.float64).max))


def _lengths(df: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            norms = [_norm(np.frombuffer(v, np.float64)) for v in batch.column(2).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(norms, pa.float64())], [*batch.schema.names, "norm"])

    return df.mapInArrow(run, f"{df.schema.names[0]} {df.schema[0].dataType.simpleString()}, dim int, vec binary, norm double")


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: doubles or 64-bit numbers where every sum fits, else Python's."""
    if not len(queries) or not len(candidates):
        return np.zeros((len(queries), len(candidates)))
    bound = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if bound < 2.0**53:
        return queries @ candidates.T
    if bound < 2.0**62:
        return queries.astype(np.int64) @ candidates.T.astype(np.int64)
    # Mostly a few rows are large; the others are worked out as above.
    out = np.empty((len(queries), len(candidates)), object)
    large_q, large_c = (_larger(x, queries.shape[1]) for x in (queries, candidates))
    small = products_of_small(queries[~large_q], candidates[~large_c])
    out[np.ix_(~large_q, ~large_c)] = small
    for rows, columns in ((large_q, np.ones(len(candidates), bool)), (~large_q, large_c)):
        out[np.ix_(rows, columns)] = _integers(queries[rows]) @ _integers(candidates[columns]).T
    return out


def _larger(x: np.ndarray, dim: int) -> np.ndarray:
    return np.abs(x).max(1) >= np.sqrt(2.0**61 / dim)


def products_of_small(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    return (queries.astype(np.int64) @ candidates.T.astype(np.int64)).astype(object)


def _integers(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out[:] = [[int(v) for v in row] for row in x.tolist()] if x.size else out
    return out


def block_best(q_ids, q, q_norm, bound, c_ids, c, c_norm, k):
    """(query row, candidate row, score) of what a block can add to each query's k best.

    Candidates must be sorted by id, so that ties go to the smaller one.
    """
    reach = q_norm * (c_norm.max() if len(c_norm) else 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(reach > 0, bound / reach, np.where(bound > 0, np.inf, -np.inf))
    found = []
    slack = 1e-9
    strict = local > COORDINATES_FROM
    for i in np.flatnonzero(strict & (local <= 1 + slack)).tolist():
        keep = _by_coordinates(q[i] / q_norm[i], min(local[i], 1.0), c, c_norm)
        keep = keep[c_norm[keep] * q_norm[i] >= bound[i] * (1 - slack)]
        found.append(_verified(np.array([i]), keep, q_ids, q, c_ids, c, k))
    rest = np.flatnonzero(~strict)
    if len(rest):
        # The loosest query of the block decides how far down the lengths go.
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(q_norm[rest] > 0, bound[rest] / q_norm[rest], -np.inf).min()
        keep = np.flatnonzero(c_norm >= needed * (1 - slack)) if needed > 0 else np.arange(len(c))
        found.append(_verified(rest, keep, q_ids, q, c_ids, c, k))
    return found


def _by_coordinates(unit: np.ndarray, cosine: float, c: np.ndarray, c_norm: np.ndarray) -> np.ndarray:
    """Candidates whose direction is near ``unit`` in its largest coordinates."""
    keep = np.flatnonzero(c_norm > 0)
    for f in np.argsort(-np.abs(unit))[:COORDINATES].tolist():
        width = np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[f] ** 2)))
        at = c[keep, f] / c_norm[keep]
        keep = keep[np.abs(at - cosine * unit[f]) <= width + (1 - cosine) * abs(unit[f]) + 1e-9]
    return keep


def _verified(rows, keep, q_ids, q, c_ids, c, k):
    scores = products(q[rows], c[keep])
    own = q_ids[rows][:, None] == c_ids[keep][None, :]
    if scores.dtype == np.float64:
        scores = np.where(own, -np.inf, scores)
        r, j = best(scores, k)
        return rows[r], keep[j], scores[r, j].astype(np.int64)
    # Doubles pick what may be among the k best, exact numbers decide.
    near = np.where(own, -np.inf, np.clip(scores, -FAR, FAR).astype(np.float64))
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for r, i in enumerate(rows.tolist()):
        least = np.partition(near[r], -k)[-k] if near.shape[1] > k else -np.inf
        some = np.flatnonzero((near[r] >= least - abs(least) * 1e-12) & ~own[r])
        order = sorted((-int(scores[r, j]), c_ids[keep[j]], int(keep[j])) for j in some.tolist())[:k]
        for score, _, j in order:
            out[0].append(i), out[1].append(j), out[2].append(-score)
    return np.array(out[0], np.int64), np.array(out[1], np.int64), np.array(out[2], object)


def _as_long(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scores, those beyond 64 bits cut, and which way they are beyond."""
    if scores.dtype != object:
        return scores, np.zeros(len(scores), np.int8)
    beyond = np.array([(v >= TOO_LONG) - (v < -TOO_LONG) for v in scores], np.int8)
    return np.array([min(max(int(v), -TOO_LONG), TOO_LONG - 1) for v in scores], np.int64), beyond


def _meet(queries: DataFrame, candidates: DataFrame, keys: list[str], k: int, id_type: str) -> DataFrame:
    """Each query's k best of each block; both sides come by ``keys``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        right = right.sort_by("vec_id")
        q, c = matrix(left["vec"], np.float64), matrix(right["vec"], np.float64)
        q_ids, c_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        parts = block_best(
            q_ids, q, left["norm"].to_numpy(), left["bound"].to_numpy(), c_ids, c, right["norm"].to_numpy(), k
        )
        if not parts:
            return out.empty_table()
        r, j, s = (np.concatenate(x) for x in zip(*parts, strict=True))
        score, beyond = _as_long(s)
        return pa.table({"query_id": q_ids[r], "vec_id": c_ids[j], "score": score, "beyond": beyond}, schema=out)

    kind = ID_KINDS[id_type]
    out = pa.schema([("query_id", kind), ("vec_id", kind), ("score", pa.int64()), ("beyond", pa.int8())])
    return (
        queries.groupBy(*keys)
        .cogroup(candidates.groupBy(*keys))
        .applyInArrow(run, f"query_id {id_type}, vec_id {id_type}, score long, beyond byte")
    )


def _spread(parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts)


def top_k(
    df: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best by floor(scale * x) vectors."""
    named = df.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("embedding"))
    id_type = id_kind(named, "vec_id")
    table = durable(_lengths(packed(named, whole_numbers(scale))), "vectors")
    asked = table.where(is_query).dropDuplicates(["vec_id", "vec"])
    n_queries = F.lit(max(1, -(-asked.count() // QUERY_BLOCK)))
    queries = durable(asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", "vec"), n_queries)), "queries")

    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / float(-np.log(FACTOR)))).otherwise(-1)
    bucketed = table.withColumn("bucket", bucket)
    sizes = bucketed.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_parts"))
    blocks = durable(
        bucketed.withColumn("_row", F.monotonically_increasing_id())
        .join(sizes, ["dim", "bucket"])
        .withColumn("part", F.pmod(F.xxhash64("_row"), F.col("_parts")))
        .drop("_row", "_parts"),
        "blocks",
    )
    lengths = durable(
        blocks.groupBy("dim", "bucket", "part").agg(
            F.max("norm").alias("_longest"), F.count(F.lit(1)).alias("_rows")
        ),
        "lengths",
    )

    # The first pass: one block of the longest vectors that can fill a list.
    block = F.struct((F.col("_rows") > k).alias("_full"), "bucket", "part")
    seed = lengths.groupBy("dim").agg(F.max(block).alias("_seed")).select("dim", "_seed.bucket", "_seed.part")
    every_query_block = F.explode(F.sequence(F.lit(0).cast("bigint"), n_queries.cast("bigint") - 1))
    seeds = blocks.join(seed, ["dim", "bucket", "part"]).withColumn("qb", every_query_block)
    first = _meet(queries.withColumn("bound", F.lit(float("-inf"))), seeds, ["dim", "qb"], k, id_type)
    bounds = (
        first.groupBy("query_id")
        .agg(F.sort_array(F.collect_list(_comparable()), asc=False).alias("_scores"))
        .select("query_id", F.when(F.size("_scores") >= k, F.element_at("_scores", k)).cast("double").alias("bound"))
    )
    bounded = durable(
        queries.join(bounds, queries["vec_id"] == bounds["query_id"], "left")
        .select("vec_id", "dim", "vec", "norm", "qb", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")),
        "queries",
    )

    # A block of queries meets a block of candidates if one of its queries can.
    keys = ["dim", "bucket", "part", "qb"]
    reach = bounded.groupBy("dim", "qb").agg(
        F.min(F.when(F.col("norm") > 0, F.col("bound") / F.col("norm")).otherwise(F.lit(float("-inf")))).alias("_needed")
    )
    pairs = durable(
        lengths.join(reach, "dim").where(F.col("_longest") * (1 + 1e-9) >= F.col("_needed")).select(*keys), "pairs"
    )
    found = _meet(
        bounded.join(pairs, ["dim", "qb"]), blocks.join(pairs, ["dim", "bucket", "part"]), keys, k, id_type
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    whole = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score is no 64-bit number")))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", whole.cast("long").alias("score"))
    )


def _comparable() -> Column:
    return F.when(F.col("beyond") < 0, F.lit(float("-inf"))).otherwise(F.col("score").cast("double"))
