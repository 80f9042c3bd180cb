"""Quality by importance resampling: hashed n-gram models of target and raw text.

Two bag models over hashed buckets of one and two tokens are compared: one of
the raw corpus, counted over all documents, and one of the target, counted over
labelled good documents. A document's log importance weight is the sum over its
n-grams of the log ratio of target to raw counts. Counts are smoothed with
``PRIOR`` n-grams a bucket, so rare n-grams say little.

Documents are drawn without replacement by Gumbel top-k: a standard Gumbel
number, made from a hash of the id, is added to the weight, and the k largest
sums stay. k is the number of documents that the weights call good: a cut on
the weight is set on labelled documents of both kinds that took no part in the
target model, where the shares of good ones lost and bad ones kept are least
together, and at most ``LOST`` of the good ones are lost.

Only the labelled sample is bounded (``LABELLED`` documents a label, those of the
smallest hashes); it is small enough to be broadcast, so texts aren't shuffled.
Models have ``BUCKETS`` numbers, whatever the corpus; each task adds up its own.

Defined results: a null or empty text has no n-grams and weight 0, a text of any
length is a block of its own at most; rows are drawn one by one, whatever other
rows share their id, and rows with a null id get the noise of an empty one; rows
that tie with the last one drawn are drawn, too, so copies of a row are drawn
alike; without held-out labels of either kind, and from an empty table, every
document stays. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.arrow_text import Block, blocks, map_blocks, narrow_batches
from siltstone.llm.shingles import mix, range_hashes
from siltstone.operators.keys import dense_index
from siltstone.runtime import durable

_U = np.uint64
_KIND = np.full(256, 2, np.uint8)  # other signs
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
for _part in (slice(0x30, 0x3A), slice(0x41, 0x5B), slice(0x61, 0x7B), slice(0x80, 0x100)):
    _KIND[_part] = 1

BUCKETS = 1 << 15
PRIOR = 50.0
LABELLED = 10_000
#: Share of the labelled good documents that the cut may lose.
LOST = 0.01


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all n-grams: runs of letters and digits, runs of signs, and pairs.

    A token right after itself makes a pair that doesn't depend on the token.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _KIND[data]
    new = np.empty(len(data), bool)
    new[0] = True
    new[1:] = kind[1:] != kind[:-1]
    new[offsets[(offsets > 0) & (offsets < len(data))]] = True
    bounds = np.flatnonzero(new)
    ends = np.append(bounds[1:], len(data))
    tokens = kind[bounds] > 0
    starts, ends = bounds[tokens], ends[tokens]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    codes = range_hashes(data, starts, ends)
    paired = rows[1:] == rows[:-1]
    left, right = codes[:-1][paired], codes[1:][paired]
    pairs = mix(left * _U(0xD1342543DE82EF95) + right)
    pairs[left == right] = _U(0)
    return (
        np.concatenate([rows, rows[1:][paired]]),
        (np.concatenate([codes, pairs]) & _U(BUCKETS - 1)).astype(np.int64),
    )


def counts(docs: DataFrame, flag: str, text: str = "text") -> DataFrame:
    """(bucket, raw, target): n-grams of all rows, and of those where ``flag`` is true."""
    narrow_batches(docs.sparkSession)

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for block in blocks(batches, text):
            rows, found = ngrams(block.data, block.offsets)
            raw += np.bincount(found, minlength=BUCKETS)
            chosen = np.array(block.rows.column(1).to_pylist(), bool)
            target += np.bincount(found[chosen[rows]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.record_batch(
            [pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])],
            ["bucket", "raw", "target"],
        )

    parts = docs.select(text, flag).mapInArrow(run, "bucket int, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket, and the weight under which documents count as bad."""

    ratios: np.ndarray
    cut: float


def log_ratios(counted: DataFrame) -> np.ndarray:
    """The model's numbers; there are at most ``BUCKETS`` rows to fetch."""
    table = counted.toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table.bucket] = table.raw
    target[table.bucket] = table.target
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + PRIOR) / (expected + PRIOR))


def weights(docs: DataFrame, ratios: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with the weight of each row in front of its columns, which go by number: (_w, _0, _1, ...)."""
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    names = [f"_{i}" for i in range(len(docs.columns))]

    def run(block: Block) -> pa.RecordBatch:
        rows, found = ngrams(block.data, block.offsets)
        # Without any n-gram the sums would be whole numbers.
        sums = np.bincount(rows, weights=model.value[found], minlength=len(block)).astype(np.float64)
        return pa.record_batch([pa.array(sums), *block.rows.columns], ["_w", *names])

    fields = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)]
    schema = T.StructType([T.StructField("_w", T.DoubleType()), *fields])
    return map_blocks(docs.toDF(*names), run, schema, names[docs.columns.index(text)])


def labelled_sample(labels: DataFrame, id_col: str = "doc_id", quality: str = "quality") -> DataFrame:
    """(id, good, fits): at most ``LABELLED`` labels of each kind, half of them to fit."""
    order = F.xxhash64(id_col)
    known = labels.where(F.col(quality).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(id_col).agg((F.min(quality) > 0).alias("good"))
    kinds = [
        known.where(F.col("good") if good else ~F.col("good")).orderBy(order, id_col).limit(LABELLED)
        for good in (True, False)
    ]
    return kinds[0].union(kinds[1]).withColumn("fits", F.pmod(order, F.lit(2)) == 0)


def gumbel(id_col: Column) -> Column:
    """Standard Gumbel noise that depends on the id alone."""
    code = F.pmod(F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("")), F.lit("gumbel")), F.lit(1 << 52))
    uniform = (code.cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight from which documents count as good: least shares of good below and bad above.

    Cuts lie halfway between neighbouring weights. Of equal ones the lowest is
    taken, and none that loses more than ``LOST`` of the good ones.
    """
    if not len(good) or not len(bad):
        return float("-inf")
    values = np.unique(np.concatenate([good, bad]))
    cuts = np.append(-np.inf, (values[1:] + values[:-1]) / 2)
    lost = np.searchsorted(np.sort(good), cuts) / len(good)
    kept = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    return float(cuts[np.argmin(np.where(lost <= LOST, lost + kept, np.inf))])


def model(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame, float]:
    """The log ratios, the stored (doc_id, log_weight) of all rows, and the cut."""
    sample = durable(labelled_sample(labels), "labelled")
    target = sample.where(F.col("good") & F.col("fits")).select("doc_id", F.lit(True).alias("_target"))
    marked = docs.select("doc_id", "text").join(F.broadcast(target), "doc_id", "left")
    ratios = log_ratios(counts(marked.select("text", F.coalesce("_target", F.lit(False)).alias("_target")), "_target"))
    weighed = weights(docs.select("doc_id", "text"), ratios)
    found = durable(weighed.select(F.col("_0").alias("doc_id"), F.col("_w").alias("log_weight")), "weights")
    # At most 2 * LABELLED rows: an id counts once, with its lowest weight.
    held = (
        found.join(F.broadcast(sample.where(~F.col("fits"))), "doc_id")
        .groupBy("doc_id", "good")
        .agg(F.min("log_weight").alias("log_weight"))
        .toPandas()
    )
    good = held.good.astype(bool)
    return ratios, found, best_cut(held.log_weight[good].to_numpy(), held.log_weight[~good].to_numpy())


def key(log_weight: Column, id_col: Column) -> Column:
    return log_weight + gumbel(id_col)


def least_key(found: DataFrame, cut: float) -> float:
    """The k-th largest key, where k rows reach the cut; all keys if that is as many as there are."""
    k = found.where(F.col("log_weight") >= cut).count()
    if not k:
        return float("inf")
    keyed = found.select(key(F.col("log_weight"), F.col("doc_id")).alias("key"), "doc_id")
    # Rows of one key are told apart, so that a large group of copies splits.
    order = [F.col("key").desc(), "doc_id", F.monotonically_increasing_id()]
    return dense_index(keyed, order, "_rank").where(F.col("_rank") == k).first()["key"]


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, key) of the rows drawn."""
    _, found, cut = model(docs, labels)
    least = least_key(found, cut)
    return found.withColumn("key", key(F.col("log_weight"), F.col("doc_id"))).where(F.col("key") >= least)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that weren't drawn."""
    ratios, found, cut = model(docs, labels)
    least = least_key(found, cut)
    weighed = weights(docs, ratios)
    id_col = F.col(f"_{docs.columns.index('doc_id')}")
    return weighed.where(key(F.col("_w"), id_col) >= least).drop("_w").toDF(*docs.columns)
