"""The beam in a shard follows how many of the nearest it can be expected to hold."""

import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import hnsw


def test_beams_shrink_with_the_number_of_shards():
    beams = [hnsw.beam_of(800, 20, shards) for shards in (1, 2, 4, 8, 64, 4096)]
    assert beams[0] == 800 and beams == sorted(beams, reverse=True)
    assert beams[3] <= 400 and beams[-1] >= 21


def test_recall_over_many_shards(spark):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(2400, 16))
    assert hnsw.beam_of(200, 20, 8) < 100
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(table, F.col("vec_id") % 20 == 0, beam=200, shard_rows=300).collect():
        got.setdefault(r.query_id, []).append(r.score)
    hits = 0
    for i in range(0, 2400, 20):
        scores = np.delete(x @ x[i], i)
        hits += sum(s >= np.sort(scores)[-20] - 1e-9 for s in got[i])
    assert hits / (20 * 120) >= 0.95
