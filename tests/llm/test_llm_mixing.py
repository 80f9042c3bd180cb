"""The mix that op7 returns is the one in training order."""

import random
from collections import Counter
from pathlib import Path

import pytest

from siltstone.llm import mixing, queries

TILTS = (-0.5, 0.0, 0.5)


def documents(rng):
    rows = [(i, "w " * rng.randint(0, 30), f"s{i % 4}" if i % 9 else None) for i in range(90)]
    return rows + [(5, "w w w ", "s9")] * 3 + [(None, "w w ", "s9"), (7, None, "s9"), (7, None, "s9")]


def test_schedule_follows_the_curriculum(spark):
    """Each source's words come as its weight, a line over training, has them come."""
    rows = documents(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = mixing.schedule(docs).collect()
    assert [c.position for c in copies] == sorted(c.position for c in copies)
    names = sorted({r[2] for r in rows if r[2]}) + [None]
    total = Counter()
    for c in copies:
        total[c.source] += c.words
    tilt = {name: TILTS[i % 3] for i, name in enumerate(names)}
    met = Counter()
    for c in copies:
        # The time at which all sources together have come this far, by bisection.
        low, high = 0.0, 1.0
        for _ in range(60):
            t = (low + high) / 2
            reached = sum(total[n] * (t + tilt[n] * (t * t - t)) for n in names)
            low, high = (t, high) if reached < c.position else (low, t)
        a = tilt[c.source]
        assert met[c.source] == pytest.approx(total[c.source] * (low + a * (low * low - low)), abs=1e-3)
        met[c.source] += c.words


def test_taken_comes_from_the_training_order(spark):
    """Documents give what their copies in the schedule give, at the places it says."""
    rows = documents(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    assert len(got) == len(rows)
    words, places = Counter(), {}
    for c in mixing.schedule(docs).collect():
        words[c.doc_id] += c.words
        places.setdefault(c.doc_id, []).append(c.position)
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.taken
        assert (r.taken == 0) == (r.first_at is None) == (r.last_at is None)
    assert +taken == words
    for doc_id, positions in places.items():
        mine = [r for r in got if r.doc_id == doc_id and r.taken]
        assert min(positions) == min(r.first_at for r in mine) and max(positions) == max(r.last_at for r in mine)


def test_op7_sorts_its_mix(spark, tmp_path):
    """The query puts the copies in order and writes them; it keeps the columns of its contract."""
    docs = spark.createDataFrame(documents(random.Random(6)), "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(scratch.glob("training-*"))
    out = queries.op7_mixing(spark, str(tmp_path))
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    (written,) = set(scratch.glob("training-*")) - before
    ordered = spark.read.parquet(str(written))
    assert ordered.agg({"_part": "sum"}).first()[0] == out.agg({"taken": "sum"}).first()[0]
