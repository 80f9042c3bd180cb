"""Tables of a build that don't read each other are written at the same time."""

import threading

import pytest
from helpers import RULES
from pyspark.sql import functions as F
from test_warehouse import RECORDS, rules, staged

from siltstone.operators import constraints as c
from siltstone.operators.keys import dense_key, ordered_key
from siltstone.plans import layers, warehouse
from siltstone.sources.tables import Run, Store


def test_independent_tables_are_written_together(spark, tmp_path, monkeypatch):
    """The staged tables wait for each other here, so one after another would time out."""
    together, written, shown = threading.Barrier(3, timeout=60), [], []
    refresh, create_view = Run.refresh, Store.create_view

    def meeting(self, layer, table, *more, **named):
        if layer == "bronze":
            together.wait()
        out = refresh(self, layer, table, *more, **named)
        written.append((layer, table))
        return out

    def seen(self, layer, view, *more, **named):
        shown.append((layer, view))
        return create_view(self, layer, view, *more, **named)

    monkeypatch.setattr(Run, "refresh", meeting)
    monkeypatch.setattr(Store, "create_view", seen)
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), Store(spark, str(tmp_path), prefix="par_"))
    assert sorted(written) == sorted(set(written)) and len(written) == 13
    assert built.gold.fact_sales.count() == 3
    # The facts are published last: what a reader opens is there as a whole.
    published = [at for at in shown if at[1] in (*layers.Bronze.TABLES, *layers.Silver.TABLES, *layers.Gold.TABLES)]
    tables = [at for at in published if at != ("silver", "data_quality_log")]
    assert tables[-1] == ("gold", "fact_sales")


def test_the_first_error_stops_a_build(spark):
    def broken():
        raise ValueError("no sales")

    bronze = layers.Bronze(stg_skins=lambda: spark.range(1), stg_players=lambda: spark.range(1), stg_sales=broken)
    silver = layers.silver(spark, bronze, RULES)
    with pytest.raises(ValueError, match="no sales"):
        layers.settle_all(spark, bronze, silver)


def test_blocks_of_keys_are_small(spark):
    """A million ids are several blocks, each the work of one task."""
    ids = spark.range(0, 1 << 20, 8)
    for numbered in (dense_key(ids, "id", "k"), ordered_key(ids.select(F.col("id").cast("decimal(18,2)")), "id", "k")):
        assert numbered.agg(F.max("k")).first()[0] == 1 << 17
        assert numbered.where(F.col("id") != (F.col("k") - 1) * 8).count() == 0
    blocks = dense_key(ids, "id", "k").groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert blocks.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_kept_rows_need_no_names(spark):
    """Names are made for rejected rows only; what is kept is told by plain conditions."""
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, s string")
    judged = c.enforce(df, [*c.not_null("n", "s"), c.Check("small", F.col("n") < 3)], "drop")
    plan = judged.kept._jdf.queryExecution().optimizedPlan().toString()
    assert "array(" not in plan
    assert [tuple(r) for r in judged.kept.collect()] == [(1, "a")]
    assert sorted((r.n or 0, r.violations) for r in judged.rejected.collect()) == [
        (0, ["not_null_n"]),
        (3, ["not_null_s", "small"]),
    ]
