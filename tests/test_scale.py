"""What the plans have to look like for the work to spread.

Broadcasting is switched off or limited, and thresholds are made small, so that
small frames are planned as large ones would be.
"""

import re
from collections import Counter
from contextlib import contextmanager
from datetime import date

import pytest
from helpers import RULES, rows
from pyspark.sql import functions as F

from siltstone.operators import constraints as c
from siltstone.operators.calendar import calendar
from siltstone.operators.facts import clean_facts, load_facts
from siltstone.operators.keys import ordered_key
from siltstone.operators.profiles import with_share, with_share_written
from siltstone.operators.quality import quarantine, quarantine_from_staging, with_id_rows
from siltstone.plans import layers, reports, views
from siltstone.plans.layers import Gold
from siltstone.plans.warehouse import keyed_facts
from siltstone.sources.tables import Store


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in names:
            spark.conf.unset(k)


LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "20000",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "20000",
}
SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_sales(spark, n=120_000):
    """A third of the rows on one player and skin, a sixth without a player."""
    i = F.col("id")
    player = F.when(i % 3 == 0, 7).when(i % 6 == 1, None).otherwise(i % 5000)
    skin = F.when(i % 3 == 0, 11).otherwise(i % 3000)
    money = "decimal(18,2)"
    return spark.range(n).select(
        F.when(i % 3 == 0, 1).otherwise(i).cast(money).alias("transaction_id"),
        player.cast(money).alias("player_id"),
        skin.cast(money).alias("skin_id"),
        F.lit("2024-05-06").alias("purchase_date"),
        F.lit(10).cast(money).alias("price_rp"),
        F.lit(1).cast(money).alias("quantity"),
    )


def hot_dims(spark):
    valid = F.lit(True).alias("is_valid")
    players = spark.range(5000).select(
        F.col("id").alias("player_id"), (F.col("id") + 1).alias("player_key"), valid
    )
    skins = spark.range(3000).select(
        F.col("id").alias("skin_id"), (F.col("id") + 1).alias("skin_key"), F.lit(10).alias("price_rp"), valid
    )
    return players, skins


def test_hot_keys_are_split_in_lookups(spark):
    sales = hot_sales(spark).withColumns(
        {
            "transaction_id": F.col("transaction_id") + F.rand(1).cast("decimal(18,2)"),
            "price_rp": (F.rand(2) * 1e9).cast("decimal(18,2)"),
            "quantity": (F.rand(3) * 1e6).cast("decimal(18,2)"),
        }
    )
    with settings(spark, **SKEWED):
        fact = load_facts(sales, *hot_dims(spark))
        found = {r.missing: r.n for r in _per_missing(fact).collect()}
        assert found == {False: 100_000, True: 20_000}
        fact.collect()
        final = plan(fact).split("== Initial Plan ==")[0]
        # Both lookups split the partition that holds the hot key.
        assert final.count("skew=true") == 2, final


def _per_missing(fact):
    return fact.groupBy(F.col("player_key").isNull().alias("missing")).agg(F.count(F.lit(1)).alias("n"))


def test_quarantine_of_a_hot_transaction_is_linear(spark):
    """40,000 rows share one id: their product is counted, never spelled out."""
    sales = hot_sales(spark)
    fact = sales.select("transaction_id", F.lit(False).alias("is_valid"), F.lit("x").alias("dq_issues"))
    found = quarantine_from_staging(fact, sales)
    assert found.count() == 120_000
    counts = found.agg(F.sum("copies").alias("n")).first().n
    ones = 40_000 + 1  # every third row, and row 1 itself
    assert counts == ones * ones + (120_000 - ones)


def test_quarantine_of_unique_ids_joins_nothing_of_staging(spark, tmp_path):
    """A stored fact knows the ids that repeat; rows with other ids are only projected."""
    sales = hot_sales(spark, 6_000).withColumn("transaction_id", F.col("skin_id") * 0 + F.monotonically_increasing_id())
    fact = clean_facts(load_facts(sales, *hot_dims(spark)), calendar(spark, RULES.calendar_start, RULES.calendar_end))
    keyed_facts(fact).write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    found = quarantine(stored)
    assert set(found.inputFiles()) <= set(stored.inputFiles())
    assert found.count() == 1_000
    found.collect()
    final = plan(found).split("== Initial Plan ==")[0]
    # What joins at all are the rows of repeated ids: none of these.
    assert "Join" not in final or "id_rows#" in final
    assert stored.where("id_rows > 1").isEmpty() and stored.where("is_valid AND staged IS NOT NULL").isEmpty()


def test_quarantine_carried_is_that_of_staging(spark):
    """Also where a third of the rows share one id, and some ids repeat."""
    sales = hot_sales(spark, 3_000).withColumn(
        "transaction_id", F.when(F.col("skin_id") % 7 == 0, 5).otherwise(F.col("transaction_id")).cast("decimal(18,2)")
    )
    calendar_ = calendar(spark, RULES.calendar_start, RULES.calendar_end)
    fact = clean_facts(load_facts(sales, *hot_dims(spark)), calendar_)
    want = quarantine_from_staging(fact, sales)
    assert want.count() > 1_000
    for carried in (with_id_rows(fact, sales), keyed_facts(fact)):
        assert rows(quarantine(carried), *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("sorted_rows", [1 << 22, 10])
def test_ordered_keys(spark, sorted_rows):
    """With and without slices: 1..n, ids ascending, the same on a rerun; a third of the rows are equal."""
    i = F.col("id")
    df = spark.range(9_000).select(
        F.when(i % 3 == 0, 2_000_000).otherwise(i * 977 % 5_000_000 - 1_000_000).alias("t"),
        F.when(i % 3 == 0, 0).otherwise(i % 5).alias("v"),
    )
    runs = [
        [(r.k, r.t, r.v, r.same) for r in ordered_key(df.repartition(n, "v"), "t", "k", "same", None, sorted_rows).orderBy("k").collect()]
        for n in (3, 5)
    ]
    assert runs[0] == runs[1] and [r[0] for r in runs[0]] == list(range(1, 9_001))
    blocks = [r[1] >> 20 for r in runs[0]]
    assert blocks == sorted(blocks)
    if sorted_rows > 9_000:
        assert [r[1:3] for r in runs[0]] == sorted(r[1:3] for r in runs[0])
    counts = Counter(r[1] for r in runs[0])
    assert counts[2_000_000] >= 3_000 and all(r[3] == counts[r[1]] for r in runs[0])


def test_ordered_keys_move_rows_once(spark):
    df = spark.range(2_000).select(F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    with settings(spark, **LARGE):
        numbered = ordered_key(df, "t", "k", "same")
        numbered.collect()
        final = plan(numbered).split("== Initial Plan ==")[0]
        # One shuffle by block; the histogram's offsets are a few rows.
        assert len(re.findall(r"Exchange hashpartitioning\(_block", final)) <= 2, final
        assert final.count("rangepartitioning") == 0


def test_an_audit_scans_the_fact_once(spark, tmp_path):
    spark.range(1_000).select(
        F.col("id").alias("k"), (F.col("id") % 10).cast("int").alias("p"), F.when(F.col("id") > 4, F.col("id") % 7).alias("q")
    ).union(spark.sql("SELECT 3L, 77, 99L")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    parents = {"p": spark.range(9).withColumnRenamed("id", "p"), "q": spark.range(7).withColumnRenamed("id", "q")}
    rules = [
        *c.not_null("q"),
        c.Check("small", F.col("q") < 6),
        c.Unique("k"),
        c.Unique("q"),
        c.ForeignKey("p", "p", "p"),
        c.ForeignKey("q", "q", "q"),
    ]
    found = c.audit(df, rules, parents)
    assert {r.constraint: r.violations for r in found.collect()} == {
        "not_null_q": 5,
        "small": 142 + 1,
        "unique_k": 1,
        "unique_q": 996 - 8,
        "fk_p": 101,
        "fk_q": 1,
    }
    assert plan(found).split("== Initial Plan ==")[0].count("FileScan parquet") == 1


def test_recent_months_scan_their_partitions_only(spark, tmp_path):
    months = [(2020, m) for m in range(1, 13)] + [(2021, m) for m in (1, 2, 3)]
    days = [(y * 10000 + m * 100 + d, i % 5, (y - 2000) * m + d) for i, (y, m) in enumerate(months) for d in (1, 15)]
    facts = spark.createDataFrame(days, "date_key int, player_key long, total_rp long").withColumns(layers.gold_parts())
    store = Store(spark, str(tmp_path), prefix="months_")
    run = store.run("r")
    run.refresh("gold", "fact_sales", facts, "Sales", layers.GOLD_PARTS)
    dates = calendar(spark, date(2020, 1, 1), date(2021, 12, 31))
    none = spark.range(0)
    star = Gold(dim_date=dates, dim_skin=none, dim_player=none, fact_sales=store.read_run("gold", "fact_sales", "r"))
    lazy = reports.gold_last6_months(star).collect()
    star.parts = lambda table: store.partitions("gold", table, "r")
    found = reports.gold_last6_months(star)
    assert found.collect() == lazy and [(r.year, r.month_name) for r in lazy][:2] == [(2021, "March"), (2021, "February")]
    scanned = reports.recent_months(star, 6).fact_sales
    folders = {f.rsplit("/", 2)[0].rsplit("/", 1)[-1] + "/" + f.rsplit("/", 2)[1] for f in scanned.inputFiles()}
    scan = scanned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.selectedPartitions().partitionCount() == 6, folders
    assert "PartitionFilters: [" in plan(found) and "PartitionFilters: []" not in plan(scanned)


@pytest.fixture
def star(spark, tmp_path):
    path = str(tmp_path)
    i = F.col("id")
    day = F.date_add(F.lit(date(2024, 1, 1)), (i % 360).cast("int"))
    facts = spark.range(60_000).select(
        i.alias("transaction_id"),
        F.when(i % 3 == 0, 1).otherwise(i % 2000).alias("player_key"),
        (i % 1500).alias("skin_key"),
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
        F.lit(10).alias("price_rp"),
        F.lit(1).alias("quantity"),
        F.lit(10).alias("total_rp"),
    )
    pad = F.repeat(F.lit("x"), 60)
    players = spark.range(2000).select(
        i.alias("player_key"),
        i.alias("player_id"),
        F.concat(F.lit("s"), (i % 3).cast("string")).alias("player_segment"),
        F.concat(F.lit("r"), (i % 4).cast("string")).alias("region"),
        F.concat(pad, F.sha2(i.cast("string"), 256)).alias("note"),
    )
    skins = spark.range(1500).select(
        i.alias("skin_key"),
        i.alias("skin_id"),
        F.sha2(i.cast("string"), 256).alias("champion_name"),
        F.sha2((i + 1).cast("string"), 256).alias("skin_name"),
        F.lit("Epic").alias("rarity"),
        F.lit(10).alias("price_rp"),
    )
    tables = {
        "dim_date": calendar(spark, RULES.calendar_start, RULES.calendar_end),
        "dim_player": players,
        "dim_skin": skins,
        "fact_sales": facts,
    }
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    return Gold(**{name: spark.read.parquet(f"{path}/{name}") for name in tables})


@pytest.mark.parametrize(
    "build", [v for v, _ in views.VIEWS.values()] + [reports.gold_segment_revenue, reports.gold_rarity_sales, reports.gold_region_sales]
)
def test_facts_are_aggregated_before_they_move(spark, star, build):
    """Between the fact scan and the first shuffle lies a partial aggregation,
    the scan reads no column the view does not use, and large dimensions are
    not broadcast."""
    with settings(spark, **LARGE):
        text = plan(build(star))
    lines = text.splitlines()
    fact = scan(lines, "total_rp")
    assert "transaction_id" not in lines[fact] and "quantity" not in lines[fact]
    above = list(ancestors(lines, fact))
    first = next(x for x in above if "partial_" in x or "Exchange hash" in x)
    assert "partial_" in first, text
    for column in ("player_segment", "champion_name"):
        if any("FileScan" in x and column in x for x in lines):
            assert not any("Broadcast" in x and "Exchange" in x for x in ancestors(lines, scan(lines, column)))


def scan(lines, column):
    return next(i for i, x in enumerate(lines) if "FileScan" in x and column in x)


def ancestors(lines, at):
    """The operators above a line of a printed plan, nearest first."""
    depth = re.search(r"\w", lines[at]).start()
    for line in reversed(lines[:at]):
        start = re.search(r"[A-Za-z*]", line).start()
        if start < depth:
            depth = start
            yield line


def test_shares_compute_their_counts_once(spark):
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("id").alias("more")
    )
    for shared in (with_share(grouped), with_share_written(grouped)):
        assert abs(sum(float(r.pct) for r in shared.collect()) - 100) < 0.1
        final = plan(shared).split("== Initial Plan ==")[0]
        assert final.count("Range (0, 1000") <= 1
