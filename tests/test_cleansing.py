"""Edge rows of dimension loading, cleansing, quarantine and monitoring."""

from dataclasses import replace
from datetime import date

import pytest
from helpers import RULES, players, rows, sales, skins
from pyspark.sql import functions as F

from siltstone.operators.constraints import ConstraintError
from siltstone.operators.dims import load_players, load_skins
from siltstone.operators.keys import dense_key
from siltstone.operators.facts import recompute_total
from siltstone.operators.quality import monitor
from siltstone.plans import layers, reports

DAY = "2024-05-06"


def under(policy):
    return replace(RULES, on_violation=policy)


@pytest.fixture(scope="module")
def dims(spark):
    return (
        players(
            spark,
            (1, "EUW", date(2020, 1, 1), "core"),
            (3, " euw", date(2020, 1, 1), "core"),
            (5, "KR", date(2025, 1, 1), "Whale"),
        ),
        skins(
            spark,
            (1, "Ann", "Red Ann", "Epic", 1350),
            (3, "Ann", "Ann", "Default", 0),
            (7, "Bob", "  ", "Legacy", 520),
        ),
    )


@pytest.fixture(scope="module")
def silver_of(spark, dims):
    def build(*records):
        staged = sales(spark, *records)
        bronze = layers.Bronze(stg_players=dims[0], stg_skins=dims[1], stg_sales=staged)
        return layers.silver(spark, bronze, RULES)

    return build


def judged(silver):
    return {
        float(r.transaction_id): (r.is_valid, r.dq_issues)
        for r in silver.fact_sale.collect()
    }


def test_sound_and_faulty_sales(silver_of):
    silver = silver_of(
        (1, 1, 1, DAY, 1350, 2),
        (2, None, 1, DAY, 1350, 1),
        (3, 99, 99, DAY, -5, 0),
        (4, 1, 1, "2023-12-31", 1350, 1),
        (5, 1, 1, DAY, None, None),
        (None, 1, 1, DAY, 1350, 1),
    )
    assert judged(silver) == {
        1: (True, ""),
        2: (False, "missing_player"),
        3: (False, "missing_player,missing_skin,negative_price,invalid_quantity"),
        4: (False, "invalid_date"),
        5: (False, "missing_price,missing_quantity"),
    }


def test_rejected_without_a_reason(silver_of):
    """A malformed or impossible date and a price of 0 reject a row but earn no tag."""
    silver = silver_of(
        (1, 1, 1, "06.05.2024", 1350, 1),
        (2, 1, 1, "2024-13-45", 1350, 1),
        (3, 1, 1, DAY + "\n", 1350, 1),
        (4, 1, 1, DAY, 0, 1),
        (5, 1, 1, None, 1350, 1),
    )
    assert judged(silver) == {i: (False, "") for i in (1, 2, 3, 4, 5)}


def test_price_repair_hides_other_tags(silver_of):
    silver = silver_of(
        (1, 1, 1, DAY, None, 3),
        (2, 1, 1, "2030-01-01", None, 1),
        (3, None, 1, DAY, None, 1),
        (4, 1, 3, DAY, None, 1),  # the list price is 0
        (5, 1, 1, DAY, None, 0),
    )
    assert judged(silver) == {
        1: (True, "price_fixed"),
        2: (False, "price_fixed"),
        3: (False, "price_fixed"),
        4: (False, "missing_price"),
        5: (False, "missing_price,invalid_quantity"),
    }
    fixed = silver.fact_sale.where("transaction_id = 1").first()
    assert (fixed.price_rp, fixed.total_rp) == (1350, 4050)
    # Quarantine shows the values as staged.
    assert rows(silver.fact_sale_quarantine.where("transaction_id = 2"), "price_rp", "copies") == [(None, 1)]


def test_ids_round_half_away_from_zero(silver_of):
    silver = silver_of((1, 2.5, 0.5, DAY, 1350, 1), (2, 2.4, 1, DAY, 1350, 1))
    assert judged(silver) == {1: (True, ""), 2: (False, "missing_player")}


def test_wrong_total_is_recomputed(spark):
    fact = spark.createDataFrame(
        [
            (1, 10, 2, 20, None),
            (2, 10, 2, 21, None),
            (3, 10, 2, None, "seen"),
            (4, 0, 2, 5, None),
            (5, None, 2, 5, None),
        ],
        "transaction_id int, price_rp int, quantity int, total_rp int, dq_issues string",
    )
    assert rows(recompute_total(fact), "transaction_id", F.col("total_rp").cast("int"), "dq_issues") == [
        (1, 20, None),
        (2, 20, "total_recalculated"),
        (3, 20, "seen,total_recalculated"),
        (4, 5, None),
        (5, 5, None),
    ]


def test_player_is_stored_normalised_but_judged_as_staged(spark, dims):
    found = dense_key(load_players(dims[0], RULES), "player_id", "player_key")
    assert rows(found, "player_key", "player_id", "region", "player_segment", "is_valid") == [
        (1, 1, "EUW", "core", True),
        (2, 3, "EUW", "core", False),
        (3, 5, "KR", "whale", False),
    ]


def test_skin_validity(spark, dims):
    odd = skins(spark, (9, "Ann", "x", "Mythic", 1), (11, "Ann", "x", "Epic", -1), (13, "A", "x", None, None))
    found = load_skins(dims[1].unionByName(odd), RULES)
    assert rows(found, "skin_id", "skin_name", "is_valid") == [
        (1, "Red Ann", True),
        (11, "x", False),
        (13, "x", True),  # unknown is not wrong
        (3, "Ann", True),
        (7, "", False),
        (9, "x", False),
    ]


def test_repeated_transaction_ids_count_in_quarantine(silver_of):
    """Every staged row of an id belongs to every rejected fact row of that id."""
    silver = silver_of(
        (1, None, 1, DAY, 1350, 1),
        (1, None, 1, DAY, 1350, 2),
        (1, 1, 1, DAY, 1350, 3),
        (2, 1, None, DAY, 1350, 1),
    )
    assert rows(silver.fact_sale_quarantine, "transaction_id", "quantity", "rejection_reason", "copies") == [
        (1, 1, "missing_player", 2),
        (1, 2, "missing_player", 2),
        (1, 3, "missing_player", 2),
        (2, 1, "missing_skin", 1),
    ]
    assert rows(reports.rejection_reasons(silver), "rejection_reason", "count") == [
        ("missing_player", 6),
        ("missing_skin", 1),
    ]
    counts = dict(rows(reports.silver_counts(silver), "tabela", "wiersze"))
    assert counts["fact_sale_quarantine"] == 7


def test_valid_sale_of_an_invalid_player_stays_out_of_gold(silver_of):
    silver = silver_of((1, 3, 1, DAY, 1350, 1), (2, 1, 7, DAY, 520, 1), (3, 1, 1, DAY, 1350, 1))
    assert all(valid for valid, _ in judged(silver).values())
    assert rows(layers.gold(silver, under("drop")).fact_sales, "transaction_id") == [(3,)]
    judged_rows = layers.gold_facts_judged(silver, under("quarantine"))
    assert rows(judged_rows.kept, "transaction_id") == [(3,)]
    assert rows(judged_rows.rejected, "transaction_id", "violations") == [
        (1, ["fk_player_key"]),
        (2, ["fk_skin_key"]),
    ]
    with pytest.raises(ConstraintError, match="fk_player_key: 1, fk_skin_key: 1"):
        layers.gold(silver, under("fail")).fact_sales


def test_no_join_above_the_silver_fact(silver_of, spark, tmp_path):
    silver = silver_of((1, 1, 1, DAY, 1350, 1))
    silver.fact_sale.write.parquet(str(tmp_path / "fact"))
    stored = layers.Silver(
        **{n: (lambda n=n: getattr(silver, n)) for n in layers.Silver.TABLES if n != "fact_sale"},
        fact_sale=spark.read.parquet(str(tmp_path / "fact")),
    )
    plan = layers.gold(stored, under("drop")).fact_sales._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_rounding_can_break_gold_constraints(silver_of):
    silver = silver_of((1, 1, 1, DAY, 0.4, 1), (2, 1, 1, DAY, 1.5, 3), (3, 1, 1, DAY, 2, 3))
    assert all(valid for valid, _ in judged(silver).values())
    assert rows(layers.gold_facts(silver), "transaction_id", "price_rp", "quantity", "total_rp") == [
        (1, 0, 1, 0),
        (2, 2, 3, 5),
        (3, 2, 3, 6),
    ]
    assert rows(layers.gold(silver, under("drop")).fact_sales, "transaction_id") == [(3,)]
    with pytest.raises(ConstraintError):
        layers.gold(silver, under("fail")).fact_sales


def test_monitor_of_an_empty_fact(silver_of):
    silver = silver_of()
    log = rows(silver.data_quality_log, "log_id", "issue_count", "issue_pct", "alert_triggered")
    assert log == [(i, 0, None, None) for i in range(1, 6)]
    assert reports.dq_totals(silver).first().error_pct is None


def test_monitor_alerts_above_the_threshold_only(spark):
    def fact(bad, total):
        return spark.range(total).select(
            F.when(F.col("id") >= bad, F.col("id")).alias("player_key"),
            F.lit(1).alias("skin_key"),
            F.lit(1).alias("price_rp"),
            F.lit(1).alias("quantity"),
            F.lit(True).alias("is_valid"),
        )

    first = monitor(fact(1, 20), RULES).where("log_id = 1").first()
    assert (float(first.issue_pct), first.alert_triggered) == (5.0, False)
    second = monitor(fact(2, 39), RULES).where("log_id = 1").first()
    assert (float(second.issue_pct), second.alert_triggered) == (5.13, True)


def test_valid_and_invalid_add_up(silver_of):
    silver = silver_of(*[(i, i % 4, 1, DAY, 10, i % 3) for i in range(1, 60)])
    totals = reports.silver_quality(silver).first()
    assert totals.valid + totals.invalid == totals.total == 59
    shares = [float(r.pct) for r in reports.quarantine_share(silver).collect()]
    assert abs(sum(shares) - 100) < 0.1
