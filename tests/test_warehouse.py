"""Stored builds: full refresh, policies, log history, views, file sources."""

import json
from datetime import date
from pathlib import Path

import pytest
from helpers import RULES, players, rows, sales, skins
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone.operators.constraints import ConstraintError
from siltstone.plans import layers, reports, views, warehouse
from siltstone.rules import Rules
from siltstone.sources import files
from siltstone.sources.nested import flatten_catalogue
from siltstone.sources.tables import Store

DAY = "2024-05-06"


def staged(spark, *records):
    return layers.Bronze(
        stg_players=players(
            spark,
            (1, "EUW", date(2020, 1, 1), "core"),
            (2, "NA", date(2020, 1, 1), "whale"),
            (3, " euw", date(2020, 1, 1), "core"),
        ),
        stg_skins=skins(spark, (1, "Ann", "Red Ann", "Epic", 1350), (2, "Bob", "Bob", "Legacy", 520)),
        stg_sales=sales(spark, *records),
    )


RECORDS = (
    (1, 1, 1, DAY, 1350, 1),
    (2, 2, 2, DAY, 520, 2),
    (3, 1, 2, "2024-06-01", 520, 1),
    (4, None, 1, DAY, 1350, 1),
    (5, 3, 1, DAY, 1350, 1),  # valid, but its player is not
)


def rules(policy):
    return Rules(
        calendar_start=RULES.calendar_start,
        calendar_end=RULES.calendar_end,
        as_of=RULES.as_of,
        on_violation=policy,
    )


def test_build_refresh_and_reports(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="a_")
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store)
    assert rows(built.gold.fact_sales, "sale_key", "transaction_id", "total_rp") == [
        (1, 1, 1350),
        (2, 2, 1040),
        (3, 3, 520),
    ]
    assert rows(built.silver.fact_sale, "sale_key") == [(i,) for i in range(1, 6)]
    assert {"created_at"} <= set(built.gold.fact_sales.columns)
    assert rows(reports.gold_region_sales(built.gold), "region", "transakcje", "revenue", "gracze") == [
        ("EUW", 2, 1870, 1),
        ("NA", 1, 1040, 1),
    ]
    assert spark.table("revenue_trends").count() == 2
    described = spark.sql("DESCRIBE TABLE EXTENDED a_gold.fact_sales").where("col_name = 'Comment'")
    assert described.first().data_type == "Valid sales"

    # A second build replaces every table and gives the same result.
    again = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store)
    assert again.gold.fact_sales.count() == 3
    assert again.silver.data_quality_log.count() == 5
    opened = warehouse.open_warehouse(store)
    assert rows(views.revenue_trends(opened.gold), "month", "revenue") == [(5, 2390), (6, 520)]
    assert rows(reports.silver_counts(opened.silver), "tabela", "wiersze") == [
        ("data_quality_log", 5),
        ("dim_date", 366),
        ("dim_player", 3),
        ("dim_skin", 2),
        ("fact_sale", 5),
        ("fact_sale_quarantine", 1),
    ]


def scratch_tables(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return set(folder.iterdir()) if folder.exists() else set()


@pytest.mark.parametrize("policy", ["quarantine", "fail"])
def test_a_build_leaves_no_scratch(spark, tmp_path, policy):
    before = scratch_tables(spark)
    store = Store(spark, str(tmp_path), prefix=f"e_{policy}_")
    try:
        warehouse.build(spark, staged(spark, *RECORDS), rules(policy), store)
    except ConstraintError:
        assert policy == "fail"
    assert scratch_tables(spark) == before


def test_log_history(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="b_")
    for _ in range(2):
        built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store, keep_log=True)
    log = built.silver.data_quality_log
    assert rows(log, "log_id") == rows(spark.range(1, 11), "id")
    assert log.select("run_timestamp").distinct().count() == 2


def test_a_repeated_run_replaces_its_log_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="f_")
    for run_id in ("one", "one"):
        built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store, True, run_id)
    assert rows(built.silver.data_quality_log, "run_id", "log_id") == [("one", i) for i in range(1, 6)]
    assert rows(built.gold.fact_sales, "sale_key") == [(1,), (2,), (3,)]
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store, True, "two")
    log = [("one", i) for i in range(1, 6)] + [("two", i) for i in range(6, 11)]
    assert sorted(rows(built.silver.data_quality_log, "run_id", "log_id")) == log
    # Without keep_log only the new run's metrics stay.
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store)
    assert rows(built.silver.data_quality_log, "log_id") == [(i,) for i in range(1, 6)]
    with pytest.raises(ValueError, match="run id"):
        store.run("not a name")


def test_a_build_that_stops_leaves_the_old_warehouse_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="g_")
    warehouse.build(spark, staged(spark, *RECORDS[:4]), rules("fail"), store, True, "first")
    before = {
        (layer, name): rows(table, *table.columns)
        for layer, tables in vars(warehouse.open_warehouse(store)).items()
        for name, table in tables.tables().items()
    }
    # Record 5 breaks a constraint of gold, when bronze and silver have been written.
    with pytest.raises(ConstraintError):
        warehouse.build(spark, staged(spark, *RECORDS), rules("fail"), store, True, "second")
    opened = warehouse.open_warehouse(store)
    assert before == {
        (layer, name): rows(table, *table.columns)
        for layer, tables in vars(opened).items()
        for name, table in tables.tables().items()
    }
    assert store.read("silver", "fact_sale").count() == 4 and store.read("gold", "top_selling_skins").count() == 2
    # Repeating the stopped run replaces what it had written, and older versions go.
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store, True, "second")
    assert built.silver.fact_sale.count() == 5 and built.gold.fact_sales.count() == 3
    warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store, True, "third")
    assert set(store._versions("gold", "fact_sales")) == {"second", "third"}
    folders = {p.name for p in (tmp_path / "gold").iterdir() if p.name.startswith("fact_sales__")}
    assert folders == {"fact_sales__second", "fact_sales__third"}


def test_views_live_in_the_catalog(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="h_")
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("drop"), store)
    other = Store(spark.newSession(), str(tmp_path), prefix="h_")
    listed = rows(views.view_catalog(other), "view_name", "comment")
    assert listed == sorted((name, comment) for name, (_, comment) in views.VIEWS.items())
    opened = warehouse.open_warehouse(other)
    for name, (view, _) in views.VIEWS.items():
        shown, made = other.read("gold", name), view(opened.gold)
        assert shown.schema == made.schema
        assert [tuple(r) for r in shown.collect()] == [tuple(r) for r in made.collect()]
    assert rows(opened.gold.fact_sales, "sale_key") == rows(built.gold.fact_sales, "sale_key")


def test_opening_needs_a_published_build(spark, tmp_path):
    with pytest.raises(ValueError, match="no warehouse"):
        warehouse.open_warehouse(Store(spark, str(tmp_path), prefix="none_"))


def test_single_tables_are_swapped_too(spark, tmp_path):
    for store in (Store(spark, str(tmp_path), "i_"), Store(spark, None, "j_")):
        assert store.published("bronze", "t") is None
        store.refresh("bronze", "t", spark.range(3), "it's \\ three")
        five = spark.range(5).withColumn("v", F.lit(1))
        assert store.refresh("bronze", "t", five, "five", ("id",)).count() == 5
        run = store.published("bronze", "t")
        assert sorted(int(p["id"]) for p in store.partitions("bronze", "t", run)) == list(range(5))


def test_fail_policy_stops_the_build(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="c_")
    with pytest.raises(ConstraintError, match="fk_player_key: 1"):
        warehouse.build(spark, staged(spark, *RECORDS), rules("fail"), store)


def test_quarantine_policy_keeps_rejected_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path), prefix="d_")
    built = warehouse.build(spark, staged(spark, *RECORDS), rules("quarantine"), store)
    assert built.gold.fact_sales.count() == 3
    rejected = store.read("gold", "fact_sales_rejected")
    assert rows(rejected, "transaction_id", "violations") == [(5, ["fk_player_key"])]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "sales")
    source = sales(spark, (1, 2.5, None, DAY, -5, 0), (None, 1, 1, "no date", None, None))
    files.write_csv(source, path)
    back = files.stage_sales(spark, path)
    assert rows(back, *schemas.STG_SALES.fieldNames()) == rows(source, *source.columns)
    assert back.where("loaded_at IS NULL").count() == 0


def test_line_breaks_need_multi_line(spark, tmp_path):
    source = players(spark, (1, "EU\nW", date(2020, 1, 1), "core"), (2, "NA", None, None))
    with pytest.raises(Exception, match="needs multi_line"):
        files.write_csv(source, str(tmp_path / "refused"))
    files.write_csv(source, str(tmp_path / "players"), multi_line=True)
    back = files.stage_players(spark, str(tmp_path / "players"), multi_line=True)
    assert rows(back, *source.columns) == rows(source, *source.columns)


def test_faulty_csv_lines_still_load(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(
        "player_id,region,account_created_date,player_segment\n"
        '1,EUW,2020-01-01,core\nx,NA,2020-13-01,"a ""b"", c"\n3,,,""\n'
    )
    back = files.stage_players(spark, str(path))
    assert rows(back, *schemas.STG_PLAYERS.fieldNames()) == [
        (1, "EUW", date(2020, 1, 1), "core"),
        (3, None, None, ""),
        (None, "NA", None, 'a "b", c'),
    ]
    assert [r[files.CORRUPT] is not None for r in back.orderBy("player_segment").collect()] == [False, True, False]


def test_documents_and_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps({"Ann": {"name": "Ann", "skins": [{"num": 0, "name": "default"}]}}, indent=1)
    )
    docs = files.read_documents(spark, str(tmp_path))
    assert docs.count() == 1
    assert rows(flatten_catalogue(docs, "text"), "champion_id", "skin_num") == [("Ann", 0)]


def test_constant_rows(spark):
    schema = T.StructType([T.StructField("n", T.LongType())])
    assert rows(files.constant_rows(spark, [(1,), (2,)], schema), "n") == [(1,), (2,)]
