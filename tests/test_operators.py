"""Keys, constraints, lookups, profiles and functions on small frames."""

from datetime import date
from decimal import Decimal

import pytest
from helpers import RULES, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import dates, numbers, text
from siltstone.operators import constraints as c
from siltstone.operators.calendar import calendar, calendar_covering
from siltstone.operators.keys import dense_index, dense_key, load_order_index
from siltstone.operators.lookups import lookup
from siltstone.operators.profiles import first_per_group, frequency, removed_by, value_counts, with_share
from siltstone.plans import prep
from siltstone.rules import Rules


@settings(max_examples=10, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1) | st.integers(-5, 5) | st.integers(2**20 - 3, 2**20 + 3), max_size=60))
def test_dense_key_is_the_rank_of_the_id(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert rows(dense_key(df, "id", "k"), "id", "k") == sorted(
        ((v, k) for k, v in enumerate(sorted(ids), start=1)), key=repr
    )


def test_dense_index_follows_the_order(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g")).repartition(7)
    got = {r.id: r.n for r in dense_index(df, ["g", F.desc("id")], "n").collect()}
    want = sorted(range(1000), key=lambda i: (i % 3, -i))
    assert got == {i: n for n, i in enumerate(want, start=1)}


def test_load_order_index_is_dense_and_unique(spark):
    df = spark.range(1000, numPartitions=7).where("id % 5 <> 0")
    numbered = load_order_index(df, "n")
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 801))
    assert load_order_index(spark.range(0), "n").count() == 0


def test_audit_counts_each_constraint(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", -1), (1, None, 0), (2, "abcd", None), (None, "a", 1)], "k int, s string, n int"
    )
    parent = spark.createDataFrame([(1,)], "id int")
    found = c.audit(
        df,
        [
            *c.not_null("s"),
            *c.max_length({"s": 3}),
            c.Check("positive", F.col("n") > 0),
            c.one_of("s", ["a", "b"]),
            c.Unique("k"),
            c.ForeignKey("k", "p", "id"),
        ],
        {"p": parent},
    )
    assert dict(rows(found, "constraint", "violations")) == {
        "not_null_s": 1,
        "length_s": 1,
        "positive": 2,
        "domain_s": 1,
        "unique_k": 2,
        "fk_k": 1,
    }


def test_policies(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, -1), (3, None), (9, 1)], "k int, n int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    rules = [c.Check("positive", F.col("n") > 0), c.Unique("k"), c.ForeignKey("k", "p", "id")]
    with pytest.raises(c.ConstraintError, match="positive: 1"):
        c.enforce(df, rules, "fail", {"p": parent})
    done = c.enforce(df, rules, "quarantine", {"p": parent})
    kept = rows(done.kept, "k", "n")
    rejected = rows(done.rejected, "k", "violations")
    assert [k for k, _ in kept] == [1, 3] and len(rejected) == 3
    assert rejected[0][0] == 1 and rejected[0][1] == ["unique_k"]
    assert rejected[1:] == [(2, ["positive"]), (9, ["fk_k"])]
    sound = df.where("k = 3")
    assert rows(c.enforce(sound, rules, "fail", {"p": parent}).kept, "k") == [(3,)]


def test_unique_keeps_a_sound_row(spark):
    rules = [c.Unique("k"), c.Check("positive", F.col("n") > 0)]
    df = spark.createDataFrame([(1, -1), (1, 5), (1, 5), (2, -1), (2, -2), (None, 1)], "k int, n int")
    for policy in ("drop", "quarantine"):
        for parts in (1, 3):
            kept = c.enforce(df.repartition(parts), rules, policy).kept
            assert rows(kept, "k", "n") == [(1, 5), (None, 1)]


def test_quotients_are_exact(spark):
    money = spark.createDataFrame(
        [(Decimal("10049999999999.99"), Decimal(10**13)), (Decimal("-0.05"), Decimal(10)), (Decimal(1), Decimal(0))],
        "n decimal(24,2), d decimal(24,2)",
    )
    found = money.select(numbers.ratio(F.col("n"), F.col("d"), kind=numbers.CENTS).alias("q"))
    assert [r.q for r in found.collect()] == [Decimal("1.00"), Decimal("-0.01"), None]
    whole = spark.createDataFrame([(1, 200), (-1, 200), (2, 3), (1, -8)], "n long, d long")
    found = whole.select(numbers.percent(F.col("n"), F.col("d"), 0).alias("p"))
    assert [int(r.p) for r in found.collect()] == [1, -1, 67, -13]


def test_shares_of_large_numbers(spark):
    """Counts and amounts that leave 64 bits when multiplied by a hundred."""
    counts = spark.createDataFrame([("a", 2 * 10**17), ("b", 10**17), ("c", 0)], "k string, n long")
    assert rows(with_share(counts, "n"), "k", "pct") == [
        ("a", Decimal("66.67")),
        ("b", Decimal("33.33")),
        ("c", Decimal("0.00")),
    ]
    most = spark.createDataFrame([("a", 2**63 - 1)], "k string, n long")
    assert rows(most.select(numbers.percent(F.col("n"), F.col("n")).alias("p")), "p") == [(Decimal("100.00"),)]
    money = spark.createDataFrame([(Decimal("3") * 10**19, Decimal(9) * 10**19)], "a decimal(24,2), b decimal(24,2)")
    found = money.select(numbers.percent(F.col("a"), F.col("b"), kind=numbers.CENTS).alias("p"))
    assert rows(found, "p") == [(Decimal("33.33"),)]


def test_quotients_as_text(spark):
    values = [(1, 3), (-2, 3), (5, -8), (7, 0), (None, 1), (10**18, 7), (0, 5)]
    df = spark.createDataFrame(values, "n long, d long")
    for kind in (numbers.WHOLE, numbers.CENTS):
        text = F.expr(numbers.ratio_sql("n", "d", 2, kind))
        both = df.select(text.alias("x"), numbers.ratio(F.col("n"), F.col("d"), 2, kind).alias("y"))
        assert both.schema["x"].dataType == both.schema["y"].dataType
        assert both.where("NOT (x <=> y)").isEmpty()


def test_lookup_keeps_every_row_and_spreads_missing_keys(spark):
    table = spark.createDataFrame([(1, "one"), (2, "two")], "id long, label string")
    left = spark.range(4000).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 4).alias("ref")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookup(left, table.withColumnRenamed("id", "table_id"), F.col("ref"), "table_id")
        assert rows(found.groupBy("label").count(), "label", "count") == [("one", 1000), (None, 3000)]
        missing = found.where("ref IS NULL").select(F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in missing.groupBy("p").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_calendar(spark):
    days = calendar(spark, date(2010, 1, 1), date(2030, 12, 31))
    assert days.count() == 7670
    first = days.where("date_key = 20100101").first()
    assert (first.year, first.week, first.day_of_week, first.day_name, first.month_name) == (
        2010,
        53,
        5,
        "Friday",
        "January",
    )
    assert first.is_month_start and not first.is_month_end and not first.is_weekend
    leap = days.where("date = DATE '2012-02-29'").first()
    assert leap.is_month_end and leap.quarter == 1


def test_calendar_covering(spark):
    df = spark.createDataFrame([(date(2023, 5, 1),), (None,), (date(2024, 2, 1),)], "d date")
    days = calendar_covering(df, F.col("d"))
    assert rows(days.agg(F.min("date_key"), F.max("date_key"), F.count("date")), "*") == [(20230101, 20241231, 731)]
    assert calendar_covering(df.where("d IS NULL"), F.col("d")).count() == 0


def test_first_per_group_limits_inside_tasks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = first_per_group(df, "g", ["id"], 2)
    assert rows(top, "g", "id") == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_profiles(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert [tuple(r) for r in frequency(df, "k").collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert rows(value_counts(df, "k"), "k", "count") == [("a", 2), ("b", 1)]
    assert tuple(removed_by(df, F.col("k") == "a").first()) == (4, 2, 2)
    assert [tuple(r) for r in prep.share_of_table(df, "k").orderBy("k").select("k", "count", F.col("pct").cast("double")).collect()] == [
        ("a", 2, 50.0),
        ("b", 1, 25.0),
    ]


def test_rounding(spark):
    df = spark.createDataFrame([(Decimal("2.50"),), (Decimal("-2.50"),), (Decimal("2.49"),)], "x decimal(18,2)")
    assert [r[0] for r in df.select(numbers.round_to_long(F.col("x"))).collect()] == [3, -3, 2]
    df = spark.createDataFrame([(1, 3), (1, 0), (2, 3), (1, 200)], "a long, b long")
    assert [r[0] and float(r[0]) for r in df.select(numbers.percent(F.col("a"), F.col("b"))).collect()] == [
        33.33,
        None,
        66.67,
        0.5,
    ]


def test_text_functions(spark):
    df = spark.createDataFrame([(" Mega-Ann 2!", ",,a,b,", None), (None, "", "x")], "n string, t string, g string")
    assert rows(
        df,
        text.normalise_name(F.col("n")),
        text.trim_commas(F.col("t")),
        text.append_tag(F.col("g"), "new"),
        text.contains_any(F.col("n"), ("mega",)),
    ) == [("", "", "x,new", False), ("megaann2", "a,b", "new", True)]


def test_lenient_dates(spark):
    texts = ["2014-05-06", "May 6, 2014", "6 May 2014", "2014/05/06", "5/6/2014", "soon", None, "2014-13-01"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in df.orderBy("i").select(dates.lenient_date(F.col("t"))).collect()]
    assert found == [date(2014, 5, 6)] * 5 + [None] * 3


def test_rules_are_checked():
    assert RULES.on_violation == "fail"
    with pytest.raises(ValueError):
        Rules(on_violation="ignore")
    with pytest.raises(ValueError):
        Rules(calendar_start=date(2031, 1, 1))
