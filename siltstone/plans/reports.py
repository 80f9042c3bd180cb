"""Verification reports, one function per report and layer.

Orders end in a tie-breaker, so every top-k is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import ISO_DATE_SHAPE, guarded_date
from siltstone.functions.numbers import CENTS, count_where, percent, ratio, sum_where
from siltstone.operators import constraints as c
from siltstone.operators.profiles import frequency, with_share
from siltstone.operators.quality import COPIES, reason_counts
from siltstone.plans import layers, views
from siltstone.plans.layers import Bronze, Gold, Silver
from siltstone.rules import Rules

# Report labels and the sizes of top-k reports and samples.
ALERT_LABEL = "ALERT!"
OK_LABEL = "✓ OK"
ALERT_MESSAGE = "THRESHOLD EXCEEDED!"
TOP = 10
SAMPLE = 20
LAST_MONTHS = 6

_SALE = ("transaction_id", "player_id", "skin_id", "purchase_date", "price_rp", "quantity")


def row_counts(tables: dict[str, DataFrame], name: str, count: str) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(table).alias(name), count)
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# Bronze ---------------------------------------------------------------------


def bronze_counts(bronze: Bronze) -> DataFrame:
    return row_counts(bronze.tables(), "table_name", "row_count")


def bronze_first_skins(bronze: Bronze) -> DataFrame:
    return (
        bronze.stg_skins.select(
            "skin_id", "champion_name", "skin_name", "rarity", "price_rp", "release_date"
        )
        .orderBy("skin_id")
        .limit(TOP)
    )


def bronze_default_skins(bronze: Bronze) -> DataFrame:
    return (
        bronze.stg_skins.where(F.col("rarity") == "Default")
        .select("skin_id", "champion_name", "skin_name", "rarity", "price_rp")
        .orderBy("skin_id")
        .limit(TOP)
    )


def bronze_rarity_dist(bronze: Bronze) -> DataFrame:
    return frequency(bronze.stg_skins, "rarity")


def bronze_price_dist(bronze: Bronze) -> DataFrame:
    return frequency(bronze.stg_skins, "price_rp").limit(TOP)


def bronze_release_dates(bronze: Bronze) -> DataFrame:
    rows, dated = F.count(F.lit(1)), F.count("release_date")
    return bronze.stg_skins.agg(
        rows.alias("total"),
        dated.alias("with_date"),
        (rows - dated).alias("without_date"),
        percent(rows - dated, rows).alias("pct_without_date"),
    )


def bronze_segment_dist(bronze: Bronze) -> DataFrame:
    return frequency(bronze.stg_players, "player_segment")


def bronze_region_dist(bronze: Bronze) -> DataFrame:
    return frequency(bronze.stg_players, "region")


def bronze_sales_errors(bronze: Bronze) -> DataFrame:
    return bronze.stg_sales.agg(
        F.count(F.lit(1)).alias("total"),
        count_where(F.col("player_id").isNull()).alias("null_player"),
        count_where(F.col("skin_id").isNull()).alias("null_skin"),
        count_where(F.col("price_rp").isNull()).alias("null_price"),
        count_where(F.col("price_rp") < 0).alias("negative_price"),
        count_where(F.col("quantity").isNull()).alias("null_quantity"),
        count_where(F.col("quantity") <= 0).alias("invalid_quantity"),
    )


def bronze_bad_sales(bronze: Bronze) -> DataFrame:
    bad = (
        F.col("player_id").isNull()
        | F.col("skin_id").isNull()
        | F.col("price_rp").isNull()
        | (F.col("price_rp") < 0)
        | F.col("quantity").isNull()
        | (F.col("quantity") <= 0)
    )
    first = (F.asc_nulls_last("transaction_id"), *_SALE[1:])
    return bronze.stg_sales.where(bad).select(*_SALE).orderBy(*first).limit(SAMPLE)


def bronze_date_range(bronze: Bronze) -> DataFrame:
    day = guarded_date(F.col("purchase_date"))
    return bronze.stg_sales.where(F.col("purchase_date").rlike(ISO_DATE_SHAPE)).agg(
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count_distinct(day).alias("unique_dates"),
    )


# Silver ---------------------------------------------------------------------


def silver_load_status(silver: Silver) -> DataFrame:
    return row_counts(
        {
            "dim_date created": silver.dim_date,
            "dim_skin created": silver.dim_skin,
            "dim_player created": silver.dim_player,
            "fact_sale loaded": silver.fact_sale,
        },
        "status",
        "count",
    )


def dq_report(silver: Silver) -> DataFrame:
    return silver.data_quality_log.orderBy(F.desc_nulls_first("issue_pct"), "log_id").select(
        F.col("issue_type").alias("Check"),
        F.col("issue_count").alias("Count"),
        F.col("issue_pct").alias("% Error"),
        F.when(F.col("alert_triggered"), ALERT_LABEL).otherwise(OK_LABEL).alias("Status"),
    )


def dq_totals(silver: Silver) -> DataFrame:
    rows, valid = F.count(F.lit(1)), count_where(F.col("is_valid"))
    invalid = count_where(~F.col("is_valid"))
    return silver.fact_sale.agg(
        rows.alias("total_sales"),
        valid.alias("valid_sales"),
        invalid.alias("invalid_sales"),
        percent(invalid, rows).alias("error_pct"),
        sum_where(F.col("total_rp"), F.col("is_valid")).alias("total_revenue"),
    )


def rejection_reasons(silver: Silver) -> DataFrame:
    return (
        reason_counts(silver.fact_sale_quarantine)
        .orderBy(F.desc("count"), "rejection_reason")
        .limit(TOP)
    )


def dq_alerts(silver: Silver) -> DataFrame:
    return _alerts(silver).select("issue_type", "issue_pct", F.lit(ALERT_MESSAGE).alias("message"))


def silver_alerts(silver: Silver) -> DataFrame:
    return _alerts(silver).select("issue_type", "issue_count", "issue_pct", "threshold_pct")


def silver_dq_log(silver: Silver) -> DataFrame:
    return silver.data_quality_log.orderBy(F.desc_nulls_first("issue_pct"), "log_id").select(
        "issue_type", "issue_count", "issue_pct", "alert_triggered", "run_timestamp"
    )


def silver_counts(silver: Silver) -> DataFrame:
    """Quarantined rows count as often as ``copies`` says."""
    tables = silver.tables()
    quarantined = tables.pop("fact_sale_quarantine")
    counts = row_counts(tables, "tabela", "wiersze")
    return counts.unionByName(
        quarantined.agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("wiersze")).select(
            F.lit("fact_sale_quarantine").alias("tabela"), "wiersze"
        )
    )


def silver_quality(silver: Silver) -> DataFrame:
    rows, invalid = F.count(F.lit(1)), count_where(~F.col("is_valid"))
    return silver.fact_sale.agg(
        rows.alias("total"),
        count_where(F.col("is_valid")).alias("valid"),
        invalid.alias("invalid"),
        percent(invalid, rows).alias("invalid_pct"),
    )


def quarantine_share(silver: Silver) -> DataFrame:
    return (
        with_share(reason_counts(silver.fact_sale_quarantine))
        .orderBy(F.desc("count"), "rejection_reason")
        .limit(TOP)
    )


def quarantine_sample(silver: Silver) -> DataFrame:
    columns = ("transaction_id", "player_id", "skin_id", "price_rp", "quantity", "rejection_reason")
    return silver.fact_sale_quarantine.select(*columns).orderBy(*columns).limit(SAMPLE)


def silver_rarity_dist(silver: Silver) -> DataFrame:
    return frequency(
        silver.dim_skin,
        "rarity",
        valid=count_where(F.col("is_valid")),
        invalid=count_where(~F.col("is_valid")),
    )


def silver_segment_dist(silver: Silver) -> DataFrame:
    return frequency(silver.dim_player, "player_segment", valid=count_where(F.col("is_valid")))


def silver_region_dist(silver: Silver) -> DataFrame:
    return frequency(silver.dim_player.where("is_valid"), "region")


def _alerts(silver: Silver) -> DataFrame:
    return silver.data_quality_log.where("alert_triggered").orderBy(
        F.desc_nulls_first("issue_pct"), "log_id"
    )


# Gold -----------------------------------------------------------------------


def gold_counts(gold: Gold) -> DataFrame:
    dates = gold.dim_date.agg(
        F.count(F.lit(1)).alias("liczba_wierszy"),
        F.min("date").alias("min_data"),
        F.max("date").alias("max_data"),
    ).select(F.lit("dim_date").alias("tabela"), "liczba_wierszy", "min_data", "max_data")
    others = {
        "dim_skin": gold.dim_skin,
        "dim_player": gold.dim_player,
        "fact_sales": gold.fact_sales,
    }
    return dates.unionByName(
        row_counts(others, "tabela", "liczba_wierszy"), allowMissingColumns=True
    )


def gold_segment_revenue(gold: Gold) -> DataFrame:
    grouped = (
        _per_player(gold, "player_segment")
        .groupBy("player_segment")
        .agg(F.sum("n").alias("transakcje"), F.sum("amount").alias("total_revenue"))
    )
    shared = with_share(grouped, "total_revenue", "revenue_pct", kind=CENTS)
    return shared.select(
        "player_segment",
        "transakcje",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("transakcje"), kind=CENTS).alias("avg_transaction"),
        "revenue_pct",
    ).orderBy(F.desc_nulls_first("total_revenue"), "player_segment")


def gold_top10_skins(gold: Gold) -> DataFrame:
    return (
        views.top_selling_skins(gold)
        .orderBy(F.desc_nulls_first("total_revenue"), "skin_id")
        .limit(TOP)
        .select("champion_name", "skin_name", "rarity", "times_purchased", "total_revenue")
    )


def recent_months(gold: Gold, n: int) -> Gold:
    """``gold`` with the facts of its last ``n`` months only.

    Stored facts are partitioned by month, so the catalog knows the months that
    have any, and the scan opens their partitions only. Where nothing is stored,
    the facts stay as they are.
    """
    if gold.parts is None:
        return gold
    months = sorted({tuple(int(part[c]) for c in layers.GOLD_PARTS) for part in gold.parts("fact_sales")})
    year, month = (F.col(c) for c in layers.GOLD_PARTS)
    wanted = reduce(lambda x, y: x | y, [(year == y) & (month == m) for y, m in months[-n:]], F.lit(False))
    return Gold(**(gold.tables() | {"fact_sales": gold.fact_sales.where(wanted)}))


def gold_last6_months(gold: Gold) -> DataFrame:
    return (
        views.revenue_trends(recent_months(gold, LAST_MONTHS))
        .orderBy(F.desc("year"), F.desc("month"))
        .limit(LAST_MONTHS)
        .select(
            "year", "month_name", "transactions", "revenue", "active_players", "revenue_per_player"
        )
    )


def gold_weekend(gold: Gold) -> DataFrame:
    return views.weekend_vs_weekday_sales(gold)


def gold_top10_players(gold: Gold) -> DataFrame:
    return (
        views.player_lifetime_value(gold)
        .orderBy(F.desc_nulls_first("lifetime_value"), "player_id")
        .limit(TOP)
        .select(
            "player_id",
            "player_segment",
            "region",
            "total_purchases",
            "lifetime_value",
            "avg_purchase_value",
        )
    )


def gold_rarity_sales(gold: Gold) -> DataFrame:
    """``avg_price`` is the mean of the totals, as specified."""
    per_skin = gold.fact_sales.groupBy("skin_key").agg(*views.sales_and_amount())
    revenue, sold = F.sum("amount"), F.sum("n")
    return (
        per_skin.join(gold.dim_skin.select("skin_key", "rarity"), "skin_key")
        .groupBy("rarity")
        .agg(
            sold.alias("sprzedane"),
            revenue.alias("revenue"),
            ratio(revenue, sold, kind=CENTS).alias("avg_price"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "rarity")
    )


def gold_region_sales(gold: Gold) -> DataFrame:
    return (
        _per_player(gold, "region")
        .groupBy("region")
        .agg(
            F.sum("n").alias("transakcje"),
            F.sum("amount").alias("revenue"),
            F.count("player_key").alias("gracze"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "region")
    )


def _per_player(gold: Gold, *columns: str) -> DataFrame:
    """One row per buying player, with columns of the player dimension."""
    return (
        gold.fact_sales.groupBy("player_key")
        .agg(*views.sales_and_amount())
        .join(gold.dim_player.select("player_key", *columns), "player_key")
    )


# Constraints ----------------------------------------------------------------


def constraint_audit(bronze: Bronze, silver: Silver, gold: Gold, rules: Rules) -> DataFrame:
    """Rows breaking each declared constraint: table_name, constraint, violations.

    The gold fact is judged as it leaves silver, before a policy is applied.
    Tables that have been keyed are judged by their keys, too. Each table is
    scanned once for all its constraints.
    """
    stg = layers.stg_constraints(rules)
    parents = {"dim_player": gold.dim_player, "dim_skin": gold.dim_skin, "dim_date": gold.dim_date}
    keyed = "sale_key" in silver.fact_sale.columns
    audits = {
        "stg_skins": c.audit(bronze.stg_skins, stg["stg_skins"]),
        "stg_players": c.audit(bronze.stg_players, stg["stg_players"]),
        "dim_date": c.audit(silver.dim_date, layers.dim_date_constraints()),
        "dim_skin": c.audit(
            silver.dim_skin, [*layers.dim_skin_constraints(rules), c.Unique("skin_key")]
        ),
        "dim_player": c.audit(
            silver.dim_player, [*layers.dim_player_constraints(rules), c.Unique("player_key")]
        ),
        "fact_sale_quarantine": c.audit(
            silver.fact_sale_quarantine,
            layers.quarantine_constraints("quarantine_id" in silver.fact_sale_quarantine.columns),
        ),
        "data_quality_log": c.audit(silver.data_quality_log, layers.log_constraints()),
        "fact_sales": c.audit(
            layers.gold_facts(silver, *(["sale_key"] if keyed else [])),
            layers.gold_fact_constraints(keyed),
            parents,
        ),
    }
    if keyed:
        audits["fact_sale"] = c.audit(silver.fact_sale, layers.silver_fact_constraints())
    return reduce(
        DataFrame.unionByName,
        [
            found.select(F.lit(table).alias("table_name"), "constraint", c.VIOLATIONS)
            for table, found in audits.items()
        ],
    )
