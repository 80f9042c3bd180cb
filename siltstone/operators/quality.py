"""Quarantine and monitoring of the sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import guarded_date
from siltstone.functions.numbers import count_where, percent, round_to_long
from siltstone.operators.facts import STAGED
from siltstone.rules import Rules

COPIES = "copies"


#: How many staged rows share the transaction id of a fact row.
ID_ROWS = "id_rows"


def quarantine(fact: DataFrame) -> DataFrame:
    """Rejected sales with their values *as staged* and the reason.

    Fact and staging belong together by ``transaction_id``. The fact carries the
    staged values and how many rows share its id (:func:`with_id_rows`), so a sale
    whose id was staged once is reported as it stands, without a join.

    Where an id was staged several times, every staged row belongs to every
    rejected fact row of that id. Each staged row is a fact row, too, so only the
    fact's rows of such ids meet each other. To keep that product from being
    spelled out, rejected rows are counted per (id, reason) first: the result has
    one row per staged row and reason, and ``copies`` says how many times it
    counts. For an id staged once it is 1.
    """
    once = fact.where(~F.col("is_valid") & (F.col(ID_ROWS) == 1)).select(
        "transaction_id", STAGED, F.col("dq_issues").alias("rejection_reason"), F.lit(1).cast("long").alias(COPIES)
    )
    often = fact.where(F.col(ID_ROWS) > 1)
    rejected = _reasons(often)
    several = often.join(rejected, F.col("transaction_id") == F.col("_id")).select(
        "transaction_id", STAGED, "rejection_reason", COPIES
    )
    return once.union(several).select(
        round_to_long(F.col("transaction_id")).alias("transaction_id"), f"{STAGED}.*", "rejection_reason", COPIES
    )


def quarantine_from_staging(fact: DataFrame, stg_sales: DataFrame) -> DataFrame:
    """As :func:`quarantine`, for a fact loaded elsewhere, which doesn't carry the staged values."""
    return stg_sales.join(_reasons(fact), F.col("transaction_id") == F.col("_id")).select(
        round_to_long(F.col("transaction_id")).alias("transaction_id"),
        round_to_long(F.col("player_id")).alias("player_id"),
        round_to_long(F.col("skin_id")).alias("skin_id"),
        guarded_date(F.col("purchase_date")).alias("purchase_date"),
        round_to_long(F.col("price_rp")).alias("price_rp"),
        round_to_long(F.col("quantity")).alias("quantity"),
        "rejection_reason",
        COPIES,
    )


def with_id_rows(fact: DataFrame, stg_sales: DataFrame) -> DataFrame:
    """``fact`` with the number of staged rows of its transaction id.

    Ids are counted in staging, a narrow scan, and only those that repeat meet
    the fact. A stored fact has the number already, from being numbered.
    """
    if ID_ROWS in fact.columns:
        return fact
    repeated = (
        stg_sales.where(F.col("transaction_id").isNotNull())
        .groupBy(F.col("transaction_id").alias("_id"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
    )
    joined = fact.join(repeated, F.col("transaction_id") == F.col("_id"), "left")
    return joined.withColumn(ID_ROWS, F.coalesce("_rows", F.lit(1).cast("long"))).drop("_id", "_rows")


def _reasons(fact: DataFrame) -> DataFrame:
    """(_id, rejection_reason, copies) of rejected rows."""
    return (
        fact.where(~F.col("is_valid"))
        .groupBy(F.col("transaction_id").alias("_id"), F.col("dq_issues").alias("rejection_reason"))
        .agg(F.count(F.lit(1)).alias(COPIES))
    )


def reason_counts(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per reason."""
    return quarantined.groupBy("rejection_reason").agg(F.sum(COPIES).alias("count"))


def monitor(fact: DataFrame, rules: Rules, table_name: str = "fact_sale") -> DataFrame:
    """The five quality metrics of a fact, from one aggregation over it.

    ``issue_pct`` and ``alert_triggered`` are NULL for an empty fact.
    """
    metrics: list[tuple[str, Column]] = [
        ("missing_player", F.col("player_key").isNull()),
        ("missing_skin", F.col("skin_key").isNull()),
        ("invalid_price", F.col("price_rp").isNull() | (F.col("price_rp") <= 0)),
        ("invalid_quantity", F.col("quantity").isNull() | (F.col("quantity") <= 0)),
        ("total_invalid", ~F.col("is_valid")),
    ]
    totals = fact.agg(
        F.count(F.lit(1)).alias("_total"),
        *[count_where(cond).alias(name) for name, cond in metrics],
    )
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("log_id"),
            F.lit(name).alias("issue_type"),
            F.col(name).alias("issue_count"),
        )
        for i, (name, _) in enumerate(metrics, start=1)
    ]
    pct = F.col("issue_pct")
    return (
        totals.select("_total", F.inline(F.array(*rows)))
        .withColumn("issue_pct", percent(F.col("issue_count"), F.col("_total")).cast("decimal(5,2)"))
        .select(
            "log_id",
            F.current_timestamp().alias("run_timestamp"),
            F.lit(table_name).alias("table_name"),
            "issue_type",
            "issue_count",
            "issue_pct",
            F.lit(rules.alert_threshold_pct).cast("decimal(5,2)").alias("threshold_pct"),
            (pct > F.lit(rules.alert_threshold_pct)).alias("alert_triggered"),
        )
    )
