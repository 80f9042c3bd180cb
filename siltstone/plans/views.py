"""The five analytical views over the star.

Facts are aggregated to the grain of one dimension key before they meet that
dimension, so joins move grouped rows and a hot key is folded inside each task.
Because a group then stands for one distinct player, distinct players are
plain counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.numbers import CENTS, ratio, ratio_sql
from siltstone.plans.layers import Gold
from siltstone.sources.tables import Store

MONTH = ("year", "month", "month_name")


def sales_and_amount() -> list[Column]:
    """Number of sales as ``n`` and their total as ``amount``."""
    return [F.count(F.lit(1)).alias("n"), F.sum("total_rp").alias("amount")]


def mean(total: Column, count: Column) -> Column:
    return total.cast("double") / count


def revenue_by_segment_month(star: Gold) -> DataFrame:
    per_player = (
        dated_facts(star, *MONTH).groupBy("player_key", *MONTH).agg(*sales_and_amount())
    )
    return (
        per_player.join(star.dim_player.select("player_key", "player_segment"), "player_key")
        .groupBy("player_segment", *MONTH)
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("amount").alias("total_revenue"),
            mean(F.sum("amount"), F.sum("n")).alias("avg_transaction"),
            F.count("player_key").alias("unique_players"),
        )
        .orderBy("year", "month", "player_segment")
    )


def top_selling_skins(star: Gold) -> DataFrame:
    per_skin = (
        star.fact_sales.groupBy("skin_key", "player_key")
        .agg(*sales_and_amount())
        .groupBy("skin_key")
        .agg(
            F.sum("n").alias("times_purchased"),
            F.sum("amount").alias("total_revenue"),
            F.count("player_key").alias("unique_buyers"),
        )
    )
    skin = ("skin_id", "champion_name", "skin_name", "rarity", "price_rp")
    return (
        per_skin.join(star.dim_skin.select("skin_key", *skin), "skin_key")
        .select(*skin, "times_purchased", "total_revenue", "unique_buyers")
        .orderBy(F.desc_nulls_first("total_revenue"), "skin_id")
    )


def weekend_vs_weekday_sales(star: Gold) -> DataFrame:
    return (
        dated_facts(star, "is_weekend")
        .groupBy("is_weekend")
        .agg(*sales_and_amount())
        .select(
            F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
            F.col("n").alias("transaction_count"),
            F.col("amount").alias("total_revenue"),
            mean(F.col("amount"), F.col("n")).alias("avg_transaction"),
        )
        .orderBy("day_type")
    )


def player_lifetime_value(star: Gold) -> DataFrame:
    per_player = (
        dated_facts(star, "date")
        .groupBy("player_key")
        .agg(
            *sales_and_amount(),
            F.min("date").alias("first_purchase_date"),
            F.max("date").alias("last_purchase_date"),
        )
    )
    player = ("player_key", "player_id", "player_segment", "region")
    return (
        per_player.join(star.dim_player.select(*player), "player_key")
        .select(
            *player,
            F.col("n").alias("total_purchases"),
            F.col("amount").alias("lifetime_value"),
            mean(F.col("amount"), F.col("n")).alias("avg_purchase_value"),
            "first_purchase_date",
            "last_purchase_date",
            F.datediff("last_purchase_date", "first_purchase_date").alias("purchase_span_days"),
        )
        .orderBy(F.desc_nulls_first("lifetime_value"), "player_id")
    )


def revenue_trends(star: Gold) -> DataFrame:
    players = F.count_distinct("player_key")
    return (
        dated_facts(star, *MONTH)
        .groupBy(*MONTH)
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("total_rp").alias("revenue"),
            mean(F.sum("total_rp"), F.count("total_rp")).alias("avg_transaction"),
            players.alias("active_players"),
            ratio(F.sum("total_rp"), players, kind=CENTS).alias("revenue_per_player"),
        )
        .orderBy("year", "month")
    )


def dated_facts(star: Gold, *columns: str) -> DataFrame:
    """Facts with calendar columns; the calendar is small enough to be broadcast."""
    return star.fact_sales.join(star.dim_date.select("date_key", *columns), "date_key")


VIEWS = {
    "revenue_by_segment_month": (revenue_by_segment_month, "Monthly revenue by segment"),
    "top_selling_skins": (top_selling_skins, "Best selling skins by revenue"),
    "weekend_vs_weekday_sales": (weekend_vs_weekday_sales, "Weekend against working days"),
    "player_lifetime_value": (player_lifetime_value, "Total spending per player"),
    "revenue_trends": (revenue_trends, "Monthly revenue and key figures"),
}

# The same views as text over the tables of a database: what the catalog keeps.
# They fold facts before they meet a dimension, as the functions above do.
VIEW_SQL = {
    "revenue_by_segment_month": """
        SELECT player_segment, year, month, month_name, sum(n) AS transaction_count,
          sum(amount) AS total_revenue, CAST(sum(amount) AS DOUBLE) / sum(n) AS avg_transaction,
          count(player_key) AS unique_players
        FROM (SELECT player_key, year, month, month_name, count(*) AS n, sum(total_rp) AS amount
              FROM {fact_sales} JOIN {dim_date} USING (date_key)
              GROUP BY player_key, year, month, month_name)
        JOIN {dim_player} USING (player_key)
        GROUP BY player_segment, year, month, month_name
        ORDER BY year, month, player_segment""",
    "top_selling_skins": """
        SELECT skin_id, champion_name, skin_name, rarity, price_rp, times_purchased, total_revenue, unique_buyers
        FROM (SELECT skin_key, sum(n) AS times_purchased, sum(amount) AS total_revenue,
                count(player_key) AS unique_buyers
              FROM (SELECT skin_key, player_key, count(*) AS n, sum(total_rp) AS amount
                    FROM {fact_sales} GROUP BY skin_key, player_key)
              GROUP BY skin_key)
        JOIN {dim_skin} USING (skin_key)
        ORDER BY total_revenue DESC NULLS FIRST, skin_id""",
    "weekend_vs_weekday_sales": """
        SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
          count(*) AS transaction_count, sum(total_rp) AS total_revenue,
          CAST(sum(total_rp) AS DOUBLE) / count(*) AS avg_transaction
        FROM {fact_sales} JOIN {dim_date} USING (date_key)
        GROUP BY is_weekend
        ORDER BY day_type""",
    "player_lifetime_value": """
        SELECT player_key, player_id, player_segment, region, n AS total_purchases, amount AS lifetime_value,
          CAST(amount AS DOUBLE) / n AS avg_purchase_value, first_purchase_date, last_purchase_date,
          datediff(last_purchase_date, first_purchase_date) AS purchase_span_days
        FROM (SELECT player_key, count(*) AS n, sum(total_rp) AS amount, min(date) AS first_purchase_date,
                max(date) AS last_purchase_date
              FROM {fact_sales} JOIN {dim_date} USING (date_key) GROUP BY player_key)
        JOIN {dim_player} USING (player_key)
        ORDER BY lifetime_value DESC NULLS FIRST, player_id""",
    "revenue_trends": f"""
        SELECT year, month, month_name, transactions, revenue,
          CAST(revenue AS DOUBLE) / priced AS avg_transaction, active_players,
          {ratio_sql("revenue", "active_players", kind=CENTS)} AS revenue_per_player
        FROM (SELECT year, month, month_name, count(*) AS transactions, sum(total_rp) AS revenue,
                count(total_rp) AS priced, count(DISTINCT player_key) AS active_players
              FROM {{fact_sales}} JOIN {{dim_date}} USING (date_key) GROUP BY year, month, month_name)
        ORDER BY year, month""",
}


def create_views(star: Gold, store: Store | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """Register every view and return them.

    Each becomes a temporary view of the session. With a ``store`` it also becomes
    a view of the gold database over its published tables, with its comment, so
    any session that knows the catalog finds it.
    """
    views = {}
    for name, (build, comment) in VIEWS.items():
        view = build(star)
        view.createOrReplaceTempView(prefix + name)
        if store:
            tables = {table: store.name("gold", table) for table in star.TABLES}
            store.create_view("gold", name, VIEW_SQL[name].format(**tables), comment)
        views[name] = view
    return views


def view_catalog(store: Store) -> DataFrame:
    """(view_name, comment, n_columns) of the analytical views in the catalog."""
    rows = []
    for name in VIEWS:
        described = store.spark.catalog.getTable(store.name("gold", name))
        if described.tableType == "VIEW":
            rows.append((name, described.description, len(store.read("gold", name).columns)))
    return store.spark.createDataFrame(rows, "view_name string, comment string, n_columns int")
