"""The warehouse as stored tables: every layer written, checked and commented.

A build is a full refresh. Each table is written once, beside the published one,
and the steps after it read the written table; tables that don't read each other
are written at the same time. When all are there, the public names are switched
to them. A build that stops leaves the warehouse of the last
one whole, and repeating it under its run id replaces what it had written. Rows
that break a declared constraint are handled as ``rules.on_violation`` says; with
``quarantine`` they end up in a table named ``<table>_rejected`` next to the one
they were meant for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import constraints as c
from siltstone.operators.facts import STAGED
from siltstone.operators.keys import dense_key, ordered_key
from siltstone.operators.quality import ID_ROWS
from siltstone.plans import layers
from siltstone.plans.layers import GOLD_PARTS, Bronze, Gold, Silver
from siltstone.plans.views import create_views
from siltstone.rules import Rules
from siltstone.runtime import passing_scratch
from siltstone.sources.tables import RUN, Run, Store

COMMENTS = {
    "stg_skins": "Skins as delivered",
    "stg_players": "Players as delivered",
    "stg_sales": "Sales as delivered, faulty rows included",
    "dim_date": "Calendar",
    "dim_skin": "Skins",
    "dim_player": "Players",
    "fact_sale": "Sales, cleansed and judged",
    "fact_sale_quarantine": "Rejected sales with the values as staged; copies counts repeats",
    "data_quality_log": "Quality metrics of each run",
    "fact_sales": "Valid sales",
}

LOG = "data_quality_log"
SILVER_KEY = "sale_key"
# Gold sales lie in partitions of a month and are sorted in this order, so scans
# filtered by month open few files, and those filtered by date few row groups.
# The key comes last: it is unique, so even a large group of sales can be split.
FACT_ORDER = ("date_key", "player_key", "transaction_id", "sale_key")


@dataclass(frozen=True)
class Warehouse:
    bronze: Bronze
    silver: Silver
    gold: Gold


def build(
    spark: SparkSession,
    staged: Bronze,
    rules: Rules,
    store: Store,
    keep_log: bool = False,
    run_id: str | None = None,
) -> Warehouse:
    """Refresh all layers from ``staged``, publish them and register the views.

    ``keep_log`` adds this run's metrics to the log instead of replacing it. A
    build that is repeated passes the same ``run_id`` again.
    """
    with passing_scratch(spark):
        run = _Build(store.run(run_id), rules, keep_log)
        bronze = layers.bronze(
            {name: (lambda df=df: df) for name, df in staged.tables().items()}, run.settle_bronze
        )
        run.bronze = bronze
        silver = layers.silver(spark, bronze, rules, run.settle_silver, run.check_dimension)
        gold = layers.gold(silver, rules, run.settle_gold, run.judge_gold)
        layers.settle_all(spark, bronze, silver, gold)
        keep_metrics(store, run.run.run_id, silver.data_quality_log, keep_log)
    run.run.publish(last=("gold", "fact_sales"))
    built = open_warehouse(store)
    create_views(built.gold, store)
    return built


def open_warehouse(store: Store) -> Warehouse:
    """The stored layers of the last build that was published, also from a new session.

    All tables are those of one run: the one that the table published last shows.
    """
    run_id = store.published("gold", "fact_sales")
    if run_id is None:
        raise ValueError("no warehouse has been published here")

    def stored(layer: type[layers.Layer], name: str):
        tables = {t: (lambda t=t: store.read_run(name, t, run_id)) for t in layer.TABLES if t != LOG}
        if LOG in layer.TABLES:
            tables[LOG] = lambda: store.read(name, LOG)
        return layer(**tables)

    gold = stored(Gold, "gold")
    gold.parts = lambda table: store.partitions("gold", table, run_id)
    return Warehouse(stored(Bronze, "bronze"), stored(Silver, "silver"), gold)


def keyed_facts(fact: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """Silver sales numbered 1..n in the order of their ids, and how many share one.

    ``staged`` is counted in place of the fact: each staged sale with an id is one
    row of it. Staged values stay only where quarantine may ask for them.
    """
    numbered = ordered_key(fact, "transaction_id", SILVER_KEY, ID_ROWS, staged)
    if STAGED not in fact.columns:
        return numbered
    needed = ~F.col("is_valid") | (F.col(ID_ROWS) > 1)
    return numbered.withColumn(STAGED, F.when(needed, F.col(STAGED)))


def keep_metrics(store: Store, run_id: str, metrics: DataFrame, keep: bool = True) -> DataFrame:
    """A run's metrics into the log, numbered after those of all other runs.

    A run that is repeated replaces its rows; without ``keep`` all others go.
    """
    earlier = store.history("silver", LOG) if keep else None
    last = 0
    if earlier is not None:
        last = earlier.where(F.col(RUN) != run_id).agg(F.coalesce(F.max("log_id"), F.lit(0))).first()[0]
    numbered = metrics.withColumn("log_id", F.col("log_id") + last)
    return store.append("silver", LOG, numbered, run_id, COMMENTS[LOG], keep)


class _Build:
    def __init__(self, run: Run, rules: Rules, keep_log: bool) -> None:
        self.run = run
        self.rules = rules
        self.keep_log = keep_log
        self.bronze: Bronze | None = None

    def settle_bronze(self, name: str, df: DataFrame) -> DataFrame:
        rules = layers.stg_constraints(self.rules).get(name, [])
        return self._refresh("bronze", name, self._checked("bronze", name, df, rules), "loaded_at")

    def check_dimension(self, name: str, df: DataFrame) -> DataFrame:
        rules = {"dim_skin": layers.dim_skin_constraints, "dim_player": layers.dim_player_constraints}
        return self._checked("silver", name, df, rules[name](self.rules))

    def settle_silver(self, name: str, df: DataFrame) -> DataFrame:
        if name == "fact_sale":
            return self._refresh("silver", name, keyed_facts(df, self.bronze.stg_sales), "created_at")
        if name == "fact_sale_quarantine":
            df = self._checked("silver", name, df, layers.quarantine_constraints())
            numbered = ordered_key(df, "transaction_id", "quarantine_id")
            return self._refresh("silver", name, numbered, "rejection_timestamp")
        if name == LOG:
            df = self._checked("silver", name, df, layers.log_constraints())
            return self.run.refresh("silver", f"{LOG}_of_run", df, "Quality metrics of this run")
        if name == "dim_date":
            df = self._checked("silver", name, df, layers.dim_date_constraints())
        return self._refresh("silver", name, df, "created_at")

    def settle_gold(self, name: str, df: DataFrame) -> DataFrame:
        # Gold dimensions are rows of checked silver ones; only facts can break.
        if name != "fact_sales":
            return self._refresh("gold", name, df, "created_at")
        numbered = dense_key(df, SILVER_KEY, "_gold_key").drop(SILVER_KEY)
        facts = numbered.withColumnRenamed("_gold_key", "sale_key").withColumns(layers.gold_parts())
        order = [*GOLD_PARTS, *FACT_ORDER]
        placed = facts.repartitionByRange(*order).sortWithinPartitions(*order)
        return self._refresh("gold", name, placed, "created_at", GOLD_PARTS)

    def judge_gold(self, silver: Silver) -> DataFrame:
        judged = layers.gold_facts_judged(silver, self.rules, SILVER_KEY)
        return self._kept("gold", "fact_sales", judged)

    def _checked(self, layer, name, df, rules) -> DataFrame:
        if not rules:
            return df
        return self._kept(layer, name, c.enforce(df, rules, self.rules.on_violation))

    def _kept(self, layer: str, name: str, judged: c.Enforced) -> DataFrame:
        if self.rules.on_violation == "quarantine":
            self.run.refresh(layer, f"{name}_rejected", judged.rejected, "Rows breaking constraints")
        return judged.kept

    def _refresh(self, layer: str, name: str, df: DataFrame, stamp: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        stamped = df if stamp in df.columns else df.withColumn(stamp, F.current_timestamp())
        return self.run.refresh(layer, name, stamped, COMMENTS[name], partition_by)
