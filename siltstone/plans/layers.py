"""The three layers as lazy DataFrames.

Each layer is a set of logical plans over the one below; only the policy
``fail`` runs a job, to find out whether there is anything to fail for. :mod:`siltstone.plans.warehouse` writes them and enforces constraints.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import rules as fixed
from siltstone.functions.numbers import round_to_long
from siltstone.operators import constraints as c
from siltstone.operators.calendar import CALENDAR_COLUMNS, calendar
from siltstone.operators.dims import load_players, load_skins
from siltstone.operators.facts import PLAYER_VALID, SKIN_VALID, clean_facts, load_facts
from siltstone.operators.keys import dense_key
from siltstone.operators.quality import monitor, quarantine, with_id_rows
from siltstone.rules import Rules
from siltstone.runtime import durable

_SKIN = (
    "skin_key",
    "skin_id",
    "champion_name",
    "skin_name",
    "rarity",
    "price_rp",
    "release_date",
    "champion_id",
    "skin_num",
)
_PLAYER = (
    "player_key",
    "player_id",
    "region",
    "account_created_date",
    "player_segment",
    "account_age_days",
)


class Layer:
    """Named tables, each given as a DataFrame or as a function that plans it.

    A function is called when its table is first asked for, so a report plans
    only the tables it reads. Threads that ask for a table being planned wait.
    """

    TABLES: tuple[str, ...] = ()

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]) -> None:
        if set(tables) != set(self.TABLES):
            raise ValueError(f"{type(self).__name__} has the tables {self.TABLES}")
        self._tables = tables
        self._locks = {name: threading.RLock() for name in tables}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in type(self).TABLES:
            raise AttributeError(name)
        with self._locks[name]:
            table = self._tables[name]
            if callable(table):
                table = self._tables[name] = table()
        return table

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.TABLES}


def settle_all(spark: SparkSession, *layers: Layer) -> None:
    """Ask for every table of ``layers``, each in a thread of its own.

    A table waits for those it reads, and for no other: a small one is written
    beside a large one instead of leaving most cores idle. All threads have ended
    when this returns; of several errors, that of the first table is raised.
    """
    asked = [(layer, name) for layer in layers for name in layer.TABLES]
    with ThreadPoolExecutor(len(asked)) as pool:
        running = [
            pool.submit(inheritable_thread_target(spark)(copy_context().run), getattr, layer, name)
            for layer, name in asked
        ]
    for table in running:
        table.result()


class Bronze(Layer):
    TABLES = ("stg_skins", "stg_players", "stg_sales")


class Silver(Layer):
    TABLES = (
        "dim_date",
        "dim_skin",
        "dim_player",
        "fact_sale",
        "fact_sale_quarantine",
        "data_quality_log",
    )


class Gold(Layer):
    """The star. ``parts`` lists a stored table's partition values; None where nothing is stored."""

    TABLES = ("dim_date", "dim_skin", "dim_player", "fact_sales")
    parts: Callable[[str], list[dict[str, str]]] | None = None


# The partitions of stored gold facts: the month of the sale.
GOLD_PARTS = ("sale_year", "sale_month")


def gold_parts() -> dict[str, Column]:
    key = F.col("date_key")
    month = F.floor(key / 100).cast("int")
    return {"sale_year": F.floor(month / 100).cast("int"), "sale_month": (month % 100).cast("int")}


Settle = Callable[[str, DataFrame], DataFrame]


def as_planned(name: str, df: DataFrame) -> DataFrame:
    return df


def same(df: DataFrame) -> DataFrame:
    return df


def durable_tables(*names: str) -> Settle:
    """Settle the named tables by writing them once to the shared scratch folder.

    For tables several later steps read. Their size is then known, so Spark's
    choice between broadcast and shuffle rests on it rather than on a guess.
    """
    return lambda name, df: durable(df, name) if name in names else df


def _settled(planned: dict[str, Callable[[], DataFrame]], settle: Settle):
    return {name: lambda n=name, plan=plan: settle(n, plan()) for name, plan in planned.items()}


def bronze(planned: dict[str, Callable[[], DataFrame]], settle: Settle = as_planned) -> Bronze:
    return Bronze(**_settled(planned, settle))


def silver_fact_load(bronze: Bronze, silver: Silver) -> DataFrame:
    """Staged sales keyed to the dimensions, before cleansing."""
    return load_facts(bronze.stg_sales, silver.dim_player, silver.dim_skin)


def silver(
    spark: SparkSession,
    bronze: Bronze,
    rules: Rules,
    settle: Settle = as_planned,
    check: Settle = as_planned,
) -> Silver:
    """The layer over ``bronze``.

    ``settle`` gets every table by name as it is planned, and returns what the
    steps after it read: the plan itself, or the table it has written.
    ``check`` gets dimension rows before they are keyed, as keys need ids to be
    unique, and returns the rows to key.
    """

    def keyed(name: str, loaded: DataFrame, id_col: str, key_col: str) -> DataFrame:
        return dense_key(check(name, loaded), id_col, key_col)

    planned = {
        "dim_date": lambda: calendar(spark, rules.calendar_start, rules.calendar_end),
        "dim_skin": lambda: keyed(
            "dim_skin", load_skins(bronze.stg_skins, rules), "skin_id", "skin_key"
        ),
        "dim_player": lambda: keyed(
            "dim_player", load_players(bronze.stg_players, rules), "player_id", "player_key"
        ),
        "fact_sale": lambda: clean_facts(silver_fact_load(bronze, layer), layer.dim_date),
        "fact_sale_quarantine": lambda: quarantine(with_id_rows(layer.fact_sale, bronze.stg_sales)),
        "data_quality_log": lambda: monitor(layer.fact_sale, rules),
    }
    layer = Silver(**_settled(planned, settle))
    return layer


def gold_dims(silver: Silver) -> dict[str, Callable[[], DataFrame]]:
    """The calendar as it is; skins and players that are valid, keys kept."""
    return {
        "dim_date": lambda: silver.dim_date.select(*CALENDAR_COLUMNS),
        "dim_skin": lambda: silver.dim_skin.where("is_valid").select(*_SKIN),
        "dim_player": lambda: silver.dim_player.where("is_valid").select(*_PLAYER),
    }


def gold_facts(silver: Silver, *more: str) -> DataFrame:
    """Valid sales as whole numbers, each column rounded on its own.

    ``more`` names columns of the silver fact to carry along.
    """
    return silver.fact_sale.where("is_valid").select(
        round_to_long(F.col("transaction_id")).alias("transaction_id"),
        "player_key",
        "skin_key",
        "date_key",
        round_to_long(F.col("price_rp")).alias("price_rp"),
        round_to_long(F.col("quantity")).alias("quantity"),
        round_to_long(F.col("total_rp")).alias("total_rp"),
        *more,
    )


def gold_facts_judged(silver: Silver, rules: Rules, *more: str) -> c.Enforced:
    """Gold facts under the policy for rows that break a gold constraint.

    A valid sale may point at an invalid dimension row, which gold does not
    hold; rounding may also turn a price into 0. The validity of the dimension
    rows came with the fact, so nothing is joined here.
    """
    facts = gold_facts(silver, *more, PLAYER_VALID, SKIN_VALID)
    judged = c.enforce(facts, gold_load_constraints(), rules.on_violation)
    return c.Enforced(*(df.drop(PLAYER_VALID, SKIN_VALID) for df in (judged.kept, judged.rejected)))


def gold(
    silver: Silver,
    rules: Rules,
    settle: Settle = as_planned,
    facts: Callable[[Silver], DataFrame] | None = None,
) -> Gold:
    """The star over ``silver``.

    With the policy ``fail`` a job looks for breaks when the facts are first
    asked for; the other policies plan only.
    """
    facts = facts or (lambda s: gold_facts_judged(s, rules).kept)
    return Gold(**_settled(gold_dims(silver) | {"fact_sales": lambda: facts(silver)}, settle))


# Declared constraints -------------------------------------------------------


def dim_date_constraints() -> list[c.Constraint]:
    return [
        *c.not_null(*CALENDAR_COLUMNS),
        *c.max_length({"month_name": 20, "day_name": 20}),
        c.Unique("date_key"),
        c.Unique("date"),
    ]


def dim_skin_constraints(rules: Rules) -> list[c.Constraint]:
    return [
        *c.not_null("skin_id", "champion_name", "skin_name", "rarity", "price_rp"),
        *c.max_length(
            {
                "champion_name": fixed.NAME_LENGTH,
                "skin_name": fixed.SKIN_NAME_LENGTH,
                "rarity": fixed.RARITY_LENGTH,
                "champion_id": fixed.NAME_LENGTH,
            }
        ),
        c.Check("price_not_negative", F.col("price_rp") >= 0),
        c.one_of("rarity", rules.rarities),
        c.Unique("skin_id"),
    ]


def dim_player_constraints(rules: Rules) -> list[c.Constraint]:
    return [
        *c.not_null("player_id", "region", "account_created_date", "player_segment"),
        *c.max_length({"region": rules.region_length, "player_segment": fixed.SEGMENT_LENGTH}),
        c.one_of("region", rules.regions),
        c.one_of("player_segment", rules.segments),
        c.Unique("player_id"),
    ]


def stg_constraints(rules: Rules) -> dict[str, list[c.Constraint]]:
    return {
        "stg_skins": c.max_length(
            {
                "champion_name": fixed.NAME_LENGTH,
                "skin_name": fixed.SKIN_NAME_LENGTH,
                "rarity": fixed.RARITY_LENGTH,
                "champion_id": fixed.NAME_LENGTH,
                "skin_name_norm": fixed.SKIN_NAME_LENGTH,
            }
        ),
        "stg_players": c.max_length(
            {"region": rules.region_length, "player_segment": fixed.SEGMENT_LENGTH}
        ),
    }


def silver_fact_constraints() -> list[c.Constraint]:
    """Of sales that have been keyed."""
    return [*c.not_null("sale_key"), c.Unique("sale_key")]


def quarantine_constraints(keyed: bool = False) -> list[c.Constraint]:
    """The key is declared, too, but given last, to the rows that are kept."""
    key = [*c.not_null("quarantine_id"), c.Unique("quarantine_id")] if keyed else []
    return [*c.max_length({"rejection_reason": fixed.REASON_LENGTH}), *key]


def log_constraints() -> list[c.Constraint]:
    return [
        *c.max_length({"table_name": fixed.LOG_LENGTH, "issue_type": fixed.LOG_LENGTH}),
        c.Unique("log_id"),
    ]


def gold_fact_checks() -> list[c.Check]:
    return [
        *c.not_null("player_key", "skin_key", "date_key", "price_rp", "quantity", "total_rp"),
        c.Check("quantity_positive", F.col("quantity") > 0),
        c.Check("price_positive", F.col("price_rp") > 0),
        c.Check("total_is_product", F.col("total_rp") == F.col("price_rp") * F.col("quantity")),
    ]


def gold_load_constraints() -> list[c.Constraint]:
    """What :func:`gold_fact_constraints` asks for, of facts that carry validity.

    Valid sales carry keys of silver dimensions and dates of the calendar, so a
    key is missing from gold exactly if its silver row is invalid.
    """
    return [
        *gold_fact_checks(),
        c.Check("fk_player_key", F.col(PLAYER_VALID)),
        c.Check("fk_skin_key", F.col(SKIN_VALID)),
    ]


def gold_fact_constraints(keyed: bool = False) -> list[c.Constraint]:
    return [
        *gold_fact_checks(),
        *([*c.not_null("sale_key"), c.Unique("sale_key")] if keyed else []),
        c.ForeignKey("player_key", "dim_player", "player_key"),
        c.ForeignKey("skin_key", "dim_skin", "skin_key"),
        c.ForeignKey("date_key", "dim_date", "date_key"),
    ]
