"""Rows of the skin and player dimensions, before they get a surrogate key.

Each function loads every staged row that has an id and flags it valid or not.
A test that meets NULL does not count against the row, as in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import is_blank
from siltstone.rules import Rules


def load_skins(stg_skins: DataFrame, rules: Rules) -> DataFrame:
    faults = [
        is_blank(F.col("champion_name")),
        is_blank(F.col("skin_name")),
        F.col("price_rp") < 0,
        ~F.col("rarity").isin(*rules.rarities),
    ]
    return stg_skins.where(F.col("skin_id").isNotNull()).select(
        "skin_id",
        F.trim("champion_name").alias("champion_name"),
        F.trim("skin_name").alias("skin_name"),
        "rarity",
        "price_rp",
        "release_date",
        "champion_id",
        "skin_num",
        _no_fault(faults).alias("is_valid"),
    )


def load_players(stg_players: DataFrame, rules: Rules) -> DataFrame:
    """Region and segment are stored normalised but judged as staged."""
    faults = [
        ~F.col("region").isin(*rules.regions),
        ~F.col("player_segment").isin(*rules.segments),
        F.col("account_created_date") > rules.today(),
    ]
    return stg_players.where(F.col("player_id").isNotNull()).select(
        "player_id",
        F.upper(F.trim("region")).alias("region"),
        "account_created_date",
        F.lower(F.trim("player_segment")).alias("player_segment"),
        F.datediff(rules.today(), "account_created_date").alias("account_age_days"),
        _no_fault(faults).alias("is_valid"),
    )


def _no_fault(faults: list[Column]) -> Column:
    return ~reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in faults])
