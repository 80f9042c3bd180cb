"""The sales fact: load, repair, tag and validate.

Each step is one derivation of columns, so the chain ends up in a single
projection over one pass of the joined rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import date_key, guarded_date
from siltstone.functions.numbers import round_to_long
from siltstone.functions.text import append_tag, is_empty, tag_list
from siltstone.operators.lookups import lookup, with_membership
from siltstone.schemas import FACT_COLUMNS, MONEY

LIST_PRICE = "list_price"
# Whether the dimension rows a sale points at are valid; NULL without a row.
PLAYER_VALID, SKIN_VALID = "player_valid", "skin_valid"

# The values as staged, which quarantine reports.
STAGED = "staged"

# The tags written to dq_issues, in the order they are written.
PRICE_FIXED = "price_fixed"
TOTAL_RECALCULATED = "total_recalculated"
MISSING_PLAYER = "missing_player"
MISSING_SKIN = "missing_skin"
MISSING_PRICE = "missing_price"
NEGATIVE_PRICE = "negative_price"
MISSING_QUANTITY = "missing_quantity"
INVALID_QUANTITY = "invalid_quantity"
INVALID_DATE = "invalid_date"


def load_facts(stg_sales: DataFrame, dim_player: DataFrame, dim_skin: DataFrame) -> DataFrame:
    """Staged sales with a transaction id, keyed to the dimensions.

    The skin's list price travels along as ``list_price``, and the validity of
    both dimension rows, so neither the price repair nor the gold load needs a
    second join with a dimension. So do the staged values, read as whole numbers
    and a date, as one struct ``staged``: quarantine needs no second look at
    staging.
    """
    # The date is parsed once, in a projection of its own, before rows move.
    sales = stg_sales.where(F.col("transaction_id").isNotNull()).select(
        "transaction_id",
        "player_id",
        "skin_id",
        guarded_date(F.col("purchase_date")).alias("_day"),
        "price_rp",
        "quantity",
    )
    staged = F.struct(
        round_to_long(F.col("player_id")).alias("player_id"),
        round_to_long(F.col("skin_id")).alias("skin_id"),
        F.col("_day").alias("purchase_date"),
        round_to_long(F.col("price_rp")).alias("price_rp"),
        round_to_long(F.col("quantity")).alias("quantity"),
    )
    players = dim_player.select(
        "player_key",
        F.col("player_id").alias("_dim_player_id"),
        F.col("is_valid").alias(PLAYER_VALID),
    )
    skins = dim_skin.select(
        "skin_key",
        F.col("skin_id").alias("_dim_skin_id"),
        F.col("price_rp").alias(LIST_PRICE),
        F.col("is_valid").alias(SKIN_VALID),
    )
    keyed = lookup(sales, players, round_to_long(F.col("player_id")), "_dim_player_id")
    keyed = lookup(keyed, skins, round_to_long(F.col("skin_id")), "_dim_skin_id")
    return keyed.select(
        "transaction_id",
        "player_key",
        "skin_key",
        date_key(F.col("_day")).alias("date_key"),
        "price_rp",
        "quantity",
        (F.col("price_rp") * F.col("quantity")).alias("total_rp"),
        F.lit(False).alias("is_valid"),
        F.lit(None).cast("string").alias("dq_issues"),
        F.col(LIST_PRICE).cast(MONEY).alias(LIST_PRICE),
        PLAYER_VALID,
        SKIN_VALID,
        staged.alias(STAGED),
    )


def attach_list_price(fact: DataFrame, dim_skin: DataFrame) -> DataFrame:
    """Add ``list_price`` to a fact that was not loaded by :func:`load_facts`."""
    prices = dim_skin.select(
        F.col("skin_key").alias("_dim_skin_key"), F.col("price_rp").cast(MONEY).alias(LIST_PRICE)
    )
    return lookup(fact, prices, F.col("skin_key"), "_dim_skin_key")


def repair_price(fact: DataFrame) -> DataFrame:
    """Fill a missing price from the list where quantity and list price allow it."""
    fixed = F.col("_fixed")
    return (
        fact.withColumn(
            "_fixed",
            F.col("price_rp").isNull() & (F.col("quantity") > 0) & (F.col(LIST_PRICE) > 0),
        )
        .withColumns(
            {
                "price_rp": F.when(fixed, F.col(LIST_PRICE)).otherwise(F.col("price_rp")),
                "total_rp": F.when(fixed, F.col(LIST_PRICE) * F.col("quantity")).otherwise(
                    F.col("total_rp")
                ),
                "dq_issues": F.when(fixed, append_tag(F.col("dq_issues"), PRICE_FIXED)).otherwise(
                    F.col("dq_issues")
                ),
            }
        )
        .drop("_fixed", LIST_PRICE)
    )


def recompute_total(fact: DataFrame) -> DataFrame:
    """Replace a missing or wrong total where price and quantity are positive."""
    product = F.col("price_rp") * F.col("quantity")
    wrong = F.col("_wrong")
    return (
        fact.withColumn(
            "_wrong",
            (F.col("price_rp") > 0)
            & (F.col("quantity") > 0)
            & ~F.col("total_rp").eqNullSafe(product),
        )
        .withColumns(
            {
                "total_rp": F.when(wrong, product).otherwise(F.col("total_rp")),
                "dq_issues": F.when(
                    wrong, append_tag(F.col("dq_issues"), TOTAL_RECALCULATED)
                ).otherwise(F.col("dq_issues")),
            }
        )
        .drop("_wrong")
    )


def tag_issues(fact: DataFrame) -> DataFrame:
    """List the faults of rows that carry no tag yet; sound rows get ''.

    Needs ``in_calendar``. A row without a date key is not tagged: it is
    neither in the calendar nor outside it.
    """
    faults = tag_list(
        [
            (MISSING_PLAYER, F.col("player_key").isNull()),
            (MISSING_SKIN, F.col("skin_key").isNull()),
            (MISSING_PRICE, F.col("price_rp").isNull()),
            (NEGATIVE_PRICE, F.col("price_rp") < 0),
            (MISSING_QUANTITY, F.col("quantity").isNull()),
            (INVALID_QUANTITY, F.col("quantity") <= 0),
            (INVALID_DATE, ~F.col("in_calendar")),
        ]
    )
    issues = F.col("dq_issues")
    return fact.withColumn("dq_issues", F.when(is_empty(issues), faults).otherwise(issues))


def mark_valid(fact: DataFrame) -> DataFrame:
    """Set ``is_valid`` on rows that pass every test. Needs ``in_calendar``."""
    sound = (
        F.col("player_key").isNotNull()
        & F.col("skin_key").isNotNull()
        & (F.col("price_rp") > 0)
        & (F.col("quantity") > 0)
        & (F.col("total_rp") == F.col("price_rp") * F.col("quantity"))
        & F.col("in_calendar")
    )
    return fact.withColumn("is_valid", F.col("is_valid") | F.coalesce(sound, F.lit(False)))


def clean_facts(loaded: DataFrame, calendar: DataFrame) -> DataFrame:
    """Repair, recompute, tag and validate, in that order."""
    fact = recompute_total(repair_price(loaded))
    fact = with_membership(fact, calendar, "date_key", "in_calendar")
    carried = [c for c in (PLAYER_VALID, SKIN_VALID, STAGED) if c in fact.columns]
    return mark_valid(tag_issues(fact)).select(*FACT_COLUMNS, *carried)
