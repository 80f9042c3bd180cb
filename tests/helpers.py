"""Small frames and comparisons."""

from datetime import date
from decimal import Decimal

from siltstone import schemas
from siltstone.rules import Rules

RULES = Rules(
    calendar_start=date(2024, 1, 1),
    calendar_end=date(2024, 12, 31),
    as_of=date(2024, 12, 31),
)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sales(spark, *records):
    """(transaction, player, skin, date, price, quantity) rows, numbers as text."""

    def number(v):
        return None if v is None else Decimal(str(v))

    return spark.createDataFrame(
        [(number(t), number(p), number(s), d, number(c), number(q)) for t, p, s, d, c, q in records],
        schemas.STG_SALES,
    )


def players(spark, *records):
    """(player_id, region, account date, segment) rows."""
    return spark.createDataFrame(list(records), schemas.STG_PLAYERS)


def skins(spark, *records):
    """(skin_id, champion, name, rarity, price) rows."""
    return spark.createDataFrame(
        [(i, c, n, r, p, None, "c", 1, None) for i, c, n, r, p in records], schemas.STG_SKINS
    )
