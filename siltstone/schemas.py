"""Declared schemas. Staging is loose on purpose so that faulty rows still load."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

STG_SKINS = T.StructType(
    [
        T.StructField("skin_id", T.LongType()),
        T.StructField("champion_name", T.StringType()),
        T.StructField("skin_name", T.StringType()),
        T.StructField("rarity", T.StringType()),
        T.StructField("price_rp", T.IntegerType()),
        T.StructField("release_date", T.DateType()),
        T.StructField("champion_id", T.StringType()),
        T.StructField("skin_num", T.IntegerType()),
        T.StructField("skin_name_norm", T.StringType()),
    ]
)

STG_PLAYERS = T.StructType(
    [
        T.StructField("player_id", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("account_created_date", T.DateType()),
        T.StructField("player_segment", T.StringType()),
    ]
)

# Nullable ids arrive as "123.0", dates as free text.
STG_SALES = T.StructType(
    [
        T.StructField("transaction_id", MONEY),
        T.StructField("player_id", MONEY),
        T.StructField("skin_id", MONEY),
        T.StructField("purchase_date", T.StringType()),
        T.StructField("price_rp", MONEY),
        T.StructField("quantity", MONEY),
    ]
)

CATALOGUE_SKINS = T.StructType(
    [
        T.StructField("champion_id", T.StringType()),
        T.StructField("champion_name", T.StringType()),
        T.StructField("skin_num", T.IntegerType()),
        T.StructField("skin_name", T.StringType()),
    ]
)

PRICE_LIST = T.StructType(
    [
        T.StructField("skin_name", T.StringType()),
        T.StructField("price_rp", T.IntegerType()),
        T.StructField("rarity", T.StringType()),
        T.StructField("champion", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("skin_name_norm", T.StringType()),
    ]
)

# A catalogue document: champion id -> its name and its skins.
CATALOGUE_JSON = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField(
                "skins",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("num", T.IntegerType()),
                            T.StructField("name", T.StringType()),
                        ]
                    )
                ),
            ),
        ]
    ),
)

FACT_COLUMNS = (
    "transaction_id",
    "player_key",
    "skin_key",
    "date_key",
    "price_rp",
    "quantity",
    "total_rp",
    "is_valid",
    "dq_issues",
)
