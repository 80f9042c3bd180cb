"""Inputs of the warehouse, derived by Spark from the given tables.

The given tables are clean, so faults are put in by the remainder of a key:
every row is kept, and the same faults come out on every run.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.functions.dates import date_key
from siltstone.functions.text import normalise_name
from siltstone.operators.calendar import calendar_covering
from siltstone.operators.lookups import lookup
from siltstone.plans import layers, prep
from siltstone.plans.layers import Bronze, Gold, Settle, as_planned
from siltstone.rules import Rules

RULES = Rules(
    regions=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    segments=("automobile", "building", "furniture", "household", "machinery"),
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2001, 12, 31),
    as_of=date(2001, 12, 31),
    region_length=20,
    on_violation="drop",
)

# Catalogue documents hold the parts of 64 consecutive keys. Part keys are
# unique, so no document collects more than 64 entries.
CHUNK = 64
COSTS = (390, 520, 750, 975, 1350, 1820, 3250, 999)
PRICES = (520, 750, 975, 1350, 1820, 3250)
NOT_LATIN = "漆黒"


# The given tables, with declared schemas: reading them infers nothing.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


# Staging --------------------------------------------------------------------


def stg_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    key = "c_custkey"
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col(key).alias("player_id"),
            F.when(every(key, 53), F.concat(F.lit(" "), F.lower("r_name")))
            .otherwise(F.col("r_name"))
            .alias("region"),
            F.when(every(key, 61), F.lit(date(2090, 1, 1)))
            .otherwise(F.date_add(F.lit(date(1990, 1, 1)), (F.col(key) % 1800).cast("int")))
            .alias("account_created_date"),
            F.lower("c_mktsegment").alias("player_segment"),
        )
    )


def stg_skins(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = "p_partkey", F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col(key).alias("skin_id"),
        F.col("p_brand").alias("champion_name"),
        F.when(every(key, 59), "  ").otherwise(F.col("p_name")).alias("skin_name"),
        F.when(size <= 2, "Default")
        .when(size <= 30, "Legacy")
        .when(size <= 42, "Epic")
        .when(size <= 48, "Legendary")
        .otherwise("Ultimate")
        .alias("rarity"),
        F.when(size <= 2, 0).otherwise(F.floor("p_retailprice").cast("int")).alias("price_rp"),
        F.when(~every(key, 11), F.date_add(F.lit(date(1994, 1, 1)), (F.col(key) % 2000).cast("int"))).alias(
            "release_date"
        ),
        F.col("p_brand").alias("champion_id"),
        size.alias("skin_num"),
    )


def stg_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale for each order, with the smallest part and quantity of its lines."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("partkey"), F.min("l_quantity").alias("qty"))
    )
    return _sales(spark, sf_dir, lines)


def stg_line_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale for each line item; the lines of an order share a transaction id."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("partkey"), F.col("l_quantity").alias("qty")
    )
    return _sales(spark, sf_dir, lines)


def _sales(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    key = "o_orderkey"
    skins = stg_skins(spark, sf_dir).select("skin_id", F.col("price_rp").alias("skin_price"))
    orders = (
        table(spark, sf_dir, "orders")
        .select(key, "o_custkey", "o_orderdate")
        .join(lines, F.col(key) == F.col("l_orderkey"), "left")
    )
    priced = lookup(orders, skins, F.col("partkey"), "skin_id")
    columns = {
        "transaction_id": F.when(~every(key, 499), F.col(key)),
        "player_id": F.when(every(key, 97), None)
        .when(every(key, 89), F.col("o_custkey") + 10000000)
        .otherwise(F.col("o_custkey")),
        "skin_id": F.when(every(key, 83), None)
        .when(every(key, 79), F.col("partkey") + 10000000)
        .otherwise(F.col("partkey")),
        "purchase_date": F.when(every(key, 73), "not-a-date")
        .when(every(key, 71), "2045-01-01")
        .otherwise(F.to_date("o_orderdate").cast("string")),
        "price_rp": F.when(every(key, 67), None)
        .when(every(key, 61), -500)
        .otherwise(F.col("skin_price")),
        "quantity": F.when(every(key, 59), 0)
        .when(every(key, 101), None)
        .otherwise(F.col("qty").cast("int")),
    }
    return priced.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.STG_SALES.fields]
    )


def bronze(
    spark: SparkSession, sf_dir: str, settle: Settle = as_planned, sales=stg_sales
) -> Bronze:
    return layers.bronze(
        {
            "stg_skins": lambda: stg_skins(spark, sf_dir).withColumn(
                "skin_name_norm", normalise_name(F.col("skin_name"))
            ),
            "stg_players": lambda: stg_players(spark, sf_dir),
            "stg_sales": lambda: sales(spark, sf_dir),
        },
        settle,
    )


# A clean star, for the views at full size -----------------------------------


def clean_star(spark: SparkSession, sf_dir: str) -> Gold:
    """Every line item is a sale in whole cents; keys are the natural ones."""

    def facts() -> DataFrame:
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("player_key"),
            date_key(F.to_date("o_orderdate")).alias("date_key"),
        )
        return (
            table(spark, sf_dir, "lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                "player_key",
                F.col("l_partkey").alias("skin_key"),
                "date_key",
                F.round(F.col("l_extendedprice") * 100).cast("long").alias("total_rp"),
            )
        )

    def players() -> DataFrame:
        return (
            table(spark, sf_dir, "customer")
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("player_key"),
                F.col("c_custkey").alias("player_id"),
                F.lower("c_mktsegment").alias("player_segment"),
                F.col("r_name").alias("region"),
            )
        )

    return Gold(
        dim_date=lambda: calendar_covering(
            table(spark, sf_dir, "orders"), F.to_date("o_orderdate")
        ),
        dim_skin=lambda: stg_skins(spark, sf_dir).withColumn("skin_key", F.col("skin_id")),
        dim_player=players,
        fact_sales=facts,
    )


# Catalogue documents --------------------------------------------------------


def pick(values: tuple[int, ...], key: Column) -> Column:
    """The value at ``key`` modulo their number."""
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def catalogue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): parts written as catalogue texts, one block per brand.

    Some entries lack an id or a cost, are special or original, hold a nested
    list, or cost more than a whole number of 64 bits.
    """
    k = F.col("p_partkey")
    key = "p_partkey"
    released = F.date_add(F.lit(date(2010, 1, 1)), (k % 3000).cast("int")).cast("string")
    props = F.concat_ws(
        ", ",
        F.when(~every(key, 19), F.format_string('["id"] = %d', k)),
        F.when(every(key, 13), '["rarity"] = "Special"').when(
            ~every(key, 17),
            F.concat(
                F.lit('["cost"] = '),
                F.when(every(key, 29), "9" * 25).otherwise(pick(COSTS, k).cast("string")),
            ),
        ),
        F.when(~every(key, 5), F.format_string('["release"] = "%s"', released)),
        F.when(every(key, 7), '["colours"] = { "red", "blue" }'),
    )
    name = F.when(every(key, 23), "Original").otherwise(F.col("p_name"))
    entries = table(spark, sf_dir, "part").select(
        F.floor(k / CHUNK).alias("doc_id"),
        "p_brand",
        F.struct(k.alias("k"), F.format_string('      ["%s"] = { %s }', name, props).alias("line")).alias(
            "entry"
        ),
    )
    blocks = entries.groupBy("doc_id", "p_brand").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["line"]), ",\n").alias(
            "body"
        ),
        F.min("entry.k").alias("k"),
    )
    block = F.format_string(
        '  ["%s"] = {\n    ["id"] = %d,\n    ["skins"] = {\n%s\n    }\n  }',
        F.col("p_brand"),
        F.col("k"),
        F.col("body"),
    )
    return (
        blocks.groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("p_brand", block.alias("block")))).alias("blocks"))
        .select(
            "doc_id",
            F.concat(
                F.lit("return {\n"),
                F.array_join(F.transform("blocks", lambda b: b["block"]), ",\n"),
                F.lit("\n}\n"),
            ).alias("text"),
        )
    )


def catalogue_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, json): parts as nested documents {champion id: {name, skins}}."""
    champions = (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / CHUNK).alias("doc_id"), "p_brand")
        .agg(
            F.collect_list(F.struct(F.col("p_size").alias("num"), F.col("p_name").alias("name"))).alias("skins")
        )
        .select(
            "doc_id",
            F.struct(
                F.regexp_replace("p_brand", "#", "").alias("id"),
                F.struct(F.col("p_brand").alias("name"), "skins").alias("champion"),
            ).alias("entry"),
        )
    )
    return champions.groupBy("doc_id").agg(
        F.to_json(F.map_from_entries(F.collect_list("entry"))).alias("json")
    )


# Names to match -------------------------------------------------------------


def match_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a catalogue with noisy names; ``seq`` is the order of the source."""
    k, key, name = F.col("p_partkey"), "p_partkey", F.col("p_name")
    noisy = (
        F.when(every(key, 37), "default")
        .when(every(key, 41), F.concat(F.lit("Prestige "), name))
        .when(every(key, 43), None)
        .when(every(key, 47), NOT_LATIN)
        .when(k % 3 == 0, F.upper(name))
        .when(k % 3 == 1, F.replace(name, F.lit(" "), F.lit("-")))
        .otherwise(F.concat(name, F.lit("!")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("champion_id"),
        F.col("p_brand").alias("champion_name"),
        (k % 50).cast("int").alias("skin_num"),
        noisy.alias("skin_name"),
        k.alias("seq"),
    )


def match_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per part name, dates in several spellings; some names are left out.

    Some names hold no letter that normalising keeps, as in the catalogue.
    """
    k = F.col("k")
    released = F.date_add(F.lit(date(2014, 1, 1)), (k % 3000).cast("int"))
    price = pick(PRICES, k)
    name = F.when(k % 53 == 0, NOT_LATIN).otherwise(F.col("p_name"))
    return (
        table(spark, sf_dir, "part")
        .where(~F.col("p_name").endswith("anvil"))
        .groupBy("p_name")
        .agg(F.min("p_partkey").alias("k"))
        .select(
            name.alias("skin_name"),
            price.alias("price_rp"),
            prep.price_band_rarity(price).alias("rarity"),
            F.when(k % 4 == 0, released.cast("string"))
            .when(k % 4 == 1, F.date_format(released, "MMM d, yyyy"))
            .when(k % 4 == 2, "unknown")
            .alias("release_date"),
            normalise_name(name).alias("skin_name_norm"),
        )
    )
