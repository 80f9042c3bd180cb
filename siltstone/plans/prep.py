"""Source preparation: from catalogue text and JSON to the staged skin table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.dates import lenient_date
from siltstone.functions.text import contains_any, normalise_name
from siltstone.operators.extract import (
    carry_forward,
    explode_matches,
    explode_matches_in_context,
    extract_or_null,
)
from siltstone.operators.keys import dense_index
from siltstone.operators.profiles import (
    coverage,
    first_per_group,
    keep_first,
    removed_by,
    value_counts,
    with_share_written,
)
from siltstone.sources.files import read_in_pieces

# The grammar of a catalogue text. A champion block holds an id
# and a list of skin entries and ends at a closing brace indented by four; an
# entry ends at the first closing brace that another key or the end follows,
# where braces nested inside it are passed over.
CHAMPION_BLOCK = (
    r'(?s)\["([A-Z][^"]+)"\]\s*=\s*\{[^{]*\["id"\]\s*=\s*\d+[^{]*'
    r'\["skins"\]\s*=\s*\{(.*?)\n\s{4}\}'
)
# A block ends behind this text, and nothing that is a block crosses such a place
# if another key than a skin list opens a brace next: see :func:`read_catalogues`.
BLOCK_END = "\n    }"
BLOCK_STARTS = r'^[\s},]*+(?:return\s*+\{\s*+)?\["(?!skins"\]|\])[^"]++"\]\s*+=\s*+\{'
_ENTRY_END = r'\s*,?\s*(?:\["|$)'
SKIN_ENTRY = (
    r'\["([^"]+)"\]\s*=\s*\{'
    r"((?:[^{}]*+\{[^}]*+\}(?!" + _ENTRY_END + r"))*+[^}]*+)"
    r"\}(?=" + _ENTRY_END + r")"
)
ENTRY_ID = r'\["id"\]\s*=\s*\d+'
ENTRY_COST = r'\["cost"\]\s*=\s*(\d+)'
ENTRY_RELEASE = r'\["release"\]\s*=\s*"([^"]+)"'
SPECIAL_MARK = "\"Special\"|'Special'"
COST_ENTRY = r'\["([^"]+)"\]\s*=\s*\{[^}]*\["cost"\]\s*=\s*(\d+)'
COST_ENTRY_SHORTEST = len('["a"]={["cost"]=1')
CONTEXT_WIDTH = 100
ORIGINAL = "Original"

# Price bands and the price lists of the profiles.
LEGACY_PRICES = (390, 520, 750, 790, 880, 975)
EPIC_PRICE = 1350
LEGENDARY_PRICE = 1820
ULTIMATE_FROM = 3250
PROFILE_PRICES = (0, 520, 750, 880, 975, 1350, 1820, 3250)
CHEAP_UP_TO = 750
MID_UP_TO = 1350
PROFILE_RARITIES = ("Default", "Legacy", "Epic", "Legendary", "Ultimate")

# Skins of past events that are not for sale.
EXCLUDED_KEYWORDS = (
    "prestige",
    "victorious",
    "immortalized legend",
    "risen legend",
    "after hours",
    "springs",
    "fright night",
)

# The columns of the prepared skin table, in order.
FINAL_COLUMNS = (
    "skin_id",
    "champion_name",
    "skin_name",
    "rarity",
    "price_rp",
    "release_date",
    "champion_id",
    "skin_num",
    "skin_name_norm",
)

EXTRACTED = ("skin_name", "price_rp", "rarity", "champion", "release_date")


def price_band_rarity(cost: Column) -> Column:
    """Rarity of a priced skin; prices off the list count as Epic."""
    return (
        F.when(cost.isin(*LEGACY_PRICES), "Legacy")
        .when(cost == LEGENDARY_PRICE, "Legendary")
        .when(cost >= ULTIMATE_FROM, "Ultimate")
        .otherwise("Epic")
    )


def full_name(name: Column, champion: Column) -> Column:
    """``name`` in front of the champion; the original skin has the bare name."""
    return F.when(name == ORIGINAL, champion).otherwise(F.concat_ws(" ", name, champion))


# Text extraction ------------------------------------------------------------


def read_catalogues(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, piece, text) of catalogue files, cut between blocks so that many tasks share a file.

    The extraction finds the same blocks in the pieces as in the whole text. A
    block being read ends at the next :data:`BLOCK_END`, so it doesn't go on
    behind one. Before its skin list, the only brace a block may come to is the
    list's own; where another key or a new document opens the next brace, no block
    has begun.
    """
    return read_in_pieces(spark, path, BLOCK_END, BLOCK_STARTS)


def champion_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, block_pos, champion, block)."""
    return explode_matches(docs, "text", CHAMPION_BLOCK, {"champion": 1, "block": 2}, "block_pos")


def skin_entries(blocks: DataFrame) -> DataFrame:
    """Blocks to (doc_id, block_pos, champion, entry_pos, name, props)."""
    return explode_matches(blocks, "block", SKIN_ENTRY, {"name": 1, "props": 2}, "entry_pos")


def extract_skins(docs: DataFrame) -> DataFrame:
    """Every skin a catalogue text prices, with its place in the text.

    Entries need an id, and a cost unless they are marked special. A cost of more
    than 64 bits is no cost. Texts may be whole or in pieces; a column ``piece``
    comes along.
    """
    piece = [c for c in docs.columns if c == "piece"]
    props, name = F.col("props"), F.col("name")
    stated = extract_or_null(props, ENTRY_COST).try_cast("bigint")
    cost = F.when(name == ORIGINAL, F.lit(0).cast("bigint")).otherwise(F.col("_cost"))
    rarity = (
        F.when(name == ORIGINAL, "Default")
        .when(F.col("price_rp") == 0, "Special")
        .otherwise(price_band_rarity(F.col("price_rp")))
    )
    return (
        skin_entries(champion_blocks(docs))
        .where(props.rlike(ENTRY_ID))
        .withColumn("_cost", F.coalesce(stated, F.when(props.rlike(SPECIAL_MARK), F.lit(0).cast("bigint"))))
        .where(F.col("_cost").isNotNull())
        .withColumn("price_rp", cost)
        .select(
            "doc_id",
            *piece,
            "block_pos",
            "entry_pos",
            full_name(name, F.col("champion")).alias("skin_name"),
            "price_rp",
            rarity.alias("rarity"),
            "champion",
            extract_or_null(props, ENTRY_RELEASE).alias("release_date"),
        )
    )


def extract_skins_fallback(docs: DataFrame) -> DataFrame:
    """The simpler extraction: any named table with a cost, in text order.

    The champion is carried forward from the last match that looks like one: a
    single capitalised word behind an id, before its skin list opens. Without
    a champion, the last word of a longer name stands in for it. A cost of more
    than 64 bits is no cost, which only the original skin can do without.
    """
    name, current = F.col("name"), F.col("current")
    looks_like_champion = (
        name.rlike(r"^\p{Lu}")
        & ~name.contains(" ")
        & (F.char_length(name) > 2)
        & F.col("context").contains('"id"]')
        & ~F.col("context").contains('"skins"]')
    )
    matches = explode_matches_in_context(
        docs,
        "text",
        COST_ENTRY,
        {"name": 1, "cost": 2},
        "entry_pos",
        "context",
        CONTEXT_WIDTH,
        COST_ENTRY_SHORTEST,
    )
    carried = carry_forward(
        matches, "doc_id", "entry_pos", F.when(looks_like_champion, name), "current"
    )
    original = (name == ORIGINAL) & current.isNotNull()
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    of_champion = current.isNotNull() & (name != current)
    cost = F.col("cost").try_cast("bigint")
    named = original | ((of_champion | (F.size(words) > 1)) & cost.isNotNull())
    return carried.where(named).select(
        "doc_id",
        F.lit(0).alias("block_pos"),
        "entry_pos",
        F.when(original, current)
        .when(of_champion, F.concat_ws(" ", name, current))
        .otherwise(name)
        .alias("skin_name"),
        F.when(original, F.lit(0).cast("bigint")).otherwise(cost).alias("price_rp"),
        F.when(original, "Default").otherwise(price_band_rarity(cost)).alias("rarity"),
        F.when(original | of_champion, current)
        .otherwise(F.try_element_at(words, F.lit(-1)))
        .alias("champion"),
        F.lit(None).cast("string").alias("release_date"),
    )


def dedup_and_filter(extracted: DataFrame) -> DataFrame:
    """First row per skin name in text order, special skins left out, normalised.

    Two names may be told apart only by their document; its id orders them.
    """
    first = keep_first(extracted, "skin_name", ["doc_id", "block_pos", "entry_pos"])
    return first.where(~F.col("rarity").eqNullSafe("Special")).select(
        *EXTRACTED, normalise_name(F.col("skin_name")).alias("skin_name_norm")
    )


# Name matching --------------------------------------------------------------


def for_sale(catalogue: DataFrame) -> DataFrame:
    """The catalogue without skins of past events; unnamed ones stay."""
    return catalogue.where(_not_excluded())


def excluded_counts(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows before, after and removed by the event filter."""
    return removed_by(catalogue, _not_excluded())


def match_prices(catalogue: DataFrame, prices: DataFrame) -> DataFrame:
    """Catalogue LEFT JOIN prices on the normalised name.

    The catalogue's ``default`` skin is looked up by its champion. A name that
    occurs twice among the prices yields two rows. A name without letters a-z and
    digits normalises to nothing and is no name: it finds no price.
    """
    named = F.when(F.col("skin_name") == "default", F.col("champion_name")).otherwise(
        F.col("skin_name")
    )
    listed = prices.where(F.col("skin_name_norm") != "").select(
        "skin_name_norm", "price_rp", "rarity", "release_date"
    )
    return catalogue.withColumn("skin_name_norm", normalise_name(named)).join(
        listed, "skin_name_norm", "left"
    )


def settle_defaults(matched: DataFrame) -> DataFrame:
    """Default skins cost nothing, whatever the price list says."""
    return matched.withColumns(
        {
            "rarity": F.when(is_default(), "Default").otherwise(F.col("rarity")),
            "price_rp": F.when(is_default(), 0).otherwise(F.col("price_rp")),
        }
    )


def is_default() -> Column:
    return F.coalesce((F.col("skin_num") == 0) | (F.col("skin_name") == "default"), F.lit(False))


def unmatched(matched: DataFrame) -> DataFrame:
    """Rows without a price that are not default skins."""
    return matched.where(F.col("price_rp").isNull() & ~is_default())


def prepared_skins(catalogue: DataFrame, prices: DataFrame, order_by: list[str]) -> DataFrame:
    """The skin table ready for staging, ids 1..n in the order given."""
    settled = settle_defaults(match_prices(for_sale(catalogue), prices))
    priced = settled.where(F.col("price_rp").isNotNull())
    numbered = dense_index(priced.drop("skin_id"), order_by, "skin_id")
    final = numbered.withColumns(
        {
            "price_rp": F.col("price_rp").cast("int"),
            "release_date": lenient_date(F.col("release_date")),
        }
    )
    return final.select(*[c for c in FINAL_COLUMNS if c in final.columns])


def match_rate(matched: DataFrame) -> DataFrame:
    """How many rows found a price, and the share that did."""
    return coverage(matched, "price_rp", "matched", "unmatched", "pct", places=1)


def unmatched_sample(matched: DataFrame, n: int = 5) -> DataFrame:
    return (
        unmatched(settle_defaults(matched))
        .select("champion_name", "skin_name")
        .orderBy("champion_name", "skin_name")
        .limit(n)
    )


def _not_excluded() -> Column:
    return ~contains_any(F.col("skin_name"), EXCLUDED_KEYWORDS)


# Profiles -------------------------------------------------------------------


def share_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows per value, with their share of all rows that have one."""
    return with_share_written(value_counts(df, key), places=1).orderBy(F.desc("count"), key)


def share_of_table(df: DataFrame, key: str) -> DataFrame:
    """Rows per value, with their share of *all* rows, valued or not."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return with_share_written(counted, places=1).where(F.col(key).isNotNull())


def listed_prices(df: DataFrame, prices: tuple[int, ...] = PROFILE_PRICES) -> DataFrame:
    """Rows per price of a fixed list, in price order; unused prices are left out."""
    return value_counts(df.where(F.col("price_rp").isin(*prices)), "price_rp").orderBy("price_rp")


def lowest_prices(df: DataFrame, n: int = 15) -> DataFrame:
    """Rows per price, for the lowest prices."""
    return value_counts(df, "price_rp").orderBy("price_rp").limit(n)


def date_coverage(df: DataFrame) -> DataFrame:
    return coverage(df, "release_date", "with_date", "without_date", "pct", places=1)


def sample_per_rarity(df: DataFrame, order_by: list[str], n: int = 2) -> DataFrame:
    """The first rows of each known rarity."""
    return first_per_group(df.where(F.col("rarity").isin(*PROFILE_RARITIES)), "rarity", order_by, n)


def distinct_champions(df: DataFrame, column: str = "champion_name") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("skins"), F.count_distinct(column).alias("champions"))


def sold_skins(skins: DataFrame) -> DataFrame:
    """Default skins are given away, so they are not in the shop."""
    return skins.where(~F.col("rarity").eqNullSafe("Default"))


def catalogue_price_counts(skins: DataFrame) -> DataFrame:
    return value_counts(sold_skins(skins), "price_rp").orderBy("price_rp")


def price_bands(skins: DataFrame) -> DataFrame:
    """Skins for sale by price band."""
    price = F.col("price_rp")
    band = (
        F.when(price <= CHEAP_UP_TO, "cheap")
        .when(price <= MID_UP_TO, "mid")
        .when(price > MID_UP_TO, "expensive")
    )
    return value_counts(sold_skins(skins).withColumn("band", band), "band").orderBy("band")


def player_profile(players: DataFrame) -> DataFrame:
    """Players per segment and per region with their shares: attribute, value, count, pct."""
    parts = [
        share_profile(players, column).select(
            F.lit(label).alias("attribute"), F.col(column).alias("value"), "count", "pct"
        )
        for label, column in (("segment", "player_segment"), ("region", "region"))
    ]
    return parts[0].unionByName(parts[1])


def sales_per_player(sales: DataFrame) -> DataFrame:
    """Sales grouped per player, so that later joins move one row per player."""
    return sales.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("sales"),
        F.count("price_rp").alias("priced"),
        F.sum("price_rp").alias("amount"),
    )


def sales_by_segment(sales: DataFrame, players: DataFrame) -> DataFrame:
    """Sales of known players per segment, in percent of *all* sales."""
    segments = players.select("player_id", "player_segment")
    grouped = (
        sales_per_player(sales)
        .join(segments, "player_id", "left")
        .groupBy("player_segment")
        .agg(F.sum("sales").alias("count"))
    )
    return (
        with_share_written(grouped, places=1)
        .where(F.col("player_segment").isNotNull())
        .orderBy(F.desc("count"), "player_segment")
    )


def top_prices(sales: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent prices, in percent of all sales; no price is no value."""
    return (
        share_of_table(sales, "price_rp")
        .orderBy(F.desc("count"), "price_rp")
        .limit(n)
        .select("price_rp", "count", "pct")
    )


def price_label(price: Column) -> Column:
    """A price as text, with a word for a missing one."""
    return F.coalesce(price.cast("long").cast("string"), F.lit("NULL"))


def total_revenue(sales: DataFrame) -> DataFrame:
    """Sum of prices and its mean over all rows, priced or not."""
    total = F.sum("price_rp")
    return sales.agg(
        total.alias("total_revenue"),
        F.round(total / F.count(F.lit(1)), 2).alias("mean_revenue"),
    )


def revenue_by_segment(sales: DataFrame, players: DataFrame) -> DataFrame:
    """Sum, mean over priced rows and number of priced rows per segment."""
    segments = players.select("player_id", "player_segment")
    return (
        sales_per_player(sales)
        .join(segments, "player_id")
        .where(F.col("player_segment").isNotNull())
        .groupBy("player_segment")
        .agg(F.sum("amount").alias("sum"), F.sum("priced").alias("count"))
        .select(
            "player_segment",
            "sum",
            (F.col("sum").cast("double") / F.nullif(F.col("count"), F.lit(0))).alias("mean"),
            "count",
        )
        .orderBy("player_segment")
    )
