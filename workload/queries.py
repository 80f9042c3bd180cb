"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone.functions import dates, numbers, text
from siltstone.operators import constraints
from siltstone.operators.calendar import calendar_covering
from siltstone.operators.extract import carry_forward, explode_matches, extract_or_null
from siltstone.operators.facts import attach_list_price, clean_facts
from siltstone.operators.keys import dense_index, ordered_key
from siltstone.operators.profiles import keep_first
from siltstone.plans import layers, prep, reports, views, warehouse
from siltstone.plans.layers import Bronze, Gold, Silver
from siltstone.runtime import scratch_dir
from siltstone.sources import files
from siltstone.sources.nested import flatten_catalogue
from siltstone.sources.tables import Store
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# The markup the page extraction looks for.
PAGE_TITLE = r"<title>([^<]*)</title>"
PAGE_LANG = r'<html lang="([^"]*)"'
PAGE_LINK = r'<a href="([^"]*)">([^<]*)</a>'


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# Tables that several steps of one query read are written once per query.
_DIMS = ("dim_skin", "dim_player")
_STAGED = ("stg_sales", *_DIMS)
_FACT = ("fact_sale", *_STAGED)


def _silver(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> tuple[Bronze, Silver]:
    settle = layers.durable_tables(*names)
    bronze = fx.bronze(spark, sf_dir, settle)
    return bronze, layers.silver(spark, bronze, fx.RULES, settle)


def silver(spark: SparkSession, sf_dir: str) -> Silver:
    return _silver(spark, sf_dir, _DIMS)[1]


def silver_stored_staging(spark: SparkSession, sf_dir: str) -> Silver:
    return _silver(spark, sf_dir, _STAGED)[1]


def silver_stored_fact(spark: SparkSession, sf_dir: str) -> Silver:
    return _silver(spark, sf_dir, _FACT)[1]


def planned_silver(spark: SparkSession, sf_dir: str) -> Silver:
    return _silver(spark, sf_dir, ())[1]


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    return layers.gold(silver(spark, sf_dir), fx.RULES)


def planned_gold(spark: SparkSession, sf_dir: str) -> Gold:
    return layers.gold(planned_silver(spark, sf_dir), fx.RULES)


def _on(layer: Callable[[SparkSession, str], object], report: Callable) -> Query:
    return lambda spark, sf_dir: plain(report(layer(spark, sf_dir)))


# Layer tables ---------------------------------------------------------------


def stg_sales(spark, sf_dir):
    return plain(fx.stg_sales(spark, sf_dir))


def csv_stage(reader: Callable, source: Callable) -> Query:
    """Write a source as CSV into the shared scratch folder and stage it from there."""

    def query(spark, sf_dir):
        path = scratch_dir(spark, "csv")
        files.write_csv(source(spark, sf_dir), path)
        return plain(reader(spark, path).drop("loaded_at", files.CORRUPT))

    return query


def dim_date(spark, sf_dir):
    """The calendar of the years in which orders were placed."""
    orders = fx.table(spark, sf_dir, "orders")
    return calendar_covering(orders, F.to_date("o_orderdate"))


def gold_dim_date(spark, sf_dir):
    days = dim_date(spark, sf_dir)
    s = layers.silver(
        spark,
        fx.bronze(spark, sf_dir),
        fx.RULES,
        lambda name, df: days if name == "dim_date" else df,
    )
    return layers.gold(s, fx.RULES).dim_date


def dim_skin(spark, sf_dir):
    return planned_silver(spark, sf_dir).dim_skin


def dim_player(spark, sf_dir):
    return planned_silver(spark, sf_dir).dim_player


def fact_sale_load(spark, sf_dir):
    loaded = layers.silver_fact_load(*_silver(spark, sf_dir, _DIMS))
    return plain(loaded.select(*schemas.FACT_COLUMNS))


def fact_sale_clean(spark, sf_dir):
    return plain(silver(spark, sf_dir).fact_sale.select(*schemas.FACT_COLUMNS))


def fact_sale_keyed(spark, sf_dir):
    keyed = warehouse.keyed_facts(silver(spark, sf_dir).fact_sale)
    return plain(keyed.select("sale_key", "transaction_id", "is_valid"))


def fact_sale_repaired_external(spark, sf_dir):
    """Cleansing of a fact loaded elsewhere: no list price, some totals wrong."""
    bronze, s = _silver(spark, sf_dir, _DIMS)
    loaded = layers.silver_fact_load(bronze, s).drop("list_price")
    wrong = F.col("transaction_id") % 7 == 0
    foreign = loaded.withColumn(
        "total_rp", F.when(wrong, F.col("total_rp") + 1).otherwise(F.col("total_rp"))
    )
    cleaned = clean_facts(attach_list_price(foreign, s.dim_skin), s.dim_date)
    return plain(cleaned.select(*schemas.FACT_COLUMNS))


def quarantine(spark, sf_dir):
    return silver_stored_staging(spark, sf_dir).fact_sale_quarantine


def quarantine_lineitem(spark, sf_dir):
    """As :func:`quarantine`, over every line item: transaction ids repeat."""
    settle = layers.durable_tables(*_STAGED)
    bronze = fx.bronze(spark, sf_dir, settle, fx.stg_line_sales)
    return layers.silver(spark, bronze, fx.RULES, settle).fact_sale_quarantine


def dq_log(spark, sf_dir):
    return plain(silver(spark, sf_dir).data_quality_log.drop("run_timestamp"))


def gold_fact_sales(spark, sf_dir):
    order = ["date_key", "player_key", "transaction_id"]
    star = layers.gold(silver_stored_fact(spark, sf_dir), fx.RULES)
    return dense_index(star.fact_sales, order, "sale_key")


def gold_fk_breaks(spark, sf_dir):
    """Valid sales on an invalid dimension row, told by what the fact carries."""
    facts = layers.gold_facts(silver(spark, sf_dir), "player_valid", "skin_valid")
    broken = facts.where(~F.col("player_valid") | ~F.col("skin_valid"))
    return broken.select("transaction_id", "player_key", "skin_key")


def gold_rejected(spark, sf_dir):
    """Valid sales that the policy ``quarantine`` keeps out of gold, and why."""
    rules = replace(fx.RULES, on_violation="quarantine")
    rejected = layers.gold_facts_judged(silver(spark, sf_dir), rules).rejected
    return rejected.select("transaction_id", F.array_join("violations", ",").alias("violations"))


def constraint_policy_drop(spark, sf_dir):
    """Customers that keep an order: one each, a large one if they have any."""
    large = constraints.Check("large", F.col("o_totalprice") > 100000)
    rules = [large, constraints.Unique("o_custkey")]
    return constraints.enforce(fx.table(spark, sf_dir, "orders"), rules, "drop").kept.select("o_custkey")


def constraint_audit(spark, sf_dir):
    """Also of the keys: sales and quarantined rows are numbered first."""
    keyed = {
        "fact_sale": lambda df: ordered_key(df, "transaction_id", "sale_key", "id_rows"),
        "fact_sale_quarantine": lambda df: ordered_key(df, "transaction_id", "quarantine_id"),
    }
    settle = layers.durable_tables(*_FACT)
    bronze = fx.bronze(spark, sf_dir, settle)
    s = layers.silver(spark, bronze, fx.RULES, lambda name, df: settle(name, keyed.get(name, layers.same)(df)))
    return reports.constraint_audit(bronze, s, layers.gold(s, fx.RULES), fx.RULES)


# The stored warehouse -------------------------------------------------------

_stores: dict[tuple[str, str], Store] = {}


def store_of(spark: SparkSession, sf_dir: str) -> Store:
    """A stored build over the given tables, made when first asked for in an application."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _stores:
        prefix = f"w{hashlib.md5(sf_dir.encode(), usedforsecurity=False).hexdigest()[:12]}_"
        store = Store(spark, scratch_dir(spark, "warehouse"), prefix)
        warehouse.build(spark, fx.bronze(spark, sf_dir), fx.RULES, store)
        _stores[key] = store
    return _stores[key]


def stored(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    return warehouse.open_warehouse(store_of(spark, sf_dir))


def stored_fact_sale(spark, sf_dir):
    fact = stored(spark, sf_dir).silver.fact_sale
    return plain(fact.select("sale_key", "transaction_id", "is_valid", "dq_issues", "id_rows"))


def stored_quarantine(spark, sf_dir):
    return stored(spark, sf_dir).silver.fact_sale_quarantine.drop("rejection_timestamp")


def stored_fact_sales(spark, sf_dir):
    return stored(spark, sf_dir).gold.fact_sales.drop("created_at")


def stored_last6_months(spark, sf_dir):
    return plain(reports.gold_last6_months(stored(spark, sf_dir).gold))


def stored_stamps(spark, sf_dir):
    """Rows of each stored table, and how many of them lack the time they were written."""
    built = stored(spark, sf_dir)
    stamps = {"fact_sale_quarantine": "rejection_timestamp", "data_quality_log": "run_timestamp"}
    counts = []
    for layer, stamp in ((built.bronze, "loaded_at"), (built.silver, "created_at"), (built.gold, "created_at")):
        for name, table in layer.tables().items():
            lacking = numbers.count_where(F.col(stamps.get(name, stamp)).isNull())
            label = F.lit(f"{type(layer).__name__.lower()}.{name}").alias("table_name")
            rows = table.agg(F.count(F.lit(1)).alias("n_rows"), lacking.alias("unstamped"))
            counts.append(rows.select(label, "n_rows", "unstamped"))
    return reduce(DataFrame.unionByName, counts)


def view_catalog(spark, sf_dir):
    """The views of the catalog, their comments and how many rows they show."""
    store = store_of(spark, sf_dir)
    found = [
        store.read("gold", row.view_name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(row.view_name).alias("view_name"), F.lit(row.comment).alias("comment"), "n_rows"
        )
        for row in views.view_catalog(store).collect()
    ]
    return reduce(DataFrame.unionByName, found)


def catalog_view(name: str) -> Query:
    return lambda spark, sf_dir: plain(store_of(spark, sf_dir).read("gold", name))


def log_history(spark, sf_dir):
    """The metrics of two runs, the first of which wrote its rows twice."""
    metrics = silver(spark, sf_dir).data_quality_log
    path = scratch_dir(spark, "log")
    store = Store(spark, path, f"log{path[-12:]}_")
    for run in ("first", "second", "first"):
        warehouse.keep_metrics(store, run, metrics)
    log = store.read("silver", warehouse.LOG)
    return plain(log.select("run_id", "log_id", "table_name", "issue_type", "issue_count", "issue_pct"))


# Scalar functions over whole tables -----------------------------------------


def scalar_dates(spark, sf_dir):
    """Date parts and guarded parsing over every order."""
    d = F.to_date("o_orderdate")
    k = F.col("o_orderkey")
    spelled = (
        F.when(k % 7 == 0, F.date_format(d, "yyyy-M-d"))
        .when(k % 11 == 0, F.lit("2024-13-45"))
        .when(k % 13 == 0, F.concat(d.cast("string"), F.lit("\n")))
        .otherwise(d.cast("string"))
    )
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.date_key(d).alias("date_key"),
        F.weekofyear(d).alias("week"),
        dates.day_of_week_from_sunday(d).alias("day_of_week"),
        dates.month_name(d).alias("month_name"),
        dates.day_name(d).alias("day_name"),
        dates.is_weekend(d).alias("is_weekend"),
        dates.is_month_start(d).alias("is_month_start"),
        dates.is_month_end(d).alias("is_month_end"),
        F.datediff(F.lit(fx.RULES.as_of), d).alias("age_days"),
        dates.guarded_date(spelled).alias("guarded"),
    )


def scalar_numbers(spark, sf_dir):
    """Rounding, exact ratios and NULL-safe division over every line item."""
    cents = F.col("l_extendedprice").cast("decimal(18,2)")
    half = F.col("l_quantity").cast("decimal(18,2)") / 2
    signed = F.when(F.col("l_linenumber") % 2 == 0, -half).otherwise(half)
    tax = F.round(F.col("l_tax") * 100).cast("long")
    return plain(
        fx.table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            numbers.round_to_long(cents).alias("rounded_price"),
            numbers.round_to_long(signed).alias("rounded_half"),
            numbers.ratio(F.col("l_partkey"), tax).alias("per_tax"),
            numbers.percent(F.col("l_linenumber"), F.col("l_quantity").cast("long")).alias("pct"),
            F.col("l_tax").cast("int").alias("truncated"),
        )
    )


def scalar_text(spark, sf_dir):
    """Trimming, tags, normalising and keyword search over every document."""
    t = F.col("text")
    lang, source = F.col("lang"), F.col("source")
    tags = F.when(F.col("doc_id") % 3 == 0, lang)
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.trim(F.concat(F.lit("  "), lang, F.lit(" "))).alias("trimmed"),
        text.trim_commas(F.concat(F.lit(",,"), lang, F.lit(","), source, F.lit(","))).alias("no_commas"),
        F.concat(tags, source).alias("null_poisons"),
        text.append_tag(tags, "seen").alias("tagged"),
        text.normalise_name(F.when(F.col("doc_id") % 5 != 0, t)).alias("normalised"),
        text.contains_any(t, prep.EXCLUDED_KEYWORDS).alias("has_keyword"),
        text.is_blank(t).alias("is_blank"),
    )


def price_labels(spark, sf_dir):
    """Sales per price, a missing price under a label of its own."""
    sales = fx.stg_sales(spark, sf_dir)
    return (
        sales.groupBy(prep.price_label(F.col("price_rp")).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "label")
    )


# Clean star -----------------------------------------------------------------


def _star(view: Callable[[Gold], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(view(fx.clean_star(spark, sf_dir)))


# Source preparation ---------------------------------------------------------


def prep_extract(spark, sf_dir):
    return prep.extract_skins(fx.catalogue_texts(spark, sf_dir)).select(*prep.EXTRACTED)


def prep_extract_files(spark, sf_dir):
    """As :func:`prep_extract`, over files that hold many catalogues each and are read in pieces."""
    path = scratch_dir(spark, "catalogues")
    fx.catalogue_texts(spark, sf_dir).select("text").write.text(path)
    return prep.extract_skins(prep.read_catalogues(spark, path)).select(*prep.EXTRACTED)


def prep_extract_fallback(spark, sf_dir):
    return prep.extract_skins_fallback(fx.catalogue_texts(spark, sf_dir)).select(*prep.EXTRACTED)


def prep_dedup_filter(spark, sf_dir):
    return prep.dedup_and_filter(prep.extract_skins(fx.catalogue_texts(spark, sf_dir)))


def page_links(spark, sf_dir):
    """Links of every page in text order; ``section`` carries the last capitalised one on."""
    html = F.col("html")
    pages = fx.table(spark, sf_dir, "pages").select(
        "page_id",
        extract_or_null(html, PAGE_LANG).alias("lang"),
        extract_or_null(html, PAGE_TITLE).alias("title"),
        "html",
    )
    links = explode_matches(pages, "html", PAGE_LINK, {"href": 1, "anchor": 2}, "position")
    capitalised = F.when(F.col("anchor").rlike(r"^\p{Lu}"), F.col("anchor"))
    return carry_forward(links, "page_id", "position", capitalised, "section")


def document_keep_first(spark, sf_dir):
    """The first of every group of documents with the same text."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    # Copies are told apart by a digest, so that texts are not shuffled.
    digested = docs.select("doc_id", F.sha2("text", 256).alias("digest"), "lang", "source", "n_chars")
    return keep_first(digested, "digest", ["doc_id"]).select("doc_id", "lang", "source", "n_chars")


def prep_flatten_json(spark, sf_dir):
    return flatten_catalogue(fx.catalogue_json(spark, sf_dir))


def _catalogue(spark, sf_dir):
    return fx.match_catalogue(spark, sf_dir)


def _matched(spark, sf_dir):
    return prep.match_prices(prep.for_sale(_catalogue(spark, sf_dir)), fx.match_prices(spark, sf_dir))


def prep_excluded(spark, sf_dir):
    return prep.excluded_counts(_catalogue(spark, sf_dir))


def prep_match(spark, sf_dir):
    return prep.prepared_skins(
        _catalogue(spark, sf_dir),
        fx.match_prices(spark, sf_dir),
        ["champion_id", "skin_num", "seq"],
    )


def prep_match_rate(spark, sf_dir):
    return plain(prep.match_rate(_matched(spark, sf_dir)))


def prep_unmatched_sample(spark, sf_dir):
    return prep.unmatched_sample(_matched(spark, sf_dir))


def _skins(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(report(fx.stg_skins(spark, sf_dir)))


def _players(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(report(fx.stg_players(spark, sf_dir)))


def _sales(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(report(fx.stg_sales(spark, sf_dir)))


def _sales_players(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(
        report(fx.stg_sales(spark, sf_dir), fx.stg_players(spark, sf_dir))
    )


def _extracted(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(prep.extract_skins(fx.catalogue_texts(spark, sf_dir)))


def _first_two(skins: DataFrame) -> DataFrame:
    return prep.sample_per_rarity(skins, ["skin_id"]).select("skin_id", "skin_name", "rarity", "price_rp")


def queries() -> dict[str, Query]:
    b, s, g = fx.bronze, silver, gold
    q, sf, ps, pg = silver_stored_staging, silver_stored_fact, planned_silver, planned_gold
    return {
        # bronze
        "bronze_counts": _on(b, reports.bronze_counts),
        "bronze_default_skins": _on(b, reports.bronze_default_skins),
        "bronze_release_dates": _on(b, reports.bronze_release_dates),
        "bronze_sales_errors": _on(b, reports.bronze_sales_errors),
        "bronze_first_skins": _on(b, reports.bronze_first_skins),
        "bronze_rarity_dist": _on(b, reports.bronze_rarity_dist),
        "bronze_price_dist": _on(b, reports.bronze_price_dist),
        "bronze_segment_dist": _on(b, reports.bronze_segment_dist),
        "bronze_region_dist": _on(b, reports.bronze_region_dist),
        "bronze_bad_sales": _on(b, reports.bronze_bad_sales),
        "bronze_date_range": _on(b, reports.bronze_date_range),
        "stage_sales": stg_sales,
        "stage_skins_csv": csv_stage(
            files.stage_skins,
            lambda spark, sf_dir: fx.stg_skins(spark, sf_dir).withColumn(
                "skin_name_norm", text.normalise_name(F.col("skin_name"))
            ),
        ),
        "stage_players_csv": csv_stage(files.stage_players, fx.stg_players),
        "stage_sales_csv": csv_stage(files.stage_sales, fx.stg_sales),
        # silver
        "dim_date": dim_date,
        "dim_skin": dim_skin,
        "dim_player": dim_player,
        "fact_sale_load": fact_sale_load,
        "fact_sale_clean": fact_sale_clean,
        "fact_sale_keyed": fact_sale_keyed,
        "fact_sale_repaired_external": fact_sale_repaired_external,
        "quarantine": quarantine,
        "quarantine_lineitem": quarantine_lineitem,
        "dq_log": dq_log,
        "silver_load_status": _on(s, reports.silver_load_status),
        "dq_report": _on(s, reports.dq_report),
        "dq_totals": _on(s, reports.dq_totals),
        "rejection_reasons": _on(q, reports.rejection_reasons),
        "dq_alerts": _on(s, reports.dq_alerts),
        "silver_counts": _on(sf, reports.silver_counts),
        "silver_quality": _on(s, reports.silver_quality),
        "silver_dq_log": _on(s, lambda layer: reports.silver_dq_log(layer).drop("run_timestamp")),
        "silver_alerts": _on(s, reports.silver_alerts),
        "quarantine_share": _on(q, reports.quarantine_share),
        "quarantine_sample": _on(q, reports.quarantine_sample),
        "silver_rarity_dist": _on(ps, reports.silver_rarity_dist),
        "silver_segment_dist": _on(ps, reports.silver_segment_dist),
        "silver_region_dist": _on(ps, reports.silver_region_dist),
        "constraint_audit": constraint_audit,
        # gold
        "gold_dim_date": gold_dim_date,
        "gold_dim_skin": _on(pg, lambda layer: layer.dim_skin),
        "gold_dim_player": _on(pg, lambda layer: layer.dim_player),
        "gold_fact_sales": gold_fact_sales,
        "gold_fk_breaks": gold_fk_breaks,
        "gold_rejected": gold_rejected,
        "constraint_policy_drop": constraint_policy_drop,
        # stored
        "stored_fact_sale": stored_fact_sale,
        "stored_quarantine": stored_quarantine,
        "stored_fact_sales": stored_fact_sales,
        "stored_last6_months": stored_last6_months,
        "stored_stamps": stored_stamps,
        "log_history": log_history,
        "view_catalog": view_catalog,
        **{f"view_{name}": catalog_view(name) for name in views.VIEWS},
        "revenue_by_segment_month": _on(g, views.revenue_by_segment_month),
        "top_selling_skins": _on(g, views.top_selling_skins),
        "weekend_vs_weekday_sales": _on(g, views.weekend_vs_weekday_sales),
        "player_lifetime_value": _on(g, views.player_lifetime_value),
        "revenue_trends": _on(g, views.revenue_trends),
        "gold_counts": _on(g, reports.gold_counts),
        "gold_segment_revenue": _on(g, reports.gold_segment_revenue),
        "gold_top10_skins": _on(g, reports.gold_top10_skins),
        "gold_last6_months": _on(g, reports.gold_last6_months),
        "gold_weekend": _on(g, reports.gold_weekend),
        "gold_top10_players": _on(g, reports.gold_top10_players),
        "gold_rarity_sales": _on(g, reports.gold_rarity_sales),
        "gold_region_sales": _on(g, reports.gold_region_sales),
        # the views over every line item
        "lineitem_revenue_by_segment_month": _star(views.revenue_by_segment_month),
        "lineitem_top_selling_skins": _star(views.top_selling_skins),
        "lineitem_weekend_vs_weekday_sales": _star(views.weekend_vs_weekday_sales),
        "lineitem_player_lifetime_value": _star(views.player_lifetime_value),
        "lineitem_revenue_trends": _star(views.revenue_trends),
        "lineitem_segment_revenue": _star(reports.gold_segment_revenue),
        "lineitem_rarity_sales": _star(reports.gold_rarity_sales),
        "lineitem_region_sales": _star(reports.gold_region_sales),
        # scalar functions
        "scalar_dates": scalar_dates,
        "scalar_numbers": scalar_numbers,
        "scalar_text": scalar_text,
        # source preparation
        "prep_extract": prep_extract,
        "prep_extract_files": prep_extract_files,
        "prep_extract_fallback": prep_extract_fallback,
        "prep_dedup_filter": prep_dedup_filter,
        "page_links": page_links,
        "document_keep_first": document_keep_first,
        "prep_flatten_json": prep_flatten_json,
        "prep_excluded": prep_excluded,
        "prep_match": prep_match,
        "prep_match_rate": prep_match_rate,
        "prep_unmatched_sample": prep_unmatched_sample,
        "prep_rarity_profile": _skins(lambda df: prep.share_profile(df, "rarity")),
        "prep_price_profile": _extracted(prep.listed_prices),
        "prep_lowest_prices": _extracted(prep.lowest_prices),
        "prep_date_coverage": _skins(prep.date_coverage),
        "prep_sample_per_rarity": _skins(_first_two),
        "prep_distinct_champions": _skins(prep.distinct_champions),
        "prep_catalog_price_counts": _extracted(prep.catalogue_price_counts),
        "prep_price_bands": _extracted(prep.price_bands),
        "prep_player_profile": _players(prep.player_profile),
        "prep_sales_by_segment": _sales_players(prep.sales_by_segment),
        "prep_top_prices": _sales(prep.top_prices),
        "prep_price_labels": price_labels,
        "prep_revenue": _sales(prep.total_revenue),
        "prep_revenue_by_segment": _sales_players(prep.revenue_by_segment),
    }
