"""Headline timings on $BENCH_SF_DIR with $BENCH_CPUS cores, as one JSON line.

``build_warehouse`` is a full refresh of the stored layers. Reports and views
then run on the stored tables, as they would between two refreshes. The
``lineitem_*`` and ``prep_*`` entries start from the raw tables. Each query runs
once to warm up; its time is the median of $BENCH_RUNS further runs, from
planning to the last row written to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from siltstone.plans import reports, views, warehouse
from siltstone.sources.tables import Store
from workload import fixtures
from workload import queries as registered

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

SILVER = (
    "dq_report",
    "dq_totals",
    "rejection_reasons",
    "silver_counts",
    "silver_quality",
    "quarantine_share",
    "silver_rarity_dist",
    "silver_segment_dist",
)
GOLD = (
    "gold_counts",
    "gold_segment_revenue",
    "gold_top10_skins",
    "gold_last6_months",
    "gold_top10_players",
    "gold_rarity_sales",
    "gold_region_sales",
)
RAW = (
    "lineitem_revenue_by_segment_month",
    "lineitem_top_selling_skins",
    "lineitem_weekend_vs_weekday_sales",
    "lineitem_player_lifetime_value",
    "lineitem_revenue_trends",
    "lineitem_segment_revenue",
    "lineitem_rarity_sales",
    "lineitem_region_sales",
    "fact_sale_clean",
    "scalar_text",
    "page_links",
    "document_keep_first",
    "prep_extract",
    "prep_dedup_filter",
    "prep_match",
    "prep_sales_by_segment",
    "prep_revenue_by_segment",
)


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("siltstone-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="siltstone-bench-")
    spark = session(scratch)
    store = Store(spark, f"{scratch}/tables")
    built: list[warehouse.Warehouse] = []

    def build() -> None:
        bronze = fixtures.bronze(spark, SF_DIR)
        built[:] = [warehouse.build(spark, bronze, fixtures.RULES, store)]

    timed = {"build_warehouse": build}
    for name in SILVER:
        timed[name] = lambda f=getattr(reports, name): run(f(built[0].silver))
    for name in GOLD:
        timed[name] = lambda f=getattr(reports, name): run(f(built[0].gold))
    for name, (view, _) in views.VIEWS.items():
        timed[name] = lambda f=view: run(f(built[0].gold))
    for name in RAW:
        timed[name] = lambda f=registered.queries()[name]: run(f(spark, SF_DIR))

    seconds: dict[str, float] = {}
    for name, work in timed.items():
        work()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            work()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)

    print(
        json.dumps(
            {
                "metric": "warehouse_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
                "cores": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
