"""Time the headline queries once warm: ``python bench.py`` prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession

from shopmill.operators.scale import release
from shopmill.registry import QUERIES
from shopmill.session import start
from shopmill.sources.tpch import forget_shop

HEADLINE = """
    r01_totals r02_monthly_sales r03_sales_by_category r04_top_products r05_top_customers
    r06_average_order_value r07_orders_by_status r08_payments_by_method r09_shipment_performance
    r10_running_sales r11_monthly_growth r12_category_top3 r13_customer_ranking
    wide_sales fact_order_detail fact_customer_sales fact_product_sales customer_rank
    latest_order latest_shipment dedup_key unify_lines fk_report request_rules
    event_reconcile events_lines sales_by_category orders_lines_inner write_events
""".split()


def session(folder: str) -> SparkSession:
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shopmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    size = sum(f.stat().st_size for f in Path(folder).glob("*.parquet"))
    spark = start(builder, size, cores)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    forget_shop(spark, folder)  # each run reads its lookups and lands its events anew
    start = time.perf_counter()
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = session(folder)
    times = {}
    for name in HEADLINE:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(rounds)), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times}
    print(json.dumps(line | {"sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
