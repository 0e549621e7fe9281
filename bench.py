"""Benchmark: headline query keys at one scale factor, one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each timed step runs to completion through the ``noop`` sink (no driver
collect); the full medallion build writes real CSV and Parquet under the
session's checkpoint folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakecart.session import build_session  # noqa: E402

HEADLINE = [
    "gold_daily_sales",
    "gold_customer_lifetime_value",
    "gold_top_products",
    "gold_top_products_exact",
    "gold_inventory_movement",
    "gold_payment_success_rates",
    "gold_shipping_performance",
    "silver_product_reviews",
    "silver_orders",
    "silver_row_parity",
    "check_unique",
    "check_referential",
    "check_consistency",
    "report_daily_revenue",
    "report_top_customers",
    "report_best_sellers",
    "report_carrier_performance",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        app_name="lakecart-bench",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,  # about one per core locally; AQE coalesces
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
            "spark.lakecart.tableParallelism": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    from lakecart.plans import queries as registry

    qs = registry.queries()
    # Warm-up: JVM class loading and the parquet footers, not timed.
    run(spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count())

    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    registry.built_lakehouse(spark, sf_dir)  # the marts and checks below read its tables
    timings["medallion_build"] = round(time.perf_counter() - t0, 3)
    for key in HEADLINE:
        t0 = time.perf_counter()
        run(qs[key](spark, sf_dir))
        timings[key] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
