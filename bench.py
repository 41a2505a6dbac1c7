"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of a scale factor), BENCH_CPUS, BENCH_RUNS
(timed runs per query after one warm run; the median counts) and BENCH_QUERIES
(comma-separated names, or ``all``).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from orderlens.plans.catalog import queries

HEADLINE = (
    "daily_net_orders",
    "daily_company_net",
    "daily_channel2_net",
    "user_order_histogram",
    "duplicate_orders",
    "age_sex_company",
    "fact_sheet",
    "surname_counts",
    "hour_profile",
    "region_net_daily_price",
    "region_share_weekly",
    "region_counts",
    "agent_cumulative",
    "agent_milestones",
    "agent_registered",
    "lured_refunds_company",
    "renewal_last_year",
    "auto_deduct_remaining",
    "deduction_funnel",
    "exclusion_list",
    "latest_refund_remark",
    "enriched_orders",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    asked = os.environ.get("BENCH_QUERIES", "")
    every = queries()
    names = tuple(every) if asked == "all" else tuple(asked.split(",")) if asked else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
