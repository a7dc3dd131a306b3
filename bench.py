"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from acctiers.catalog import load
from acctiers.session import build_session

HEADLINE = (
    "C1_latest_record",
    "D1_int_order_lines",
    "D2_fct_orders",
    "D3_dim_customers",
    "D4_dim_products",
    "E1_int_order_totals",
    "E2_fct_customer_monthly",
    "E9_exact_quantiles",
    "F5_average_percent_rank",
    "I2_scd2_from_log",
    "J_warehouse_tests",
    "K_all_expectations",
    "L4_volume_history",
    "L7_infer_logical_types",
    "L16_mart_data_health",
    "M_build_features",
    "M16_build_features_multi",
    "O8_score_customers",
    "R1_mart_customer_tiers",
    "P2_kruskal_wallis",
    "P8_bootstrap_spearman",
    "S5_revenue_cube",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()
    queries["B3_is_recognized"].run(spark, folder).collect()  # start the session
    wanted = sys.argv[1:] or HEADLINE
    times = {}
    for name in wanted:
        started = time.perf_counter()
        queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
