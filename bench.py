"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.  Each
query runs once unmeasured on the same tables and is then timed; the result is
consumed by the noop sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlane.plans.catalog_runs import QUERIES  # noqa: E402
from marketlane.session import build_session  # noqa: E402

HEADLINE = [
    "q1_gmv_daily",
    "q1_gmv_daily_from_states",
    "q2_top_categories",
    "q3_cohort_retention",
    "q4_session_funnel",
    "q5_promo_impact",
    "s2_market_basket",
    "jn10_pairs_by_self_join",
    "s3_distinct_users",
    "k1_kpi_card",
    "m4_first_buy",
    "pl14_orders_fact",
    "pl15_order_items_fact",
    "pl1_core_users",
    "pl2_orders_promoted",
    "pl3_items_promoted",
    "pl4_payments_promoted",
    "pl8_load_audit",
    "str1_ingest_events",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "marketlane-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
