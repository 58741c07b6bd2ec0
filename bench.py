"""Time the headline reports and print one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the number of local threads. Each
report runs once to warm up and then BENCH_RUNS times; its median counts. Results go to
a sink that reads every row and column but stores nothing.
"""

import contextlib
import json
import os
import statistics
import sys
import time

from souk.plans.queries import queries
from souk.session import local_session

HEADLINE = [
    "clean_transactions",
    "clean_sessions",
    "export_transactions",
    "export_transaction_items",
    "export_sessions",
    "enrich_products",
    "session_keyed_table",
    "recent_sessions_per_user",
    "top_products_lines",
    "top_products_orders",
    "product_revenue",
    "top_product_names",
    "monthly_revenue",
    "category_revenue",
    "payment_mix",
    "kpi_summary",
    "user_segments",
    "cohort_spend",
    "clv",
    "clv_histogram",
    "clv_concentration",
    "device_conversion",
    "referrer_revenue",
    "session_funnel",
    "product_funnel",
    "product_performance",
    "copurchase_pairs",
    "also_bought",
    "coview_pairs",
    "stream_product_views",
    "fk_violations",
    "duplicate_keys",
    "user_sessions_recent",
    "user_sessions_converted",
    "order_lines_from_carts",
    "stream_payment_windows",
    "stream_sessions",
    "stream_dedup",
]


def run(build, spark, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    available = queries()
    if names == ["all"]:
        names = list(available)
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(cpus)
        seconds = {}
        for name in names:
            run(available[name], spark, folder)
            seconds[name] = round(statistics.median(run(available[name], spark, folder) for _ in range(runs)), 3)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
