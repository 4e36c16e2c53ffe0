"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Every query is built and executed completely (a noop
sink takes all rows); the session is warmed up once, untimed.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.queries.all import REGISTRY
from tidemark.session import local_session, run_folders

HEADLINE = [
    "weekly_revenue_by_region", "quarterly_revenue_to_date", "quarterly_order_cube", "revenue_measures_by_source",
    "weekly_traffic_cube", "visit_fact", "trial_conversions", "last_click_before_purchase", "phase_interval_join",
    "survivor_and_parent", "latest_order_per_account", "lower_funnel", "seat_rate", "renewal_rate", "active_users",
    "social_posts", "fund_raw_claims", "fund_stage", "fuzzy_country", "smoothed_conversion", "reconciled_sources",
    "row_checks", "upserted_rows", "grouped_measures",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, cpus)

    def run(name: str) -> float:
        with run_folders(spark):
            began = time.perf_counter()
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            return round(time.perf_counter() - began, 3)

    run(HEADLINE[0])
    timings = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
