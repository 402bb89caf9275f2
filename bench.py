"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query starts without cached tables and is counted until all its rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayflux import catalog  # noqa: E402
from wayflux.session import local_session  # noqa: E402

HEADLINES = [
    "flow_alerts", "daily_graph_nodes", "daily_graph_edges", "graph_values", "movement_statistics", "neighbour_case_totals", "cases_in_areas",
    "flows_between_areas", "nearest_centre", "smoothed_cases", "forecast_features", "onset_counts", "renewal_rt", "case_windows", "change_maps",
    "attributes_by_rule", "best_tenth_per_hour", "lines_ranked", "prices_without_outliers", "top_brands_and_others", "weekday_weekend_flows", "personalised_rank",
    "ridge_summary", "rt_by_area", "ranges_for_areas",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{root}/lineitem.parquet").count()  # start the executor threads
    queries, took = catalog.load(), {}
    for name in HEADLINES:
        spark.catalog.clearCache()
        t0 = time.time()
        queries[name].run(spark, root).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": root}))


if __name__ == "__main__":
    main()
