"""Headline queries on one machine: one JSON line with seconds per query.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores,
BENCH_QUERIES (comma-separated) narrows the list, BENCH_RUNS the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.queries import QUERIES  # noqa: E402
from strata.session import get_spark  # noqa: E402

HEADLINE = [
    "top_parts_by_weekday", "top_businesses_with_ties", "ranked_lines_per_group", "latest_event_per_user", "latest_texts",
    "profile_orders", "metric_view_year_brand", "percentile_trim", "weekday_usage", "daily_sales_report", "daily_item_revenue",
    "star_query", "star_fact_unknown", "lookup_as_of", "not_exists", "exists_changed", "rejects", "summary_lineitem",
    "render_text", "merge_upsert", "merge_newer", "merge_hash_diff", "assign_surrogate_keys", "scd2_dimension", "fact_transactions",
    "dq_quarantine", "dq_route", "key_audit", "doc_block_counts", "embed_docs", "similar_topk", "similar_batch", "hybrid_search",
    "source_rescued",
]


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    # The noop sink computes every row and column, like a write without the disk.
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_spark(
        "strata-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run_once(spark, name, folder)  # cold
        seconds[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "warm median, all headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
