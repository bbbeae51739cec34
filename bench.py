"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local threads.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from stratamart.plans.queries import QUERIES
from stratamart.session import build_session

# Rules, keys, upsert, marts, questions, profiling; then ingestion and all jobs in one.
HEADLINES = (
    "q1_monthly_mean",
    "q1_from_fact",
    "q2_hourly_mean",
    "q2_from_fact",
    "rules_split_summary",
    "quarantine_by_reason",
    "surrogate_key",
    "duplicate_keys_topk",
    "keep_one_per_key",
    "upsert_silver",
    "fact_trip",
    "agg_hourly_daily_lines",
    "agg_monthly_rollup",
    "orphan_counts",
    "null_profile",
    "percentiles_line_price",
    "top_amounts",
    "monthly_trips",
)
ONCE = ("upsert_stored", "type_drift", "bronze_stream", "published_hourly_mart")
REPEATS = 3


def timed(spark, name: str, folder: str) -> float:
    """Seconds to plan a query and compute all of its columns."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, "q2_hourly_mean", folder)
    seconds = {n: statistics.median(timed(spark, n, folder) for _ in range(REPEATS)) for n in HEADLINES}
    seconds |= {n: timed(spark, n, folder) for n in ONCE}
    scale = re.search(r"sf([\d.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
