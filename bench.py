"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line.

Each query is built and read in full (all columns, all rows, no sink) in a warm session; its time
is the median of ``BENCH_RUNS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "fn_parse_date",
    "fn_truncate_text",
    "rule_age_inconsistent",
    "rule_event_date_future",
    "clean_parent",
    "clean_child",
    "dedup_keep_first",
    "join_fk_anti",
    "validate_cross_refs",
    "profile_dataset",
    "profile_top_values",
    "metrics_long",
    "metric_before_after",
    "issues_by_rule",
    "report_rule_impact",
    "star_fact",
    "star_dim_catalog",
    "quality_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
