"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores.
Each query runs once to warm up, then ``BENCH_RUNS`` times (default 3); the median
counts. A run covers planning, any staging, and a write to the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from feedquality.plans.queries import QUERIES
from feedquality.session import session_builder

HEADLINE = [
    "flagship",
    "job_from_json_feeds",
    "quality_report_all_scopes",
    "quarantine_split",
    "rule_regex_keep",
    "rule_unique_keep",
    "rule_unique_keeps_nulls",
    "rule_in_set_mostly_fails",
    "discard_by_value",
    "failing_value_sample",
    "agg_all_functions",
    "agg_several_columns",
    "rollup_per_user",
    "join_inner",
    "join_left",
    "join_full",
    "join_right",
    "join_left_semi",
    "join_left_anti",
    "join_full_split",
    "join_theta",
    "join_theta_left",
    "join_range_bands",
    "join_range_events",
    "json_round_trip",
    "csv_round_trip",
    "discard_by_value_many",
    "failing_values_complete",
    "rule_unique_struct",
    "rule_in_set_large",
    "job_from_inferred_feeds",
    "job_with_corrupt_lines",
    "gate_declared_types",
    "rule_in_set_table",
    "join_range_left",
    "join_range_anti",
    "sink_runs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (session_builder("bench").master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
             .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-shared-"))
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 4), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
