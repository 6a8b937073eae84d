"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``.
Every query is run to completion once to warm up and then three times; the
median wall time counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from emberscope.acceptance import REGISTRY
from emberscope.session import local_session

HEADLINE = (
    "logs_query",
    "logs_text_match",
    "documents_text_match",
    "logs_time_range",
    "logs_volume_by_service",
    "logs_count",
    "metric_range_avg",
    "metric_rate_counter",
    "metric_instant",
    "histogram_quantile_step",
    "exp_histogram_quantile",
    "trace_search",
    "span_metrics_red",
    "spanset_traces",
    "series_instant_grid",
    "series_rate",
    "log_count_over_time",
    "attr_names",
    "join_logs_spans_left",
    "join_logs_in_span",
    "asof_log_metric",
    "sql_cube",
    "sql_window_rank",
    "sql_window_moving_avg",
)
RUNS = 3


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": int(cores) if cores.isdigit() else cores,
            }
        )
    )


if __name__ == "__main__":
    main()
