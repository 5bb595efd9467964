"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores. Every query runs once to warm up and
twice for time, the faster run counts; queries that fit models come last and run once, each candidate being fitted by the first query
that needs it. Results go to a sink that evaluates every column. ``value`` is the total of the headline queries alone.

A line on stderr reports each query as it ends. After BENCH_LIMIT seconds the JSON line is printed with what there is, and
the queries that are missing are named in ``unfinished``.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from skyweave.queries import QUERIES  # noqa: E402
from skyweave.session import build_session  # noqa: E402

HEADLINE = [
    "scan_table",
    "class_balance",
    "clean_report",
    "rule_attribution",
    "anomaly_counts",
    "expectation_metrics",
    "missing_profile",
    "feature_summary",
    "feature_summary_lineitem",
    "box_plot_lineitem",
    "kpi_tiles",
    "altitude_histogram",
    "hourly_volume",
    "grid_density",
    "metric_cube",
    "drift_psi",
    "regional_summary",
    "medallion_summary",
    "random_row_per_key",
    "latest_position",
    "latest_order",
    "busiest_tracks",
    "downsample_tracks",
    "altitude_delta",
    "rolling_features",
    "holding_loops",
    "flight_segments",
    "step_distance",
    "entity_features",
    "feature_lookup",
    "asof_features",
    "training_set",
    "stratified_split",
    "cdc_scd1",
    "cdc_scd2",
    "snapshot_diff",
    "classification_report",
    "stream_silver",
    "stream_tumbling",
    "stream_sliding",
    "stream_sessions",
    "stream_dedupe",
    "stream_latest",
    "stream_append_log",
    "feedback_append",
    "medallion_expectations",
    "entity_tracks_sliced",
    "flight_segments_sliced",
    "feature_summary_sliced",
]

# Queries that fit models take seconds to minutes: one timed run, without a warm-up.
FITTED = [
    "ml_boosting",
    "ml_logistic",
    "ml_forest",
    "ml_compare",
    "batch_score",
    "stream_score",
    "alias_move",
    "score_with_lookup",
]


def report(names: list[str], seconds: dict[str, float], folder: str) -> str:
    timed = [n for n in names if n in seconds]
    return json.dumps(
        {
            "metric": "headline_queries_total",
            "value": round(sum(seconds[n] for n in timed if n not in FITTED), 3),
            "unit": "sec",
            "queries": {n: seconds[n] for n in timed},
            "fitted_total": round(sum(seconds[n] for n in timed if n in FITTED), 3),
            "unfinished": [n for n in names if n not in seconds],
            "sf": Path(folder).name.removeprefix("sf"),
        }
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    limit = float(os.environ.get("BENCH_LIMIT", "1200"))
    names = sys.argv[1:] or HEADLINE + FITTED
    seconds: dict[str, float] = {}

    def give_up() -> None:
        print(report(names, dict(seconds), folder), flush=True)
        os._exit(0)

    clock = threading.Timer(limit, give_up)
    clock.daemon = True
    clock.start()
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "bench", "8g")
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        best = None
        first = 1 if name in FITTED else 0
        for attempt in range(first, first + 1 if first else runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            if attempt and (best is None or spent < best):
                best = spent
        seconds[name] = round(best, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    clock.cancel()
    print(report(names, seconds, folder), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
