"""Benchmark: prints one JSON line with the median seconds of the headline queries.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 3).
Every result is evaluated in full into a discarding sink. The template corpus is built first and timed as
``build_corpus``; the queries then read it, as they would read a stored corpus.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans import corpus  # noqa: E402
from plumbline.plans.queries import REGISTRY  # noqa: E402
from plumbline.session import local_session  # noqa: E402

HEADLINE = (
    "c_summary",
    "c_summary_from_documents",
    "c_details",
    "c02",
    "redundant_resources",
    "t_component_summary",
    "t_pipeline_info",
    "t_activity_info",
    "shred_resources",
    "shred_activities",
    "n_word_count",
    "n_order_line_count",
    "r_latest_run",
    "r_terminal_runs",
    "r_activity_errors",
    "r_running_gate",
    "r_last_execution",
    "i_landing_path",
    "i_clean_csv",
    "workspace_tree",
    "st_autoscale_target_batch",
    "st_autoscale_target",
    "st_run_status",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="bench", **{"spark.checkpoint.dir": shared})
    times: dict[str, float] = {}
    start = time.perf_counter()
    corpus.resources(spark, sf_dir)
    times["build_corpus"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds), 3)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    sf = float(scale) if scale.replace(".", "", 1).isdigit() else scale
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)


if __name__ == "__main__":
    main()
