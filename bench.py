"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver); the median of $BENCH_RUNS (default 5) runs is
reported, the job's median of 3. ``job`` is the whole monthly job over CSV
month folders (read, stage, summary JSON, tag analysis Parquet); its CSV
inputs are written once beforehand and not timed.

Set BENCH_EVENT_LOG=1 to write Spark's event log to a fresh scratch folder
for stage and task times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postlens.plans.catalog import QUERIES, write_job_inputs  # noqa: E402
from postlens.plans.monthly import run_monthly_job  # noqa: E402
from postlens.session import build_session, new_scratch_dir  # noqa: E402

HEADLINE = [
    "q_tag_analysis",
    "q_tag_analysis_by_month",
    "q_summary",
    "q_tag_stats",
    "q_tag_hero",
    "q_user_tag_counts",
    "q_active_tags",
    "q_posts_per_user",
    "q_histogram",
    "q_join_left",
    "q_explode_tags",
]


# Median of N runs per query, after a warm-up.
QUERY_RUNS = int(os.environ.get("BENCH_RUNS", "5"))
JOB_RUNS = 3


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    if os.environ.get("BENCH_EVENT_LOG"):
        log_dir = tempfile.mkdtemp(prefix="postlens-events-")
        os.environ["PYSPARK_SUBMIT_ARGS"] = (
            f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir={log_dir} "
            "pyspark-shell"
        )
        print(f"event log: {log_dir}", file=sys.stderr)

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)

    # Warm-up: JVM class loading and codegen, on the same data.
    _run(QUERIES["q_tag_analysis"](spark, sf_dir))
    _run(QUERIES["q_summary"](spark, sf_dir))

    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(QUERY_RUNS):
            t0 = time.perf_counter()
            _run(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[name] = round(median(runs), 3)

    root, posts_glob, users_glob = write_job_inputs(spark, sf_dir)
    runs = []
    for _ in range(JOB_RUNS):
        out = new_scratch_dir(spark, "bench-job")
        t0 = time.perf_counter()
        run_monthly_job(
            spark,
            root,
            out,
            snapshot_months=((1995, 1),),
            posts_glob=posts_glob,
            users_glob=users_glob,
        )
        runs.append(time.perf_counter() - t0)
    times["job"] = round(median(runs), 3)

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
