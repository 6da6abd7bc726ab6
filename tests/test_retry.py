"""Task failures: the job's results do not change when tasks are retried.

Runs in a separate Spark process with master ``local[4,3]`` (failed tasks
are retried up to 3 times; the shared test session does not retry). A
test-only Python UDF makes the first attempt of some scan tasks fail; the
outputs must equal those of a run without failures.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import json, sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from postlens.plans.monthly import run_on_frames
    from postlens.plans.sinks import read_summary, read_tag_analysis
    from postlens.session import JOB_CONF
    from postlens.sources.adapters import posts_from_orders, users_from_customer

    b = SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
    b = b.config("spark.sql.shuffle.partitions", "4")
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")

    @F.udf(T.BooleanType())
    def flaky(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return True

    sf = "/root/testdata/sf0.001"
    out = {{}}
    for name, inject in (("clean", False), ("flaky", True)):
        spark.sparkContext.setJobGroup(name, name)
        posts = posts_from_orders(spark, sf).repartition(4)
        if inject:
            posts = posts.where(flaky(F.col("score")))
        res = run_on_frames(posts, users_from_customer(spark, sf), {out!r} + "/" + name)
        tags = read_tag_analysis(spark, res.tag_analysis)
        summ = read_summary(spark, res.summary).drop("histogram")
        out[name] = [sorted(map(repr, map(tuple, d.collect()))) for d in (tags, summ)]
    st = spark.sparkContext.statusTracker()
    failed = 0
    for job in st.getJobIdsForGroup("flaky"):
        for stage in st.getJobInfo(job).stageIds:
            info = st.getStageInfo(stage)
            failed += info.numFailedTasks if info else 0
    same = out["clean"] == out["flaky"] and len(out["clean"][0]) > 0
    print("RESULT" + json.dumps({{"same": same, "failed_tasks": failed}}))
    """
)


def test_results_survive_task_retries(tmp_path):
    code = SCRIPT.format(repo=REPO, out=str(tmp_path))
    proc = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=600
    )
    lines = [l for l in proc.stdout.splitlines() if l.startswith("RESULT")]
    assert lines, proc.stderr[-3000:]
    result = json.loads(lines[-1][len("RESULT"):])
    assert result["failed_tasks"] > 0  # failures were injected and retried
    assert result["same"]
