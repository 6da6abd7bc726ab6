"""Scale and skew check: tag analysis and summary on a scaled, skewed input.

Usage: python scripts/scale_check.py [sf_dir] [copies]

Posts are derived from ``orders`` with Spark: ``copies`` copies of every
order (new owner ids per copy, so owners grow with the data), and then a
third of all rows moved to ONE owner with ONE extra tag ("hot"), plus a
twentieth with no owner. Users are ``customer`` copied the same way. The
inputs are written once as Parquet under the shared scratch folder.

Prints per analysis the wall time of a second (warm) run and, per stage, task count, max and
median task time (from Spark's event log in a fresh scratch folder): a hot
key processed by one task would show as max >> median in some stage.
ONE_USERS_TABLE=1 joins on owner only (one hot join key).
SHUFFLE_PARTITIONS=n, SKEW_THRESHOLD=16MB, ADVISORY_SIZE=4MB and
MAX_PARTITION_BYTES=2MB set the shuffle width, AQE's skew-split threshold
and target size, and the scan split size (to mimic at small scale the
partition counts of a large cluster). JOINS=1 times the row-level join, plain and with salt_buckets=16.
NO_BROADCAST=1 disables broadcast joins (the shape used when the users
table is too large to broadcast). This is a measurement script, not a
registered query.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LOG_DIR = tempfile.mkdtemp(prefix="postlens-scale-events-")
os.environ["PYSPARK_SUBMIT_ARGS"] = (
    "--conf spark.eventLog.enabled=true --conf spark.eventLog.compress=false "
    f"--conf spark.eventLog.dir={LOG_DIR} pyspark-shell"
)

from pyspark.sql import functions as F  # noqa: E402

from postlens.operators import (  # noqa: E402
    compute_summary,
    compute_tag_analysis,
    join_users,
)
from postlens.plans.sinks import stage_table  # noqa: E402
from postlens.session import build_session  # noqa: E402
from postlens.sources.adapters import posts_from_orders, users_from_customer  # noqa: E402

ID_STRIDE = 10_000_000


def scaled_inputs(spark, sf_dir: str, copies: int):
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    posts = posts_from_orders(spark, sf_dir).select("*", copy)
    bucket = F.abs(F.hash("owner_user_id", "creation_date", "score", "copy")) % 60
    owner = (
        F.when(bucket < 20, F.lit(1))  # a third of all rows: one owner
        .when(bucket < 23, F.lit(None))  # a twentieth: no owner
        .otherwise(F.col("owner_user_id") + F.col("copy") * ID_STRIDE)
    )
    tags = F.when(bucket < 20, F.concat_ws("|", F.col("tags"), F.lit("hot"))).otherwise(
        F.col("tags")
    )
    posts = posts.withColumn("owner_user_id", owner.cast("long")).withColumn("tags", tags)
    users = users_from_customer(spark, sf_dir).select("*", copy)
    users = users.withColumn(
        "id", (F.col("id") + F.col("copy") * ID_STRIDE).cast("int")
    ).where("copy = 0 OR id <> 1")
    return posts.drop("copy"), users.drop("copy")


def stage_stats(group: str):
    jobs, stage_job, tasks = {}, {}, {}
    for f in glob.glob(f"{LOG_DIR}/*/events*") + glob.glob(f"{LOG_DIR}/*"):
        if os.path.isdir(f):
            continue
        for line in open(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                if e.get("Properties", {}).get("spark.jobGroup.id") == group:
                    jobs[e["Job ID"]] = True
                    for s in e["Stage IDs"]:
                        stage_job[s] = e["Job ID"]
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    out = []
    for s in sorted(tasks):
        if s in stage_job:
            ts = tasks[s]
            out.append((s, len(ts), max(ts), statistics.median(ts)))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    parts = os.environ.get("SHUFFLE_PARTITIONS")
    spark = build_session(shuffle_partitions=int(parts) if parts else None)
    if os.environ.get("NO_BROADCAST"):
        # the large-data shape: users too big to broadcast, sort-merge join
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    if os.environ.get("ADVISORY_SIZE"):  # AQE's target partition size
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", os.environ["ADVISORY_SIZE"])
    if os.environ.get("MAX_PARTITION_BYTES"):  # more, smaller scan tasks
        spark.conf.set("spark.sql.files.maxPartitionBytes", os.environ["MAX_PARTITION_BYTES"])
    if os.environ.get("SKEW_THRESHOLD"):
        spark.conf.set(
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            os.environ["SKEW_THRESHOLD"],
        )
    posts, users = scaled_inputs(spark, sf_dir, copies)
    t0 = time.perf_counter()
    posts = stage_table(spark, posts, "scale-posts")
    users = stage_table(spark, users, "scale-users")
    n_posts, n_users = posts.count(), users.count()
    hot = posts.where("owner_user_id = 1").count()
    print(
        f"inputs: {n_posts} posts ({hot} by one owner), {n_users} users, "
        f"written in {time.perf_counter() - t0:.1f}s"
    )
    # ONE_USERS_TABLE=1 joins on owner only: the hot owner is then ONE join
    # key holding a third of all rows (by default the month keys split it).
    on_month = not os.environ.get("ONE_USERS_TABLE")
    analyses = [
        (
            "tag_analysis",
            lambda: compute_tag_analysis(posts, users, join_on_month=on_month),
        ),
        (
            "tag_analysis_join_first",
            lambda: compute_tag_analysis(
                posts, users, join_on_month=on_month, pre_aggregate=False
            ),
        ),
        ("summary", lambda: compute_summary(posts, users)),
    ]
    if os.environ.get("JOINS"):  # the row-level join, plain and salted
        analyses = [
            ("join_plain", lambda: join_users(posts, users, join_on_month=on_month)),
            (
                "join_salted_16",
                lambda: join_users(
                    posts, users, join_on_month=on_month, salt_buckets=16
                ),
            ),
        ]
    for name, build in analyses:
        build().write.format("noop").mode("overwrite").save()  # warm-up
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t0
        print(f"{name}: {wall:.2f}s (second run)")
        for s, n, mx, med in stage_stats(name):
            print(f"   stage {s:4d} tasks={n:4d} max={mx:6d}ms median={med:8.1f}ms")
    spark.stop()


if __name__ == "__main__":
    main()
