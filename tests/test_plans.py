"""Plan shape: the properties the design relies on at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from conftest import make_posts, make_users
from postlens.operators import compute_summary, compute_tag_analysis, filter_snapshot_users
from postlens.plans.catalog import QUERIES
from postlens.plans.sinks import stage_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    """Physical plan text, as printed by ``explain()``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def no_static_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_tag_analysis_plan(spark, no_static_broadcast):
    plan = _plan(QUERIES["q_tag_analysis"](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # users are not broadcast without a size check passing: sort-merge join
    assert "SortMergeJoin" in plan and "LeftOuter" in plan
    # every exchange on the posts side follows a partial aggregation
    assert plan.count("partial_count(1)") == 1
    assert plan.count("partial_sum(rows") >= 1
    # the customer scan reads only the columns the analysis needs
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    customer_scan = [s for s in scans if "c_custkey" in s][0]
    assert "c_mktsegment" not in customer_scan and "c_nationkey" not in customer_scan


def test_tag_analysis_hero_is_not_collected(spark):
    plan = _plan(QUERIES["q_tag_analysis"](spark, SF))
    for f in ("collect_list", "collect_set", "mode("):
        assert f not in plan


def test_summary_has_no_join(spark):
    plan = _plan(QUERIES["q_summary"](spark, SF))
    assert "Join" not in plan
    assert "partial_count(distinct" in plan


def test_snapshot_filter_prunes_staged_partitions(spark):
    users = make_users(
        spark,
        [(1, "a", 1, "2016-01-02 00:00:00", (2016, 1)), (2, "b", 1, "2016-02-02 00:00:00", (2016, 2))],
    )
    staged, _ = stage_table(spark, users, "plan-test")
    plan = _plan(filter_snapshot_users(staged).where("src_month = 2"))
    assert re.search(r"PartitionFilters: \[[^\]]*src_month", plan)


def test_skewed_keys_are_exact(spark):
    # one owner, one tag and the null owner each hold a large share of rows
    rows = (
        [("2016-02-01 00:00:00", 1, 2, 1, "hot|a")] * 300
        + [("2016-02-02 00:00:00", None, 1, 1, "hot")] * 300
        + [("2016-02-03 00:00:00", i, 3, 1, "hot|b") for i in range(2, 302)]
    )
    posts = make_posts(spark, rows)
    users = make_users(spark, [(1, "whale", 5)] + [(i, f"u{i}", 1) for i in range(2, 302)])
    got = {r["tag"]: r for r in compute_tag_analysis(posts, users).collect()}
    assert got["hot"]["posts"] == 600
    assert got["hot"]["avg_score"] == pytest.approx((300 * 2 + 300 * 1 + 300 * 3) / 900)
    assert got["hot"]["avg_reputation"] == pytest.approx((300 * 5 + 300 * 1) / 600)
    assert got["hot"]["tag_hero"] == "whale"
    assert got["a"]["posts"] == 300 and got["b"]["posts"] == 300
    s = compute_summary(posts, users).collect()[0]
    assert s["number_of_posts"] == 900
    assert s["average_posts_per_user"] == pytest.approx(900 / 301)
    assert s["total_active_tags"] == 3


def test_write_clustering_is_bounded_by_output_folders(spark):
    from postlens.plans.sinks import _cluster

    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        posts = make_posts(
            spark,
            [
                ("2016-01-01 00:00:00", 1, 1, 1, "a", (2016, 1)),
                ("2016-02-01 00:00:00", 1, 1, 1, "a", (2016, 2)),
            ],
        )
        users = make_users(spark, [(1, "a", 1)])
        summary = compute_summary(posts, users)
        assert _cluster(summary, ["src_year", "src_month"]).rdd.getNumPartitions() <= 2
    finally:
        spark.conf.set(key, old)


def test_many_month_selection_is_one_set_lookup(spark):
    from postlens.plans.monthly import _only_months

    posts = make_posts(spark, [("2016-01-01 00:00:00", 1, 1, 1, "a", (2016, 1))])
    months = [(2000 + i // 12, 1 + i % 12) for i in range(100)] + [(2016, 1)]
    plan = _plan(_only_months(posts, months))
    assert "INSET" in plan.upper()
    assert plan.count("src_year") < 10  # no per-month OR terms
    assert _only_months(posts, months).count() == 1


def test_salted_join_uses_salt_as_join_key(spark, no_static_broadcast):
    plan = _plan(QUERIES["q_join_left_salted"](spark, SF))
    join_line = [l for l in plan.splitlines() if "SortMergeJoin" in l][0]
    assert "_salt" in join_line and "_owner_key" in join_line
