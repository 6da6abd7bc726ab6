"""The join finds heavy owners itself and splits only these."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import make_posts, make_users
from postlens.operators import compute_tag_analysis, join_users
from postlens.operators.joins import HEAVY_SHARE, heavy_owners

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
}


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, no runtime re-planning."""
    before = {k: spark.conf.get(k) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def skewed(spark, n=24_000):
    """A third of all posts by owner 7, a sixth without owner."""
    posts = make_posts(spark, [("2016-02-01 00:00:00", 1, 1, 1, "a|b")]).limit(0)
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.col("id") % 4001)
        .cast("long")
        .alias("owner_user_id"),
        F.col("id").cast("int").alias("score"),
        F.lit("a|b").alias("tags"),
        F.timestamp_seconds(F.col("id") * 60 + 1454284800).alias("creation_date"),
        F.lit(2016).alias("src_year"),
        F.lit(2).alias("src_month"),
    )
    return posts.unionByName(rows, allowMissingColumns=True).drop("title")


def all_users(spark):
    return make_users(spark, [(i, f"n{i}", i) for i in range(0, 3000)])


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("on_month", [False, True])
def test_same_rows_and_even_tasks(shuffled, how, on_month):
    posts, users = skewed(shuffled).cache(), all_users(shuffled).cache()
    found = join_users(posts, users, how, on_month)
    plain = join_users(posts, users, how, on_month, salt_buckets=1)
    assert found.columns == plain.columns
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()

    def loads(df):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) / sorted(sizes)[len(sizes) // 2]

    assert loads(plain) > 2 and loads(found) < 1.5


def test_heavy_owners_are_few(shuffled):
    posts = skewed(shuffled)
    assert [r[0] for r in heavy_owners(posts).collect()] == [7]
    assert heavy_owners(posts.limit(0)).collect() == []
    one_each = posts.where("owner_user_id <> 7").dropDuplicates(["owner_user_id"])
    assert one_each.count() > HEAVY_SHARE and heavy_owners(one_each).isEmpty()


def test_broadcast_users_need_no_count(spark):
    """A small users side is broadcast as it was: posts are read once."""
    df = join_users(skewed(spark, 60), all_users(spark).limit(5), "left", False)
    assert "_salt" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_analysis_is_the_same(shuffled):
    posts, users = skewed(shuffled, 6000), all_users(shuffled)
    for on_month in (False, True):
        a = compute_tag_analysis(posts, users, join_on_month=on_month, pre_aggregate=False)
        b = compute_tag_analysis(posts, users, join_on_month=on_month, pre_aggregate=True)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_salted_copies_are_never_broadcast(spark):
    """Copies of a users side that Spark itself would broadcast, at planning or
    at run time, are joined by sort and merge: same rows."""
    posts, users = skewed(spark, 6000).cache(), all_users(spark).cache()
    for how in ("left", "inner"):
        for limit in ("10MB", "-1"):
            before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            try:
                plain = join_users(posts, users, how, False, salt_buckets=1)
                salted = join_users(posts, users, how, False, salt_buckets=8)
                assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
                ran = salted._jdf.queryExecution().executedPlan().toString()
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
            assert "isFinalPlan=true" in ran
            assert "SortMergeJoin" in ran and "BroadcastHashJoin" not in ran
