"""Summary on hand-computed frames (FIXTURES.md section 2)."""

from __future__ import annotations

import pytest

from conftest import make_posts, make_users
from postlens.operators import compute_summary, filter_snapshot_users
from postlens.schemas import SUMMARY_SCHEMA


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_feb_summary(spark):
    posts = make_posts(
        spark,
        [
            ("2016-02-01 00:00:00", 1, 4, 2, "python|pandas"),
            ("2016-02-01 00:00:00", 1, 0, 0, "python"),
            ("2016-02-03 00:00:00", 2, 3, 1, "python|spark"),
            ("2016-02-03 00:00:00", 99, 5, None, "spark"),
            ("2016-02-29 00:00:00", None, 1, 3, None),
        ],
    )
    users = make_users(spark, [(1, "ann", 10), (2, None, 20), (3, "cy", 30)])
    s = _one(compute_summary(posts, users))
    assert s["number_of_posts"] == 5
    assert s["average_comments_per_post"] == 1.5
    assert s["number_of_new_users"] == 3
    assert s["total_active_tags"] == 3
    assert s["average_posts_per_user"] == pytest.approx(5 / 3)
    assert s["average_reputation_per_user"] == 20.0
    assert s["histogram"] == {1: 2, 3: 2, 29: 1}
    assert list(compute_summary(posts, users).columns) == SUMMARY_SCHEMA.fieldNames()


def _snapshot_users(spark, src):
    return make_users(
        spark,
        [
            (1, "a", 1, "2014-05-01 00:00:00", src),
            (2, "b", 2, "2015-12-31 23:59:59", src),
            (3, "c", 3, "2016-01-01 00:00:00", src),
            (4, "d", 4, "2016-01-31 12:00:00", src),
        ],
    )


def test_snapshot_filter_in_snapshot_folder(spark):
    users = filter_snapshot_users(_snapshot_users(spark, (2016, 1)))
    assert sorted(r["id"] for r in users.collect()) == [3, 4]
    posts = make_posts(spark, [("2016-01-02 00:00:00", 1, 1, 1, "a")], src=(2016, 1))
    s = _one(compute_summary(posts, users))
    assert s["number_of_new_users"] == 2
    assert s["average_reputation_per_user"] == 3.5


def test_snapshot_filter_elsewhere_is_noop(spark):
    users = filter_snapshot_users(_snapshot_users(spark, (2016, 2)))
    assert users.count() == 4


def test_snapshot_months_parameter(spark):
    users = _snapshot_users(spark, (2015, 12))
    kept = filter_snapshot_users(users, [(2015, 12)])
    assert [r["id"] for r in kept.collect()] == [2]
    assert filter_snapshot_users(users, []).count() == 4


def test_no_owners_gives_null_ratio(spark):
    posts = make_posts(spark, [("2016-02-01 00:00:00", None, 1, 1, "a")] * 3)
    users = make_users(spark, [(1, "a", 1)])
    s = _one(compute_summary(posts, users))
    assert s["number_of_posts"] == 3
    assert s["average_posts_per_user"] is None


def test_null_date_counted_not_in_histogram(spark):
    posts = make_posts(
        spark, [("2016-02-04 00:00:00", 1, 1, 1, "a"), (None, 1, 1, 1, "a")]
    )
    users = make_users(spark, [(1, "a", 1)])
    s = _one(compute_summary(posts, users))
    assert s["number_of_posts"] == 2
    assert s["histogram"] == {4: 1}


def test_month_with_users_only(spark):
    posts = make_posts(spark, [("2016-02-04 00:00:00", 1, 1, 1, "a")], src=(2016, 2))
    users = make_users(spark, [(1, "a", 7)], src=(2016, 3))
    got = {r["src_month"]: r.asDict() for r in compute_summary(posts, users).collect()}
    assert got[3]["number_of_posts"] == 0
    assert got[3]["total_active_tags"] == 0
    assert got[3]["histogram"] == {}
    assert got[3]["number_of_new_users"] == 1
    assert got[2]["number_of_new_users"] == 0
    assert got[2]["average_reputation_per_user"] is None


def test_active_tags_are_distinct(spark):
    posts = make_posts(
        spark,
        [("2016-02-01 00:00:00", 1, 1, 1, "a|b"), ("2016-02-02 00:00:00", 1, 1, 1, "b|c|c")],
    )
    users = make_users(spark, [(1, "a", 1)])
    assert _one(compute_summary(posts, users))["total_active_tags"] == 3
