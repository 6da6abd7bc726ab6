"""Tag analysis on hand-computed frames (FIXTURES.md section 2)."""

from __future__ import annotations

import pytest

from conftest import make_posts, make_users
from postlens.operators import (
    compute_tag_analysis,
    join_users,
    tag_heroes,
    tag_stats,
    user_tag_counts,
)


def _by_tag(df):
    return {r["tag"]: r.asDict() for r in df.collect()}


@pytest.fixture()
def feb(spark):
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
    return posts, users


def test_left_join_tag_analysis(feb):
    posts, users = feb
    got = _by_tag(compute_tag_analysis(posts, users))
    assert set(got) == {"pandas", "python", "spark"}
    assert got["pandas"]["posts"] == 1
    assert got["pandas"]["avg_reputation"] == 10.0
    assert got["pandas"]["avg_score"] == 4.0
    assert got["pandas"]["tag_hero"] == "ann"
    assert got["python"]["posts"] == 3
    assert got["python"]["avg_reputation"] == pytest.approx(40 / 3)
    assert got["python"]["avg_score"] == pytest.approx(7 / 3)
    assert got["python"]["tag_hero"] == "ann"
    # unmatched owner 99 counts in posts and score, cannot be hero (D4, D5)
    assert got["spark"]["posts"] == 2
    assert got["spark"]["avg_reputation"] == 20.0
    assert got["spark"]["avg_score"] == 4.0
    assert got["spark"]["tag_hero"] == ""
    for row in got.values():
        assert (row["src_year"], row["src_month"], row["year"], row["month"]) == (
            2016,
            2,
            2016,
            2,
        )


def test_inner_join_tag_analysis(feb):
    posts, users = feb
    got = _by_tag(compute_tag_analysis(posts, users, how="inner"))
    assert got["spark"]["posts"] == 1
    assert got["spark"]["avg_score"] == 3.0
    assert got["python"]["posts"] == 3
    assert got["pandas"]["tag_hero"] == "ann"


def test_parts_agree_with_whole(feb):
    posts, users = feb
    whole = _by_tag(compute_tag_analysis(posts, users))
    stats = _by_tag(tag_stats(posts, users))
    heroes = _by_tag(tag_heroes(posts, users))
    for tag, row in whole.items():
        for c in ("posts", "avg_reputation", "avg_score"):
            assert stats[tag][c] == row[c]
        assert heroes[tag]["tag_hero"] == row["tag_hero"]
    counts = {(r["tag"], r["display_name"]): r["n_posts"] for r in user_tag_counts(posts, users).collect()}
    assert counts == {
        ("python", "ann"): 2,
        ("pandas", "ann"): 1,
        ("python", ""): 1,
        ("spark", ""): 1,
    }


def test_bad_join_type(feb):
    posts, users = feb
    with pytest.raises(ValueError):
        compute_tag_analysis(posts, users, how="right")
    with pytest.raises(ValueError):
        join_users(posts, users, how="cross")


def test_numeric_hero_order(spark):
    # 10 beats 9 as numbers (as text "9" > "10")
    rows = [("2016-02-01 00:00:00", 1, 1, 0, "t")] * 10 + [
        ("2016-02-01 00:00:00", 2, 1, 0, "t")
    ] * 9
    posts = make_posts(spark, rows)
    users = make_users(spark, [(1, "bob", 1), (2, "ann", 1)])
    (row,) = compute_tag_analysis(posts, users).collect()
    assert row["tag_hero"] == "bob"
    assert row["posts"] == 19


def test_tie_goes_to_greatest_name(spark):
    rows = [("2016-02-01 00:00:00", 1, 1, 0, "t")] * 2 + [
        ("2016-02-01 00:00:00", 2, 1, 0, "t")
    ] * 2
    posts = make_posts(spark, rows)
    users = make_users(spark, [(1, "ann", 1), (2, "zed", 1)])
    (row,) = compute_tag_analysis(posts, users).collect()
    assert row["tag_hero"] == "zed"


def test_hero_groups_by_name_not_user(spark):
    # two users named "al" with 2 posts each beat one "bo" with 3
    rows = (
        [("2016-02-01 00:00:00", 1, 1, 0, "t")] * 2
        + [("2016-02-01 00:00:00", 2, 1, 0, "t")] * 2
        + [("2016-02-01 00:00:00", 3, 1, 0, "t")] * 3
    )
    posts = make_posts(spark, rows)
    users = make_users(spark, [(1, "al", 1), (2, "al", 1), (3, "bo", 1)])
    (row,) = compute_tag_analysis(posts, users).collect()
    assert row["tag_hero"] == "al"


def test_no_match_gives_null_hero(spark):
    posts = make_posts(spark, [("2016-02-01 00:00:00", 7, 2, 0, "t")])
    users = make_users(spark, [(1, "ann", 1)])
    (row,) = compute_tag_analysis(posts, users).collect()
    assert row["tag_hero"] is None
    assert row["avg_reputation"] is None
    assert row["posts"] == 1
    assert row["avg_score"] == 2.0


def test_repeated_tag_and_null_owner(spark):
    posts = make_posts(
        spark,
        [("2016-02-01 00:00:00", 1, 1, 0, "a|a"), ("2016-02-01 00:00:00", None, 1, 0, "a")],
    )
    users = make_users(spark, [(1, "ann", 1)])
    (row,) = compute_tag_analysis(posts, users).collect()
    assert row["posts"] == 2  # owner-less post not counted, repeat counted twice
    assert row["avg_score"] == 1.0


def test_null_date_dropped(spark):
    posts = make_posts(
        spark,
        [("2016-02-01 00:00:00", 1, 1, 0, "a"), (None, 1, 1, 0, "b")],
    )
    users = make_users(spark, [(1, "ann", 1)])
    tags = {r["tag"] for r in compute_tag_analysis(posts, users).collect()}
    assert tags == {"a"}


def test_date_outside_folder(spark):
    posts = make_posts(spark, [("2016-03-01 00:00:00", 1, 1, 0, "a")], src=(2016, 2))
    users = make_users(spark, [(1, "ann", 1)], src=(2016, 2))
    (row,) = compute_tag_analysis(posts, users).collect()
    assert (row["src_year"], row["src_month"], row["year"], row["month"]) == (2016, 2, 2016, 3)
    assert row["tag_hero"] == "ann"


def test_trailing_delimiter(spark):
    posts = make_posts(spark, [("2016-02-01 00:00:00", 1, 1, 0, "x|")])
    users = make_users(spark, [(1, "ann", 1)])
    tags = sorted(r["tag"] for r in compute_tag_analysis(posts, users).collect())
    assert tags == ["", "x"]


def test_same_user_id_in_two_months(spark):
    posts = make_posts(
        spark,
        [
            ("2016-01-10 00:00:00", 1, 1, 0, "a", (2016, 1)),
            ("2016-02-10 00:00:00", 1, 1, 0, "a", (2016, 2)),
        ],
    )
    users = make_users(
        spark,
        [
            (1, "jan", 100, "2016-01-02 00:00:00", (2016, 1)),
            (1, "feb", 200, "2016-02-02 00:00:00", (2016, 2)),
        ],
    )
    got = {r["src_month"]: r for r in compute_tag_analysis(posts, users).collect()}
    assert got[1]["tag_hero"] == "jan" and got[1]["avg_reputation"] == 100.0
    assert got[2]["tag_hero"] == "feb" and got[2]["avg_reputation"] == 200.0
    # one users table for all months instead: both rows match both users
    got_all = compute_tag_analysis(posts, users, join_on_month=False).collect()
    assert all(r["posts"] == 2 for r in got_all)


def test_join_keeps_unmatched_only_for_left(feb):
    posts, users = feb
    left = join_users(posts, users, how="left")
    inner = join_users(posts, users, how="inner")
    assert left.count() == 5
    assert inner.count() == 3
    assert "id" in left.columns and "reputation" in left.columns


def test_left_join_with_many_null_owners(spark):
    rows = [("2016-02-01 00:00:00", None, i, 0, "t") for i in range(200)] + [
        ("2016-02-01 00:00:00", 1, 1, 0, "t")
    ]
    posts = make_posts(spark, rows)
    users = make_users(spark, [(1, "ann", 7)])
    for on_month in (True, False):
        joined = join_users(posts, users, how="left", join_on_month=on_month)
        assert "_owner_key" not in joined.columns
        got = joined.collect()
        assert len(got) == 201
        assert sum(1 for r in got if r["id"] is not None) == 1
        assert all(r["owner_user_id"] is None for r in got if r["id"] is None)
    # the null owners are spread over many join keys, none a valid user id
    from postlens.operators.joins import _spread_null_owners

    keys = [r["_owner_key"] for r in _spread_null_owners(posts).collect()]
    null_keys = [k for k in keys if k != 1]
    assert len(set(null_keys)) > 150
    assert all(k < -(2**31) for k in null_keys)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("on_month", [True, False])
def test_salted_join_equals_plain_join(spark, how, on_month):
    rows = (
        [("2016-02-01 00:00:00", 1, i, 0, "t") for i in range(60)]  # hot owner
        + [("2016-02-02 00:00:00", None, 1, 0, "t")] * 5
        + [("2016-02-03 00:00:00", 2, 3, 1, "u"), ("2016-02-03 00:00:00", 99, 4, 1, "u")]
    )
    posts = make_posts(spark, rows)
    users = make_users(spark, [(1, "ann", 10), (2, None, 20), (2, "dup", 30)])
    plain = join_users(posts, users, how=how, join_on_month=on_month)
    salted = join_users(posts, users, how=how, join_on_month=on_month, salt_buckets=7)
    assert salted.columns == plain.columns
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, salted.collect())) == sorted(map(key, plain.collect()))
    with pytest.raises(ValueError):
        join_users(posts, users, salt_buckets=0)
