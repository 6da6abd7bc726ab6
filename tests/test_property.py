"""Random posts and users: Spark results against a brute-force Python model."""

from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_posts, make_users
from postlens.operators import compute_summary, compute_tag_analysis

TAGS = ["a", "b", "c", ""]
NAMES = ["al", "bo", None, ""]
MONTHS = [(2016, 1), (2016, 2)]

post_st = st.tuples(
    st.sampled_from(MONTHS),
    st.one_of(st.none(), st.integers(1, 28)),  # day, None = no date
    st.one_of(st.none(), st.integers(1, 6)),  # owner
    st.integers(-3, 9),  # score
    st.one_of(st.none(), st.integers(0, 4)),  # comments
    st.one_of(st.none(), st.lists(st.sampled_from(TAGS), min_size=1, max_size=3)),
)
user_st = st.tuples(
    st.sampled_from(MONTHS),
    st.integers(1, 5),  # id (owner 6 never matches)
    st.sampled_from(NAMES),
    st.integers(0, 50),
)


def _model_tags(posts, users, how="left", join_on_month=True):
    by_key = defaultdict(list)
    for (y, m), uid, name, rep in users:
        by_key[(y, m, uid) if join_on_month else uid].append((name, rep))
    groups = defaultdict(list)
    for (y, m), day, owner, score, _, tags in posts:
        if day is None or tags is None:
            continue
        key_u = (y, m, owner) if join_on_month else owner
        matches = by_key.get(key_u, []) if owner is not None else []
        for tag in tags:
            key = (y, m, y, m, tag)
            if matches:
                for name, rep in matches:
                    groups[key].append((owner, score, True, name, rep))
            elif how == "left":
                groups[key].append((owner, score, False, None, None))
    out = {}
    for key, rows in groups.items():
        posts_n = sum(1 for r in rows if r[0] is not None)
        reps = [r[4] for r in rows if r[4] is not None]
        names = Counter("" if r[3] is None else r[3] for r in rows if r[2])
        hero = max(names.items(), key=lambda kv: (kv[1], kv[0]))[0] if names else None
        out[key] = (
            posts_n,
            sum(reps) / len(reps) if reps else None,
            sum(r[1] for r in rows) / len(rows),
            hero,
        )
    return out


def _to_frames(spark, posts, users):
    prow = []
    for (y, m), day, owner, score, comments, tags in posts:
        cd = None if day is None else f"{y}-{m:02d}-{day:02d} 10:00:00"
        prow.append((cd, owner, score, comments, None if tags is None else "|".join(tags), (y, m)))
    urow = [(uid, name, rep, f"{y}-{m:02d}-03 00:00:00", (y, m)) for (y, m), uid, name, rep in users]
    return make_posts(spark, prow), make_users(spark, urow)


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(post_st, min_size=1, max_size=25),
    st.lists(user_st, max_size=8),
    st.sampled_from(["left", "inner"]),
    st.booleans(),
    st.booleans(),
)
def test_tag_analysis_matches_model(spark, posts, users, how, join_on_month, pre_aggregate):
    pdf, udf = _to_frames(spark, posts, users)
    result = compute_tag_analysis(
        pdf, udf, how=how, join_on_month=join_on_month, pre_aggregate=pre_aggregate
    )
    got = {
        (r["src_year"], r["src_month"], r["year"], r["month"], r["tag"]): (
            r["posts"],
            r["avg_reputation"],
            r["avg_score"],
            r["tag_hero"],
        )
        for r in result.collect()
    }
    want = _model_tags(posts, users, how, join_on_month)
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        assert g[0] == w[0] and g[3] == w[3], (k, g, w)
        for a, b in ((g[1], w[1]), (g[2], w[2])):
            assert (a is None and b is None) or abs(a - b) < 1e-9, (k, g, w)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(post_st, min_size=1, max_size=25), st.lists(user_st, max_size=8))
def test_histogram_sums_to_dated_posts(spark, posts, users):
    pdf, udf = _to_frames(spark, posts, users)
    rows = {(r["src_year"], r["src_month"]): r for r in compute_summary(pdf, udf).collect()}
    for ym in MONTHS:
        mine = [p for p in posts if p[0] == ym]
        if ym not in rows:
            assert not mine and not [u for u in users if u[0] == ym]
            continue
        r = rows[ym]
        assert r["number_of_posts"] == len(mine)
        assert sum(r["histogram"].values()) == sum(1 for p in mine if p[1] is not None)
        tags = {t for p in mine if p[5] is not None for t in p[5]}
        assert r["total_active_tags"] == len(tags)
        assert r["number_of_new_users"] == sum(1 for u in users if u[0] == ym)
