"""A write that is killed between any two steps leaves every month readable,
old or new, and the next write completes it."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from postlens.plans import sinks
from conftest import make_posts, make_users
from postlens.operators import compute_summary, compute_tag_analysis


class Killed(Exception):
    pass


def frames(spark, mark, months):
    posts, users = None, None
    for m in months:
        p = make_posts(spark, [(f"2016-{m:02d}-03 00:00:00", 1, mark, mark, f"t{mark}|x")], src=(2016, m))
        posts = p if posts is None else posts.unionByName(p)
        u = make_users(spark, [(1, f"name{mark}", 10 + mark, "2016-01-01 00:00:00", (2016, m))])
        users = u if users is None else users.unionByName(u)
    return compute_summary(posts, users), compute_tag_analysis(posts, users)


def rows(df):
    return sorted(map(str, df.collect()))


def by_month(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["src_month"], []).append(str(r))
    return {m: sorted(v) for m, v in out.items()}


@pytest.mark.parametrize("months", [None, [(2016, 2), (2016, 4)]])
@pytest.mark.parametrize("step", ["write_text", "move_path", "delete_path"])
def test_kill_at_every_step(spark, tmp_path, monkeypatch, months, step):
    old = frames(spark, 1, (2, 3, 4))
    # month 4 has no rows in the second run, month 3 none in a whole one
    new = frames(spark, 2, (2,))
    real = getattr(sinks, step)
    sink = [(sinks.write_summary, sinks.read_summary), (sinks.write_tag_analysis, sinks.read_tag_analysis)]
    for which, (write, read) in enumerate(sink):
        if which == 0 and step != "move_path":
            continue
        before, after = by_month(old[which]), by_month(new[which])
        if months:
            after[3] = before[3]
        for nth in range(1, 9):
            path = str(tmp_path / f"{step}{which}{nth}")
            write(old[which], path)
            calls = []

            def failing(*args):
                calls.append(args)
                if len(calls) == nth:
                    raise Killed
                return real(*args)

            monkeypatch.setattr(sinks, step, failing)
            try:
                write(new[which], path, months=months)
                killed = False
            except Killed:
                killed = True
            monkeypatch.setattr(sinks, step, real)
            now = by_month(read(spark, path))
            # all old or all new, as one
            assert now in (before, after), (which, nth)
            if not killed:
                assert now == after
                break
            # the next run completes it
            write(new[which], path, months=months)
            assert by_month(read(spark, path)) == after
            left = [f for f in os.listdir(path) if f.startswith("_")]
            assert not [f for f in left if f != "_SUCCESS" and not f.startswith("_fresh")]
        else:
            raise AssertionError("more steps than tried")


def test_bitmap_owners(spark):
    """Owners beside block borders, zero, negative, null, repeated."""
    from postlens.operators import posts_per_user

    owners = [1, 1, 32768, 32769, 65536, 65537, 0, -1, -32768, 2**31 - 1, None, None]
    posts = make_posts(spark, [("2016-02-01 00:00:00", o, 1, 1, "a") for o in owners])
    r = posts_per_user(posts).first()
    assert (r.number_of_posts, r.unique_users) == (12, 9)
    r = posts_per_user(posts.where(F.col("owner_user_id").isNull())).first()
    assert (r.number_of_posts, r.unique_users, r.average_posts_per_user) == (2, 0, None)
