"""Incremental month runs: results equal one batch run over all months."""

from __future__ import annotations

from test_sources_sinks import POSTS_HEADER, USERS_HEADER, _write

from postlens.plans.monthly import run_monthly_job
from postlens.plans.sinks import read_summary, read_tag_analysis
from postlens.streaming import start_month_stream


def _month(root, month, posts, users):
    _write(f"{root}/2016/{month:02d}/posts.csv", POSTS_HEADER, posts)
    _write(f"{root}/2016/{month:02d}/users.csv", USERS_HEADER, users)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_matches_batch(spark, scratch):
    inputs, out_stream, out_batch = f"{scratch}/in", f"{scratch}/s", f"{scratch}/b"
    _month(
        inputs,
        1,
        [("a", 0, 1, "2016-01-03 00:00:00", 1, 5, "x|y", 1)],
        [(1, "ann", "2016-01-01 00:00:00", 10, "", 0, 0)],
    )
    q = start_month_stream(spark, inputs, out_stream)
    q.awaitTermination()
    assert _rows(read_summary(spark, f"{out_stream}/summary").select("src_month")) == [(1,)]

    _month(
        inputs,
        2,
        [
            ("b", 0, 2, "2016-02-03 00:00:00", 2, 3, "x", 1),
            ("c", 0, 3, "2016-02-04 00:00:00", 2, 4, "z", 1),
        ],
        [(2, "bo", "2016-02-01 00:00:00", 20, "", 0, 0)],
    )
    q = start_month_stream(spark, inputs, out_stream)
    q.awaitTermination()
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in progress) == 2  # only the new files

    run_monthly_job(spark, inputs, out_batch)
    for reader, sub in ((read_summary, "summary"), (read_tag_analysis, "tag_analysis")):
        s = reader(spark, f"{out_stream}/{sub}")
        b = reader(spark, f"{out_batch}/{sub}")
        if "histogram" in s.columns:
            s, b = s.drop("histogram"), b.drop("histogram")
        assert _rows(s) == _rows(b)


def test_late_part_file_rebuilds_its_month(spark, scratch):
    inputs, out = f"{scratch}/in", f"{scratch}/out"
    _write(
        f"{inputs}/2016/01/posts.csv/part-1.csv",
        POSTS_HEADER,
        [("a", 0, 1, "2016-01-03 00:00:00", 1, 5, "x", 1)],
    )
    _write(
        f"{inputs}/2016/01/users.csv",
        USERS_HEADER,
        [(1, "ann", "2016-01-01 00:00:00", 10, "", 0, 0)],
    )
    _month(
        inputs,
        2,
        [("b", 0, 2, "2016-02-03 00:00:00", 1, 3, "x", 1)],
        [(1, "feb-ann", "2016-02-01 00:00:00", 20, "", 0, 0)],
    )
    start_month_stream(spark, inputs, out).awaitTermination()
    before = {r["src_month"]: r["number_of_posts"] for r in read_summary(spark, f"{out}/summary").collect()}
    assert before == {1: 1, 2: 1}

    # a late part file for January only
    _write(
        f"{inputs}/2016/01/posts.csv/part-2.csv",
        POSTS_HEADER,
        [("c", 0, 1, "2016-01-04 00:00:00", 1, 7, "x|y", 1)],
    )
    q = start_month_stream(spark, inputs, out)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1  # the new file only
    after = {r["src_month"]: r["number_of_posts"] for r in read_summary(spark, f"{out}/summary").collect()}
    assert after == {1: 2, 2: 1}
    tags = {(r["src_month"], r["tag"]): r["posts"] for r in read_tag_analysis(spark, f"{out}/tag_analysis").collect()}
    assert tags == {(1, "x"): 2, (1, "y"): 1, (2, "x"): 1}
