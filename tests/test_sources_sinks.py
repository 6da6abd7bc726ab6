"""Month-folder CSV source, sinks, and the whole job over CSV files."""

from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from postlens.functions.columns import folder_key
from postlens.plans.monthly import run_monthly_job
from postlens.plans.sinks import read_summary, read_tag_analysis
from postlens.sources.csv_months import read_posts, read_users

POSTS_HEADER = [
    "title",
    "answer_count",
    "comment_count",
    "creation_date",
    "owner_user_id",
    "score",
    "tags",
    "view_count",
]
USERS_HEADER = [
    "id",
    "display_name",
    "creation_date",
    "reputation",
    "location",
    "up_votes",
    "down_votes",
]


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)  # doubles quotes, quotes fields with newlines
        w.writerow(header)
        w.writerows(rows)


def _inputs(root):
    _write(
        f"{root}/2016/01/posts.csv",
        POSTS_HEADER,
        [
            ('Say "hi"\nplease', 1, 2, "2016-01-03 00:00:00", 1, 5, "python|spark", 10),
            ("plain", 0, 4, "2016-01-04 01:02:03", 2, 1, "python", 3),
            ("no owner", 0, "", "2016-01-04 05:00:00", "", 2, "", 1),
        ],
    )
    _write(
        f"{root}/2016/01/users.csv",
        USERS_HEADER,
        [
            (1, 'Ann "the" Coder', "2016-01-01 00:00:00", 100, "x, y", 1, 0),
            (2, "Old Timer", "2014-05-01 00:00:00", 900, "", 1, 0),
        ],
    )
    _write(
        f"{root}/2016/02/posts.csv",
        POSTS_HEADER,
        [
            ("feb", 0, 1, "2016-02-10 00:00:00", 3, 7, "spark", 1),
            ("feb2", 0, 3, "2016-02-11 00:00:00", 1, 1, "spark|scala", 1),
        ],
    )
    _write(
        f"{root}/2016/02/users.csv",
        USERS_HEADER,
        [(3, "Cy", "2016-02-02 00:00:00", 30, "", 0, 0)],
    )


def test_folder_key_patterns(spark):
    df = spark.createDataFrame(
        [
            ("file:/data/in/2016/01/posts.csv",),
            ("file:/x/src_year=2015/src_month=12/part-0.csv",),
            ("s3a://b/p/2017/3/users.csv",),
            ("file:/flat/posts.csv",),
        ],
        "p string",
    )
    got = [tuple(r) for r in df.select(folder_key(1, "p"), folder_key(2, "p")).collect()]
    assert got == [(2016, 1), (2015, 12), (2017, 3), (None, None)]


def test_csv_dialect_and_month_keys(spark, scratch):
    _inputs(scratch)
    posts = read_posts(spark, scratch, multiline=True)
    rows = {r["title"]: r for r in posts.collect()}
    assert len(rows) == 5
    assert rows['Say "hi"\nplease']["tags"] == "python|spark"
    assert (rows["plain"]["src_year"], rows["plain"]["src_month"]) == (2016, 1)
    assert (rows["feb"]["src_year"], rows["feb"]["src_month"]) == (2016, 2)
    assert rows["no owner"]["owner_user_id"] is None
    assert rows["no owner"]["comment_count"] is None
    users = {r["id"]: r for r in read_users(spark, scratch).collect()}
    assert users[1]["display_name"] == 'Ann "the" Coder'
    assert users[1]["location"] == "x, y"


def test_missing_inputs_raise(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_posts(spark, f"{scratch}/nothing-here")


def test_job_end_to_end_and_rerun(spark, scratch):
    inputs, outputs = f"{scratch}/in", f"{scratch}/out"
    _inputs(inputs)
    counts = []
    for _ in range(2):
        res = run_monthly_job(spark, inputs, outputs, multiline=True)
        summary = read_summary(spark, res.summary)
        tags = read_tag_analysis(spark, res.tag_analysis)
        counts.append((summary.count(), tags.count()))
    assert counts[0] == counts[1] == (2, 4)

    s = {r["src_month"]: r.asDict() for r in summary.collect()}
    jan, feb = s[1], s[2]
    assert jan["number_of_posts"] == 3
    assert jan["average_comments_per_post"] == 3.0
    # snapshot folder: the 2014 user is dropped
    assert jan["number_of_new_users"] == 1
    assert jan["average_reputation_per_user"] == 100.0
    # an empty CSV field is null: the third post has no tags
    assert jan["total_active_tags"] == 2
    assert jan["average_posts_per_user"] == 1.5
    assert jan["histogram"] == {3: 1, 4: 2}
    assert feb["number_of_posts"] == 2 and feb["histogram"] == {10: 1, 11: 1}

    t = {(r["src_month"], r["tag"]): r.asDict() for r in tags.collect()}
    assert t[(1, "python")]["posts"] == 2
    assert t[(1, "python")]["tag_hero"] == 'Ann "the" Coder'
    # user 2 was filtered out of the snapshot, so their post is unmatched
    assert t[(1, "python")]["avg_reputation"] == 100.0
    # Feb posts of user 1 do not match: user 1 is in the January file only
    assert t[(2, "spark")]["posts"] == 2
    assert t[(2, "spark")]["tag_hero"] == "Cy"
    assert t[(2, "scala")]["tag_hero"] is None

    # partition folders as documented
    assert os.path.isdir(f"{outputs}/summary/src_year=2016/src_month=1")
    assert os.path.isdir(
        f"{outputs}/tag_analysis/src_year=2016/src_month=2/year=2016/month=2"
    )


def test_dynamic_rerun_of_one_month(spark, scratch):
    inputs, outputs = f"{scratch}/in", f"{scratch}/out"
    _inputs(inputs)
    run_monthly_job(spark, inputs, outputs, multiline=True)
    res = run_monthly_job(spark, inputs, outputs, months=[(2016, 2)], multiline=True)
    summary = read_summary(spark, res.summary)
    assert sorted(r["src_month"] for r in summary.collect()) == [1, 2]
    tags = read_tag_analysis(spark, res.tag_analysis)
    assert tags.where(F.col("src_month") == 2).count() == 2
    assert tags.count() == 4


def test_single_line_csv_option(spark, scratch):
    _write(
        f"{scratch}/2016/03/posts.csv",
        POSTS_HEADER,
        [("t", 0, 1, "2016-03-01 00:00:00", 1, 1, "a|b", 1)],
    )
    posts = read_posts(spark, scratch, multiline=False)
    assert posts.count() == 1


def test_month_entry_as_folder_of_part_files(spark, scratch):
    # a big month delivered as several files inside posts.csv/
    _write(
        f"{scratch}/2016/05/posts.csv/part-1.csv",
        POSTS_HEADER,
        [("p1", 0, 1, "2016-05-01 00:00:00", 1, 1, "a", 1)],
    )
    _write(
        f"{scratch}/2016/05/posts.csv/part-2.csv",
        POSTS_HEADER,
        [("p2", 0, 1, "2016-05-02 00:00:00", 2, 1, "b", 1)],
    )
    _write(
        f"{scratch}/2016/06/posts.csv",
        POSTS_HEADER,
        [("p3", 0, 1, "2016-06-02 00:00:00", 2, 1, "b", 1)],
    )
    got = sorted(
        (r["title"], r["src_year"], r["src_month"]) for r in read_posts(spark, scratch).collect()
    )
    assert got == [("p1", 2016, 5), ("p2", 2016, 5), ("p3", 2016, 6)]


def test_run_on_frames_matches_csv_job(spark, scratch):
    from postlens.plans.monthly import run_on_frames

    inputs = f"{scratch}/in"
    _inputs(inputs)
    via_csv = run_monthly_job(spark, inputs, f"{scratch}/a", multiline=True)
    posts, users = read_posts(spark, inputs, multiline=True), read_users(spark, inputs)
    via_frames = run_on_frames(posts, users, f"{scratch}/b")
    for reader, attr in ((read_summary, "summary"), (read_tag_analysis, "tag_analysis")):
        a = reader(spark, getattr(via_csv, attr))
        b = reader(spark, getattr(via_frames, attr))
        if "histogram" in a.columns:
            a, b = a.drop("histogram"), b.drop("histogram")
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_month_without_users_and_month_with_header_only(spark, scratch):
    inputs = f"{scratch}/in"
    _write(
        f"{inputs}/2016/03/posts.csv",
        POSTS_HEADER,
        [("p", 0, 2, "2016-03-05 00:00:00", 5, 1, "a", 1)],
    )  # no users.csv in 2016/03
    _write(f"{inputs}/2016/04/posts.csv", POSTS_HEADER, [])  # header only
    _write(
        f"{inputs}/2016/04/users.csv",
        USERS_HEADER,
        [(5, "eve", "2016-04-01 00:00:00", 50, "", 0, 0)],
    )
    with pytest.raises(FileNotFoundError, match="2016/03/users.csv"):
        run_monthly_job(spark, inputs, f"{scratch}/out")
    res = run_monthly_job(spark, inputs, f"{scratch}/out", strict=False)
    s = {r["src_month"]: r.asDict() for r in read_summary(spark, res.summary).collect()}
    assert s[3]["number_of_posts"] == 1 and s[3]["number_of_new_users"] == 0
    assert s[3]["average_reputation_per_user"] is None
    assert s[4]["number_of_posts"] == 0 and s[4]["number_of_new_users"] == 1
    assert s[4]["histogram"] == {} and s[4]["average_posts_per_user"] is None
    (t,) = read_tag_analysis(spark, res.tag_analysis).collect()
    assert (t["src_month"], t["tag"], t["posts"], t["tag_hero"]) == (3, "a", 1, None)


def test_summary_json_lines_keep_nulls(spark, scratch):
    import glob
    import json as _json

    inputs = f"{scratch}/in"
    _write(
        f"{inputs}/2016/07/posts.csv",
        POSTS_HEADER,
        [("t", 0, "", "2016-07-02 00:00:00", "", 1, "a", 1)],  # no owner, no comments
    )
    _write(f"{inputs}/2016/07/users.csv", USERS_HEADER, [])
    res = run_monthly_job(spark, inputs, f"{scratch}/out")
    files = glob.glob(f"{res.summary}/src_year=2016/src_month=7/*.json")
    assert len(files) == 1
    (line,) = [l for l in open(files[0]) if l.strip()]
    obj = _json.loads(line)
    assert set(obj) == {
        "number_of_posts",
        "average_comments_per_post",
        "number_of_new_users",
        "total_active_tags",
        "average_posts_per_user",
        "average_reputation_per_user",
        "histogram",
    }
    assert obj["number_of_posts"] == 1 and obj["histogram"] == {"2": 1}
    assert obj["average_comments_per_post"] is None
    assert obj["average_posts_per_user"] is None


def _month(root, month, posts, users):
    _write(f"{root}/2016/{month:02d}/posts.csv", POSTS_HEADER, posts)
    _write(f"{root}/2016/{month:02d}/users.csv", USERS_HEADER, users)


def _both(spark, res):
    s = read_summary(spark, res.summary).collect()
    t = read_tag_analysis(spark, res.tag_analysis).collect()
    return sorted(map(repr, s)), sorted(map(repr, t))


def test_partial_run_sees_users_of_all_months(spark, scratch):
    inputs = f"{scratch}/in"
    _month(inputs, 2, [], [(1, "ann", "2016-02-01 00:00:00", 10, "", 0, 0)])
    _month(inputs, 3, [("p", 0, 1, "2016-03-02 00:00:00", 1, 4, "py", 1)], [])
    full = run_monthly_job(spark, inputs, f"{scratch}/out", join_on_month=False)
    want = _both(spark, full)
    assert "tag_hero='ann'" in want[1][0]
    run_monthly_job(spark, inputs, f"{scratch}/out", join_on_month=False, months=[(2016, 3)])
    assert _both(spark, full) == want


def test_partial_run_leaves_no_stale_rows(spark, scratch):
    inputs, out = f"{scratch}/in", f"{scratch}/out"
    user = [(1, "ann", "2016-02-01 00:00:00", 10, "", 0, 0)]
    stray = ("s", 0, 1, "2016-01-09 00:00:00", 1, 4, "old", 1)
    post = ("p", 0, 1, "2016-02-02 00:00:00", 1, 4, "py", 1)
    _month(inputs, 2, [stray, post], user)
    _month(inputs, 3, [("m", 0, 1, "2016-03-02 00:00:00", 1, 4, "py", 1)], [])
    res = run_monthly_job(spark, inputs, out)
    assert read_tag_analysis(spark, res.tag_analysis).count() == 3
    # the stray post goes, and March becomes empty
    _month(inputs, 2, [post], user)
    _month(inputs, 3, [], [])
    run_monthly_job(spark, inputs, out, months=[(2016, 2), (2016, 3)])
    fresh = run_monthly_job(spark, inputs, f"{scratch}/fresh")
    assert _both(spark, res) == _both(spark, fresh)
    assert not os.path.exists(f"{res.summary}/src_year=2016/src_month=3")
    assert not [f for f in os.listdir(res.summary) if f.startswith("_fresh")]


def test_large_file_is_split(spark, scratch):
    rows = [(f"t{i}", 0, 1, "2016-03-01 00:00:00", 1, 1, "a|b", 1) for i in range(20000)]
    _write(f"{scratch}/2016/03/posts.csv", POSTS_HEADER, rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        assert read_posts(spark, scratch).rdd.getNumPartitions() > 1
        assert read_posts(spark, scratch, multiline=True).rdd.getNumPartitions() == 1
        assert read_posts(spark, scratch).count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_broken_rows_are_reported(spark, scratch):
    inputs, out = f"{scratch}/in", f"{scratch}/out"
    good = ("ok", 0, 1, "2016-03-01 00:00:00", 1, 1, "a", 1)
    _month(inputs, 3, [("line1\nline2", 0, 1, "2016-03-01 00:00:00", 1, 1, "a", 1), good], [])
    with pytest.raises(Exception, match="(?i)malformed"):
        run_monthly_job(spark, inputs, out)
    res = run_monthly_job(spark, inputs, out, malformed="reject")
    bad = spark.read.json(f"{out}/rejected/posts.csv").collect()
    assert len(bad) >= 1 and any("line1" in r["line"] for r in bad)
    assert read_summary(spark, res.summary).count() == 1
    # the same file read as it is meant
    assert read_posts(spark, inputs, multiline=True).count() == 2


def test_reordered_header_is_an_error(spark, scratch):
    header = [POSTS_HEADER[1], POSTS_HEADER[0], *POSTS_HEADER[2:]]
    _write(f"{scratch}/2016/03/posts.csv", header, [(1, "t", 1, "", 1, 1, "a", 1)])
    for mode in ("fail", "null", "keep"):
        with pytest.raises(Exception, match="(?i)header"):
            read_posts(spark, scratch, malformed=mode).collect()


def test_staged_folders_are_removed(spark, scratch):
    from postlens.session import scratch_root

    inputs = f"{scratch}/in"
    _inputs(inputs)
    run_monthly_job(spark, inputs, f"{scratch}/out", multiline=True)
    root = scratch_root(spark).removeprefix("file:")
    folder = f"{root}/postlens"
    left = os.listdir(folder) if os.path.isdir(folder) else []
    assert not [f for f in left if f.startswith(("posts-", "users-"))]


def test_month_is_written_by_several_tasks(spark, scratch):
    from postlens.sources.csv_months import write_month_csv

    rows = [(f"t{i}", 1, 1, None, i, 1, "a", 1, 2016, 1) for i in range(200)]
    cols = "title string, answer_count int, comment_count int, creation_date timestamp, "
    cols += "owner_user_id long, score int, tags string, view_count int, src_year int, src_month int"
    write_month_csv(spark.createDataFrame(rows, cols), f"{scratch}/w")
    files = os.listdir(f"{scratch}/w/src_year=2016/src_month=1")
    assert len([f for f in files if f.endswith(".csv")]) > 1


def test_caller_settings_stay(spark):
    from postlens.session import apply_job_conf

    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        apply_job_conf(spark)
        assert spark.conf.get(key) == "-1"
    finally:
        spark.conf.set(key, old)
