"""CSV files with line breaks in quoted fields, split; columns by name; broken
rows out of one parse."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from postlens.plans import monthly
from postlens.plans.monthly import run_monthly_job
from postlens.plans.sinks import read_summary, read_tag_analysis
from postlens.sources.csv_months import read_posts, read_users
from postlens.sources.csv_records import quoted_records
from tests.test_sources_sinks import POSTS_HEADER, USERS_HEADER, _both, _month, _write


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "997", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _titles(seed, n):
    """Titles with line breaks, quotes and commas, some longer than a split."""
    rng = random.Random(seed)
    bits = ["a", "b c", "\n", "\n\n", '"', '""', ",", "\r\n", " x ", "é", "\n\"q\"\n"]
    out = []
    for i in range(n):
        long = 60 if i % 37 == 5 else 1
        out.append(f"t{i}" + "".join(rng.choice(bits) * long for _ in range(rng.randint(0, 12))))
    return out


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_reads_what_one_task_reads(spark, scratch, small_splits, seed):
    for month in (3, 4):
        rows = [
            (t, i, 1, "2016-03-01 00:00:00", i, 1, "a|b", 1)
            for i, t in enumerate(_titles(seed * month, 150))
        ]
        _write(f"{scratch}/2016/{month:02d}/posts.csv", POSTS_HEADER, rows)
    got = read_posts(spark, scratch, multiline="split")
    whole = read_posts(spark, scratch, multiline=True)
    assert _rows(got) == _rows(whole) and got.count() == 300
    assert got.rdd.getNumPartitions() > 4


def test_record_longer_than_splits_and_open_at_the_end(spark, scratch, small_splits):
    path = f"{scratch}/2016/03/posts.csv"
    _write(path, POSTS_HEADER, [("x\n" * 4000, 0, 1, "2016-03-01 00:00:00", 1, 1, "a", 1)])
    with open(path, "a", newline="") as fh:
        fh.write('ok,0,1,2016-03-01 00:00:00,2,1,a,1\n\n\r\n"never closed,1\nand on\n')
    rows = read_posts(spark, scratch, multiline="split", malformed="keep").collect()
    good = {r["owner_user_id"]: r["title"] for r in rows if r["_corrupt_record"] is None}
    assert good == {1: "x\n" * 4000, 2: "ok"}
    (bad,) = [r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None]
    assert bad.startswith('"never closed') and "and on" in bad
    with pytest.raises(Exception, match="(?i)malformed"):
        read_posts(spark, scratch, multiline="split").collect()


def test_edges_of_files(spark, scratch):
    _write(f"{scratch}/2016/03/posts.csv", POSTS_HEADER, [])  # a header only
    os.makedirs(f"{scratch}/2016/04")
    open(f"{scratch}/2016/04/posts.csv", "w").close()  # nothing at all
    df = read_posts(spark, scratch, multiline="split")
    assert df.count() == 0 and df.columns[:8] == POSTS_HEADER
    with open(f"{scratch}/2016/04/posts.csv", "w", newline="", encoding="utf-8-sig") as fh:
        # a byte order mark, no line break at the end, a row equal to the header
        fh.write(",".join(POSTS_HEADER) + '\r\nt,,1,,1,1,a,1\r\n"u\r\nv",,1,,2,1,,1')
    rows = read_posts(spark, scratch, multiline="split").collect()
    assert {(r["title"], r["tags"], r["src_month"]) for r in rows} == {
        ("t", "a", 4),
        ("u\r\nv", None, 4),
    }
    with pytest.raises(FileNotFoundError):
        read_posts(spark, f"{scratch}/none", multiline="split")


def test_a_changed_split_is_an_error(spark, scratch, small_splits):
    path = f"{scratch}/2016/03/posts.csv"
    rows = [(t, 0, 1, None, 1, 1, "a", 1) for t in _titles(9, 100)]
    _write(path, POSTS_HEADER, rows)
    records = quoted_records(spark, [path])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "601")
    with pytest.raises(Exception, match="not in the first scan"):
        records.collect()


@pytest.mark.parametrize("multiline", [False, True, "split"])
def test_columns_by_name(spark, scratch, multiline):
    rows = [(f"t{i}", i, 1, "2016-03-01 00:00:00", i, 1, "a|b", 1) for i in range(5)]
    _write(f"{scratch}/plain/2016/03/posts.csv", POSTS_HEADER, rows)
    _write(f"{scratch}/plain/2016/04/posts.csv", POSTS_HEADER, rows)
    _write(f"{scratch}/mixed/2016/03/posts.csv", POSTS_HEADER, rows)
    order = [6, 0, 4, 2, 1, 3, 7, 5]
    header = ["extra", *[POSTS_HEADER[i] for i in order], "Extra", "x,y"]
    header[2] = " Title "
    _write(
        f"{scratch}/mixed/2016/04/posts.csv",
        header,
        [("e", *[r[i] for i in order], "f", "g,h") for r in rows],
    )
    want = read_posts(spark, f"{scratch}/plain")
    got = read_posts(spark, f"{scratch}/mixed", by_name=True, multiline=multiline)
    assert got.columns == want.columns and _rows(got) == _rows(want)
    if multiline == "split":  # without by_name the order counts
        with pytest.raises(ValueError, match="header"):
            read_posts(spark, f"{scratch}/mixed", multiline=multiline)


@pytest.mark.parametrize("header", [POSTS_HEADER[:-1], [*POSTS_HEADER, "title"]])
def test_missing_and_repeated_names_are_errors(spark, scratch, header):
    _write(f"{scratch}/2016/03/posts.csv", header, [[1] * len(header)])
    for mode in ("fail", "null", "keep"):
        with pytest.raises(ValueError, match="header"):
            read_posts(spark, scratch, by_name=True, malformed=mode)


def test_broken_rows_by_name_and_folders_with_odd_names(spark, scratch):
    root = f"{scratch}/a b[1]{{2}}%41"
    header = ["other", *reversed(POSTS_HEADER)]
    good = ["o", 1, "a", 1, 1, "2016-03-01 00:00:00", 1, 0, "t"]
    _write(f"{root}/2016/03/posts.csv", header, [good, good[:4], good])
    escaped = root.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}")
    for multiline in (False, "split"):
        rows = read_posts(
            spark, escaped, by_name=True, malformed="keep", multiline=multiline
        ).collect()
        assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ["o,1,a,1"]
        assert sum(r["title"] == "t" and r["src_month"] == 3 for r in rows) == 2


def test_job_with_split_files_equals_the_job_on_whole_files(spark, scratch, small_splits):
    inputs = f"{scratch}/in"
    for month in (2, 3):
        posts = [
            (t, i, i % 4, f"2016-{month:02d}-01 00:00:00", i % 5, i, f"a|b{i % 3}", 1)
            for i, t in enumerate(_titles(month, 60))
        ]
        users = [(i, f"n\n{i}", f"2016-{month:02d}-01 00:00:00", i, "", 0, 0) for i in range(4)]
        _month(inputs, month, posts, users)
    a = run_monthly_job(spark, inputs, f"{scratch}/a", multiline=True)
    b = run_monthly_job(spark, inputs, f"{scratch}/b", multiline="split", by_name=True)
    assert _both(spark, a) == _both(spark, b)


def test_reject_parses_the_files_once(spark, scratch, monkeypatch):
    inputs, out = f"{scratch}/in", f"{scratch}/out"
    good = ("ok", 0, 1, "2016-03-01 00:00:00", 1, 1, "a", 1)
    user = (1, "ann", "2016-03-01 00:00:00", 10, "", 0, 0)
    _month(inputs, 3, [good, ("bad", 0, "x", "", 1, 1, "a", 1)], [user, (2, "few")])
    reads, seen = [], monthly.write_rejected

    def rejected(rows, path, **kw):
        reads.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return seen(rows, path, **kw)

    monkeypatch.setattr(monthly, "write_rejected", rejected)
    res = run_monthly_job(spark, inputs, out, malformed="reject", stage_inputs=False)
    assert len(reads) == 2 and all("parquet" in r and "csv" not in r for r in reads)
    (bad,) = spark.read.json(f"{out}/rejected/posts.csv").collect()
    assert bad["line"].startswith("bad,0,x") and bad["first_field"] == "bad"
    (few,) = spark.read.json(f"{out}/rejected/users.csv").collect()
    assert few["line"] == "2,few" and few["first_field"] == "2"
    (s,) = read_summary(spark, res.summary).collect()
    assert s["number_of_posts"] == 1 and s["number_of_new_users"] == 1
    (t,) = read_tag_analysis(spark, res.tag_analysis).collect()
    assert (t["tag"], t["tag_hero"]) == ("a", "ann")
