"""Command line entry and bad input values."""

from __future__ import annotations

import argparse

import pytest

from postlens.cli import _year_month, build_parser, job_options, main
from postlens.plans.sinks import read_summary, read_tag_analysis
from postlens.sources.csv_months import read_posts
from test_sources_sinks import POSTS_HEADER, _inputs, _write


def test_options():
    args = build_parser().parse_args(
        ["in", "out", "--how", "inner", "--snapshot", "2015-12", "--multi-line"]
    )
    opts = job_options(args)
    assert opts["how"] == "inner"
    assert opts["snapshot_months"] == ((2015, 12),)
    assert opts["multiline"] is True and opts["join_on_month"] is True
    assert job_options(build_parser().parse_args(["i", "o", "--no-snapshot"]))[
        "snapshot_months"
    ] == ()
    with pytest.raises(argparse.ArgumentTypeError):
        _year_month("2016-13")


def test_cli_runs_job(spark, scratch):
    _inputs(f"{scratch}/in")
    assert main([f"{scratch}/in", f"{scratch}/out", "--multi-line"], spark=spark) == 0
    assert read_summary(spark, f"{scratch}/out/summary").count() == 2
    assert read_tag_analysis(spark, f"{scratch}/out/tag_analysis").count() == 4
    assert main([f"{scratch}/in", f"{scratch}/out2", "--stream", "--multi-line"], spark=spark) == 0
    assert read_summary(spark, f"{scratch}/out2/summary").count() == 2


def test_unparseable_values_become_null(spark, scratch):
    _write(
        f"{scratch}/2016/04/posts.csv",
        POSTS_HEADER,
        [("t", "many", 1, "not a date", "x9", 1, "a", 1)],
    )
    (row,) = read_posts(spark, scratch, malformed="null").collect()
    assert row["answer_count"] is None
    assert row["creation_date"] is None
    assert row["owner_user_id"] is None
    assert row["comment_count"] == 1 and row["tags"] == "a"


def test_config_file(spark, scratch):
    _inputs(f"{scratch}/in")
    conf = f"{scratch}/config.yaml"
    with open(conf, "w") as fh:
        fh.write(
            f'INPUTS_FOLDER: "{scratch}/in"\n'
            f'OUTPUTS_FOLDER: "{scratch}/out"\n'
            'PIPELINE_CHOICE: "pyspark"\n'
        )
    assert main(["--config", conf, "--multi-line"], spark=spark) == 0
    assert read_summary(spark, f"{scratch}/out/summary").count() == 2
    with pytest.raises(SystemExit):
        main([], spark=spark)
