"""Column functions on edge values (nulls, empty strings, zero divisors)."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import (
    day_of,
    fill_name,
    month_of,
    safe_ratio,
    tag_array,
    tags_per_post,
    year_of,
)


def test_tag_functions(spark):
    df = spark.createDataFrame(
        [("a|b",), ("a|b|",), ("",), (None,), ("a||b",), ("c++|c#",)], "tags string"
    )
    got = [
        (r["tags"], r["arr"], r["n"])
        for r in df.select("tags", tag_array().alias("arr"), tags_per_post().alias("n")).collect()
    ]
    assert got == [
        ("a|b", ["a", "b"], 2),
        ("a|b|", ["a", "b", ""], 3),
        ("", [""], 1),
        (None, None, 0),
        ("a||b", ["a", "", "b"], 3),
        ("c++|c#", ["c++", "c#"], 2),
    ]


def test_date_parts_and_names(spark):
    df = spark.createDataFrame(
        [("2016-02-29 23:59:59", None), (None, "bob")], "ts string, display_name string"
    ).withColumn("creation_date", F.col("ts").cast("timestamp"))
    rows = df.select(
        year_of().alias("y"), month_of().alias("m"), day_of().alias("d"), fill_name().alias("n")
    ).collect()
    assert [tuple(r) for r in rows] == [(2016, 2, 29, ""), (None, None, None, "bob")]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(5, 2), (5, 0), (None, 3), (0, 0)], "a long, b long")
    got = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert got == [2.5, None, None, None]
