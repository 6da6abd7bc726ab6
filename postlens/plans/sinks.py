"""Sinks: summary as JSON, tag analysis as Parquet, staged inputs.

Outputs are partition folders under one root per result, e.g.
``<out>/summary/src_year=2016/src_month=1/part-*.json`` and
``<out>/tag_analysis/src_year=2016/src_month=1/year=2016/month=1/*.parquet``.

Re-runs: a run over all months replaces the whole result; a run over some
months replaces the whole folders of these months, also where the new run has
no rows for them, and leaves the others in place.

Publishing is safe against a kill at any step. New folders are written beside
the result, under a hidden name. Then one small manifest is renamed into place,
which names the folders to replace: before that the old folders count, from
there on the new ones. Only then are folders moved, one by one; the manifest
goes last. ``read_summary`` and ``read_tag_analysis`` read a folder that a
manifest names from where it is, so they see the old or the new months, never
none; the next write first completes what a killed run left. One run at a time
may write a result.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.schemas import SOURCE_KEYS, SUMMARY_SCHEMA, TAG_ANALYSIS_COLUMNS
from postlens.session import (
    delete_path,
    glob_paths,
    move_path,
    new_scratch_dir,
    path_exists,
    read_text,
    write_text,
)


# Rows per staged Parquet file (a few hundred MB for the staged columns).
STAGE_MAX_RECORDS_PER_FILE = 10_000_000


MANIFEST = "_publish.json"


def _write(df: DataFrame, path: str, months, save) -> None:
    """Writes ``df`` to ``path``: all of it, or the named months, whose whole
    folders are replaced, also when the new run has no rows for them."""
    spark = df.sparkSession
    path = path.rstrip("/")
    finish_publish(spark, path)
    run = uuid.uuid4().hex[:12]
    fresh = f"{path}/_fresh-{run}"
    try:
        save(df.write.mode("error"), fresh)
        if months is None:  # the folders of whole years
            old, new = (
                {p.rsplit("/", 1)[1] for p in glob_paths(spark, f"{root}/src_year=*")}
                for root in (path, fresh)
            )
            folders = sorted(old | new)
        else:
            folders = [f"src_year={y}/src_month={m}" for y, m in sorted(set(months))]
            new = {f for f in folders if path_exists(spark, f"{fresh}/{f}")}
    except BaseException:
        delete_path(spark, fresh)
        raise
    plan = {"run": run, "folders": [[f, f in new] for f in folders]}
    write_text(spark, f"{path}/{MANIFEST}", json.dumps(plan))
    finish_publish(spark, path)


def _manifest(spark: SparkSession, path: str) -> dict | None:
    name = f"{path}/{MANIFEST}"
    return json.loads(read_text(spark, name)) if path_exists(spark, name) else None


def finish_publish(spark: SparkSession, path: str) -> None:
    """Moves the folders a manifest names into place. Every step can be taken
    again: a new folder that is no longer beside the result has been moved."""
    plan = _manifest(spark, path)
    if plan is None:
        return
    fresh, gone = f"{path}/_fresh-{plan['run']}", f"{path}/_old-{plan['run']}"
    for folder, is_new in plan["folders"]:
        target = f"{path}/{folder}"
        if is_new and not path_exists(spark, f"{fresh}/{folder}"):
            continue
        if path_exists(spark, target):
            move_path(spark, target, f"{gone}/{folder}")
        if is_new:
            move_path(spark, f"{fresh}/{folder}", target)
    delete_path(spark, gone)
    delete_path(spark, fresh)
    delete_path(spark, f"{path}/{MANIFEST}")


def _published(spark: SparkSession, path: str, read) -> DataFrame:
    """The result at ``path``, as ``read(folder)`` reads it; where a run was
    killed while it moved folders, those it has not moved yet come from beside
    the result."""
    path = path.rstrip("/")
    plan = _manifest(spark, path)
    if plan is None:
        return read(path)
    fresh = f"{path}/_fresh-{plan['run']}"
    waiting = [f for f, is_new in plan["folders"] if not is_new or path_exists(spark, f"{fresh}/{f}")]
    years = [int(f[9:]) for f in waiting if "/" not in f]
    pairs = [f.replace("src_month=", "")[9:].split("/") for f in waiting if "/" in f]
    keys = [int(y) * 100 + int(m) for y, m in pairs]
    key = F.col("src_year") * 100 + F.col("src_month")
    replaced = F.col("src_year").isin(years) | key.isin(keys)
    parts = []
    if glob_paths(spark, f"{path}/src_year=*/src_month=*/*"):
        parts.append(read(path).where(~replaced))
    if glob_paths(spark, f"{fresh}/src_year=*/src_month=*/*"):
        parts.append(read(fresh).where(replaced))
    if not parts:
        return read(path)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _cluster(df: DataFrame, cols: list[str]) -> DataFrame:
    """Range-cluster rows by the output partition columns before a write.

    Every output folder then gets its rows from one task (one file per
    folder), while the folders are spread over all write tasks in runs of
    neighbouring months. The write cost here is per file, not per byte, so
    the task count must not shrink with the data: an explicit count keeps AQE
    from coalescing the partitions, and range (not hash) partitioning keeps
    Spark from dropping the step as redundant after an aggregation that is
    already hash-partitioned on the same keys. Range partitioning also caps
    the task count at the number of distinct output folders (the sampled
    bounds), so a large ``spark.sql.shuffle.partitions`` adds no empty tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cols)


def write_summary(summary: DataFrame, path: str, *, months=None) -> None:
    """One JSON object per month; null values are written, not dropped.

    One row per month, one file per month folder. ``months``: see ``_write``.
    """

    def save(writer, target):
        writer.partitionBy(*SOURCE_KEYS).option("ignoreNullFields", False).json(target)

    _write(_cluster(summary, SOURCE_KEYS), path, months, save)


def write_tag_analysis(tags: DataFrame, path: str, *, months=None) -> None:
    """Parquet partitioned by source month and by the posts' year and month.

    Rows per output folder are bounded by the number of distinct tags, so
    clustering by the four partition columns gives one file per folder
    without creating a large task, whatever the input size.
    ``months``: see ``_write``.
    """

    def save(writer, target):
        writer.partitionBy(*SOURCE_KEYS, "year", "month").parquet(target)

    _write(_cluster(tags, [*SOURCE_KEYS, "year", "month"]), path, months, save)


def write_rejected(rows: DataFrame, path: str, *, months=None) -> None:
    """Text of broken input rows as JSON, by month folder."""

    def save(writer, target):
        writer.partitionBy(*SOURCE_KEYS).json(target)

    _write(rows, path, months, save)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Summary back from JSON. JSON object keys are text, so the histogram
    is read with string keys and its keys cast back to int."""
    fields = []
    for f in SUMMARY_SCHEMA.fields:
        if f.name in SOURCE_KEYS:
            continue
        if f.name == "histogram":
            f = T.StructField(f.name, T.MapType(T.StringType(), T.LongType()), True)
        fields.append(T.StructField(f.name, f.dataType, True))
    schema = T.StructType(fields)
    df = _published(spark, path, lambda root: spark.read.schema(schema).json(root))
    df = df.withColumn(
        "histogram", F.transform_keys("histogram", lambda k, _: k.cast("int"))
    )
    return df.select(*[f.name for f in SUMMARY_SCHEMA.fields])


def read_tag_analysis(spark: SparkSession, path: str) -> DataFrame:
    return _published(
        spark, path, lambda root: spark.read.parquet(root).select(*TAG_ANALYSIS_COLUMNS)
    )


def stage_table(
    spark: SparkSession, df: DataFrame, label: str, *, partition_by=SOURCE_KEYS
) -> tuple[DataFrame, str]:
    """``df`` written as Parquet under the shared scratch root and read back,
    and the folder, which the caller deletes.

    Used to parse the CSV inputs once: later stages read the columnar copy
    with column pruning and month-partition pruning instead of parsing the
    text again per aggregation. It also cuts the lineage, so a lost executor
    costs a re-read of the staged files, not a re-parse of the CSV. Input
    files of one month folder map to one partition folder, so partitioned
    writing adds no shuffle.
    """
    path = new_scratch_dir(spark, label)
    # A month parsed by one task (a multi-line CSV file) must not become one
    # huge file: cap the rows per staged file.
    writer = df.write.mode("overwrite").option(
        "maxRecordsPerFile", STAGE_MAX_RECORDS_PER_FILE
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(path)
    except BaseException:
        delete_path(spark, path)
        raise
    # The schema is known: reading with it skips the footer-reading job.
    staged = spark.read.schema(df.schema).parquet(path)
    return staged.select(*df.columns), path
