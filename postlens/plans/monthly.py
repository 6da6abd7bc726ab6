"""The monthly job: load, preprocess, summarise, analyse tags, write.

One plan covers every month folder under ``inputs``; there is no loop over
months on the driver. Two write actions in total (plus two staging writes
when ``stage_inputs``). Only the input columns the analyses read are staged.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.preprocess import DEFAULT_SNAPSHOT_MONTHS, filter_snapshot_users
from postlens.operators.summary import compute_summary
from postlens.operators.tags import compute_tag_analysis
from postlens.plans.sinks import (
    stage_table,
    write_rejected,
    write_summary,
    write_tag_analysis,
)
from postlens.schemas import (
    POSTS_SCHEMA,
    POSTS_USED,
    SOURCE_KEYS,
    USERS_SCHEMA,
    USERS_USED,
)
from postlens.session import apply_job_conf, delete_path
from postlens.sources.csv_months import CORRUPT, missing_entries, read_month_csv


@dataclass(frozen=True)
class JobOutputs:
    summary: str
    tag_analysis: str


def month_key(year=None, month=None):
    """One integer per (year, month): yyyymm."""
    return (year if year is not None else F.col("src_year")) * 100 + (
        month if month is not None else F.col("src_month")
    )


def _only_months(df: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows of the named month folders: one set lookup per row (Spark's
    InSet), so the predicate stays small however many months are named."""
    keys = sorted({y * 100 + m for y, m in months})
    return df.where(month_key().isin(keys))


def run_monthly_job(
    spark: SparkSession,
    inputs: str,
    outputs: str,
    *,
    how: str = "left",
    join_on_month: bool = True,
    snapshot_months: Iterable[tuple[int, int]] = DEFAULT_SNAPSHOT_MONTHS,
    multiline: bool | str = False,
    malformed: str = "fail",
    by_name: bool = False,
    months: Iterable[tuple[int, int]] | None = None,
    stage_inputs: bool = True,
    strict: bool = True,
    posts_glob: str | None = None,
    users_glob: str | None = None,
    pre_aggregate: bool | None = None,
    salt_buckets: int = 1,
) -> JobOutputs:
    """Summary and tag analysis for every month folder under ``inputs``.

    ``months`` restricts the run to some (year, month) folders; their folders
    in the results are replaced as a whole. The folder filter is applied on
    the file path before parsing, so files of other months are skipped; with
    ``join_on_month=False`` the users of all months are still read, because a
    post's owner may be in any of them. ``strict`` stops if a month folder
    lacks one of its two files (default layout only).
    ``posts_glob``/``users_glob`` override the default
    ``<inputs>/*/*/posts.csv`` layout (e.g. Spark-written part files).

    ``multiline`` and ``by_name`` are those of ``read_month_csv``, as are
    ``malformed="fail"`` and ``"null"``. ``malformed="reject"``: broken rows are
    left out of the results and written as JSON, with their text and month,
    under ``<outputs>/rejected``; the inputs are then staged in any case, and
    good and broken rows taken from the staged table, so the CSV is parsed once.
    """
    apply_job_conf(spark)
    root = inputs.rstrip("/")
    out = outputs.rstrip("/")
    subset = list(months) if months is not None else None
    if subset is not None and not subset:
        raise ValueError("months must name at least one (year, month)")
    if strict and not posts_glob and not users_glob:
        missing = missing_entries(spark, root)
        if subset is not None:
            wanted = {(y, m) for y, m in subset}
            missing = [f for f in missing if _month_of(f) in wanted]
        if missing:
            raise FileNotFoundError("month folders are incomplete: " + ", ".join(missing))
    reject = malformed == "reject"
    frames, staged = [], []
    try:
        for entry, glob, schema, used in (
            ("posts.csv", posts_glob, POSTS_SCHEMA, POSTS_USED),
            ("users.csv", users_glob, USERS_SCHEMA, USERS_USED),
        ):
            df = read_month_csv(
                spark,
                glob or f"{root}/*/*/{entry}",
                schema,
                multiline=multiline,
                malformed="keep" if reject else malformed,
                by_name=by_name,
                leaf=None if glob else entry,
            )
            # users of all months belong to a join on the owner alone
            if subset is not None and (entry == "posts.csv" or join_on_month):
                df = _only_months(df, subset)
            broken = F.col(CORRUPT).isNotNull()
            kept = []
            if reject:
                first = F.col(schema.fieldNames()[0]).cast("string")
                kept = [CORRUPT, F.when(broken, first).alias("first_field")]
            df = df.select(*used, *kept, *SOURCE_KEYS)
            if stage_inputs or reject:
                df, path = stage_table(spark, df, entry.removesuffix(".csv"))
                staged.append(path)
            if reject:
                bad = df.where(broken).select(
                    *SOURCE_KEYS, F.col(CORRUPT).alias("line"), "first_field"
                )
                write_rejected(bad, f"{out}/rejected/{entry}", months=subset)
                df = df.where(~broken)
            frames.append(df.select(*used, *SOURCE_KEYS))
        return run_on_frames(
            *frames,
            out,
            how=how,
            join_on_month=join_on_month,
            snapshot_months=snapshot_months,
            months=subset,
            pre_aggregate=pre_aggregate,
            salt_buckets=salt_buckets,
        )
    finally:
        for path in staged:
            delete_path(spark, path)


def _month_of(path: str) -> tuple[int, int]:
    year, month = path.split("/")[-3:-1]
    return int(year), int(month)


def run_on_frames(
    posts: DataFrame,
    users: DataFrame,
    outputs: str,
    *,
    how: str = "left",
    join_on_month: bool = True,
    snapshot_months: Iterable[tuple[int, int]] = DEFAULT_SNAPSHOT_MONTHS,
    months: Iterable[tuple[int, int]] | None = None,
    pre_aggregate: bool | None = None,
    salt_buckets: int = 1,
) -> JobOutputs:
    """The job's core on DataFrames already loaded from any source.

    ``posts`` and ``users`` need the input columns the analyses read
    (``schemas.POSTS_USED``, ``schemas.USERS_USED``) plus ``src_year`` and
    ``src_month``. ``months`` names the months ``posts`` was restricted to:
    only these are replaced in the results, and only their users count in the
    summary, while the tag analysis sees all of ``users``.
    ``pre_aggregate`` and ``salt_buckets`` go to ``compute_tag_analysis``.
    """
    apply_job_conf(posts.sparkSession)
    months = None if months is None else list(months)
    users = filter_snapshot_users(users, snapshot_months)
    counted = users if months is None else _only_months(users, months)
    out = outputs.rstrip("/")
    result = JobOutputs(f"{out}/summary", f"{out}/tag_analysis")
    write_summary(compute_summary(posts, counted), result.summary, months=months)
    write_tag_analysis(
        compute_tag_analysis(
            posts,
            users,
            how=how,
            join_on_month=join_on_month,
            pre_aggregate=pre_aggregate,
            salt_buckets=salt_buckets,
        ),
        result.tag_analysis,
        months=months,
    )
    return result
