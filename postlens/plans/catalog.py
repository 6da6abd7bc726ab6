"""Checked queries: a Spark callable and an equivalent DuckDB SQL per key.

Each Spark query reads the test tables through the adapters in
``postlens.sources.adapters`` and runs one operator (or the whole job) over
the whole tables. The SQL writes the same adapters as CTEs over the
pre-registered views, and computes the same result the direct way (join
then aggregate, window for the top name), so it checks the Spark plan's
shortcuts. Column names and types match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.columns import day_of, fill_name, month_of, tags_per_post, year_of
from postlens.operators import (
    active_tags,
    avg_comments,
    compute_summary,
    compute_tag_analysis,
    day_histogram_long,
    explode_tags,
    filter_snapshot_users,
    join_users,
    post_counts,
    posts_per_user,
    tag_heroes,
    tag_stats,
    user_measures,
    user_tag_counts,
)
from postlens.plans.monthly import run_monthly_job
from postlens.plans.sinks import (
    read_summary,
    read_tag_analysis,
    write_summary,
    write_tag_analysis,
)
from postlens.schemas import POSTS_SCHEMA, SOURCE_KEYS, TAG_KEYS, USERS_SCHEMA
from postlens.session import apply_job_conf, new_scratch_dir
from postlens.sources.adapters import (
    posts_from_events,
    posts_from_orders,
    users_from_customer,
)
from postlens.sources.csv_months import read_month_csv, write_month_csv

SNAPSHOT = ((1995, 1),)

# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def _posts(spark: SparkSession, d: str) -> DataFrame:
    apply_job_conf(spark)
    return posts_from_orders(spark, d)


def _users(spark: SparkSession, d: str, snapshot: bool = False) -> DataFrame:
    apply_job_conf(spark)
    return users_from_customer(spark, d, snapshot=snapshot)


def q_scan_posts(spark, d):
    return _posts(spark, d)


def q_scan_users(spark, d):
    return _users(spark, d)


def q_csv_roundtrip(spark, d):
    root = new_scratch_dir(spark, "csv-roundtrip")
    write_month_csv(_posts(spark, d), root)
    # titles hold line breaks
    back = read_month_csv(spark, f"{root}/*/*/*.csv", POSTS_SCHEMA, multiline=True)
    return back.select(*POSTS_SCHEMA.fieldNames(), *SOURCE_KEYS)


def q_csv_split_lines(spark, d):
    """The same files, titles with line breaks included, read by many tasks."""
    root = new_scratch_dir(spark, "csv-split-lines")
    write_month_csv(_posts(spark, d), root)
    back = read_month_csv(spark, f"{root}/*/*/*.csv", POSTS_SCHEMA, multiline="split")
    return back.select(*POSTS_SCHEMA.fieldNames(), *SOURCE_KEYS)


def q_csv_by_name(spark, d):
    """Odd months written with their columns in another order and one more."""
    posts = _posts(spark, d)
    root = new_scratch_dir(spark, "csv-by-name")
    odd = F.col("src_month") % 2 == 1
    write_month_csv(posts.where(~F.coalesce(odd, F.lit(False))), f"{root}/a")
    turned = [F.lit("more").alias("more"), *reversed(POSTS_SCHEMA.fieldNames()), *SOURCE_KEYS]
    write_month_csv(posts.where(odd).select(*turned), f"{root}/b")
    back = read_month_csv(
        spark, f"{root}/*/*/*/*.csv", POSTS_SCHEMA, multiline="split", by_name=True
    )
    return back.select(*POSTS_SCHEMA.fieldNames(), *SOURCE_KEYS)


def q_snapshot_filter(spark, d):
    return filter_snapshot_users(_users(spark, d, snapshot=True), SNAPSHOT)


def q_date_parts(spark, d):
    return _posts(spark, d).select(
        "owner_user_id",
        "creation_date",
        year_of().alias("year"),
        month_of().alias("month"),
        day_of().alias("day"),
    )


def q_tags_per_post(spark, d):
    return _posts(spark, d).select(
        "owner_user_id", "tags", tags_per_post().alias("n_tags")
    )


def q_explode_tags(spark, d):
    return explode_tags(_posts(spark, d)).select(
        *SOURCE_KEYS, "owner_user_id", "score", "tag"
    )


def q_fill_names(spark, d):
    return _users(spark, d).select("id", fill_name().alias("name"))


_JOIN_COLS = ["owner_user_id", "creation_date", "score", "tags", "id", "reputation", "display_name"]


def q_join_left(spark, d):
    return join_users(
        _posts(spark, d), _users(spark, d), how="left", join_on_month=False
    ).select(*_JOIN_COLS)


def q_join_inner(spark, d):
    return join_users(
        _posts(spark, d), _users(spark, d), how="inner", join_on_month=False
    ).select(*_JOIN_COLS)


def q_join_left_salted(spark, d):
    """Left join with every owner split 8 ways (users copied 8 times)."""
    return join_users(
        _posts(spark, d), _users(spark, d), how="left", join_on_month=False, salt_buckets=8
    ).select(*_JOIN_COLS)


def q_join_by_month(spark, d):
    return join_users(
        _posts(spark, d), _users(spark, d), how="left", join_on_month=True
    ).select(*SOURCE_KEYS, *_JOIN_COLS)


def q_post_counts(spark, d):
    return post_counts(_posts(spark, d))


def q_avg_comments(spark, d):
    return avg_comments(_posts(spark, d))


def q_new_users(spark, d):
    users = filter_snapshot_users(_users(spark, d, snapshot=True), SNAPSHOT)
    return user_measures(users).select(*SOURCE_KEYS, "number_of_new_users")


def q_avg_reputation(spark, d):
    users = filter_snapshot_users(_users(spark, d, snapshot=True), SNAPSHOT)
    return user_measures(users).select(*SOURCE_KEYS, "average_reputation_per_user")


def q_active_tags(spark, d):
    return active_tags(_posts(spark, d))


def q_posts_per_user(spark, d):
    return posts_per_user(_posts(spark, d))


def q_histogram(spark, d):
    return day_histogram_long(_posts(spark, d))


def q_histogram_events(spark, d):
    apply_job_conf(spark)
    return day_histogram_long(posts_from_events(spark, d))


def q_tag_stats(spark, d):
    return tag_stats(_posts(spark, d), _users(spark, d), join_on_month=False)


def q_user_tag_counts(spark, d):
    return user_tag_counts(_posts(spark, d), _users(spark, d), join_on_month=False)


def q_tag_hero(spark, d):
    return tag_heroes(_posts(spark, d), _users(spark, d), join_on_month=False)


def q_tag_analysis(spark, d):
    return compute_tag_analysis(_posts(spark, d), _users(spark, d), join_on_month=False)


def q_tag_analysis_inner(spark, d):
    return compute_tag_analysis(
        _posts(spark, d), _users(spark, d), how="inner", join_on_month=False
    )


def q_tag_analysis_by_month(spark, d):
    return compute_tag_analysis(_posts(spark, d), _users(spark, d), join_on_month=True)


def q_tag_analysis_join_first(spark, d):
    """Flagship without the per-owner pre-aggregation (every post joined)."""
    return compute_tag_analysis(
        _posts(spark, d), _users(spark, d), join_on_month=False, pre_aggregate=False
    )


def q_tag_analysis_events(spark, d):
    """Flagship over a second input: events as posts (no scores)."""
    apply_job_conf(spark)
    return compute_tag_analysis(
        posts_from_events(spark, d), _users(spark, d), join_on_month=False
    )


def q_summary_events(spark, d):
    users = filter_snapshot_users(_users(spark, d), SNAPSHOT)
    apply_job_conf(spark)
    return compute_summary(posts_from_events(spark, d), users, with_histogram=False)


def q_summary(spark, d):
    users = filter_snapshot_users(_users(spark, d), SNAPSHOT)
    return compute_summary(_posts(spark, d), users, with_histogram=False)


def q_parquet_sink(spark, d):
    """Tag analysis written twice (re-run) and read back."""
    path = new_scratch_dir(spark, "tag-analysis-sink")
    for _ in range(2):
        write_tag_analysis(q_tag_analysis(spark, d), path)
    return read_tag_analysis(spark, path)


def _with_histogram_text(summary: DataFrame) -> DataFrame:
    """The histogram's entries in the map's own order, as day:posts."""
    entry = lambda e: F.concat_ws(":", e["key"], e["value"])
    return summary.withColumn(
        "histogram", F.array_join(F.transform(F.map_entries("histogram"), entry), ",")
    )


def q_json_sink(spark, d):
    """Summary written twice (re-run) and read back."""
    path = new_scratch_dir(spark, "summary-sink")
    users = filter_snapshot_users(_users(spark, d), SNAPSHOT)
    for _ in range(2):
        write_summary(compute_summary(_posts(spark, d), users), path)
    return _with_histogram_text(read_summary(spark, path))


def write_job_inputs(spark, d, *, line_breaks: bool = False) -> tuple[str, str, str]:
    """Adapters written as month folders of CSV: posts and users. Without
    ``line_breaks`` titles are one line, as splittable reads need."""
    root = new_scratch_dir(spark, "job-inputs")
    posts = _posts(spark, d)
    if not line_breaks:
        posts = posts.withColumn("title", F.translate("title", "\n", " "))
    write_month_csv(posts, f"{root}/posts")
    write_month_csv(_users(spark, d), f"{root}/users")
    return root, f"{root}/posts/*/*/*.csv", f"{root}/users/*/*/*.csv"


def _run_job(spark, d, line_breaks: bool | str = False, rerun=None, **options):
    """The whole job over the adapters written as CSV month folders, then
    again for the months ``rerun`` names."""
    root, posts_glob, users_glob = write_job_inputs(spark, d, line_breaks=bool(line_breaks))
    out = new_scratch_dir(spark, "job-outputs")
    for months in (None, rerun) if rerun else (None,):
        result = run_monthly_job(
            spark,
            root,
            out,
            snapshot_months=SNAPSHOT,
            posts_glob=posts_glob,
            users_glob=users_glob,
            multiline=line_breaks,
            months=months,
            **options,
        )
    return result


def q_job_tag_analysis(spark, d):
    """Whole job over CSV month folders with line breaks in titles."""
    return read_tag_analysis(spark, _run_job(spark, d, line_breaks=True).tag_analysis)


def q_job_summary(spark, d):
    """Whole job over split CSV files with line breaks in titles; summary read back."""
    return _with_histogram_text(
        read_summary(spark, _run_job(spark, d, line_breaks="split").summary)
    )


RERUN_MONTHS = ((1995, 3), (1996, 7), (1998, 9))


def q_job_partial_rerun(spark, d):
    """Whole job with one users table for all months, then some months again:
    their owners' user rows lie in other months' files."""
    result = _run_job(spark, d, rerun=RERUN_MONTHS, join_on_month=False)
    return read_tag_analysis(spark, result.tag_analysis)


def q_job_partial_summary(spark, d):
    """As above; summary read back."""
    result = _run_job(spark, d, rerun=RERUN_MONTHS, join_on_month=False)
    return _with_histogram_text(read_summary(spark, result.summary))


def _run_stream(spark, d, **options):
    """Incremental runner: CSV month folders picked up by the file-name
    stream (all present files, then stop)."""
    from postlens.streaming import start_month_stream

    root, _, _ = write_job_inputs(spark, d)
    out = new_scratch_dir(spark, "stream-outputs")
    # Spark-written month folders hold part files directly.
    query = start_month_stream(
        spark,
        root,
        out,
        snapshot_months=SNAPSHOT,
        watch_glob=f"{root}/*/*/*/*.csv",
        posts_glob=f"{root}/posts/*/*/*.csv",
        users_glob=f"{root}/users/*/*/*.csv",
        **options,
    )
    query.awaitTermination()
    return read_tag_analysis(spark, f"{out}/tag_analysis")


def q_stream_tag_analysis(spark, d):
    return _run_stream(spark, d)


def q_stream_one_users_table(spark, d):
    return _run_stream(spark, d, join_on_month=False)


def q_tag_analysis_salted(spark, d):
    """Flagship with every owner split 8 ways instead of folded first."""
    return compute_tag_analysis(
        _posts(spark, d), _users(spark, d), join_on_month=False, salt_buckets=8
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_scan_posts": q_scan_posts,
    "q_scan_users": q_scan_users,
    "q_csv_roundtrip": q_csv_roundtrip,
    "q_csv_split_lines": q_csv_split_lines,
    "q_csv_by_name": q_csv_by_name,
    "q_snapshot_filter": q_snapshot_filter,
    "q_date_parts": q_date_parts,
    "q_tags_per_post": q_tags_per_post,
    "q_explode_tags": q_explode_tags,
    "q_fill_names": q_fill_names,
    "q_join_left": q_join_left,
    "q_join_inner": q_join_inner,
    "q_join_left_salted": q_join_left_salted,
    "q_join_by_month": q_join_by_month,
    "q_post_counts": q_post_counts,
    "q_avg_comments": q_avg_comments,
    "q_new_users": q_new_users,
    "q_avg_reputation": q_avg_reputation,
    "q_active_tags": q_active_tags,
    "q_posts_per_user": q_posts_per_user,
    "q_histogram": q_histogram,
    "q_histogram_events": q_histogram_events,
    "q_tag_stats": q_tag_stats,
    "q_user_tag_counts": q_user_tag_counts,
    "q_tag_hero": q_tag_hero,
    "q_tag_analysis": q_tag_analysis,
    "q_tag_analysis_inner": q_tag_analysis_inner,
    "q_tag_analysis_by_month": q_tag_analysis_by_month,
    "q_tag_analysis_join_first": q_tag_analysis_join_first,
    "q_tag_analysis_events": q_tag_analysis_events,
    "q_summary": q_summary,
    "q_summary_events": q_summary_events,
    "q_parquet_sink": q_parquet_sink,
    "q_json_sink": q_json_sink,
    "q_job_tag_analysis": q_job_tag_analysis,
    "q_job_summary": q_job_summary,
    "q_stream_tag_analysis": q_stream_tag_analysis,
    "q_stream_one_users_table": q_stream_one_users_table,
    "q_job_partial_rerun": q_job_partial_rerun,
    "q_job_partial_summary": q_job_partial_summary,
    "q_tag_analysis_salted": q_tag_analysis_salted,
}

# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------

_CREATED = "CAST(o_orderdate AS TIMESTAMP)"
_FOLDER = (
    f"(CASE WHEN o_orderkey % 23 = 0 THEN {_CREATED} + INTERVAL 40 DAY ELSE {_CREATED} END)"
)
POSTS_SQL = f"""
SELECT
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('Say "', o_orderstatus, '", ok')
    WHEN 2 THEN concat('two', chr(10), 'lines, ', o_orderstatus)
    ELSE concat('How to ', o_orderkey) END AS title,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INTEGER) END AS answer_count,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 7 AS INTEGER) END AS comment_count,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE {_CREATED} END AS creation_date,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL
    WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey + 1000000000 AS BIGINT)
    ELSE CAST(o_custkey AS BIGINT) END AS owner_user_id,
  CAST(floor(o_totalprice) AS INTEGER) AS score,
  CASE o_orderkey % 13 WHEN 0 THEN NULL
    WHEN 1 THEN concat_ws('|', o_orderpriority, o_orderstatus, o_orderpriority)
    WHEN 2 THEN concat_ws('|', o_orderpriority, o_orderstatus, 'extra')
    ELSE concat_ws('|', o_orderpriority, o_orderstatus) END AS tags,
  CAST(o_custkey % 1000 AS INTEGER) AS view_count,
  CAST(year({_FOLDER}) AS INTEGER) AS src_year,
  CAST(month({_FOLDER}) AS INTEGER) AS src_month
FROM orders
"""


def _users_sql(snapshot: bool) -> str:
    created = (
        "make_timestamp(CAST(1995 + c_custkey % 3 AS BIGINT), "
        "CAST(1 + c_custkey % 12 AS BIGINT), 1, 0, 0, 0)"
    )
    year, month = f"year({created})", f"month({created})"
    if snapshot:
        year = f"CASE WHEN c_custkey % 4 < 2 THEN 1995 ELSE {year} END"
        month = f"CASE WHEN c_custkey % 4 < 2 THEN 1 ELSE {month} END"
    return f"""
SELECT
  CAST(c_custkey AS INTEGER) AS id,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS display_name,
  {created} AS creation_date,
  CAST(floor(c_acctbal) AS INTEGER) AS reputation,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat(c_mktsegment, ', "x"') END AS location,
  CAST(c_custkey % 100 AS INTEGER) AS up_votes,
  CAST(c_nationkey AS INTEGER) AS down_votes,
  CAST({year} AS INTEGER) AS src_year,
  CAST({month} AS INTEGER) AS src_month
FROM customer
"""


EVENTS_POSTS_SQL = """
SELECT
  CAST(NULL AS VARCHAR) AS title,
  CAST(NULL AS INTEGER) AS answer_count,
  CAST(NULL AS INTEGER) AS comment_count,
  CAST(ts AS TIMESTAMP) AS creation_date,
  CAST(user_id AS BIGINT) AS owner_user_id,
  CAST(NULL AS INTEGER) AS score,
  event_type AS tags,
  CAST(NULL AS INTEGER) AS view_count,
  CAST(year(ts) AS INTEGER) AS src_year,
  CAST(month(ts) AS INTEGER) AS src_month
FROM events
"""

_SNAPSHOT_WHERE = (
    "NOT (src_year = 1995 AND src_month = 1) "
    "OR (year(creation_date) = src_year AND month(creation_date) = src_month)"
)


def _with(users_snapshot: bool = False, posts_sql: str = POSTS_SQL, **extra: str) -> str:
    ctes = {"posts": posts_sql, "users": _users_sql(users_snapshot)}
    ctes.update(extra)
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n"


_K = "src_year, src_month, year, month, tag"

# Exploded, dated posts joined to users; then the direct tag computations.
_TAG_ROWS = """
SELECT src_year, src_month,
       CAST(year(creation_date) AS INTEGER) AS year,
       CAST(month(creation_date) AS INTEGER) AS month,
       owner_user_id, score, unnest(string_split(tags, '|')) AS tag
FROM posts WHERE creation_date IS NOT NULL
"""


def _joined(how: str, on_month: bool) -> str:
    cond = "pt.owner_user_id = u.id"
    if on_month:
        cond += " AND pt.src_year = u.src_year AND pt.src_month = u.src_month"
    return (
        "SELECT pt.*, u.id, u.reputation, u.display_name "
        f"FROM pt {how.upper()} JOIN users u ON {cond}"
    )


_STATS = f"""
SELECT {_K}, count(owner_user_id) AS posts, avg(reputation) AS avg_reputation,
       avg(score) AS avg_score
FROM j GROUP BY {_K}
"""

_NAMES = f"""
SELECT {_K}, coalesce(display_name, '') AS name, count(*) AS n
FROM j WHERE id IS NOT NULL GROUP BY {_K}, coalesce(display_name, '')
"""

_HERO = f"""
SELECT {_K}, name AS tag_hero, n AS hero_posts FROM (
  SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY n DESC, name DESC) AS rn
  FROM nm) WHERE rn = 1
"""

_KEY_EQ = " AND ".join(f"st.{k} = h.{k}" for k in TAG_KEYS)


def _tag_analysis_sql(
    how: str = "left", on_month: bool = False, posts_sql: str = POSTS_SQL
) -> str:
    return _with(
        posts_sql=posts_sql,
        pt=_TAG_ROWS,
        j=_joined(how, on_month),
        st=_STATS,
        nm=_NAMES,
        h=_HERO,
    ) + (
        "SELECT st.src_year, st.src_month, st.tag, st.posts, st.avg_reputation, "
        "st.avg_score, h.tag_hero, st.month, st.year "
        f"FROM st LEFT JOIN h ON {_KEY_EQ}"
    )


def _summary_sql(histogram: bool = False, posts_sql: str = POSTS_SQL) -> str:
    pm = (
        "SELECT src_year, src_month, count(*) AS number_of_posts, "
        "avg(comment_count) AS average_comments_per_post, "
        "CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT owner_user_id), 0) "
        "AS average_posts_per_user FROM posts GROUP BY src_year, src_month"
    )
    um = (
        "SELECT src_year, src_month, count(id) AS number_of_new_users, "
        "avg(reputation) AS average_reputation_per_user FROM users "
        f"WHERE {_SNAPSHOT_WHERE} GROUP BY src_year, src_month"
    )
    tg = (
        "SELECT src_year, src_month, count(DISTINCT tag) AS total_active_tags FROM "
        "(SELECT src_year, src_month, unnest(string_split(tags, '|')) AS tag FROM posts) "
        "GROUP BY src_year, src_month"
    )
    hd = (
        "SELECT src_year, src_month, string_agg(day || ':' || posts, ',' ORDER BY day) AS histogram "
        "FROM (SELECT src_year, src_month, day(creation_date) AS day, count(*) AS posts "
        "FROM posts WHERE creation_date IS NOT NULL GROUP BY ALL) GROUP BY src_year, src_month"
    )
    keys = (
        "SELECT src_year, src_month FROM pm UNION SELECT src_year, src_month FROM um "
        "UNION SELECT src_year, src_month FROM tg"
    )
    extra_cols = ", coalesce(hd.histogram, '') AS histogram" if histogram else ""
    return _with(posts_sql=posts_sql, pm=pm, um=um, tg=tg, hd=hd, k=keys) + f"""
SELECT k.src_year, k.src_month,
       coalesce(pm.number_of_posts, 0) AS number_of_posts,
       pm.average_comments_per_post,
       coalesce(um.number_of_new_users, 0) AS number_of_new_users,
       coalesce(tg.total_active_tags, 0) AS total_active_tags,
       pm.average_posts_per_user,
       um.average_reputation_per_user{extra_cols}
FROM k
LEFT JOIN pm ON k.src_year = pm.src_year AND k.src_month = pm.src_month
LEFT JOIN um ON k.src_year = um.src_year AND k.src_month = um.src_month
LEFT JOIN tg ON k.src_year = tg.src_year AND k.src_month = tg.src_month
LEFT JOIN hd ON k.src_year = hd.src_year AND k.src_month = hd.src_month
"""


_POSTS_COLS = ", ".join(POSTS_SCHEMA.fieldNames() + SOURCE_KEYS)
_USERS_COLS = ", ".join(USERS_SCHEMA.fieldNames() + SOURCE_KEYS)
_JOIN_SELECT = "p.owner_user_id, p.creation_date, p.score, p.tags, u.id, u.reputation, u.display_name"


ORACLE_SQL: dict[str, str] = {
    "q_scan_posts": _with() + f"SELECT {_POSTS_COLS} FROM posts",
    "q_scan_users": _with() + f"SELECT {_USERS_COLS} FROM users",
    "q_csv_roundtrip": _with() + f"SELECT {_POSTS_COLS} FROM posts",
    "q_csv_split_lines": _with() + f"SELECT {_POSTS_COLS} FROM posts",
    "q_csv_by_name": _with() + f"SELECT {_POSTS_COLS} FROM posts",
    "q_snapshot_filter": _with(users_snapshot=True)
    + f"SELECT {_USERS_COLS} FROM users WHERE {_SNAPSHOT_WHERE}",
    "q_date_parts": _with()
    + "SELECT owner_user_id, creation_date, CAST(year(creation_date) AS INTEGER) AS year, "
    "CAST(month(creation_date) AS INTEGER) AS month, "
    "CAST(day(creation_date) AS INTEGER) AS day FROM posts",
    "q_tags_per_post": _with()
    + "SELECT owner_user_id, tags, CAST(CASE WHEN tags IS NULL THEN 0 "
    "ELSE len(string_split(tags, '|')) END AS INTEGER) AS n_tags FROM posts",
    "q_explode_tags": _with()
    + "SELECT src_year, src_month, owner_user_id, score, "
    "unnest(string_split(tags, '|')) AS tag FROM posts",
    "q_fill_names": _with() + "SELECT id, coalesce(display_name, '') AS name FROM users",
    "q_join_left": _with()
    + f"SELECT {_JOIN_SELECT} FROM posts p LEFT JOIN users u ON p.owner_user_id = u.id",
    "q_join_inner": _with()
    + f"SELECT {_JOIN_SELECT} FROM posts p JOIN users u ON p.owner_user_id = u.id",
    "q_join_left_salted": _with()
    + f"SELECT {_JOIN_SELECT} FROM posts p LEFT JOIN users u ON p.owner_user_id = u.id",
    "q_join_by_month": _with()
    + f"SELECT p.src_year, p.src_month, {_JOIN_SELECT} FROM posts p LEFT JOIN users u "
    "ON p.owner_user_id = u.id AND p.src_year = u.src_year AND p.src_month = u.src_month",
    "q_post_counts": _with()
    + "SELECT src_year, src_month, count(*) AS number_of_posts FROM posts "
    "GROUP BY src_year, src_month",
    "q_avg_comments": _with()
    + "SELECT src_year, src_month, avg(comment_count) AS average_comments_per_post "
    "FROM posts GROUP BY src_year, src_month",
    "q_new_users": _with(users_snapshot=True)
    + "SELECT src_year, src_month, count(id) AS number_of_new_users FROM users "
    f"WHERE {_SNAPSHOT_WHERE} GROUP BY src_year, src_month",
    "q_avg_reputation": _with(users_snapshot=True)
    + "SELECT src_year, src_month, avg(reputation) AS average_reputation_per_user "
    f"FROM users WHERE {_SNAPSHOT_WHERE} GROUP BY src_year, src_month",
    "q_active_tags": _with()
    + "SELECT src_year, src_month, count(DISTINCT tag) AS total_active_tags FROM "
    "(SELECT src_year, src_month, unnest(string_split(tags, '|')) AS tag FROM posts) "
    "GROUP BY src_year, src_month",
    "q_posts_per_user": _with()
    + "SELECT src_year, src_month, count(*) AS number_of_posts, "
    "count(DISTINCT owner_user_id) AS unique_users, "
    "CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT owner_user_id), 0) "
    "AS average_posts_per_user FROM posts GROUP BY src_year, src_month",
    "q_histogram": _with()
    + "SELECT src_year, src_month, CAST(day(creation_date) AS INTEGER) AS day, "
    "count(*) AS posts FROM posts WHERE creation_date IS NOT NULL "
    "GROUP BY src_year, src_month, day(creation_date)",
    "q_histogram_events": "WITH posts AS (" + EVENTS_POSTS_SQL + ")\n"
    "SELECT src_year, src_month, CAST(day(creation_date) AS INTEGER) AS day, "
    "count(*) AS posts FROM posts WHERE creation_date IS NOT NULL "
    "GROUP BY src_year, src_month, day(creation_date)",
    "q_tag_stats": _with(pt=_TAG_ROWS, j=_joined("left", False)) + _STATS,
    "q_user_tag_counts": _with(pt=_TAG_ROWS, j=_joined("left", False))
    + f"SELECT {_K}, coalesce(display_name, '') AS display_name, count(*) AS n_posts "
    f"FROM j WHERE id IS NOT NULL GROUP BY {_K}, coalesce(display_name, '')",
    "q_tag_hero": _with(
        pt=_TAG_ROWS,
        j=_joined("left", False),
        nm=_NAMES,
        h=_HERO,
        st=f"SELECT DISTINCT {_K} FROM j",
    )
    + f"SELECT st.src_year, st.src_month, st.year, st.month, st.tag, h.tag_hero, "
    f"h.hero_posts FROM st LEFT JOIN h ON {_KEY_EQ}",
    "q_tag_analysis": _tag_analysis_sql("left", False),
    "q_tag_analysis_inner": _tag_analysis_sql("inner", False),
    "q_tag_analysis_by_month": _tag_analysis_sql("left", True),
    "q_tag_analysis_join_first": _tag_analysis_sql("left", False),
    "q_tag_analysis_events": _tag_analysis_sql("left", False, EVENTS_POSTS_SQL),
    "q_summary": _summary_sql(),
    "q_summary_events": _summary_sql(posts_sql=EVENTS_POSTS_SQL),
    "q_parquet_sink": _tag_analysis_sql("left", False),
    "q_json_sink": _summary_sql(True),
    "q_job_tag_analysis": _tag_analysis_sql("left", True),
    "q_job_summary": _summary_sql(True),
    "q_stream_tag_analysis": _tag_analysis_sql("left", True),
    "q_stream_one_users_table": _tag_analysis_sql("left", False),
    "q_job_partial_rerun": _tag_analysis_sql("left", False),
    "q_job_partial_summary": _summary_sql(True),
    "q_tag_analysis_salted": _tag_analysis_sql("left", False),
}


# Flagship: the tag analysis.
FLAGSHIP = "q_tag_analysis"
