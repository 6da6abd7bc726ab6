"""Monthly summary: one row per source month.

Each measure is a grouped aggregate over the source-month keys, so all months
are summarised by one plan. The four inputs (post measures, user measures,
active tags, day histogram) are each at most one row per month (31 for the
histogram before it is folded into a map), and are stacked and grouped once
by the month keys; that last step touches only these tiny results.

Distinct counts run as Spark's two-phase distinct aggregation: rows are first
combined per (month, value) map-side, so a very active owner or a very common
tag does not land in one task as raw rows; ``posts_per_user`` alone counts
owners by bitmaps. One scan of the posts that emits a row per day, owner and tag
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.columns import day_of, safe_ratio, tag_array
from postlens.operators.preprocess import dated_posts
from postlens.schemas import SOURCE_KEYS


def post_counts(posts: DataFrame) -> DataFrame:
    """Number of posts per source month (posts without date included)."""
    return posts.groupBy(*SOURCE_KEYS).agg(F.count(F.lit(1)).alias("number_of_posts"))


def avg_comments(posts: DataFrame) -> DataFrame:
    """Mean comment count per post; posts without a count are skipped."""
    return posts.groupBy(*SOURCE_KEYS).agg(
        F.avg("comment_count").alias("average_comments_per_post")
    )


def posts_per_user(posts: DataFrame) -> DataFrame:
    """Posts, distinct owners, and their ratio (null when no owner).

    Owners are counted by bitmaps: per month and block of 32768 ids one bitmap
    of 4 KB, set map-side, so a month's shuffle is bounded by its id range and
    not by its owners. Posts without an owner are a block of their own.
    """
    owner = F.col("owner_user_id").cast("long")
    blocks = posts.groupBy(*SOURCE_KEYS, F.bitmap_bucket_number(owner).alias("block")).agg(
        F.count(F.lit(1)).alias("posts"),
        F.bitmap_construct_agg(F.bitmap_bit_position(owner)).alias("owners"),
    )
    known = F.when(F.col("block").isNotNull(), F.bitmap_count("owners")).otherwise(F.lit(0))
    return (
        blocks.groupBy(*SOURCE_KEYS)
        .agg(F.sum("posts").alias("number_of_posts"), F.sum(known).alias("unique_users"))
        .withColumn(
            "average_posts_per_user", safe_ratio("number_of_posts", "unique_users")
        )
    )


def post_measures(posts: DataFrame) -> DataFrame:
    """Post count, mean comments and posts per owner in one aggregation."""
    return posts.groupBy(*SOURCE_KEYS).agg(
        F.count(F.lit(1)).alias("number_of_posts"),
        F.avg("comment_count").alias("average_comments_per_post"),
        safe_ratio(F.count(F.lit(1)), F.countDistinct("owner_user_id")).alias(
            "average_posts_per_user"
        ),
    )


def user_measures(users: DataFrame) -> DataFrame:
    """New users (rows with an id) and their mean reputation per month.

    Apply ``filter_snapshot_users`` first so the snapshot file counts only
    the users created in its month.
    """
    return users.groupBy(*SOURCE_KEYS).agg(
        F.count("id").alias("number_of_new_users"),
        F.avg("reputation").alias("average_reputation_per_user"),
    )


def active_tags(posts: DataFrame) -> DataFrame:
    """Distinct tags used by the month's posts."""
    return (
        posts.select(*SOURCE_KEYS, F.explode(tag_array("tags")).alias("tag"))
        .groupBy(*SOURCE_KEYS)
        .agg(F.countDistinct("tag").alias("total_active_tags"))
    )


def day_histogram_long(posts: DataFrame) -> DataFrame:
    """Posts per day of month, long form: (keys, day, posts)."""
    return (
        dated_posts(posts)
        .groupBy(*SOURCE_KEYS, day_of().alias("day"))
        .agg(F.count(F.lit(1)).alias("posts"))
    )


def day_histogram(posts: DataFrame) -> DataFrame:
    """Posts per day of month as a map day -> posts, ordered by day.

    Days without posts are absent. At most 31 entries per month, so the
    collect is bounded whatever the data size.
    """
    return (
        day_histogram_long(posts)
        .groupBy(*SOURCE_KEYS)
        .agg(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("day", "posts")))
            ).alias("histogram")
        )
    )


def _empty_histogram():
    return F.create_map().cast("map<int,bigint>")


def _combine_by_month(parts: list[DataFrame]) -> DataFrame:
    """Put per-month results side by side without joins.

    Each part has the month keys plus its own columns. The parts are stacked
    (columns missing from a part are null) and grouped once by month; every
    column is non-null in exactly one part, so ``first(ignorenulls)`` picks
    that value. One small shuffle instead of a chain of outer joins.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    value_cols = [c for c in stacked.columns if c not in SOURCE_KEYS]
    return stacked.groupBy(*SOURCE_KEYS).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in value_cols]
    )


def compute_summary(
    posts: DataFrame, users: DataFrame, *, with_histogram: bool = True
) -> DataFrame:
    """The summary table: one row per source month seen in posts or users."""
    parts = [post_measures(posts), user_measures(users), active_tags(posts)]
    if with_histogram:
        parts.append(day_histogram(posts))
    combined = _combine_by_month(parts)
    cols = [
        *SOURCE_KEYS,
        F.coalesce("number_of_posts", F.lit(0)).cast("long").alias("number_of_posts"),
        F.col("average_comments_per_post"),
        F.coalesce("number_of_new_users", F.lit(0))
        .cast("long")
        .alias("number_of_new_users"),
        F.coalesce("total_active_tags", F.lit(0)).cast("long").alias("total_active_tags"),
        F.col("average_posts_per_user"),
        F.col("average_reputation_per_user"),
    ]
    if with_histogram:
        cols.append(F.coalesce("histogram", _empty_histogram()).alias("histogram"))
    return combined.select(*cols)
