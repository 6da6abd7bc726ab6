"""Tag analysis: posts, average reputation, average score and hero per tag.

Result grain: one row per (source month, year, month, tag), where year and
month come from the post's creation date. Per group:

* ``posts``          posts carrying the tag with a known owner (a tag
                     repeated inside one post counts each time);
* ``avg_reputation`` mean reputation of the matched owner, one value per
                     (post, tag) row, so an owner weighs by their posts;
* ``avg_score``      mean score over the same rows;
* ``tag_hero``       display name with the most rows among matched users
                     (missing name counts as ""), ties to the greatest name;
                     null when no owner matched.

Plan (two aggregations and one join, every input read once; one more
aggregation first for the join on the owner alone):

1. each post is one row with its tags string, so it crosses the join once,
   not once per tag. Where the join is on the owner alone, one very active
   owner would be a hot key: posts are first folded per (source month, year,
   month, tags string, owner), with partial sums before the shuffle, or the
   join is salted (``salt_buckets``). A join on owner and source month needs
   neither by default: an owner's posts are spread over the months, real
   (owner, tag set) pairs are almost unique, and AQE splits what is left;
2. join those rows to users on owner (and source month);
3. explode the tags string and aggregate per (keys, tag, matched, name):
   hero candidates and partial sums, combined map-side, so a tag used by a
   large share of all posts is spread over names before its shuffle;
4. aggregate per (keys, tag): sums into averages, ``max(struct(rows, name))``
   into the hero, again combined map-side.

Averages are a sum of integers divided by a count, exactly as a direct mean
over the joined rows would be, so results do not depend on the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.columns import fill_name, month_of, safe_ratio, tag_array, year_of
from postlens.operators.joins import join_users
from postlens.operators.preprocess import dated_posts
from postlens.schemas import SOURCE_KEYS, TAG_ANALYSIS_COLUMNS, TAG_KEYS


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per (post, tag); posts without a tags string give no row."""
    return posts.withColumn("tag", F.explode(tag_array("tags")))


def owner_tagset_rows(posts: DataFrame) -> DataFrame:
    """Level 1: per (source month, year, month, tags, owner) the post count,
    score sum and score count. Posts without date or tags have no tag row
    and are left out here."""
    tagged = dated_posts(posts).where(F.col("tags").isNotNull())
    return tagged.groupBy(
        *SOURCE_KEYS,
        year_of().alias("year"),
        month_of().alias("month"),
        "tags",
        "owner_user_id",
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("score_n"),
    )


def post_tagset_rows(posts: DataFrame) -> DataFrame:
    """Level 1 without aggregation: one row per dated, tagged post with unit
    counts, in the columns of ``owner_tagset_rows``."""
    tagged = dated_posts(posts).where(F.col("tags").isNotNull())
    score = F.col("score")
    return tagged.select(
        *SOURCE_KEYS,
        year_of().alias("year"),
        month_of().alias("month"),
        "tags",
        "owner_user_id",
        F.lit(1).cast("long").alias("rows"),
        score.cast("long").alias("score_sum"),
        F.when(score.isNotNull(), 1).otherwise(0).cast("long").alias("score_n"),
    )


def _tag_rows(joined: DataFrame) -> DataFrame:
    """Joined level-1 rows, one per tag. A tag repeated inside one post
    counts each time."""
    matched = F.col("id").isNotNull()
    return joined.select(
        *SOURCE_KEYS,
        "year",
        "month",
        F.explode(tag_array("tags")).alias("tag"),
        "owner_user_id",
        "rows",
        "score_sum",
        "score_n",
        "reputation",
        matched.alias("matched"),
        F.when(matched, fill_name()).alias("name"),
    )


def _partial_sums() -> list:
    rows = F.col("rows")
    return [
        F.sum(F.when(F.col("owner_user_id").isNotNull(), rows)).alias("posts"),
        F.sum(rows * F.col("reputation")).alias("rep_sum"),
        F.sum(F.when(F.col("reputation").isNotNull(), rows)).alias("rep_n"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("score_n").alias("score_n"),
    ]


def name_tag_rows(joined: DataFrame) -> DataFrame:
    """Level 2: explode the tags, then per (TAG_KEYS, matched, name) the
    partial sums."""
    return (
        _tag_rows(joined)
        .groupBy(*TAG_KEYS, "matched", "name")
        .agg(F.sum("rows").alias("name_rows"), *_partial_sums())
    )


def _joined_rows(
    posts: DataFrame,
    users: DataFrame,
    how: str,
    join_on_month: bool,
    pre_aggregate: bool | None,
    salt_buckets: int,
) -> DataFrame:
    """Level-1 rows joined to the owner's user row.

    By default (``pre_aggregate=None``) posts are joined as they are when the
    source month is a join key (an owner's posts are then spread over the
    months) or when the join is salted, and folded per owner first otherwise.
    """
    if pre_aggregate is None:
        pre_aggregate = not join_on_month and salt_buckets == 1
    level1 = owner_tagset_rows(posts) if pre_aggregate else post_tagset_rows(posts)
    # posts joined as they are: the join finds heavy owners itself
    salt = None if salt_buckets == 1 and not pre_aggregate else salt_buckets
    return join_users(level1, users, how, join_on_month, salt)


def _stat_columns() -> list:
    return [
        F.coalesce(F.sum("posts"), F.lit(0)).cast("long").alias("posts"),
        safe_ratio(F.sum("rep_sum"), F.sum("rep_n")).alias("avg_reputation"),
        safe_ratio(F.sum("score_sum"), F.sum("score_n")).alias("avg_score"),
    ]


def _hero_column():
    candidate = F.when(F.col("matched"), F.struct("name_rows", "name"))
    return F.max(candidate).getField("name").alias("tag_hero")


def tag_stats(
    posts: DataFrame,
    users: DataFrame,
    how: str = "left",
    join_on_month: bool = True,
    pre_aggregate: bool | None = None,
    salt_buckets: int = 1,
) -> DataFrame:
    """Per tag group: posts, avg_reputation, avg_score (no hero).

    Names play no part, so rows are aggregated straight to the tag group;
    map-side partial sums carry a hot tag.
    """
    joined = _joined_rows(posts, users, how, join_on_month, pre_aggregate, salt_buckets)
    return (
        _tag_rows(joined)
        .groupBy(*TAG_KEYS)
        .agg(*_partial_sums())
        .select(
            *TAG_KEYS,
            F.coalesce("posts", F.lit(0)).cast("long").alias("posts"),
            safe_ratio(F.col("rep_sum"), F.col("rep_n")).alias("avg_reputation"),
            safe_ratio(F.col("score_sum"), F.col("score_n")).alias("avg_score"),
        )
    )


def user_tag_counts(
    posts: DataFrame,
    users: DataFrame,
    how: str = "left",
    join_on_month: bool = True,
    pre_aggregate: bool | None = None,
    salt_buckets: int = 1,
) -> DataFrame:
    """Per tag group and display name of a matched user: rows (``n_posts``)."""
    joined = _joined_rows(posts, users, how, join_on_month, pre_aggregate, salt_buckets)
    return (
        name_tag_rows(joined)
        .where(F.col("matched"))
        .select(
            *TAG_KEYS,
            F.col("name").alias("display_name"),
            F.col("name_rows").cast("long").alias("n_posts"),
        )
    )


def tag_heroes(
    posts: DataFrame,
    users: DataFrame,
    how: str = "left",
    join_on_month: bool = True,
    pre_aggregate: bool | None = None,
    salt_buckets: int = 1,
) -> DataFrame:
    """Per tag group: the hero and the hero's row count (``hero_posts``)."""
    candidate = F.when(F.col("matched"), F.struct("name_rows", "name"))
    joined = _joined_rows(posts, users, how, join_on_month, pre_aggregate, salt_buckets)
    return (
        name_tag_rows(joined)
        .groupBy(*TAG_KEYS)
        .agg(F.max(candidate).alias("_best"))
        .select(
            *TAG_KEYS,
            F.col("_best.name").alias("tag_hero"),
            F.col("_best.name_rows").cast("long").alias("hero_posts"),
        )
    )


def compute_tag_analysis(
    posts: DataFrame,
    users: DataFrame,
    how: str = "left",
    join_on_month: bool = True,
    pre_aggregate: bool | None = None,
    salt_buckets: int = 1,
) -> DataFrame:
    """The tag analysis table (see module doc), all months at once.

    ``pre_aggregate`` folds posts per owner and tag set before the join; the
    default does so only for the join on the owner alone without salting.
    ``salt_buckets=S`` splits every owner's rows S ways in the join instead.
    """
    joined = _joined_rows(posts, users, how, join_on_month, pre_aggregate, salt_buckets)
    return (
        name_tag_rows(joined)
        .groupBy(*TAG_KEYS)
        .agg(*_stat_columns(), _hero_column())
        .select(*TAG_ANALYSIS_COLUMNS)
    )
