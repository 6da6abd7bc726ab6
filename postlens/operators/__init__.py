"""Relational operators of the monthly job (DataFrame in, DataFrame out)."""

from postlens.operators.joins import join_users
from postlens.operators.preprocess import dated_posts, filter_snapshot_users
from postlens.operators.summary import (
    active_tags,
    avg_comments,
    compute_summary,
    day_histogram,
    day_histogram_long,
    post_counts,
    post_measures,
    posts_per_user,
    user_measures,
)
from postlens.operators.tags import (
    compute_tag_analysis,
    explode_tags,
    name_tag_rows,
    owner_tagset_rows,
    post_tagset_rows,
    tag_heroes,
    tag_stats,
    user_tag_counts,
)

__all__ = [
    "active_tags",
    "avg_comments",
    "compute_summary",
    "compute_tag_analysis",
    "dated_posts",
    "day_histogram",
    "day_histogram_long",
    "explode_tags",
    "filter_snapshot_users",
    "join_users",
    "name_tag_rows",
    "owner_tagset_rows",
    "post_tagset_rows",
    "post_counts",
    "post_measures",
    "posts_per_user",
    "tag_heroes",
    "tag_stats",
    "user_measures",
    "user_tag_counts",
]
