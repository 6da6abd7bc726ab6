"""Row filters applied before the analyses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.columns import month_of, year_of

# Fixed value: the first users file, January 2016, holds every user created
# up to then; each later file holds only the users created in its month.
DEFAULT_SNAPSHOT_MONTHS: tuple[tuple[int, int], ...] = ((2016, 1),)


def filter_snapshot_users(
    users: DataFrame,
    snapshot_months: Iterable[tuple[int, int]] = DEFAULT_SNAPSHOT_MONTHS,
) -> DataFrame:
    """In a snapshot folder keep only users created in that folder's month.

    Rows of other folders pass unchanged. A user without creation date in a
    snapshot folder is dropped (its month is unknown). A row-level filter
    (map-side, no shuffle); it mixes folder keys and creation dates, so it
    is not a partition filter.
    """
    months = sorted({y * 100 + m for y, m in snapshot_months})
    if not months:
        return users
    is_snapshot = (F.col("src_year") * 100 + F.col("src_month")).isin(months)
    created_in_folder_month = (year_of() == F.col("src_year")) & (
        month_of() == F.col("src_month")
    )
    keep = F.coalesce(~is_snapshot, F.lit(True)) | F.coalesce(
        created_in_folder_month, F.lit(False)
    )
    return users.where(keep)


def dated_posts(posts: DataFrame) -> DataFrame:
    """Posts with a creation date: only those belong to a (year, month)."""
    return posts.where(F.col("creation_date").isNotNull())
