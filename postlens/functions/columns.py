"""Scalar column expressions used by the operators.

All of them are Catalyst expressions, so they stay inside whole-stage
codegen and are pushed into scans where Spark can do so.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: tags of a post are one string joined by a vertical bar, e.g.
# "python|pandas". Split is literal (the bar is escaped in the pattern) and
# keeps empty pieces, so "x|" gives ["x", ""].
TAG_SEPARATOR_PATTERN = r"\|"

# Two directories directly above a file name a month folder: .../2016/01/f.
# A Hive-style folder (src_year=2016/src_month=1) gives the same keys.
FOLDER_KEYS_PATTERN = r"/(?:[^/=]*=)?([^/]+)/(?:[^/=]*=)?([^/]+)/[^/]+$"


def folder_keys_pattern(leaf: str | tuple[str, ...] | None = None) -> str:
    """Pattern for the month folder above ``leaf`` (e.g. ``posts.csv``).

    With a leaf name (or several) the entry may be the file itself or a
    folder of part files: .../2016/01/posts.csv and
    .../2016/01/posts.csv/part-1.csv both give (2016, 1). Without one, the
    two directories above the file count.
    """
    if leaf is None:
        return FOLDER_KEYS_PATTERN
    names = (leaf,) if isinstance(leaf, str) else tuple(leaf)
    entry = "(?:" + "|".join(re.escape(n) for n in names) + ")"
    return r"/(?:[^/=]*=)?([^/]+)/(?:[^/=]*=)?([^/]+)/" + entry + r"(?:/[^/]+)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tag_array(tags: str | Column = "tags") -> Column:
    """Tags string to array of tags; null stays null."""
    return F.split(_col(tags), TAG_SEPARATOR_PATTERN, -1)


def tags_per_post(tags: str | Column = "tags") -> Column:
    """Number of tags of a post; 0 when the post has no tags string."""
    t = _col(tags)
    return F.when(t.isNull(), F.lit(0)).otherwise(F.size(tag_array(t)))


def year_of(ts: str | Column = "creation_date") -> Column:
    return F.year(_col(ts))


def month_of(ts: str | Column = "creation_date") -> Column:
    return F.month(_col(ts))


def day_of(ts: str | Column = "creation_date") -> Column:
    return F.dayofmonth(_col(ts))


def fill_name(name: str | Column = "display_name") -> Column:
    """A missing display name counts as the empty name."""
    return F.coalesce(_col(name), F.lit(""))


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division that gives null instead of failing on a zero."""
    return F.try_divide(
        _col(numerator).cast("double"), _col(denominator).cast("double")
    )


def folder_key(
    part: int,
    path: str | Column | None = None,
    leaf: str | tuple[str, ...] | None = None,
) -> Column:
    """Year (part=1) or month (part=2) of the month folder a row came from.

    Reads the file path from the hidden ``_metadata`` column by default.
    ``leaf`` names the entry inside the month folder (see
    ``folder_keys_pattern``).
    """
    p = _col(path) if path is not None else F.col("_metadata.file_path")
    raw = F.regexp_extract(p, folder_keys_pattern(leaf), part)
    return F.when(raw == "", F.lit(None)).otherwise(raw).try_cast("int")
