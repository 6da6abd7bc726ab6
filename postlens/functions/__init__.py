"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from postlens.functions.columns import (
    day_of,
    fill_name,
    folder_key,
    month_of,
    safe_ratio,
    tag_array,
    tags_per_post,
    year_of,
)

__all__ = [
    "day_of",
    "fill_name",
    "folder_key",
    "month_of",
    "safe_ratio",
    "tag_array",
    "tags_per_post",
    "year_of",
]
