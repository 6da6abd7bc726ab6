"""Sources: month-folder CSV files and adapters over the test tables."""

from postlens.sources.adapters import (
    load_table,
    posts_from_events,
    posts_from_orders,
    users_from_customer,
)
from postlens.sources.csv_months import (
    read_month_csv,
    read_posts,
    read_users,
    write_month_csv,
)

__all__ = [
    "load_table",
    "posts_from_events",
    "posts_from_orders",
    "read_month_csv",
    "read_posts",
    "read_users",
    "users_from_customer",
    "write_month_csv",
]
