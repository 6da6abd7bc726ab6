"""Posts-to-users equi-join.

Join keys are the owner id and, by default, the source month too: a month's
posts are matched against that month's users file only. ``join_on_month``
set to False matches against one users table for all months.

Strategy is left to Spark: Catalyst broadcasts the users side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans a sort-merge join into a broadcast join when the measured size is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise both sides
are hash-shuffled on the keys. Then a very active owner would be one task's
load, so the join looks for heavy owners itself: rows are counted per owner
map-side, owners with over 1/``HEAVY_SHARE`` of all rows (so fewer than that
many) are broadcast, and only their rows are split by a salt and only their user
rows copied. Posts without owner, which never match, are spread by a hash of
the post instead of sharing one null key. The analyses in ``tags`` avoid hot
owners by aggregating posts per owner before joining.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.schemas import SOURCE_KEYS

JOIN_TYPES = ("left", "inner")

# Columns taken from the users side.
USER_COLUMNS = ["id", "reputation", "display_name"]


def users_side(users: DataFrame, join_on_month: bool) -> DataFrame:
    """Users projected to the join columns, keys renamed to avoid clashes."""
    cols = [F.col(c) for c in USER_COLUMNS]
    if join_on_month:
        cols += [F.col(k).alias(f"_u_{k}") for k in SOURCE_KEYS]
    return users.select(*cols)


# Null owners never match a user. In a left join they would all hash to one
# partition; instead each gets a key below every 32-bit user id, spread by a
# hash of the post itself (deterministic, so task retries see the same key).
NULL_OWNER_SPREAD = 1 << 20
NULL_OWNER_BASE = -(1 << 40)


def _spread_null_owners(posts: DataFrame) -> DataFrame:
    owner = F.col("owner_user_id")
    spread = F.pmod(F.xxhash64(*[posts[c] for c in posts.columns]), F.lit(NULL_OWNER_SPREAD))
    return posts.withColumn(
        "_owner_key",
        F.when(owner.isNull(), F.lit(NULL_OWNER_BASE) - spread).otherwise(owner),
    )


# An owner with more than this share of the rows is heavy; ways it is split.
HEAVY_SHARE = 256
HEAVY_SALT = 64


def heavy_owners(left: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """(owner_user_id): owners with more than 1/``share`` of all rows, so fewer
    than ``share``."""
    counts = left.where(F.col("owner_user_id").isNotNull()).groupBy("owner_user_id").agg(
        F.count(F.lit(1)).alias("rows")
    )
    total = left.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.where(F.col("rows") * share > total).select("owner_user_id")


def _may_broadcast(users: DataFrame) -> bool:
    """Whether Spark joins the users side by broadcast by its own estimate."""
    limit = users.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = users._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def _salted(keyed: DataFrame, right: DataFrame, row: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt that is 0 but for heavy owners."""
    heavy = heavy_owners(keyed).select(F.col("owner_user_id").alias("_heavy"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in row]), F.lit(HEAVY_SALT))
    keyed = keyed.join(F.broadcast(heavy), F.col("owner_user_id") == F.col("_heavy"), "left")
    keyed = keyed.withColumn("_salt", F.when(F.col("_heavy").isNotNull(), salt).otherwise(F.lit(0)))
    copies = F.when(F.col("_heavy").isNotNull(), F.lit(HEAVY_SALT - 1)).otherwise(F.lit(0))
    right = right.join(F.broadcast(heavy), F.col("id") == F.col("_heavy"), "left")
    right = right.withColumn("_u_salt", F.explode(F.sequence(F.lit(0), copies)))
    return keyed.drop("_heavy"), right.drop("_heavy")


def join_users(
    left: DataFrame,
    users: DataFrame,
    how: str = "left",
    join_on_month: bool = True,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Join any frame with ``owner_user_id`` (and the month keys) to users.

    Adds ``id``, ``reputation``, ``display_name``. ``how="left"`` keeps rows
    whose owner has no user row (user columns null); ``how="inner"`` drops
    them. Null owners never match;
    in a left join they are spread over all partitions rather than sent to
    one.

    By default (``salt_buckets=None``) heavy owners are found and split
    ``HEAVY_SALT`` ways where the users side is not broadcast; ``left`` is then
    read twice, the first time its owner column alone. ``salt_buckets=S > 1``
    splits every owner's rows S ways (by a hash of the row) and copies each
    user row S times instead; 1 splits none. The copies are joined by sort and
    merge, never broadcast: Spark's size estimates leave them out, at planning
    as at run time (a row's copies compress to little), and each task would
    hold all of them.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}, got {how!r}")
    find = salt_buckets is None
    if find:
        salt_buckets = 1
    if salt_buckets < 1:
        raise ValueError("salt_buckets must be at least 1")
    right = users_side(users, join_on_month)
    keyed = _spread_null_owners(left) if how == "left" else left
    key = keyed["_owner_key"] if how == "left" else keyed["owner_user_id"]
    if salt_buckets > 1:
        keyed = keyed.withColumn(
            "_salt",
            F.pmod(F.xxhash64(*[left[c] for c in left.columns]), F.lit(salt_buckets)),
        )
        right = right.withColumn(
            "_u_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
        ).hint("merge")
        key = keyed["_owner_key"] if how == "left" else keyed["owner_user_id"]
    found = find and not _may_broadcast(right)
    if found:
        keyed, right = _salted(keyed, right, left.columns)
        key = keyed["_owner_key"] if how == "left" else keyed["owner_user_id"]
    salted = found or salt_buckets > 1
    cond = key == right["id"].cast("long")
    if join_on_month:
        for k in SOURCE_KEYS:
            cond = cond & (keyed[k] == right[f"_u_{k}"])
    if salted:
        cond = cond & (keyed["_salt"] == right["_u_salt"])
    joined = keyed.join(right, cond, how)
    drop = [f"_u_{k}" for k in SOURCE_KEYS] if join_on_month else []
    if how == "left":
        drop.append("_owner_key")
    if salted:
        drop += ["_salt", "_u_salt"]
    return joined.drop(*drop)
