"""Input and output schemas.

Fixed values: the input column names, order and types below must equal the
job being replaced, because the CSV files carry a header but are read with a
fixed schema (no inference), and downstream users read the outputs by name.
"""

from pyspark.sql import types as T

# --- fixed values: input schemas ---------------------------------------------
# posts.csv: title, answer_count, comment_count, creation_date, owner_user_id,
#            score, tags, view_count
# users.csv: id, display_name, creation_date, reputation, location, up_votes,
#            down_votes
POSTS_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType(), True),
        T.StructField("answer_count", T.IntegerType(), True),
        T.StructField("comment_count", T.IntegerType(), True),
        T.StructField("creation_date", T.TimestampType(), True),
        T.StructField("owner_user_id", T.LongType(), True),
        T.StructField("score", T.IntegerType(), True),
        T.StructField("tags", T.StringType(), True),
        T.StructField("view_count", T.IntegerType(), True),
    ]
)

USERS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType(), True),
        T.StructField("display_name", T.StringType(), True),
        T.StructField("creation_date", T.TimestampType(), True),
        T.StructField("reputation", T.IntegerType(), True),
        T.StructField("location", T.StringType(), True),
        T.StructField("up_votes", T.IntegerType(), True),
        T.StructField("down_votes", T.IntegerType(), True),
    ]
)
# --- end fixed values ----------------------------------------------------------

# Input columns the summary and the tag analysis read; the job stages only
# these (plus the folder keys), so e.g. post titles are parsed once and
# never written again.
POSTS_USED = ["comment_count", "creation_date", "owner_user_id", "score", "tags"]
USERS_USED = ["id", "display_name", "creation_date", "reputation"]

# Keys naming the month folder a row was read from. They are carried next to
# the date keys (year, month) derived from creation_date, because a post can
# be dated outside its folder's month.
SOURCE_KEYS = ["src_year", "src_month"]

# Group keys of the tag analysis.
TAG_KEYS = SOURCE_KEYS + ["year", "month", "tag"]

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("src_year", T.IntegerType(), True),
        T.StructField("src_month", T.IntegerType(), True),
        T.StructField("number_of_posts", T.LongType(), False),
        T.StructField("average_comments_per_post", T.DoubleType(), True),
        T.StructField("number_of_new_users", T.LongType(), False),
        T.StructField("total_active_tags", T.LongType(), False),
        T.StructField("average_posts_per_user", T.DoubleType(), True),
        T.StructField("average_reputation_per_user", T.DoubleType(), True),
        T.StructField(
            "histogram", T.MapType(T.IntegerType(), T.LongType(), False), False
        ),
    ]
)

TAG_ANALYSIS_COLUMNS = [
    "src_year",
    "src_month",
    "tag",
    "posts",
    "avg_reputation",
    "avg_score",
    "tag_hero",
    "month",
    "year",
]
