"""Posts and users built from the driver's test tables.

The test data has no Q&A tables, so ``orders`` plays posts and ``customer``
plays users. Each adapter is a projection over the whole table; the same
expressions are written in SQL in ``postlens.plans.catalog`` for the DuckDB
oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postlens.schemas import POSTS_SCHEMA, USERS_SCHEMA

# Schemas of the test tables used here, as generated. Reading
# with a given schema skips schema inference (a footer-reading job per read).
TABLE_SCHEMAS = {
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nulls(schema: T.StructType, *fields: str) -> dict[str, str]:
    return {f: f"CAST(NULL AS {schema[f].dataType.simpleString()})" for f in fields}


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One projection from SQL expressions: one plan node, one analysis."""
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def posts_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts: one per order, with the irregularities real posts have.

    Some owners are null or have no user row; some posts have no date (their
    folder month stays), no tags, a repeated tag or three tags; some lie in a
    folder that differs from their date's month; titles hold quotes, commas
    and line breaks.
    """
    created = "CAST(o_orderdate AS TIMESTAMP)"
    folder = (
        f"(CASE WHEN o_orderkey % 23 = 0 THEN {created} + INTERVAL 40 DAYS ELSE {created} END)"
    )
    cols = {
        "title": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('Say \"', o_orderstatus, '\", ok') "
        "WHEN 2 THEN concat('two', chr(10), 'lines, ', o_orderstatus) ELSE concat('How to ', o_orderkey) END",
        "answer_count": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INT) END",
        "comment_count": "CASE WHEN o_orderkey % 5 = 0 THEN NULL "
        "ELSE CAST(o_orderkey % 7 AS INT) END",
        "creation_date": f"CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE {created} END",
        "owner_user_id": "CASE WHEN o_orderkey % 17 = 0 THEN NULL "
        "WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey + 1000000000 AS BIGINT) "
        "ELSE CAST(o_custkey AS BIGINT) END",
        "score": "CAST(FLOOR(o_totalprice) AS INT)",
        "tags": "CASE o_orderkey % 13 WHEN 0 THEN NULL "
        "WHEN 1 THEN concat_ws('|', o_orderpriority, o_orderstatus, o_orderpriority) "
        "WHEN 2 THEN concat_ws('|', o_orderpriority, o_orderstatus, 'extra') "
        "ELSE concat_ws('|', o_orderpriority, o_orderstatus) END",
        "view_count": "CAST(o_custkey % 1000 AS INT)",
        "src_year": f"year({folder})",
        "src_month": f"month({folder})",
    }
    return _project(load_table(spark, sf_dir, "orders"), cols)


def users_from_customer(
    spark: SparkSession, sf_dir: str, *, snapshot: bool = False
) -> DataFrame:
    """Users: one per customer; reputation (the floored balance) may be
    negative.

    ``snapshot=True`` puts half of the users into the folder 1995/01, which
    then acts as the all-users snapshot file the snapshot filter applies to;
    the others stay in the folder of their own month.
    """
    created = (
        "make_timestamp(CAST(1995 + c_custkey % 3 AS INT), "
        "CAST(1 + c_custkey % 12 AS INT), 1, 0, 0, 0)"
    )
    year, month = f"year({created})", f"month({created})"
    if snapshot:
        year = f"CASE WHEN c_custkey % 4 < 2 THEN 1995 ELSE {year} END"
        month = f"CASE WHEN c_custkey % 4 < 2 THEN 1 ELSE {month} END"
    cols = {
        "id": "CAST(c_custkey AS INT)",
        "display_name": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END",
        "creation_date": created,
        "reputation": "CAST(FLOOR(c_acctbal) AS INT)",
        "location": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat(c_mktsegment, ', \"x\"') END",
        "up_votes": "CAST(c_custkey % 100 AS INT)",
        "down_votes": "CAST(c_nationkey AS INT)",
        "src_year": year,
        "src_month": month,
    }
    return _project(load_table(spark, sf_dir, "customer"), cols)


def posts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second posts input: one post per event (histogram input).

    ``user_id`` is the owner, ``ts`` the creation time, ``event_type`` the
    single tag; the folder month is the month of ``ts``.
    """
    created = "CAST(ts AS TIMESTAMP)"
    cols = {
        **_nulls(POSTS_SCHEMA, "title", "answer_count", "comment_count"),
        "creation_date": created,
        "owner_user_id": "CAST(user_id AS BIGINT)",
        **_nulls(POSTS_SCHEMA, "score"),
        "tags": "event_type",
        **_nulls(POSTS_SCHEMA, "view_count"),
        "src_year": f"year({created})",
        "src_month": f"month({created})",
    }
    return _project(load_table(spark, sf_dir, "events"), cols)
