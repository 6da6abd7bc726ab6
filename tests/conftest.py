from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from postlens.schemas import POSTS_SCHEMA, USERS_SCHEMA  # noqa: E402
from postlens.session import JOB_CONF  # noqa: E402


SRC_FIELDS = [
    T.StructField("src_year", T.IntegerType(), True),
    T.StructField("src_month", T.IntegerType(), True),
]


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("postlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where none is configured.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="postlens-test-"))
    yield session


def ts(s: str | None):
    if s is None:
        return None
    return dt.datetime.fromisoformat(s)


def make_posts(spark, rows, src=(2016, 2)):
    """rows: (creation_date, owner_user_id, score, comment_count, tags)."""
    full = []
    for r in rows:
        cd, owner, score, comments, tags = r[:5]
        s = r[5] if len(r) > 5 else src
        full.append((None, None, comments, ts(cd), owner, score, tags, None, s[0], s[1]))
    schema = T.StructType(POSTS_SCHEMA.fields + SRC_FIELDS)
    return spark.createDataFrame(full, schema)


def make_users(spark, rows, src=(2016, 2)):
    """rows: (id, display_name, reputation[, creation_date[, (y, m)]])."""
    full = []
    for r in rows:
        uid, name, rep = r[:3]
        cd = r[3] if len(r) > 3 else f"{src[0]}-{src[1]:02d}-05 00:00:00"
        s = r[4] if len(r) > 4 else src
        full.append((uid, name, ts(cd), rep, None, None, None, s[0], s[1]))
    schema = T.StructType(USERS_SCHEMA.fields + SRC_FIELDS)
    return spark.createDataFrame(full, schema)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="postlens-case-")
