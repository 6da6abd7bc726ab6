"""Run every catalog query on Spark and its SQL on DuckDB; compare results.

Usage: python scripts/oracle_check.py [sf_dir] [query ...]

Compares column names, row counts and the multiset of rows (columns sorted
by name, floats rounded to 9 significant digits; EXACT=1 compares floats
bit for bit). Prints one line per query
and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from postlens.plans.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from postlens.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


EXACT = bool(os.environ.get("EXACT"))


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((_norm(k), _norm(x)) for k, x in v.items()))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    bad = 0
    for name in wanted:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        s_names = df.columns
        s_types = [f.dataType.simpleString() for f in df.schema.fields]
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        sql = ORACLE_SQL.get(name)
        if sql is None:
            print(f"{name:28s} rows={len(s_rows):7d} spark={t1 - t0:6.2f}s (no oracle)")
            continue
        cur = con.execute(sql)
        d_names = [c[0] for c in cur.description]
        d_types = [str(c[1]) for c in cur.description]
        d_rows = cur.fetchall()
        ok_names = sorted(s_names) == sorted(d_names)
        ok_count = len(s_rows) == len(d_rows)
        ok_vals = ok_names and ok_count and _rows(s_names, s_rows) == _rows(d_names, d_rows)
        status = "OK" if (ok_names and ok_count and ok_vals) else "MISMATCH"
        bad += status != "OK"
        print(
            f"{name:28s} rows={len(s_rows):7d}/{len(d_rows):7d} names={ok_names} "
            f"values={ok_vals} spark={t1 - t0:6.2f}s {status}"
        )
        if status != "OK" or os.environ.get("SHOW_TYPES"):
            print("   spark :", list(zip(s_names, s_types)))
            print("   duckdb:", list(zip(d_names, d_types)))
        if status != "OK" and ok_names and ok_count:
            a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print("   first diffs:", diff)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
