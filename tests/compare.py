"""Run queries against their checks: python tests/compare.py <sf dir> [names...]."""

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def difference(spark_df, con, sql):
    """None when both give the same rows; otherwise what differs."""
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if got != want:
        return (
            f"{sum(got.values())} vs {sum(want.values())} rows; only spark {list((got - want))[:2]}; "
            f"only check {list((want - got))[:2]}"
        )
    return None


if __name__ == "__main__":
    from conftest import make_session

    import __spark_entry__ as e

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = make_session()
    con = connect(sf_dir)
    queries, checks = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            diff = difference(df, con, checks[name]) if name in checks else f"no check, {df.count()} rows"
        except Exception as exc:  # report and go on with the next query
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += diff is not None and not diff.startswith("no check")
        print(f"{name:28s} {time.time() - t0:6.2f}s {'ok' if diff is None else diff}", flush=True)
    print("failed:", bad)
