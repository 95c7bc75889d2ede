"""Compare queries with their SQL in DuckDB: `python tests/oracle.py [sf] [name ...]`."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "nan")
        return (2, repr(v + 0.0 if v else 0.0))
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    return (1, str(v))


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, query, sql) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(x) for x in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = bag(got, df.columns), bag(want, names)
    if a != b:
        extra = [x for x in a if x not in set(b)][:2]
        missing = [x for x in b if x not in set(a)][:2]
        return f"rows {len(a)} vs {len(b)}; only ours {extra}; only sql {missing}"
    return None


def main() -> int:
    from tidegauge import plans
    from tidegauge.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    sf_dir = f"{DATA}/sf{sf}"
    con = connect(sf_dir)
    sql, bad = plans.all_sql(), 0
    for name, query in plans.all_queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in sql:
                why = compare(spark, con, sf_dir, query, sql[name])
            else:
                why = None if query(spark, sf_dir).count() > 0 else "no rows"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:600]}"
        bad += why is not None
        print(f"{'ok  ' if why is None else 'FAIL'} {name} {time.time() - t:.2f}s {why or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
