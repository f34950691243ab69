"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python scripts/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (doubles rounded
to 9 significant digits for the comparison only).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    import duckdb
    from tavola.session import get_session
    from tavola.plans.registry import all_queries, all_oracles
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = all_queries(), all_oracles()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(norm(v) for v in r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = [tuple(norm(v) for v in r) for r in res.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns {sorted(cols)} vs {sorted(ocols)}")
            bad += 1
            continue
        idx = [ocols.index(c) for c in cols]
        orows = [tuple(r[i] for i in idx) for r in orows]
        s1, s2 = sorted(srows, key=key), sorted(orows, key=key)
        if s1 == s2:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            diff1 = [r for r in s1 if r not in set(s2)][:3]
            diff2 = [r for r in s2 if r not in set(s1)][:3]
            print(f"FAIL {name}: {len(s1)} vs {len(s2)} rows; spark-only {diff1}; sql-only {diff2}")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
