"""Run registered queries on Spark and their oracles on DuckDB; compare.

    python tools/compare.py [sf_dir] [name ...]

Prints one line per query: rows on each side and whether the sorted,
rounded rows are equal.  Used while developing; the pytest suite runs the
same comparison at sf0.001.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from trendlens.plans import catalog  # noqa: E402
from trendlens.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None):
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = rows_of([tuple(r) for r in df.collect()], s_cols)
        t1 = time.time()
        if name not in sqls:
            results[name] = (len(s_rows), None, None)
            print(f"{name:28s} spark={len(s_rows):7d} (no oracle) {t1 - t0:6.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        d_cols = [c[0] for c in cur.description]
        d_rows = rows_of(cur.fetchall(), d_cols)
        same_cols = sorted(s_cols) == sorted(d_cols)
        ok = same_cols and s_rows == d_rows
        results[name] = (len(s_rows), len(d_rows), ok)
        print(f"{name:28s} spark={len(s_rows):7d} duck={len(d_rows):7d} cols={'ok' if same_cols else 'DIFF'} "
              f"{'MATCH' if ok else 'MISMATCH'} {t1 - t0:6.1f}s", flush=True)
        if not same_cols:
            print("   spark cols", sorted(s_cols), "\n   duck cols ", sorted(d_cols))
        elif not ok:
            sd = set(s_rows) - set(d_rows)
            ds = set(d_rows) - set(s_rows)
            print("   spark-only", list(sd)[:3], "\n   duck-only ", list(ds)[:3])
    return results


if __name__ == "__main__":
    from trendlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    compare(spark, sf, sys.argv[2:] or None)
