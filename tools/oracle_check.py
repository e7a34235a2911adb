"""Run registered queries in Spark and their oracle SQL in DuckDB on the
same parquet tables, and compare row counts, column names and values.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple(repr(x) for x in r))


def compare(spark, sf_dir, names=None, verbose=True):
    from rebuy.plans import catalog
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:300])
            if verbose:
                print(f"{name:32s} SPARK_ERROR {str(e)[:300]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows_only", len(srows))
            if verbose:
                print(f"{name:32s} rows_only n={len(srows)} {ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL_ERROR", str(e)[:300])
            if verbose:
                print(f"{name:32s} SQL_ERROR {str(e)[:300]}", flush=True)
            continue
        sc, sr = rows_of(scols, srows)
        dc, dr = rows_of(dcols, drows)
        if sc != dc:
            status = f"COLS {sorted(set(sc) ^ set(dc))}"
        elif len(sr) != len(dr):
            status = f"NROWS spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            bad = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            diffs = []
            for a, b in bad:
                diffs.append({sc[i]: (a[i], b[i]) for i in range(len(sc)) if a[i] != b[i]})
            status = f"VALUES {diffs}"
        else:
            status = "OK"
        results[name] = (status, len(sr))
        if verbose:
            print(f"{name:32s} {status[:400]} n={len(sr)} {ts:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from rebuy.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows_only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
