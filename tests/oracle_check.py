"""Run registered queries next to their SQL oracle (DuckDB) and compare
row count, column names and an order-insensitive value digest."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)  # exact: values are compared bit for bit
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        try:
            return v.replace(tzinfo=None).isoformat()
        except TypeError:
            return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr([_norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    hs, ls = digest(s_rows, s_cols)
    hd, ld = digest(d_rows, d_cols)
    info = dict(name=name, spark_rows=len(s_rows), oracle_rows=len(d_rows), cols_ok=ok_cols,
                hash_ok=hs == hd, sec=round(t1 - t0, 2))
    if not (ok_cols and hs == hd):
        info["spark_cols"] = s_cols
        info["oracle_cols"] = d_cols
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        info["only_spark"] = only_s
        info["only_oracle"] = only_d
    return info


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tablewright.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf).count()
            print({"name": name, "rows_only": n, "sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            info = compare(spark, name, fn, sqls[name], sf, con)
        except Exception as e:  # noqa: BLE001
            info = {"name": name, "error": repr(e)[:600]}
        ok = info.get("hash_ok") and info.get("cols_ok")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(info), flush=True)
    print("failures:", bad)
