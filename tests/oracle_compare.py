"""Run a registered query and its DuckDB oracle and compare them.

Mirrors the driver's gate: column names sorted, row count, and an
order-insensitive comparison of the values.
"""

from __future__ import annotations

import datetime as dt
import os
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET TimeZone = '{os.environ.get('DUCK_TZ', 'UTC')}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _canon(v.item())
    except ImportError:
        pass
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple("" if x is None else str(x) for x in r))


def compare(spark, name: str, sf_dir: str, fn, sql: str | None, show: int = 3) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        return res
    con = duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["schema_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["schema_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        res["match"] = False
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:show]
        res["only_oracle"] = list(sb - sa)[:show]
        res["cols"] = sorted(s_cols)
    return res


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from reelhouse.session import build_session
    import __spark_entry__ as E

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, qs[n], os_.get(n))
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:2000]}
        ok = r.get("match", "rows-only" if "error" not in r else False)
        bad += ok is False
        print(("OK   " if ok is True else "ROWS " if ok == "rows-only" else "FAIL ") + n,
              {k: v for k, v in r.items() if k not in ("name",)}, flush=True)
    print("failures:", bad)
