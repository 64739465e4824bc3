"""Side-by-side check of registered Spark queries against their DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of rows
(columns sorted by name), like the round's correctness gate.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

ALL_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in ALL_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", repr(float(v)))
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    if isinstance(v, bool):
        return ("i", str(int(v)))
    if isinstance(v, int):
        return ("i", str(v))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("s", str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out["duck_rows"] = len(d_rows)
    out["duck_sec"] = round(time.time() - t1, 2)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"schema {sorted(s_cols)} != {sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(a) != len(b):
        out["status"] = "rowcount"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        out["status"] = f"values ({len(diff)} rows differ) e.g. {diff[:2]}"
    else:
        out["status"] = "ok"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from reviewlens.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        try:
            r = compare(spark, con, sf_dir, n, qs[n], orc.get(n))
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"error {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"# {bad} failing of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
