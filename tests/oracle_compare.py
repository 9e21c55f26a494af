"""Compare a registered Spark query with its DuckDB oracle.

Same rules as the driver's gate: column names sorted, row count, and an
order-insensitive multiset of row values.  Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from farebox.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if os.environ.get("ORACLE_EXACT") else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


_TYPE_MAP = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
}


def _same_type(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("decimal"):
        return duck_type.upper().replace(" ", "") == spark_type.upper().replace(" ", "")
    return _TYPE_MAP.get(spark_type, spark_type.upper()) == duck_type.upper()


def compare(spark, name: str, fn, sql: str, sf_dir: str, verbose: bool = True) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    s_types = dict(sdf.dtypes)
    d_rows = rel.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    out["rows_spark"], out["rows_duck"] = len(s_rows), len(d_rows)
    if not out["cols_match"]:
        out["ok"] = False
        out["detail"] = f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_set = Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
    d_set = Counter(tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows)
    out["ok"] = s_set == d_set
    out["type_mismatch"] = {
        c: (s_types[c], d_types[c]) for c in s_cols
        if c in d_types and not _same_type(s_types[c], d_types[c])
    }
    if not out["ok"]:
        only_s = list((s_set - d_set).elements())[:3]
        only_d = list((d_set - s_set).elements())[:3]
        out["detail"] = f"cols={sorted(s_cols)}\n  spark-only={only_s}\n  duck-only={only_d}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from farebox.plans.catalog import REGISTRY
    from farebox.session import get_spark

    spark = get_spark()
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if names and name not in names:
            continue
        if sql is None:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"[rows-only] {name}: {n} rows {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            r = compare(spark, name, fn, sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"[ERROR] {name}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            continue
        status = "ok" if r["ok"] else "MISMATCH"
        bad += 0 if r["ok"] else 1
        print(f"[{status}] {name}: rows {r['rows_spark']}/{r['rows_duck']} "
              f"spark {r['spark_sec']}s duck {r['duck_sec']}s", flush=True)
        if r.get("type_mismatch"):
            print(f"  types differ: {r['type_mismatch']}", flush=True)
        if not r["ok"]:
            print("  " + r.get("detail", ""), flush=True)
    print(f"done, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
